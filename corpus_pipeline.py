"""The corpus pipeline: language ID, near-duplicate removal, benchmark decontamination, secret
redaction and packing, each stage written as Parquet and read again by the next.

Every stage but the last returns the columns of ``documents``; a stage sees all rows that the
one before it kept. Empty inputs pass through all stages as empty tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from edpanel.llm import decontam, langid, ngram_join, packing, secret_scan
from edpanel.llm.common import tuned, written
from edpanel.llm.queries import learned
from edpanel.sources.tables import read_table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


#: Languages that the corpus is built from; a document in another language is rejected.
WANTED = ("de", "en", "es", "fr")


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a wanted language, by the network's label; those without letters go. The label
    also fills a missing ``lang``. Where no row is labelled nothing is learned, and all documents with letters stay."""
    model = learned(docs)
    if model is None:
        return docs.where(langid.has_letter())
    found = langid.predict(docs, model).where(F.col("lang_pred").isin(*WANTED))
    return found.withColumn("lang", F.coalesce("lang", "lang_pred")).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by n-gram Jaccard similarity: the smallest doc_id, and of rows that share
    it the one with the smallest text digest. Rows are told apart by (doc_id, text digest), so unlike texts under one
    doc_id are documents of their own. Null ids and texts without words are never linked and stay."""
    links = ngram_join.linked_components(docs)
    key = ["doc_id", "digest"]
    least = links.where("n_shingles > 0 and doc_id = component_id")
    twins = written(least.groupBy("doc_id", "group_id").agg(F.count("*").alias("rows"), F.min("digest").alias("kept")).where("rows > 1"), "twins")
    lost = written(links.where("doc_id > component_id").select(*key).union(
        least.join(twins, ["doc_id", "group_id"]).where("digest > kept").select(*key)).distinct(), "lost")
    again = twins.select("doc_id", F.col("kept").alias("digest"))
    # Only rows that may be lost or repeated are joined, so most texts are not shuffled.
    marks = ngram_join.slot_words(lost.select("doc_id").union(again.select("doc_id")), "doc_id")
    sure, rest = ngram_join.slot_split(docs, marks, "doc_id")
    kept = rest.withColumn("digest", F.md5(F.coalesce("text", F.lit("")))).join(lost, key, "left_anti")
    if twins.isEmpty():
        return sure.unionByName(kept.select(*docs.columns))
    once = kept.join(again, key, "left_semi").groupBy(*key).agg(F.min(F.struct(*docs.columns)).alias("row")).select("row.*")
    return sure.unionByName(kept.join(again, key, "left_anti").select(*docs.columns)).unionByName(once)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by the benchmark."""
    return decontam.remove_documents(docs, read_table(spark, sf_dir, "benchmark", "item_id", "text"))


def redacted(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets in their text replaced; n_chars follows where the text changed."""
    out = secret_scan.redact(docs.withColumn("_before", F.col("text")))
    return out.withColumn("n_chars", F.when(F.col("text").eqNullSafe(F.col("_before")), F.col("n_chars"))
                          .otherwise(F.length("text")).cast("long")).select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 1024 ids as pieces of documents."""
    pieces = packing.pack(docs)
    return pieces.withColumn("ids_crc32", F.crc32("ids"))


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("language_id", language), ("ngram_jaccard_join", near_duplicates), ("benchmark_decontamination", decontaminated),
    ("secret_scan", redacted), ("packing", packed)]

#: The learned language model, the tokenizer and the packing order have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read back."""
    docs = read_table(tuned(spark), sf_dir, "documents", *COLUMNS)
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
