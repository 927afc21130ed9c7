"""Operational queries: file catalog, skip and URL-change signals, archive, manifest,
staging replace, run audit, retention (A5, B1–B3, B7, B8, B10, D1, D2).

Inputs derived from the driver tables:

- resolved source files = ``pages``: source = URL host, sha256 of the page body, file
  name from the URL; pages with ``page_id`` divisible by 3 are already catalogued.
- run audit events = ``events``: run = user, status = event type, rows = value.

Writers put their output under the shared checkpoint folder (``spark.checkpoint.dir``),
in a new folder per call, and the query reads the written table back.
"""

from __future__ import annotations

import functools
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from edpanel.functions import columns as C
from edpanel.operators import changes, links, sinks
from edpanel.plans import analogue, ingest, revisions
from edpanel.session import scratch_path
from edpanel.sources import seeds
from edpanel.sources.registry import DEFAULT_SCHEMA_VERSION
from edpanel.sources.tables import read_table
from edpanel.streaming.ingest import ingest_rows_available
from edpanel.streaming.run import LANDING, run_available

HOST_PATTERN = r"^[a-zA-Z][a-zA-Z0-9+.\-]*://([^/?#:]*)"
CATALOGUED_EVERY = 3
ARCHIVE_DATES = ("2001-12-13", "2001-12-14", "2001-12-15")      # analogue ingest dates, by page id (fixed values)
ARCHIVE_KEEP_DAYS = 1
INGEST_TIMESTAMP = "2001-12-15T08:00:00+00:00"
ARCHIVE_PREFIX = "raw"
MANIFEST_FIELDS = ("source_name", "source_url", "original_filename", "data_month", "ingest_timestamp", "size_bytes",
                   "sha256", "raw_storage_path", "schema_version", "row_count")
RETENTION_AS_OF = "2024-01-31"
RETENTION_DAYS = 14


def resolved_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read_table(spark, sf_dir, "pages", "page_id", "url", "html")
    return p.select("page_id", F.regexp_extract("url", HOST_PATTERN, 1).alias("source_name"),
                    F.sha2("html", 256).alias("sha256"), C.url_filename("url").alias("original_filename"),
                    F.col("url").alias("resolved_url"))


def _catalog(files: DataFrame) -> DataFrame:
    return files.where(F.pmod("page_id", F.lit(CATALOGUED_EVERY)) == 0).select(
        "source_name", "sha256", "original_filename", "resolved_url")


def file_skip(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = resolved_files(spark, sf_dir)
    return changes.file_skip(files, _catalog(files)).select("page_id", "source_name", "sha256", "action")


def catalog_insert_ignore(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = resolved_files(spark, sf_dir)
    return changes.catalog_insert_ignore(_catalog(files), files.drop("page_id"))


URL_BUCKET_PAGES = 10_000            # page ids per bucket: the most rows one window holds


def url_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = resolved_files(spark, sf_dir)
    return changes.url_change(files, "source_name", "page_id", "resolved_url",
                              F.floor(F.col("page_id") / URL_BUCKET_PAGES)).select(
        "page_id", "source_name", "resolved_url", "previous_url", "url_changed")


def _downloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as a downloaded file with its bytes and ingest date."""
    p = read_table(spark, sf_dir, "pages", "page_id", "url", "html")
    dates = F.array(*[F.lit(d) for d in ARCHIVE_DATES])
    files = p.select("page_id", F.regexp_extract("url", HOST_PATTERN, 1).alias("source_name"), F.col("url").alias("source_url"),
                     C.url_filename("url").alias("original_filename"), F.encode("html", "UTF-8").alias("content"),
                     F.size(F.regexp_extract_all("html", F.lit(ROW_PATTERN), F.lit(0))).cast("long").alias("row_count"),
                     F.get(dates, F.pmod("page_id", F.lit(len(ARCHIVE_DATES))).cast("int")).alias("ingest_date"))
    return links.content_hashes(files, "content")


ROW_PATTERN = "<p>"                      # a page's paragraphs stand for the rows of a file


def manifest(spark: SparkSession, sf_dir: str, prefix: str = ARCHIVE_PREFIX) -> DataFrame:
    """One manifest document of ten keys per downloaded page (B2)."""
    files = _downloads(spark, sf_dir).withColumns({
        "data_month": F.substring("ingest_date", 1, 7), "ingest_timestamp": F.lit(INGEST_TIMESTAMP),
        "schema_version": F.lit(DEFAULT_SCHEMA_VERSION),
        "raw_storage_path": F.concat(F.lit(f"{prefix}/ingest_date="), "ingest_date", F.lit("/"), "original_filename")})
    return sinks.manifest_json(files, MANIFEST_FIELDS).select("page_id", "raw_storage_path", "manifest")


def archive_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archive every page's bytes under ``ingest_date=`` twice, the rerun adding nothing (B1),
    then read each ingest date back by partition filter and hash its bytes anew (A5)."""
    root = scratch_path(spark, f"raw_archive/{uuid.uuid4().hex}")
    key = ["ingest_date", "source_name", "original_filename", "sha256"]
    raw = _downloads(spark, sf_dir).select(*key, "size_bytes", "content")
    for _ in range(2):
        sinks.archive_new(raw, root, "ingest_date", key)
    parts = [links.read_archived(spark, root, d) for d in ARCHIVE_DATES]
    back = functools.reduce(DataFrame.unionByName, parts)
    return links.content_hashes(back, "content").select(F.col("ingest_date").cast("string").alias("ingest_date"), *key[1:], "size_bytes")


def staging_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Load the first release, then replace only the periods the revised release changed
    (B3 + D5); read the staging table back."""
    path = scratch_path(spark, f"staging/{uuid.uuid4().hex}")
    first = revisions.staged(spark, sf_dir, "first")
    revised = revisions.staged(spark, sf_dir, "revised")
    cols = [c for c in first.columns if c != "row_hash"]
    sinks.replace_periods(first.select(*cols), path)
    changed = revisions.changed_periods(spark, sf_dir)
    sinks.replace_periods(revised.select(*cols).join(changed, "period_date", "left_semi"), path)
    return spark.read.parquet(path).select(*cols)


def run_audit_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read_table(spark, sf_dir, "events", "ts", "user_id", "event_type", "value", "props")
    ev = e.select(F.col("user_id").alias("run_id"), F.col("ts").alias("event_ts"), F.col("event_type").alias("status"),
                  F.floor("value").cast("bigint").alias("rows_loaded"), F.col("props").alias("notes"))
    return sinks.run_audit_latest(ev)


def retention_prune(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read_table(spark, sf_dir, "events", "event_id", "ts")
    return sinks.retention_prune(e, "ts", RETENTION_AS_OF, RETENTION_DAYS)


def retention_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The archive of all pages, one folder per ingest date, after the folders before the retention
    window were dropped (twice, the rerun dropping nothing)."""
    root = scratch_path(spark, f"raw_archive/{uuid.uuid4().hex}")
    sinks.append_partitioned(_downloads(spark, sf_dir).select("page_id", "ingest_date", "size_bytes", "sha256"), root, "ingest_date")
    for _ in range(2):
        sinks.drop_expired_partitions(spark, root, "ingest_date", ARCHIVE_DATES[-1], ARCHIVE_KEEP_DAYS)
    kept = spark.read.schema("page_id long, size_bytes long, sha256 string, ingest_date string").parquet(root)
    return kept.select("page_id", "ingest_date", "size_bytes", "sha256")


def table_file_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1: size and SHA-256 of every file of the given tables (files without a byte aside)."""
    return links.file_hashes(spark, f"{sf_dir.rstrip('/')}/*.parquet").select("file_name", "size_bytes", "sha256")


SEED_SCHEMA = "provider_key long, trust_code string, trust_name string, icb_name string"


def seed_provider(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The provider reference as a CSV seed, written and read back under its schema."""
    path = scratch_path(spark, f"seeds/{uuid.uuid4().hex}")
    seeds.write_seed(analogue.build_dim_provider(spark, sf_dir).select("provider_key", "trust_code", "trust_name", "icb_name"), path)
    return seeds.read_seed(spark, path, SEED_SCHEMA)


def stream_ingest_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages land as files in two drops, the second of which repeats the first under new
    file names; each availableNow run catalogues only content not seen before."""
    root = scratch_path(spark, f"stream/{uuid.uuid4().hex}")
    files, landed = _downloads(spark, sf_dir), ["source_name", "file_name", "content"]
    early = files.where(F.pmod("page_id", F.lit(2)) == 0).withColumn("file_name", F.col("original_filename"))
    every = files.withColumn("file_name", F.concat(F.lit("again_"), "original_filename"))
    for drop in (early.select(*landed), every.select(*landed)):
        drop.write.mode("append").parquet(f"{root}/landing")
        cat = ingest_rows_available(spark, f"{root}/landing", f"{root}/catalog", f"{root}/checkpoint")
    return cat.select("source_name", "size_bytes", "sha256")


def land_release(spark: SparkSession, sf_dir: str, release: str, published_at: str, landing: str, months: F.Column | None = None) -> None:
    """One release of the workbooks (those that the condition ``months`` on file holds for, all where not given) as landed rows;
    a workbook lies in one Parquet file."""
    texts = ingest.release_texts(spark, sf_dir, release)
    rows = (texts if months is None else texts.where(months)).select(F.lit("monthly").alias("source_name"), F.col("file").alias("file_name"), F.concat(F.lit(f"https://files.example/{release}/"), "file").alias("source_url"),
                        changes.ts_literal(published_at).alias("published_at"), "sheet", F.col("first_row").cast("int").alias("first_row"), "text")
    rows.repartition("file_name").write.mode("append").parquet(landing)


def land_again(spark: SparkSession, published_at: str, landing: str) -> None:
    """All workbooks landed so far land once more under the same names, as published at ``published_at``."""
    rows = spark.read.schema(LANDING).parquet(landing).withColumn("published_at", changes.ts_literal(published_at))
    rows.repartition("file_name").write.mode("append").parquet(landing)


def scheduled_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first release lands and is loaded, then all of it lands again under the same names together with
    the revised one; the second run skips what it knows and merges the rest. Returns the version table."""
    root = scratch_path(spark, f"run/{uuid.uuid4().hex}")
    land_release(spark, sf_dir, "first", revisions.T_FIRST, f"{root}/landing")
    run_available(spark, f"{root}/landing", f"{root}/warehouse")
    land_again(spark, revisions.T_REVISED, f"{root}/landing")
    land_release(spark, sf_dir, "revised", revisions.T_REVISED, f"{root}/landing")
    house = run_available(spark, f"{root}/landing", f"{root}/warehouse")
    return house.versions().select("period_date", "org_code", "org_name", "attendances_total", "breaches_total", "row_hash", "valid_from", "valid_to", "is_current")
