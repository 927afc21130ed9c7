"""N-gram Jaccard self-join: rare-first prefix filtering with length, positional and suffix
filters, and the connected components of its links.

Words are runs of non-white-space (ASCII white space), A-Z lower-cased; a document's set holds
its distinct ``SHINGLE``-word shingles (the whole sequence if it has fewer words). Two documents
link when 100 * intersection >= SIMILARITY * union. Shingles are known by two independent 64-bit
hashes: the first finds the candidates, the second counts what a pair shares, and a class of
equal sets needs both, so unlike texts are told apart by 128 bits.

1. One pass over the texts profiles each document (set size, 128-bit set signature, histogram) and counts
   shingles into ``2 ** sketch_bits`` buckets (merged in two levels; a fixed size to broadcast).
   Documents with equal sets form a class, represented by the smallest doc_id.
2. Shingles are ordered globally by (bucket count, hash): rare ones first. Any common order
   keeps the join exact; the counts only make prefixes selective. A second pass emits each
   document's prefix, n - ceil(0.8 n) + 1 shingles. Documents can only link when their prefixes
   share a shingle, so only shingles with two prefixes or more are kept (one shuffle; postings
   of frequent shingles are salted, with as many salts as their bucket count asks for), and only representatives.
3. Pairs of such a posting list pass the length filter, the positional filter (the rest after
   both positions must still reach the overlap that the sizes ask for) and the suffix filter
   (the sets' Hamming distance is at least the sum of differences over RANGES hash ranges, a fixed
   partition in place of recursive pivots, fine enough that few unlike sets are gathered whole); each pair is verified once, on whole sets, which
   a pass over the texts gathers for the documents of such pairs only.
4. A posting list of n members is not expanded into n * n pairs. It is joined with one leader
   per round (first the member with the fewest rarer shingles before it, later any by hash);
   linked members then carry one component, and a list whose members are in one component is
   done. After ``ROUNDS`` rounds the lists that still span components are joined between
   different components: first their distinct (size, position) combinations, then the members of
   those combinations that can link. Every link between different components is found, and
   links inside one cannot change the result.

Defined results: null or wordless texts have n_shingles 0 and are their own component; equal
texts share a component; rows that repeat exactly give one output row each; rows that share a
doc_id but not the text are documents of their own (the join then runs on row numbers);
a null doc_id has a null component and links nothing; an empty table
gives no row; extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from edpanel.llm.common import drop_written, slices, tuned, written
from edpanel.llm.components import components
from edpanel.llm.tokens import SpanHash, _mix
from edpanel.llm.words import NOT_SPACE, SECOND_BASE, Words

SHINGLE = 5
SIMILARITY = 80  # percent
SKETCH_BITS = 20
SLICES = 64
RANGES = 256
MOST_IN_RANGE = 127  # counts are cut to a byte, which can only lower the differences
ROUNDS = 1
SLOT_BITS = 22
FREQUENT = 256  # postings above twice the mean bucket count from which a shingle is salted
MOST_UNSALTED = 1 << 20  # and at most so many in one window, whatever the mean
MOST_SALTS = 1 << 16
CLASS_ROWS = 1 << 20  # rows of the input per salt of a class, 64 salts at least


def shingle_sets(texts: pa.Array, span_hash: SpanHash) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    return _sets(Words(texts, span_hash, NOT_SPACE))


def _sets(found: Words) -> list[np.ndarray]:
    sizes = np.diff(found.word_bounds)
    at, hashes = found.windows(SHINGLE)
    lo = np.searchsorted(at, found.word_bounds)
    out = [np.unique(hashes[a:b]) for a, b in zip(lo[:-1].tolist(), lo[1:].tolist())]
    for length in range(1, SHINGLE):
        at, hashes = found.windows(length)
        for k in np.flatnonzero(sizes == length).tolist():
            out[k] = hashes[np.searchsorted(at, found.word_bounds[k])][None]
    return out


def prefix_length(n: np.ndarray | int):
    """Shingles of a set of ``n`` of which a linked set must share one."""
    return n - (SIMILARITY * n + 99) // 100 + 1


def _texts(df: DataFrame) -> DataFrame:
    text = F.col("text").cast("string")
    return df.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.md5(F.coalesce(text, F.lit(""))).alias("digest"))


def _profile(df: DataFrame, sketch_bits: int) -> DataFrame:
    """Per document (doc_id, digest, n, s1, s2, ranges), s1 and s2 being sums over its set of the two hashes, ranges being the histogram of its set over RANGES
    hash ranges, cut at MOST_IN_RANGE; per task its shingle counts as SLICES compressed rows."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span_hash, second, counts = SpanHash(), SpanHash(SECOND_BASE), np.zeros(1 << sketch_bits, np.uint32)
        names = ["doc_id", "digest", "n", "s1", "s2", "ranges", "slice", "salt", "counts"]
        for batch in slices(batches, 1 << 20):
            found = Words(batch.column("text"), span_hash, NOT_SPACE)
            sets = _sets(found)
            found.rehash(second)
            others = _sets(found)
            flat = np.concatenate(sets)
            counts += np.bincount((flat >> np.uint64(64 - sketch_bits)).astype(np.int64), minlength=1 << sketch_bits).astype(np.uint32)
            signed = [[int(x.sum(dtype=np.uint64)), int(y.sum(dtype=np.uint64))] for x, y in zip(sets, others)]
            s = np.array(signed, np.uint64).view(np.int64)
            n, sizes = batch.num_rows, np.array([len(x) for x in sets], np.int64)
            cell = np.repeat(np.arange(n), sizes) * RANGES + (flat % np.uint64(RANGES)).astype(np.int64)
            ranges = np.minimum(np.bincount(cell, minlength=n * RANGES), MOST_IN_RANGE).astype(np.int8)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("digest"), pa.array(sizes), pa.array(s[:, 0]), pa.array(s[:, 1]),
                                              pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * RANGES, pa.int32()), pa.array(ranges)),
                                              pa.nulls(n, pa.int32()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary())], names)
        if counts.any():
            parts, empty = np.split(counts, SLICES), pa.nulls(SLICES, pa.int64())
            yield pa.RecordBatch.from_arrays([empty, pa.nulls(SLICES, pa.string()), empty, empty, empty, pa.nulls(SLICES, pa.list_(pa.int8())), pa.array(range(SLICES), pa.int32()),
                                              pa.array([TaskContext.get().partitionId() % 16] * SLICES, pa.int32()),
                                              pa.array([zlib.compress(p.tobytes(), 1) for p in parts], pa.binary())], names)

    return df.mapInArrow(task, "doc_id long, digest string, n long, s1 long, s2 long, ranges array<tinyint>, slice int, salt int, counts binary")


def _rarity(profile: DataFrame, sketch_bits: int) -> np.ndarray:
    """Bucket counts of all shingles: 2 ** sketch_bits numbers, whatever the input's size."""

    def merge(group: pd.DataFrame, first: bool = False) -> pd.DataFrame:
        total = sum(np.frombuffer(zlib.decompress(c), np.uint32 if first else np.uint64).astype(np.uint64) for c in group["counts"])
        return pd.DataFrame({"slice": group["slice"].iloc[:1], "counts": [zlib.compress(total.tobytes(), 1)]})

    rows = profile.where("slice is not null").select("slice", "salt", "counts")
    halves = rows.groupBy("slice", "salt").applyInPandas(lambda g: merge(g, True), "slice int, counts binary")
    out = np.zeros((SLICES, (1 << sketch_bits) // SLICES), np.uint64)
    for r in halves.groupBy("slice").applyInPandas(lambda g: merge(g), "slice int, counts binary").collect():
        out[r.slice] = np.frombuffer(zlib.decompress(r.counts), np.uint64)
    return out.reshape(-1)


def _prefixes(df: DataFrame, rarity: np.ndarray, sketch_bits: int) -> DataFrame:
    """(doc, n, prefix, salts) of every document with shingles: its prefix, rare first, and for
    each of those shingles 0, or a salt by the document where the shingle is frequent."""
    shared = df.sparkSession.sparkContext.broadcast(rarity)
    frequent = int(min(2 * float(rarity.mean()) + FREQUENT, MOST_UNSALTED))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span_hash, counts = SpanHash(), shared.value
        for batch in slices(batches, 1 << 20):
            docs, sizes, prefixes, salts = [], [], [], []
            for doc, own in zip(batch.column("doc_id").to_pylist(), shingle_sets(batch.column("text"), span_hash)):
                if doc is None or not len(own):
                    continue
                often = counts[(own >> np.uint64(64 - sketch_bits)).astype(np.int64)]
                order = np.lexsort((own, often))[:prefix_length(len(own))]
                parts = np.minimum(often[order] // np.uint64(frequent) + np.uint64(1), np.uint64(MOST_SALTS))
                spread = 1 + (_mix(np.array([doc], np.int64).view(np.uint64)) % parts).astype(np.int32)
                docs.append(doc)
                sizes.append(len(own))
                prefixes.append(own[order].view(np.int64))
                salts.append(np.where(often[order] <= frequent, 0, spread))
            if docs:
                ends = pa.array(np.cumsum([0, *map(len, prefixes)]), pa.int32())
                yield pa.RecordBatch.from_arrays([
                    pa.array(docs, pa.int64()), pa.array(sizes, pa.int32()), pa.ListArray.from_arrays(ends, pa.array(np.concatenate(prefixes))),
                    pa.ListArray.from_arrays(ends, pa.array(np.concatenate(salts), pa.int32()))], ["doc", "n", "prefix", "salts"])

    return df.select("doc_id", "text").mapInArrow(task, "doc long, n int, prefix array<bigint>, salts array<int>")


def _slot(column: str) -> F.Column:
    return F.pmod(F.xxhash64(column), F.lit(1 << SLOT_BITS))


def slot_words(df: DataFrame, column: str) -> DataFrame:
    """(word, bits) of the hashed slots of ``column``: a bitmap of 2 ** (SLOT_BITS - 5) rows at most."""
    marks = df.select(_slot(column).alias("s")).selectExpr("cast(s div 32 as int) as word", "shiftleft(1L, cast(s % 32 as int)) as bit")
    return marks.groupBy("word").agg(F.bit_or("bit").alias("bits"))


def slot_split(df: DataFrame, words: DataFrame, column: str) -> tuple[DataFrame, DataFrame]:
    """The rows of ``df`` whose ``column`` is surely in none of the slots of ``words``, and the others: those in them and
    some more. The bitmap is of fixed size and broadcast, so ``df`` is not shuffled."""
    words = written(words, "slots").select(F.col("word").alias("_word"), F.col("bits").alias("_bits"))
    marked = df.withColumn("_slot", _slot(column)).join(F.broadcast(words), F.expr("cast(_slot div 32 as int) = _word"), "left")
    maybe = F.expr("coalesce(shiftright(_bits, cast(_slot % 32 as int)) & 1L, 0L) = 1L")
    return marked.where(~maybe).select(*df.columns), marked.where(maybe).select(*df.columns)


def _sets_of(df: DataFrame, docs: DataFrame) -> DataFrame:
    """(doc, shingles by the second hash) of the documents in ``docs`` (doc), and of some others. Hashed slots of the
    ids go to the tasks as a bitmap of fixed size, so most other texts are dropped at once."""
    bitmap = np.zeros(1 << (SLOT_BITS - 5), np.uint64)
    for r in slot_words(docs, "doc").toLocalIterator():  # 2 ** 17 rows at most
        bitmap[r.word] = r.bits
    shared = df.sparkSession.sparkContext.broadcast(bitmap)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span_hash, bits = SpanHash(SECOND_BASE), shared.value
        for batch in batches:
            slot = batch.column("slot").to_numpy(zero_copy_only=False)
            mine = (bits[slot // 32] >> (slot % 32).astype(np.uint64)) & np.uint64(1) > 0
            kept = batch.filter(pa.array(mine & batch.column("doc_id").is_valid().to_numpy(zero_copy_only=False)))
            for part in slices(iter([kept]), 1 << 20):
                found = Words(part.column("text"), span_hash, NOT_SPACE)
                found.rehash(span_hash)
                sets = _sets(found)
                ends = np.cumsum([0, *map(len, sets)])
                flat = pa.array(np.concatenate(sets).view(np.int64))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat)], ["doc", "shingles"])

    return df.select("doc_id", "text", _slot("doc_id").alias("slot")).mapInArrow(task, "doc long, shingles array<bigint>")


def _can_link(a: str, b: str) -> F.Column:
    """Length and positional filter of two postings of one shingle."""
    n, m, i, j = (F.col(f"{x}.{c}").cast("long") for c in ("n", "pos") for x in (a, b))
    small, large = F.least(n, m), F.greatest(n, m)
    return (100 * small >= SIMILARITY * large) & ((100 + SIMILARITY) * F.least(n - i, m - j) >= SIMILARITY * (n + m))


def _near(pairs: DataFrame, facts: DataFrame) -> DataFrame:
    """The pairs (a, b) that pass the suffix filter."""
    x = facts.select(F.col("doc").alias("a"), F.col("n").alias("n"), F.col("ranges").alias("ra"))
    y = facts.select(F.col("doc").alias("b"), F.col("n").alias("m"), F.col("ranges").alias("rb"))
    far = F.aggregate(F.zip_with("ra", "rb", lambda p, q: F.abs(p - q)), F.lit(0), lambda s, d: s + d)
    both = F.col("n") + F.col("m")
    return pairs.join(x, "a").join(y, "b").where((100 + SIMILARITY) * (both - far) >= 2 * SIMILARITY * both).select("a", "b")


def _verified(near: DataFrame, df: DataFrame) -> DataFrame:
    """The pairs (a, b) that link, by their whole sets."""
    docs = near.select(F.col("a").alias("doc")).union(near.select("b")).distinct()
    sets = written(_sets_of(df, docs), "sets")
    whole = (near.join(sets.select(F.col("doc").alias("b"), F.col("shingles").alias("sb")), "b")
             .join(sets.select(F.col("doc").alias("a"), F.col("shingles").alias("sa")), "a"))
    common = F.size(F.array_intersect("sa", "sb")).cast("long")
    union = F.size("sa").cast("long") + F.size("sb") - common
    links = written(whole.where(100 * common >= SIMILARITY * union).select("a", "b"), "links")
    drop_written(sets)
    return links


def _relabel(postings: DataFrame, labels: DataFrame | None) -> DataFrame:
    if labels is None:
        return postings.withColumn("comp", F.col("doc"))
    return (postings.join(labels.withColumnRenamed("node", "doc"), "doc", "left")
            .withColumn("comp", F.coalesce("label", "doc")).drop("label"))


def _merged(labels: DataFrame | None, links: DataFrame) -> DataFrame:
    """Labels after more links: components of the contracted links, carried to all nodes."""
    if labels is None:
        return components(links)
    a = labels.select(F.col("node").alias("a"), F.col("label").alias("la"))
    b = labels.select(F.col("node").alias("b"), F.col("label").alias("lb"))
    between = (links.join(a, "a", "left").join(b, "b", "left")
               .select(F.coalesce("la", "a").alias("a"), F.coalesce("lb", "b").alias("b")).distinct())
    tops = components(between).select(F.col("node").alias("top"), F.col("label").alias("best"))
    old = labels.join(tops, labels.label == tops.top, "left").select("node", F.coalesce("best", "label").alias("label"))
    new = tops.join(labels, labels.node == tops.top, "left_anti").select(F.col("top").alias("node"), F.col("best").alias("label"))
    return written(old.union(new), "labels")


def _joined(df: DataFrame, profile: DataFrame, sketch_bits: int, rounds: int) -> DataFrame:
    """(doc_id, digest, n_shingles, component_id) of rows whose doc_id tells unlike sets apart."""
    rows = profile.where("slice is null").select("doc_id", "digest", "n", "s1", "s2")
    # A class that many rows share meets them in as many tasks as it has salts among its rows.
    parts = max(64, rows.count() // CLASS_ROWS)
    rows = rows.withColumn("part", F.pmod(F.xxhash64("doc_id", "digest"), F.lit(parts)))
    classes = (rows.where("n > 0 and doc_id is not null").groupBy("n", "s1", "s2")
               .agg(F.min("doc_id").alias("class_id"), F.collect_set("part").alias("parts")))
    # One shuffle decides which prefix shingles are shared: a frequent one is, so its postings are
    # salted over tasks; a rare one has all its few postings in one window.
    entries = _prefixes(df, _rarity(profile, sketch_bits), sketch_bits)
    postings = (entries.select("doc", "n", F.posexplode(F.arrays_zip("prefix", "salts")).alias("pos", "p"))
                .select(F.col("p.prefix").alias("sh"), "doc", "n", "pos", F.col("p.salts").alias("salt")))
    postings = (postings.withColumn("c", F.count("*").over(Window.partitionBy("sh", "salt"))).where("c > 1 or salt > 0")
                .join(classes.select(F.col("class_id").alias("doc")), "doc", "left_semi"))
    postings = written(postings.select("sh", "doc", "n", "pos"), "postings")
    docs = written(postings.select("doc").distinct(), "candidates")
    facts = profile.where("n > 0").select(F.col("doc_id").alias("doc"), "n", "ranges").join(docs, "doc", "left_semi")
    facts = written(facts.dropDuplicates(["doc"]), "facts")

    labels = None
    for turn in range(rounds + 1):
        live = _relabel(postings, labels)
        first = F.col("pos") if turn == 0 else F.lit(0)  # the fewest rare shingles before it: the most like all others
        one = F.struct(first.alias("first"), F.xxhash64("doc", F.lit(turn)).alias("rank"), "doc", "n", "pos", "comp")
        lists = live.groupBy("sh").agg(F.min(one).alias("lead"), F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo != hi").select("sh", "lead")
        if turn < rounds:
            met = (live.select("sh", F.struct("doc", "n", "pos", "comp").alias("own")).join(lists, "sh")
                   .where((F.col("own.comp") != F.col("lead.comp")) & _can_link("own", "lead"))
                   .select(F.col("own.doc").alias("a"), F.col("lead.doc").alias("b")))
        else:
            met = _between(written(live.join(lists.select("sh"), "sh", "left_semi"), "rest"))
        near = written(_near(met.distinct(), facts), "near")
        if near.isEmpty():
            continue
        links = _verified(near, df)
        if not links.isEmpty():
            labels = _merged(labels, links)

    label = F.col("class_id")
    if labels is not None:
        classes = classes.join(labels.withColumnRenamed("node", "class_id"), "class_id", "left")
        label = F.coalesce("label", "class_id")
    spread = classes.select("n", "s1", "s2", label.alias("label"), F.explode("parts").alias("part"))
    own = F.when(F.col("doc_id").isNotNull(), F.coalesce("label", "doc_id"))
    return rows.join(spread, ["n", "s1", "s2", "part"], "left").select("doc_id", "digest", F.col("n").alias("n_shingles"), own.alias("component_id"))


def _between(rest: DataFrame) -> DataFrame:
    """(a, b) of different components that share a shingle and pass length and positional filter.
    Combinations of (size, position) within a list are joined before any members are."""
    kinds = rest.groupBy("sh", "n", "pos").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"))
    own = kinds.select("sh", F.struct("n", "pos", "lo", "hi").alias("own"))
    other = kinds.select("sh", F.struct("n", "pos", "lo", "hi").alias("lead"))
    # components differ somewhere unless both combinations hold the same single one
    alive = (F.col("own.lo") != F.col("lead.lo")) | (F.col("own.hi") != F.col("lead.hi")) | (F.col("own.lo") != F.col("own.hi"))
    fits = own.join(other, "sh").where(alive & _can_link("own", "lead")).select(
        "sh", F.col("own.n").alias("n"), F.col("own.pos").alias("pos"), F.col("lead.n").alias("n2"), F.col("lead.pos").alias("pos2"))
    a = rest.select("sh", "n", "pos", F.col("doc").alias("a"), F.col("comp").alias("comp_a"))
    b = rest.select("sh", F.col("n").alias("n2"), F.col("pos").alias("pos2"), F.col("doc").alias("b"), F.col("comp").alias("comp_b"))
    return a.join(fits, ["sh", "n", "pos"]).join(b, ["sh", "n2", "pos2"]).where("comp_a < comp_b").select("a", "b")


def linked_components(df: DataFrame, sketch_bits: int = SKETCH_BITS, rounds: int = ROUNDS) -> DataFrame:
    """One row per row of ``df`` (doc_id, text): doc_id, digest (of the text), n_shingles, component_id (smallest
    doc_id reachable by links) and group_id (one value per component, also where a doc_id repeats)."""
    tuned(df.sparkSession)
    df = _texts(df)
    profile = written(_profile(df, sketch_bits), "profile")
    sets = F.struct("n", "s1", "s2")
    unlike = (profile.where("slice is null and n > 0 and doc_id is not null").groupBy("doc_id")
              .agg(F.min(sets).alias("lo"), F.max(sets).alias("hi")).where("lo != hi"))
    if unlike.isEmpty():
        return _joined(df, profile, sketch_bits, rounds).withColumn("group_id", F.col("component_id"))
    drop_written(profile)
    keyed = written(df.withColumn("row", F.when(F.col("doc_id").isNotNull(), F.monotonically_increasing_id())), "keyed")
    rows = keyed.select(F.col("row").alias("doc_id"), "text", "digest")
    found = _joined(rows, written(_profile(rows, sketch_bits), "profile"), sketch_bits, rounds)
    named = found.join(keyed.where("row is not null").select(F.col("row").alias("doc_id"), F.col("doc_id").alias("name")), "doc_id", "left").select(
        F.col("name").alias("doc_id"), "digest", "n_shingles", F.col("component_id").alias("group_id"))
    named = written(named, "named")
    least = named.where("group_id is not null").groupBy("group_id").agg(F.min("doc_id").alias("component_id"))
    return named.join(least, "group_id", "left").select("doc_id", "digest", "n_shingles", "component_id", "group_id")
