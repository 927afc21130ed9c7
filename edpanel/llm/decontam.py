"""Benchmark decontamination: which words of a document lie in a benchmark window.

Words are maximal runs of ``0-9``, ``a-z`` (after lower-casing A-Z) and characters from U+0080
on. A window is ``window`` consecutive words of a benchmark item; an item of fewer words, but
not none, is one window. The windows' 64-bit hashes are broadcast as a sorted array where the
measured size of the benchmark is within ``broadcast_bytes``; tasks roll the same hash over
all windows of their texts and compare the words of every hit before it counts: within
``DICT_BYTES`` the words themselves go along. A larger benchmark sends its hashes only, 8 bytes a window, and the few windows
whose hash is met are joined to the benchmark's on hash and words; past ``broadcast_bytes`` of
hashes all windows of both sides are joined.

Defined results: null or wordless texts have no words and no hits; wordless items match
nothing; repeated rows are scanned one by one; items with equal text are all reported; a null
``item_id`` is an item like others, reported as one null after the named ones; an empty table on either side gives no hits; columns that clash with result names are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from edpanel.llm.common import slices, tuned, written
from edpanel.llm.tokens import SpanHash
from edpanel.llm.words import Words

WINDOW = 13
BROADCAST_BYTES = 64 << 20
DICT_BYTES, DICT_FACTOR = 64 << 20, 128  # the dictionary of windows takes about 112 bytes a byte of text
CONTAMINATED_RATIO = 20  # contaminated when 20 * hit words >= words

RESULT = [("n_words", "long"), ("n_hit", "long"), ("item_ids", "array<string>"), ("hit_spans", "array<array<long>>")]


def item_windows(items: list[str | None], texts: pa.Array, window: int) -> dict[int, dict[int, dict[tuple, list[str | None]]]]:
    """By length and hash: the words of each window and the items that hold it."""
    out: dict[int, dict[int, dict[tuple, list[str | None]]]] = {}
    found = Words(texts, SpanHash())
    sizes = np.diff(found.word_bounds)
    for length in sorted({min(window, int(n)) for n in sizes if n}):
        at, hashes = found.windows(length)
        owner = np.searchsorted(found.word_bounds, at, side="right") - 1
        for a, h, k in zip(at.tolist(), hashes.tolist(), owner.tolist()):
            if min(window, sizes[k]) == length:
                held = out.setdefault(length, {}).setdefault(h, {}).setdefault(found.words(a, length), [])
                if not held or held[-1] != items[k]:  # an item's windows come in a row
                    held.append(items[k])
    return out


def _report(found: Words, k: int, hits: list[tuple[int, int, list[str | None]]]) -> tuple[int, list[str | None], list[list[int]]]:
    """Hit words, items and code point spans of text ``k`` from its (word, length, items)."""
    lo, hi = found.word_bounds[k], found.word_bounds[k + 1]
    mark = np.zeros(hi - lo + 1, np.int64)
    for at, length, _ in hits:
        mark[at - lo] += 1
        mark[at - lo + length] -= 1
    covered = np.cumsum(mark)[:-1] > 0
    edges = np.flatnonzero(np.diff(np.concatenate([[0], covered.astype(np.int8), [0]])))
    begin = found.bounds[k]
    points = np.concatenate([[0], np.cumsum((found.data[begin:found.bounds[k + 1]] & 0xC0) != 0x80)])
    spans = [[int(points[found.starts[lo + a] - begin]), int(points[found.ends[lo + b - 1] - begin])]
             for a, b in zip(edges[::2], edges[1::2])]
    return int(covered.sum()), sorted({i for _, _, items in hits for i in items}, key=lambda i: (i is None, i or "")), spans


def _scan_broadcast(docs: DataFrame, rows: list, window: int, fields: list) -> DataFrame:
    windows = item_windows([r.item_id for r in rows], pa.array([r.text for r in rows], pa.string()), window)
    shared = docs.sparkSession.sparkContext.broadcast(windows)
    schema = docs.schema
    for name, kind in fields:
        schema = T.StructType([*schema.fields, T.StructField(name, T._parse_datatype_string(kind))])
    arrow_types = [pa.int64(), pa.int64(), pa.list_(pa.string()), pa.list_(pa.list_(pa.int64()))]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        sorted_hashes = {n: np.sort(np.fromiter(h, np.uint64, len(h))) for n, h in known.items()}
        span_hash = SpanHash()
        for batch in slices(batches, 1 << 20):
            found = Words(batch.column("text"), span_hash)
            hits: dict[int, list] = {}
            for length, listed in sorted_hashes.items():
                at, hashes = found.windows(length)
                place = np.minimum(np.searchsorted(listed, hashes), len(listed) - 1)
                for a, h in zip(at[listed[place] == hashes].tolist(), hashes[listed[place] == hashes].tolist()):
                    items = known[length][h].get(found.words(a, length))
                    if items:
                        k = int(np.searchsorted(found.word_bounds, a, side="right")) - 1
                        hits.setdefault(k, []).append((a, length, items))
            n = batch.num_rows
            hit, ids, spans = np.zeros(n, np.int64), [[] for _ in range(n)], [[] for _ in range(n)]
            for k, own in hits.items():
                hit[k], ids[k], spans[k] = _report(found, k, own)
            new = [np.diff(found.word_bounds), hit, ids, spans]
            arrays = [*batch.columns, *(pa.array(x, t) for x, t in zip(new, arrow_types))]
            yield pa.RecordBatch.from_arrays(arrays, [*batch.schema.names, *(name for name, _ in fields)])

    return docs.mapInArrow(task, schema)


def _windows_of(df: DataFrame, key: str, lengths: list[int] | None, window: int, only: dict[int, np.ndarray] | None = None) -> DataFrame:
    """(key, pos, length, hash, words) of all windows of the texts; with ``lengths`` of these
    lengths, else of the item rule. With ``only``, of the windows whose hash is listed."""
    shared = df.sparkSession.sparkContext.broadcast(only)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span_hash = SpanHash()
        for batch in slices(batches, 1 << 18):
            found = Words(batch.column("text"), span_hash)
            sizes, keys = np.diff(found.word_bounds), np.array(batch.column(key).to_pylist(), object)
            for length in lengths or sorted({min(window, int(n)) for n in sizes if n}):
                at, hashes = found.windows(length)
                owner = np.searchsorted(found.word_bounds, at, side="right") - 1
                if lengths is None:
                    mine = np.minimum(window, sizes[owner]) == length
                    at, hashes, owner = at[mine], hashes[mine], owner[mine]
                if shared.value is not None:
                    listed = shared.value[length]
                    mine = listed[np.minimum(np.searchsorted(listed, hashes), len(listed) - 1)] == hashes
                    at, hashes, owner = at[mine], hashes[mine], owner[mine]
                yield pa.RecordBatch.from_pydict({
                    "key": pa.array(keys[owner].tolist(), pa.string()), "pos": at - found.word_bounds[owner],
                    "length": np.full(len(at), length, np.int64), "hash": hashes.view(np.int64),
                    "words": pa.array([b" ".join(found.words(a, length)) for a in at.tolist()], pa.binary())})

    return df.select(F.col(key).cast("string").alias(key), "text").mapInArrow(
        task, "key string, pos long, length long, hash long, words binary")


def _scan_joined(docs: DataFrame, bench: DataFrame, window: int, fields: list, broadcast_bytes: int) -> DataFrame:
    """The same result by a shuffle join on window hashes. Equal rows share one scan; a row's
    hits are bounded by its own words and items."""
    items = _windows_of(bench, "item_id", None, window).select("length", "hash", "words", F.col("key").alias("item"))
    items = written(items, "windows")
    counts = {r.length: r["count"] for r in items.groupBy("length").count().collect()}  # at most ``window`` rows
    lengths, only = sorted(counts), None
    if 8 * sum(counts.values()) <= broadcast_bytes:
        listed = items.select("length", "hash").distinct().toArrow()
        of, hashes = listed["length"].to_numpy(), listed["hash"].to_numpy().view(np.uint64)
        only = {n: np.sort(hashes[of == n]) for n in lengths}
        only = only or {window: np.zeros(1, np.uint64)}
    keyed = docs.withColumn("_row", F.sha2(F.coalesce("text", F.lit("")), 256))
    texts = keyed.select("_row", "text").dropDuplicates(["_row"])
    hits = (_windows_of(texts, "_row", lengths or [window], window, only).join(items, ["length", "hash", "words"])
            .groupBy("key").agg(F.collect_set(F.struct("pos", "length", "item")).alias("hits")))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span_hash = SpanHash()
        for batch in slices(batches):
            found = Words(batch.column("text"), span_hash)
            out = [_report(found, k, [(found.word_bounds[k] + h["pos"], h["length"], [h["item"]]) for h in own or []])
                   for k, own in enumerate(batch.column("hits").to_pylist())]
            yield pa.RecordBatch.from_pydict({
                "_row": batch.column("_row"), fields[0][0]: np.diff(found.word_bounds), fields[1][0]: pa.array([o[0] for o in out], pa.int64()),
                fields[2][0]: pa.array([o[1] for o in out], pa.list_(pa.string())),
                fields[3][0]: pa.array([o[2] for o in out], pa.list_(pa.list_(pa.int64())))})

    result = texts.join(hits.withColumnRenamed("key", "_row"), "_row", "left").mapInArrow(
        task, "_row string, " + ", ".join(f"{n} {t}" for n, t in fields))
    return keyed.join(result, "_row").drop("_row")


def scan(docs: DataFrame, bench: DataFrame, window: int = WINDOW, broadcast_bytes: int = BROADCAST_BYTES, dict_bytes: int = DICT_BYTES) -> DataFrame:
    """``docs`` with n_words, n_hit, item_ids (sorted, a null last) and hit_spans (code points of
    the runs of hit words). ``bench`` has item_id and text."""
    tuned(docs.sparkSession)
    docs = docs.drop(*(name for name, _ in RESULT))
    docs = docs.withColumn("text", F.col("text").cast("string"))
    bench = bench.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text")).where("text is not null")
    measured = bench.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("n")).first().n * DICT_FACTOR
    if measured <= min(dict_bytes, broadcast_bytes):
        return _scan_broadcast(docs, bench.collect(), window, RESULT)
    return _scan_joined(docs, bench, window, RESULT, broadcast_bytes)


def contaminated() -> F.Column:
    """The contract's rule over the columns of :func:`scan`."""
    return (F.col("n_hit") > 0) & (F.lit(CONTAMINATED_RATIO) * F.col("n_hit") >= F.col("n_words"))


def remove_documents(docs: DataFrame, bench: DataFrame, **options) -> DataFrame:
    """Documents that are not contaminated, with the columns of ``docs``."""
    return scan(docs, bench, **options).where(~contaminated()).select(*docs.columns)


def remove_spans(docs: DataFrame, bench: DataFrame, **options) -> DataFrame:
    """All documents, without the runs of hit words."""
    found = scan(docs, bench, **options)
    n = F.size("hit_spans")
    kept = F.transform(F.sequence(F.lit(0), n), lambda k: F.call_function(
        "substring", F.col("text"), F.when(k == 0, 1).otherwise(F.get(F.get("hit_spans", k - 1), F.lit(1)) + 1).cast("int"),
        F.when(k == n, F.length("text")).otherwise(
            F.get(F.get("hit_spans", k), F.lit(0)) - F.when(k == 0, 0).otherwise(F.get(F.get("hit_spans", k - 1), F.lit(1)))).cast("int")))
    return found.withColumn("text", F.when(n == 0, F.col("text")).otherwise(F.array_join(kept, ""))).select(*docs.columns)
