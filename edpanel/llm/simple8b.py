"""Token-id files in Simple-8b word-aligned coding.

Documents are range-partitioned by ``doc_id`` and sorted; each task encodes its texts and
writes files of at most ``file_ids`` ids. A file:

- header: magic ``S8B1``, then little-endian uint64 counts of documents, ids, blocks, words;
- ``doc_id`` int64, a validity byte and the id count (uint64) of every document;
- per block of ``BLOCK`` ids the position of its first word (uint64);
- the 64-bit words.

A word holds a selector in its top 4 bits and ``count`` ids of ``width`` bits below them.
Selector 0 is the escape: the next word is one raw value of up to 64 bits. A block's last
word may hold fewer ids than its selector says; the block size tells how many count. Since
blocks start at known words, they decode independently and each with numpy only.

Defined results: a null text is empty (only the end id); a null ``doc_id`` is kept and sorts
first; rows that repeat are written as often as they occur, ties ordered by text; an empty
table gives no file and no row; extra columns are ignored.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from edpanel.llm.common import fresh_folder, slices, write_blob
from edpanel.llm.tokens import END_ID, encoder

BLOCK = 16_384
FILE_IDS = 2_000_000
# Fixed values of the coding: (ids per word, bits per id) of selectors 1 to 14.
WIDTHS = [(60, 1), (30, 2), (20, 3), (15, 4), (12, 5), (10, 6), (8, 7), (7, 8), (6, 10), (5, 12),
          (4, 15), (3, 20), (2, 30), (1, 60)]
_MAGIC = b"S8B1"
_HEAD = struct.Struct("<4sQQQQ")


def _pack(values: np.ndarray) -> np.ndarray:
    """The words of one block: at each value the selector with the most values that fit."""
    n = len(values)
    values = values.astype(np.uint64)
    bits = np.zeros(n + 64, np.uint8)
    if n:
        big = values >= np.uint64(1 << 52)
        bits[:n] = np.frexp(np.where(big, 0, values).astype(np.float64))[1]
        bits[:n][big] = [int(v).bit_length() for v in values[big]]
    run, have = {1: bits}, 1  # the largest width among the next k values, from doubled windows
    while have * 2 <= 60:
        prev = run[have]
        run[have * 2] = np.maximum(prev[:-have], prev[have:]) if len(prev) > have else prev[:0]
        have *= 2
    choice = np.zeros(n, np.uint8)
    for selector in range(len(WIDTHS), 0, -1):
        count, width = WIDTHS[selector - 1]
        p = 1 << (count.bit_length() - 1)
        top = run[p]
        # values past the end count as zero bits wide, so a block's last word is never forced apart
        a = np.zeros(n, np.uint8)
        a[:min(n, len(top))] = top[:n]
        if count > p:
            b = np.zeros(n, np.uint8)
            shifted = top[count - p:]
            b[:min(n, len(shifted))] = shifted[:n]
            a = np.maximum(a, b)
        choice[a <= width] = selector
    choice[bits[:n] > 60] = 0
    step = np.array([1] + [c for c, _ in WIDTHS], np.int64)[choice].tolist()
    starts, at = [], 0
    while at < n:
        starts.append(at)
        at += step[at]
    starts = np.array(starts, np.int64)
    chosen = choice[starts] if n else choice
    place = np.arange(len(starts)) + np.cumsum(chosen == 0) - (chosen == 0)
    words = np.zeros(len(starts) + int((chosen == 0).sum()), np.uint64)
    padded = np.concatenate([values, np.zeros(64, np.uint64)])
    for selector in np.unique(chosen).tolist():
        mine = np.flatnonzero(chosen == selector)
        if selector == 0:
            words[place[mine] + 1] = values[starts[mine]]
            continue
        count, width = WIDTHS[selector - 1]
        word = np.full(len(mine), selector << 60, np.uint64)
        for k in range(count):
            word |= padded[starts[mine] + k] << np.uint64(k * width)
        words[place[mine]] = word
    return words


def _unpack(words: np.ndarray, n: int) -> np.ndarray:
    """The ``n`` values of one block."""
    selector = (words >> np.uint64(60)).astype(np.int64)
    raw = np.zeros(len(words), bool)
    zero = np.flatnonzero(selector == 0)
    if len(zero):  # a raw word may look like anything: walk the escapes in order
        last = -1
        for at in zero.tolist():
            if at != last and not raw[at]:
                raw[at + 1], last = True, at + 1
        kept = np.flatnonzero(~raw)
    else:
        kept = np.arange(len(words))
    chosen = selector[kept]
    counts = np.array([1] + [c for c, _ in WIDTHS] + [0], np.int64)[chosen]
    start = np.cumsum(counts) - counts
    out = np.zeros(int(counts.sum()) + 64, np.uint64)
    for s in np.unique(chosen).tolist():
        mine = np.flatnonzero(chosen == s)
        if s == 0:
            out[start[mine]] = words[kept[mine] + 1]
            continue
        count, width = WIDTHS[s - 1]
        shift = np.arange(count, dtype=np.uint64) * np.uint64(width)
        out[start[mine][:, None] + np.arange(count)] = (words[kept[mine]][:, None] >> shift) & np.uint64((1 << width) - 1)
    return out[:n]


def encode_file(doc_ids: list[int | None], counts: np.ndarray, ids: np.ndarray) -> bytes:
    """The bytes of one file with these documents, in this order."""
    blocks = [_pack(ids[at:at + BLOCK]) for at in range(0, len(ids), BLOCK)]
    sizes = np.array([len(b) for b in blocks], np.uint64)
    offsets = np.cumsum(sizes) - sizes
    head = _HEAD.pack(_MAGIC, len(doc_ids), len(ids), len(blocks), int(sizes.sum()))
    return b"".join([head, np.array([d or 0 for d in doc_ids], "<i8").tobytes(),
                     bytes(d is not None for d in doc_ids), np.asarray(counts).astype("<u8").tobytes(),
                     offsets.astype("<u8").tobytes(), *(b.astype("<u8").tobytes() for b in blocks)])


def decode_file(data: bytes) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """``doc_id``s, id counts and all ids (uint64) of one file."""
    magic, n_docs, n_ids, n_blocks, n_words = _HEAD.unpack_from(data)
    if magic != _MAGIC:
        raise ValueError("not a token-id file")
    at = _HEAD.size
    docs = np.frombuffer(data, "<i8", n_docs, at)
    valid = data[at + 8 * n_docs:at + 9 * n_docs]
    at += 9 * n_docs
    counts = np.frombuffer(data, "<u8", n_docs, at).astype(np.int64)
    at += 8 * n_docs
    offsets = np.append(np.frombuffer(data, "<u8", n_blocks, at).astype(np.int64), n_words)
    words = np.frombuffer(data, "<u8", n_words, at + 8 * n_blocks)
    parts = [_unpack(words[offsets[b]:offsets[b + 1]], min(BLOCK, n_ids - b * BLOCK)) for b in range(n_blocks)]
    ids = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
    if len(ids) != n_ids or counts.sum() != n_ids:
        raise ValueError("a token-id file is cut off")
    return [int(d) if v else None for d, v in zip(docs, valid)], counts, ids


def write_ids(df: DataFrame, folder: str, tokenizer_path: str | None = None, end_id: int | None = END_ID,
              file_ids: int = FILE_IDS) -> DataFrame:
    """Write the ids of all ``text`` in ascending ``doc_id`` order under ``folder``; returns
    the written manifest (part, seq, file, n_docs, n_ids). ``file_ids`` bounds a file's ids,
    but for one document of more."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context, enc, seq = TaskContext.get(), encoder(tokenizer_path), 0
        docs: list[int | None] = []
        counts: list[np.ndarray] = []
        parts: list[np.ndarray] = []
        held = 0

        def file():
            nonlocal docs, counts, parts, held, seq
            ids = np.concatenate(parts)
            name = f"part-{context.partitionId():06d}-{seq:06d}.s8b"
            write_blob(folder, name, encode_file(docs, np.concatenate(counts), ids), context.taskAttemptId())
            row = pa.RecordBatch.from_pydict({"part": [context.partitionId()], "seq": [seq], "file": [name],
                                              "n_docs": [len(docs)], "n_ids": [len(ids)]})
            docs, counts, parts, held, seq = [], [], [], 0, seq + 1
            return row

        for batch in slices(batches):
            ids, sizes = enc.encode(batch.column("text"), end_id)
            docs += batch.column("doc_id").to_pylist()
            counts.append(sizes)
            parts.append(ids)
            held += len(ids)
            if held >= file_ids:
                yield file()
        if docs:
            yield file()

    rows = df.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # a doc_id that many rows share is split by text digest and scan position
    order = ["doc_id", "_digest", "_at"]
    ordered = rows.withColumns({"_digest": F.md5("text"), "_at": F.monotonically_increasing_id()}).repartitionByRange(*order).sortWithinPartitions(*order)
    manifest = ordered.select("doc_id", "text").mapInArrow(task, "part long, seq long, file string, n_docs long, n_ids long")
    path = f"{folder}/_manifest"
    manifest.write.parquet(path)
    return df.sparkSession.read.schema(manifest.schema).parquet(path)


def read_ids(spark: SparkSession, folder: str, with_ids: bool = True) -> DataFrame:
    """Documents read back from the files that the manifest lists: doc_id, start (ids of all
    documents before it), n_tokens, ids_crc32 and, ``with_ids``, ids (little-endian uint32)."""
    manifest = spark.read.parquet(f"{folder}/_manifest")
    inside = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    parts = manifest.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    starts = (manifest.withColumn("within", F.coalesce(F.sum("n_ids").over(inside), F.lit(0)))
              .join(parts.select("part", F.coalesce(before, F.lit(0)).alias("before")), "part")
              .select("file", (F.col("before") + F.col("within")).alias("file_start")))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, data in zip(batch.column("file").to_pylist(), batch.column("content")):
                docs, counts, ids = decode_file(data.as_buffer().to_pybytes())
                ids, ends = ids.astype("<u4"), np.cumsum(counts)
                raw = memoryview(ids.tobytes())
                own = [raw[4 * (e - c):4 * e] for e, c in zip(ends.tolist(), counts.tolist())]
                for at in range(0, len(docs), 2000):
                    to = at + 2000
                    out = {"file": [name] * len(docs[at:to]), "doc_id": pa.array(docs[at:to], pa.int64()),
                           "within": (ends - counts)[at:to], "n_tokens": counts[at:to],
                           "ids_crc32": [zlib.crc32(x) for x in own[at:to]]}
                    if with_ids:
                        out["ids"] = pa.array([bytes(x) for x in own[at:to]], pa.binary())
                    yield pa.RecordBatch.from_pydict(out)

    schema = "file string, doc_id long, within long, n_tokens long, ids_crc32 long" + ", ids binary" * with_ids
    files = (spark.read.format("binaryFile").option("pathGlobFilter", "*.s8b").load(folder)
             .select(F.element_at(F.split("path", "/"), -1).alias("file"), "content"))
    rows = files.mapInArrow(task, schema).join(starts, "file")
    return rows.select("doc_id", (F.col("file_start") + F.col("within")).alias("start"), "n_tokens", "ids_crc32",
                       *["ids"] * with_ids)


def token_files(df: DataFrame, **options) -> DataFrame:
    """Write the ids of ``df`` into a new shared folder and read the documents back. An empty
    input reads back as no rows."""
    spark = df.sparkSession
    folder = fresh_folder(spark, "s8b")
    manifest = write_ids(df, folder, **options)
    if manifest.isEmpty():
        return spark.createDataFrame([], "doc_id long, start long, n_tokens long, ids_crc32 long")
    return read_ids(spark, folder, with_ids=False)
