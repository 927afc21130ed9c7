"""Packing of token ids into sequences of fixed capacity by best-fit decreasing.

Each task encodes its documents and cuts overlong ones into full windows, each a sequence of
its own; what is left of a document is shorter than a window. The remainders of up to
``pack_ids`` ids are held, sorted by falling length, and each goes to the open sequence with
the least room that still takes it. A segment tree indexed by remaining room finds that
sequence. Nothing is shuffled: a group is bounded and spans a task's rows, so a copy or a
source of any size costs no more than other rows.

Defined results: a null text is empty (one piece with the end id); a null ``doc_id`` is kept;
repeated rows are packed once each; ties in length keep input order; an empty table gives no
piece; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edpanel.llm.common import slices
from edpanel.llm.tokens import END_ID, encoder

CAPACITY = 1024
PACK_IDS = 4_000_000
SCHEMA = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


class RoomTree:
    """Open sequences by remaining room, over a segment tree of which rooms occur."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.any = [0] * (2 * self.leaves)  # sequences below each node
        self.open: list[list[int]] = [[] for _ in range(self.leaves)]

    def put(self, room: int, sequence: int) -> None:
        self.open[room].append(sequence)
        node = room + self.leaves
        while node:
            self.any[node] += 1
            node >>= 1

    def take(self, need: int) -> tuple[int, int] | None:
        """Removes and returns (sequence, room) with the least room of at least ``need``."""
        node = need + self.leaves
        while not self.any[node]:
            while node & 1:  # a right child: the next larger rooms hang off an ancestor
                node >>= 1
            if not node:
                return None
            node += 1
        while node < self.leaves:
            node = 2 * node if self.any[2 * node] else 2 * node + 1
        room = node - self.leaves
        while node:
            self.any[node] -= 1
            node >>= 1
        return self.open[room].pop(), room


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Sequence and offset of each piece (of at most ``capacity``), and the sequences used."""
    sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    tree, used = RoomTree(capacity), 0
    for at in np.argsort(-lengths, kind="stable").tolist():
        need = int(lengths[at])
        found = tree.take(need)
        if found is None:
            found, used = (used, capacity), used + 1
        sequence[at], room = found
        offset[at] = capacity - room
        if room > need:
            tree.put(room - need, found[0])
    return sequence, offset, used


def pack(df: DataFrame, tokenizer_path: str | None = None, end_id: int | None = END_ID,
         capacity: int = CAPACITY, pack_ids: int = PACK_IDS) -> DataFrame:
    """Pieces of all documents: doc_id, start (ids of the document before it), length, ids
    (little-endian uint32), doc_tokens, sequence_id, offset. Each id is in one piece."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, base = encoder(tokenizer_path), TaskContext.get().partitionId() << 40
        rest: list[tuple] = []  # (doc_id, start, ids, doc_tokens) of remainders
        held = used = 0

        def rows(pieces, sequences, offsets):
            for at in range(0, len(pieces), 2000):
                part = pieces[at:at + 2000]
                doc, start, ids, tokens = zip(*part)
                yield pa.RecordBatch.from_arrays([
                    pa.array(doc, pa.int64()), pa.array(start, pa.int64()), pa.array(map(len, ids), pa.int64()),
                    pa.array([i.tobytes() for i in ids], pa.binary()), pa.array(tokens, pa.int64()),
                    pa.array(base + sequences[at:at + 2000], pa.int64()), pa.array(offsets[at:at + 2000], pa.int64())],
                    ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])

        def fill():
            nonlocal rest, held, used
            sequence, offset, n = best_fit_decreasing(np.array([len(r[2]) for r in rest], np.int64), capacity)
            yield from rows(rest, used + sequence, offset)
            rest, held, used = [], 0, used + n

        for batch in slices(batches):
            ids, sizes = enc.encode(batch.column("text"), end_id)
            ids, ends, full = ids.astype("<u4"), np.cumsum(sizes).tolist(), []
            for doc, end, n in zip(batch.column("doc_id").to_pylist(), ends, sizes.tolist()):
                own, cut = ids[end - n:end], n - n % capacity
                full += [(doc, at, own[at:at + capacity], n) for at in range(0, cut, capacity)]
                if n > cut:
                    rest.append((doc, cut, own[cut:], n))
                    held += n - cut
            if full:
                yield from rows(full, used + np.arange(len(full)), np.zeros(len(full), np.int64))
                used += len(full)
            if held >= pack_ids:
                yield from fill()
        if rest:
            yield from fill()

    return df.select(F.col("doc_id").cast("long").alias("doc_id"),
                     F.col("text").cast("string").alias("text")).mapInArrow(task, SCHEMA)
