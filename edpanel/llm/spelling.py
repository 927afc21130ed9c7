"""Spelling variants: words one edit apart, and each word's commoner form.

Words are maximal runs of letters of whole texts (A-Z lower-cased) of at least ``MIN_LENGTH``
code points and ``MIN_COUNT`` occurrences. Near words are found by blocked Gram matrices:

1. Words are blocked by their letter counts, added up in ``classes`` classes of letters. One
   edit changes the length by one at most, and the class counts by one letter put in, taken out
   or moved, so a block only meets itself and the blocks one such step away (same or adjacent
   length). The number of classes grows with the vocabulary, which keeps blocks small.
2. Blocks are cut into tiles of bounded bytes. A product of two tiles' letter-count matrices
   gives all squared distances; pairs of at most two are kept (one replaced letter changes two
   counts, one inserted or deleted letter one) and verified as edits on the letters themselves.
3. Each word counts its near words and takes the most frequent as its form, if that one occurs
   at least ``RATIO`` times as often; forms are followed to their last word by pointer jumping.

Defined results: a null text has no words, a null id counts as empty text; ties of frequency go
to the smaller word by code points; repeated rows count each time; an empty table gives no row;
very long words are tiled by their bytes; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from edpanel.llm.common import drop_written, tuned, written

MIN_LENGTH, MIN_COUNT, RATIO = 6, 5, 5
SLIP = 199
TILE_WORDS, TILE_BYTES = 512, 1 << 16
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LETTERS = LOWER + "".join(map(chr, range(0xC0, 0x100)))
PAIRS = "word string, near string, n long"


def runs(docs: DataFrame, min_length: int = MIN_LENGTH) -> DataFrame:
    """(doc_id, run): every maximal run of at least ``min_length`` letters, A-Z lower-cased."""
    found = F.regexp_extract_all(F.translate("text", UPPER, LOWER), F.lit(f"[a-zÀ-ÿ]{{{min_length},}}"), F.lit(0))
    return docs.select("doc_id", F.explode(found).alias("run"))


def slipped(doc_id: Column, run: Column) -> Column:
    """``run``, with one letter dropped where the hash of (document, run) says so."""
    h = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run).cast("binary"))
    at = (h % F.length(run)).cast("int")
    cut = F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run)))
    return F.when(h % SLIP == 0, cut).otherwise(run)


def vocabulary(docs: DataFrame) -> DataFrame:
    """(word, n) of all words."""
    words = runs(docs).select(slipped(F.col("doc_id"), F.col("run")).alias("word"))
    return words.where(F.length("word") >= MIN_LENGTH).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= MIN_COUNT)


def class_counts(word: Column, classes: int) -> Column:
    """Letters of the word per class of letters (every ``classes``-th letter)."""
    return F.array(*(F.length(word) - F.length(F.translate(word, LETTERS[k::classes], "")) for k in range(classes)))


def next_blocks(counts: Column, classes: int) -> Column:
    """The block itself, those with one letter more, and those with one letter moved to a later
    class: of two neighbouring blocks exactly one names the other."""
    places = F.sequence(F.lit(0), F.lit(classes - 1))

    def changed(less: Column, more: Column) -> Column:
        return F.transform(counts, lambda x, i: x + F.when(i == more, 1).otherwise(0) - F.when(i == less, 1).otherwise(0))

    longer = F.transform(places, lambda m: changed(F.lit(-1), m))
    moved = F.flatten(F.transform(places, lambda s: F.transform(F.filter(places, lambda m: m > s), lambda m: changed(s, m))))
    return F.concat(F.array(counts), longer, F.filter(moved, lambda c: F.array_min(c) >= 0))


def _codes(words: list[str]) -> np.ndarray:
    """Letters of words of one length, a row each."""
    return np.frombuffer("".join(words).encode("latin-1"), np.uint8).reshape(len(words), -1)


_PLACE = np.zeros(256, np.int64)
_PLACE[[ord(c) for c in LETTERS]] = np.arange(len(LETTERS))


def _count_matrix(codes: np.ndarray) -> np.ndarray:
    kind = np.float32 if codes.shape[1] < 2000 else np.float64  # products stay exact integers
    n, width = len(codes), len(LETTERS)
    flat = (_PLACE[codes] + np.arange(n)[:, None] * width).ravel()
    return np.bincount(flat, minlength=n * width).reshape(n, width).astype(kind)


def gram_candidates(a: np.ndarray, b: np.ndarray, limit: int = 2) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of rows of two letter matrices with squared count distance at most ``limit``."""
    ca, cb = _count_matrix(a), _count_matrix(b)
    gram = ca @ cb.T
    gram *= -2
    gram += (ca * ca).sum(1)[:, None]
    gram += (cb * cb).sum(1)[None, :]
    return np.nonzero(gram <= limit)


def one_edit(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether rows of ``a`` and ``b`` (as long, or one longer) differ by exactly one edit."""
    if a.shape[1] == b.shape[1]:
        return (a != b).sum(1) == 1
    head, tail = a == b[:, :-1], (a == b[:, 1:])[:, ::-1]
    same = [np.where(m.all(1), a.shape[1], m.argmin(1)) for m in (head, tail)]
    return same[0] + same[1] >= a.shape[1]


def _near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Near pairs, in both directions, of tile pairs. The tiles of one length that meet the same
    tile in a row share a product."""
    for batch in batches:
        rows = batch.to_pydict()
        total, at = batch.num_rows, 0
        while at < total:
            to, held = at + 1, len(rows["words"][at])
            same = rows["same"][at]
            while (to < total and not same and not rows["same"][to] and held < 8 * TILE_WORDS and rows["tile2"][to] == rows["tile2"][at]
                   and len(rows["words"][to][0]) == len(rows["words"][at][0])):
                held += len(rows["words"][to])
                to += 1
            left, left_n = sum(rows["words"][at:to], []), np.array(sum(rows["ns"][at:to], []), np.int64)
            right, right_n = rows["words2"][at], np.array(rows["ns2"][at], np.int64)
            a, b = _codes(left), _codes(right)
            i, j = gram_candidates(a, b)
            if same:
                keep = i < j
                i, j = i[keep], j[keep]
            step = max(1, (1 << 24) // a.shape[1])
            hits = [one_edit(a[i[k:k + step]], b[j[k:k + step]]) for k in range(0, len(i), step)]
            if hits and (hit := np.concatenate(hits)).any():
                i, j = i[hit], j[hit]
                mine, other = pa.array(left).take(pa.array(i)), pa.array(right).take(pa.array(j))
                for word, near, n in ((mine, other, right_n[j]), (other, mine, left_n[i])):
                    yield pa.RecordBatch.from_arrays([word, near, pa.array(n)], ["word", "near", "n"])
            at = to


def class_number(words: int) -> int:
    """Letter classes for a vocabulary: two more for every sixteenfold of words."""
    return max(3, round(math.log2(max(words, 2)) / 2) - 2)


def near_pairs(words: DataFrame, classes: int | None = None, tile_words: int = TILE_WORDS) -> DataFrame:
    """(word, near, n of near) for all ordered pairs of ``words`` (word, n) one edit apart."""
    tuned(words.sparkSession)
    classes = classes or class_number(words.count())
    blocked = words.withColumn("block", class_counts(F.col("word"), classes))
    per_tile = F.greatest(F.lit(1), F.least(F.lit(tile_words), F.expr(f"{TILE_BYTES} div any_value(length(word))")))
    sizes = blocked.groupBy("block").agg(F.ceil(F.count("*") / per_tile).alias("tiles"))
    tiles = written(blocked.join(sizes, "block").withColumn("tile", F.pmod(F.xxhash64("word"), F.col("tiles")))
                    .groupBy("block", "tile").agg(F.collect_list(F.struct("word", "n")).alias("held"))
                    .select("block", "tile", F.col("held.word").alias("words"), F.col("held.n").alias("ns")), "tiles")
    left = tiles.select(F.col("block").alias("own"), F.col("tile").alias("tile1"), "words", "ns",
                        F.explode(next_blocks(F.col("block"), classes)).alias("block"))
    right = tiles.select("block", F.col("tile").alias("tile2"), F.col("words").alias("words2"), F.col("ns").alias("ns2"))
    met = left.join(right, "block").where("own != block or tile1 <= tile2")
    return met.select("words", "ns", "words2", "ns2", F.struct("block", "tile2").alias("tile2"),
                      F.expr("own = block and tile1 = tile2").alias("same")).mapInArrow(_near, PAIRS)


def forms(words: DataFrame, pairs: DataFrame) -> DataFrame:
    """``words`` with n_near, form and form_n."""
    best = F.min(F.struct((-F.col("n")).alias("less"), F.col("near").alias("near")))
    near = pairs.groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    most = -F.col("best.less")
    taken = most >= RATIO * F.col("n")
    return words.join(near, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                                                   F.when(taken, F.col("best.near")).alias("form"), F.when(taken, most).alias("form_n"))


def roots(found: DataFrame) -> DataFrame:
    """(word, root) of the words that have a form. Counts rise by ``RATIO`` at each step, so chains are short;
    each round doubles the steps, is written, and the last changes nothing."""
    links = written(found.where("form is not null").select("word", F.col("form").alias("root")), "roots")
    while True:
        step = links.select(F.col("word").alias("root"), F.col("root").alias("above"))
        new = written(links.join(step, "root", "left").select("word", F.coalesce("above", "root").alias("root"),
                                                              F.col("above").isNotNull().alias("moved")), "roots")
        drop_written(links)
        links = new.select("word", "root")
        if new.where("moved").isEmpty():
            return links


def variants(docs: DataFrame) -> DataFrame:
    """(word, n, n_near, form, form_n, root) of the words of ``docs`` (doc_id, text)."""
    words = written(vocabulary(docs.select("doc_id", "text")), "words")
    found = written(forms(words, near_pairs(words)), "forms")
    return found.join(roots(found), "word", "left").withColumn("root", F.coalesce("root", "word"))
