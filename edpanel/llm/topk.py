"""Exact top-k search by the threshold algorithm.

Components become integers floor(256 * x); the score is the integer inner product. Vectors and
queries are dealt into blocks of bounded size and every (query block, vector block) pair is one
group. In a group each dimension's vectors are sorted once. For a query, the lists are walked
in rounds (descending where its component is positive, ascending where negative): vectors met
for the first time are scored in full, and once the k-th best score exceeds the sum of the
component-wise bests still to come, no unmet vector can enter and the walk stops. Equal scores
may still win by a smaller id, so the walk goes on while the bound equals the k-th score. The
k best of each group are merged per query.

Defined results: vectors that are null or empty or hold null or non-finite components take no
part; a vector shorter or longer than a query has no score with it; a null ``vec_id`` takes no
part; rows that repeat a ``vec_id`` are candidates each (ties by id, then equal); a query finds
no row of its own id; fewer than k candidates give fewer rows; empty tables give none.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from edpanel.llm.common import split_on_hash

SCALE = 256
BLOCK_VECTORS = 8192
BLOCK_QUERIES = 1024


def quantised(df: DataFrame) -> DataFrame:
    """(vec_id, v array<bigint>) of the vectors that take part."""
    x = F.col("embedding").cast("array<double>")
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return (df.where(F.col("vec_id").isNotNull() & x.isNotNull() & (F.size(x) > 0)).where(F.coalesce(finite, F.lit(False)))
            .select(F.col("vec_id").cast("long").alias("vec_id"), F.transform(x, lambda c: F.floor(F.lit(float(SCALE)) * c)).alias("v")))


def threshold_search(vectors: np.ndarray, ids: np.ndarray, order: np.ndarray, query: np.ndarray, own: int, k: int,
                     first: int = 16) -> tuple[np.ndarray, np.ndarray]:
    """The k best (scores, rows) of one block. ``order``: rows by rising component, per dimension."""
    n = len(vectors)
    rising, falling = np.flatnonzero(query < 0), np.flatnonzero(query > 0)
    exact = query.astype(np.float64)  # components and sums stay far below 2 ** 53
    met = np.zeros(n, bool)
    best_score, best_row = np.zeros(0, np.int64), np.zeros(0, np.int64)
    depth, step = 0, first
    while depth < n:
        to = min(n, depth + step)
        before = met.copy()
        met[order[depth:to, rising].ravel()] = True
        met[order[n - to:n - depth, falling].ravel()] = True
        if not len(rising) and not len(falling):
            met[:] = True
        rows = np.flatnonzero(met & ~before)
        rows = rows[ids[rows] != own]
        score = (vectors[rows] @ exact).astype(np.int64)
        least = score.min(initial=0)
        if len(best_score) == k:
            least = best_score[-1]
        elif len(rows) > 4 * k + 4:
            least = np.partition(score, len(score) - k)[len(score) - k]  # k rows of this round score as much
        likely = score >= least
        best_score, best_row = np.concatenate([best_score, score[likely]]), np.concatenate([best_row, rows[likely]])
        top = np.lexsort((ids[best_row], -best_score))[:k]
        best_score, best_row = best_score[top], best_row[top]
        if met.all():
            break
        bound = int(vectors[order[to - 1, rising], rising] @ exact[rising] + vectors[order[n - to, falling], falling] @ exact[falling])
        if len(top) == k and best_score[-1] > bound:  # no unmet vector scores more than the bound
            break
        depth, step = to, step * 4
    return best_score, best_row


def top_k(df: DataFrame, queries: DataFrame, k: int, block_vectors: int = BLOCK_VECTORS, block_queries: int = BLOCK_QUERIES) -> DataFrame:
    """(query_id, rank, vec_id, score) of each row of ``queries`` against all of ``df``; both
    have vec_id and embedding."""
    data, asked = quantised(df), quantised(queries)
    n_data, n_asked = split_on_hash(data.count(), block_vectors), split_on_hash(asked.count(), block_queries)
    key, salted = F.xxhash64("vec_id"), F.xxhash64("vec_id", "v")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = data.select("vec_id", "v", F.pmod(salted, F.lit(n_data)).cast("int").alias("d"), every(n_asked).alias("q"))
    right = asked.select("vec_id", "v", every(n_data).alias("d"), F.pmod(key, F.lit(n_asked)).cast("int").alias("q"))

    def group(vectors: pd.DataFrame, wanted: pd.DataFrame) -> pd.DataFrame:
        out = []
        for size in sorted({len(v) for v in wanted["v"]} & {len(v) for v in vectors["v"]}):
            mine, ask = vectors[vectors["v"].map(len) == size], wanted[wanted["v"].map(len) == size]
            mine = mine.sort_values("vec_id", kind="stable")
            block, ids = np.stack(mine["v"].to_list()).astype(np.float64), mine["vec_id"].to_numpy()
            order = np.argsort(block, axis=0, kind="stable")
            for own, query in zip(ask["vec_id"], ask["v"]):
                score, row = threshold_search(block, ids, order, np.asarray(query, np.int64), own, k)
                out.append(pd.DataFrame({"query_id": own, "vec_id": ids[row], "score": score}))
        return pd.concat(out) if out else pd.DataFrame({"query_id": [], "vec_id": [], "score": []}, dtype="int64")

    found = left.groupBy("d", "q").cogroup(right.groupBy("d", "q")).applyInPandas(group, "query_id long, vec_id long, score long")
    ranked = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
