"""Ranks and exact percentiles within large groups without putting a group in one task.

A window ``PARTITION BY period ORDER BY value`` sends every row of a period to one
task; at scale one period may hold a third of all rows. Both RANK and
PERCENTILE_CONT only depend on *how many rows hold each value*, so we aggregate to a
value histogram first (partial aggregation map-side; one row per distinct value and
group), run the ordered window over that histogram, and join the result back.
For rounded percentages the histogram holds at most 1,001 values per group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from edpanel.session import materialize


#: Ranges of a month whose values are not bounded; windows then hold one range each.
VALUE_RANGES = 64


def value_histogram(df: DataFrame, group_cols: Sequence[str], value_col: str, *aggs: Column, ranges: int = 1) -> DataFrame:
    """(group..., value, cnt, cum_le, n): rows per value, running count, group size, and any
    further ``aggs`` per value.

    With one range the running count is a window over a group's distinct values, which suits
    values that are bounded (percentages). With more, each group's values are cut at approximate
    quantiles: counts per range, a prefix sum over the ranges, and a window inside each range. Any
    cut gives the same counts; equal values fall in one range. The cuts are checkpointed, so that all parts of the
    plan see the same ones."""
    h = (df.where(F.col(value_col).isNotNull())
         .groupBy(*group_cols, value_col).agg(F.count(F.lit(1)).alias("cnt"), *aggs))
    if ranges == 1:
        w = Window.partitionBy(*group_cols).orderBy(F.col(value_col).asc())
        return (h.withColumn("cum_le", F.sum("cnt").over(w.rowsBetween(Window.unboundedPreceding, 0)))
                .withColumn("n", F.sum("cnt").over(Window.partitionBy(*group_cols))))
    h = materialize(h)
    at = [k / ranges for k in range(1, ranges)]
    cuts = materialize(h.groupBy(*group_cols).agg(F.percentile_approx(value_col, at).alias("_cuts"), F.sum("cnt").alias("n")))
    h = h.join(cuts, list(group_cols)).withColumn("_range", F.size(F.filter("_cuts", lambda c: c < F.col(value_col)))).drop("_cuts")
    per_range = h.groupBy(*group_cols, "_range").agg(F.sum("cnt").alias("_held"))
    before = F.sum("_held").over(Window.partitionBy(*group_cols).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1))
    per_range = per_range.select(*group_cols, "_range", F.coalesce(before, F.lit(0)).alias("_before"))
    inside = Window.partitionBy(*group_cols, "_range").orderBy(F.col(value_col).asc()).rowsBetween(Window.unboundedPreceding, 0)
    return (h.join(per_range, [*group_cols, "_range"]).withColumn("cum_le", F.col("_before") + F.sum("cnt").over(inside))
            .drop("_range", "_before"))


def rank_within(df: DataFrame, group_cols: Sequence[str], value_col: str, *, descending: bool = True,
                rank_col: str = "rank", count_col: str | None = None) -> DataFrame:
    """RANK() OVER (PARTITION BY group ORDER BY value [DESC]) with ties sharing a rank.
    NULL values get a NULL rank; ``count_col`` = number of non-NULL values in the group."""
    h = value_histogram(df, group_cols, value_col)
    rank = (F.col("n") - F.col("cum_le") + 1) if descending else (F.col("cum_le") - F.col("cnt") + 1)
    cols = [*group_cols, value_col, rank.cast("int").alias(rank_col)]
    if count_col:
        cols.append(F.col("n").cast("bigint").alias(count_col))
    return df.join(h.select(*cols), [*group_cols, value_col], "left")


def band_within(df: DataFrame, group_cols: Sequence[str], value_col: str, bands: int,
                band_col: str = "band", band_sums: dict[str, Column] | None = None, ranges: int = VALUE_RANGES) -> DataFrame:
    """Deterministic quantile band 1..bands: ``floor(bands * rows_below / n) + 1``.

    Ties always share a band (unlike NTILE, which splits ties arbitrarily). ``band_sums``
    maps a column name to a per-row number to be totalled over the row's band: the totals
    come from the same histogram, so ``df`` is read twice, not once more per total."""
    sums = band_sums or {}
    h = value_histogram(df, group_cols, value_col, *[F.sum(c).alias(n) for n, c in sums.items()], ranges=ranges)
    below = F.col("cum_le") - F.col("cnt")
    band = (F.floor(F.lit(bands) * below / F.col("n")) + 1).cast("int")
    h = h.withColumn(band_col, band)
    totals = h.groupBy(*group_cols, band_col).agg(*[F.sum(n).alias(n) for n in sums]) if sums else None  # ``bands`` rows a group
    h = h.select(*group_cols, value_col, band_col)
    joined = df.join(h, [*group_cols, value_col], "left")
    return joined if totals is None else joined.join(totals, [*group_cols, band_col], "left")


def numbered(df: DataFrame, order: Sequence[Column], position_col: str = "position") -> DataFrame:
    """``df`` in a global order with each row's place from 1 (I1), no task seeing all rows.

    ``order`` holds sort expressions that state their null order and end in a unique one, so that the places are the
    same in every run. Rows are cut into ranges of that order and written once with their range; rows are numbered
    inside a range, after the rows of the ranges before it (one row a range)."""
    ranged = materialize(df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()))
    held = ranged.groupBy("_range").agg(F.count(F.lit(1)).alias("_held"))
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = held.select("_range", F.coalesce(F.sum("_held").over(earlier), F.lit(0)).alias("_before"))
    own = F.row_number().over(Window.partitionBy("_range").orderBy(*order))
    placed = ranged.withColumn("_own", own).join(F.broadcast(starts), "_range")  # as many rows as partitions
    return placed.withColumn(position_col, (F.col("_before") + F.col("_own")).cast("bigint")).drop("_range", "_own", "_before").orderBy(position_col)


def percentile_cont(df: DataFrame, group_cols: Sequence[str], value_col: str,
                    quantiles: dict[str, tuple[int, int]]) -> DataFrame:
    """Exact PERCENTILE_CONT for rational quantiles ``num/den`` (linear interpolation).

    For each group with n values, position h = (n-1) * num/den; the result is
    v[floor h] + frac(h) * (v[floor h + 1] - v[floor h]). Returns one row per group with
    one DOUBLE column per quantile, ``n``, the ``total`` of the values and their sum of
    squared deviations from the mean, ``ssd`` (DOUBLE).
    """
    h = value_histogram(df, group_cols, value_col)
    v, cum, n, cnt = F.col(value_col), F.col("cum_le"), F.col("n"), F.col("cnt")
    h = h.withColumn("_mean", F.sum(v * cnt).over(Window.partitionBy(*group_cols)) / n)
    aggs: list[Column] = [F.first("n").alias("n"), F.sum(v * cnt).alias("total"),
                          F.sum(cnt * (v - F.col("_mean")) * (v - F.col("_mean"))).cast("double").alias("ssd")]
    for name, (num, den) in quantiles.items():
        pos = (n - 1) * num
        lo_idx = F.floor(pos / den)
        rem = pos - lo_idx * den
        hi_idx = lo_idx + F.when(rem > 0, 1).otherwise(0)
        aggs += [F.min(F.when(cum > lo_idx, v)).alias(f"_{name}_lo"),
                 F.min(F.when(cum > hi_idx, v)).alias(f"_{name}_hi"),
                 F.first(rem).alias(f"_{name}_rem")]
    agg = h.groupBy(*group_cols).agg(*aggs)
    out = [*group_cols, "n", "total", "ssd"]
    for name, (num, den) in quantiles.items():
        lo, hi, rem = F.col(f"_{name}_lo"), F.col(f"_{name}_hi"), F.col(f"_{name}_rem")
        out.append((lo + (hi - lo) * rem / F.lit(den)).cast("double").alias(name))
    return agg.select(*out)
