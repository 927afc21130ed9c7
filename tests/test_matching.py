"""Rename matching, header labels under merged banners, and ranks over many distinct values."""

from __future__ import annotations

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from edpanel.operators import drift, grid, ranking

LABELS = "file string, sheet string, col int, compound string"
MISSING = "file string, sheet string, canonical string, spec_order int, expected_label string"


def renames(spark, labels, missing):
    lab = spark.createDataFrame([("f", "s", c, t) for c, t in labels], LABELS)
    mis = spark.createDataFrame([("f", "s", n, k, t) for k, (n, t) in enumerate(missing)], MISSING)
    found = drift.fuzzy_renames(lab, lab.where("false"), mis, 0.8).collect()
    return sorted((r.canonical, r.col) for r in found)


def test_contested_labels_give_both_renames(spark):
    """All four similarities pass; the loser of the best label takes the other one."""
    labels = [(3, "total attendancez"), (4, "totals attendance")]
    assert renames(spark, labels, [("a", "total attendances"), ("b", "total attendance")]) == [("a", 3), ("b", 4)]
    assert renames(spark, labels[:1], [("a", "total attendances"), ("b", "total attendance")]) == [("a", 3)]
    assert renames(spark, [(1, "other")], [("a", "total attendances")]) == []
    same = [(5, "total attendance"), (2, "total attendance")]
    assert renames(spark, same, [("a", "total attendance"), ("b", "total attendance")]) == [("a", 2), ("b", 5)]


def test_blank_label_under_a_merged_banner(spark):
    cells = [(0, 1, "Banner"), (1, 0, "Code"), (1, 1, "First"), (2, 0, "x"), (2, 1, "1"), (2, 2, "2"), (3, 3, "9")]
    df = spark.createDataFrame([("f", "s", *c) for c in cells], "file string, sheet string, row int, col int, value string")
    headers = spark.createDataFrame([("f", "s", 1)], "file string, sheet string, header_row int")
    got = {r.col: r.compound for r in grid.header_labels(df, headers).collect()}
    assert got == {0: "Code", 1: "Banner :: First", 2: "Banner", 3: "Banner"}


@pytest.mark.parametrize("ranges", [1, 2, 64])
def test_histogram_ranges_agree(spark, ranges):
    rnd = random.Random(3)
    values = [("a", rnd.choice([1, 2, 2, 7, rnd.randint(0, 10 ** 6)])) for _ in range(3000)] + [("b", 5)] * 40 + [("c", None)]
    df = spark.createDataFrame(values, "g string, v int")
    counts = Counter(v for v in values if v[1] is not None)
    want = {(g, v): (n, sum(m for (h, w), m in counts.items() if h == g and w <= v), sum(m for (h, _), m in counts.items() if h == g))
            for (g, v), n in counts.items()}
    got = ranking.value_histogram(df, ["g"], "v", ranges=ranges).collect()
    assert {(r.g, r.v): (r.cnt, r.cum_le, r.n) for r in got} == want


def test_a_month_of_a_million_distinct_totals(spark):
    """Bands are exact, and no window holds more than a range of the month."""
    n = 1_000_000
    df = spark.range(n).select(F.lit("m").alias("g"), (F.col("id") * 7919 % 1_000_003).alias("v"))
    h = ranking.value_histogram(df, ["g"], "v", ranges=ranking.VALUE_RANGES)
    rows = [line for line in h._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Window [" in line]
    assert rows and all("_range" in line for line in rows)
    banded = ranking.band_within(df, ["g"], "v", 5)
    assert [r["count"] for r in banded.groupBy("band").count().orderBy("band").collect()] == [n // 5] * 5


def test_places_follow_the_stated_null_order(spark):
    rng = random.Random(4)
    rows = [(rng.choice([None, "a", "b"]), rng.choice([None, 1.5, 2.5, -1.0]), k) for k in range(4000)]
    df = spark.createDataFrame(rows, "g string, v double, id long").repartition(7)
    placed = ranking.numbered(df, [F.col("g").asc_nulls_first(), F.col("v").desc_nulls_last(), F.col("id").asc()]).collect()
    want = sorted(rows, key=lambda r: (r[0] is not None, r[0] or "", r[1] is None, -(r[1] or 0), r[2]))
    assert [(r.g, r.v, r.id) for r in placed] == want and [r.position for r in placed] == list(range(1, 4001))
    assert ranking.numbered(df.where("false"), [F.col("id").asc()]).count() == 0


def test_missing_months_of_each_key(spark):
    import datetime as dt

    from edpanel.operators import dimensions
    day = lambda m: dt.date(2020, m, 1)
    held = [("a", day(2)), ("a", day(2)), ("a", day(5)), ("b", day(1)), ("b", day(6)), ("d", day(3)), (None, day(4))]
    present = spark.createDataFrame(held, "k string, p date")
    keys = spark.createDataFrame([("a",), ("b",), ("c",), ("c",)], "k string")
    got = sorted(((r.k or "", r.p.month) for r in dimensions.missing_periods(present, keys, "k", "p", dimensions.all_months(present, "p")).collect()))
    want = [("", m) for m in (1, 2, 3, 5, 6)] + [("a", m) for m in (1, 3, 4, 6)] + [("b", m) for m in (2, 3, 4, 5)]
    want += [("c", m) for m in range(1, 7)] + [("d", m) for m in (1, 2, 4, 5, 6)]
    assert got == want
