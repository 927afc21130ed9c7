"""URL changes across buckets, the provider version in force, and integer coercion."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from edpanel.functions import columns as C
from edpanel.operators import changes
from edpanel.operators import dimensions as D


def test_url_change_looks_back_across_buckets(spark):
    urls = ["a", "a", "b", "b", None, "b", "b", "c"]
    rows = [("s", i * 3, u) for i, u in enumerate(urls)] + [("t", 4, "a")]
    df = spark.createDataFrame(rows, "src string, n int, url string")
    out = changes.url_change(df, "src", "n", "url", F.floor(F.col("n") / 5))
    got = {(r.src, r.n): (r.previous_url, r.url_changed) for r in out.collect()}
    for i, u in enumerate(urls):
        prev = urls[i - 1] if i else None
        assert got[("s", i * 3)] == (prev, prev is not None and prev != u)
    assert got[("t", 4)] == (None, False)


def test_version_in_force_keeps_every_row(spark):
    d = dt.date
    versions = spark.createDataFrame(
        [("A", 1, d(2000, 1, 1), d(2001, 1, 1)), ("A", 2, d(2001, 1, 1), None)],
        "org string, version_no int, valid_from date, valid_to date")
    rows = spark.createDataFrame([("A", d(1999, 12, 1)), ("A", d(2000, 12, 1)), ("A", d(2001, 1, 1)), ("B", d(2001, 1, 1))],
                                 "org string, period date")
    got = {(r.org, r.period): r.version_no
           for r in D.with_version_in_force(rows, versions, "org", "period", ["version_no"]).collect()}
    assert got == {("A", d(1999, 12, 1)): None, ("A", d(2000, 12, 1)): 1, ("A", d(2001, 1, 1)): 2, ("B", d(2001, 1, 1)): None}


def test_coerce_int_forms(spark):
    cases = {" 7 ": 7, "5.0": 5, "-": None, "1,234": None, "": None, "NaN": None, "12.5": None, "-3": -3,
             "9223372036854775807": 2**63 - 1, "9223372036854775808": None}
    df = spark.createDataFrame([(c,) for c in cases], "v string")
    assert {r.v: r.i for r in df.select("v", C.coerce_int("v").alias("i")).collect()} == cases
