"""Exact ratios beyond 2**53, long bridge chains, crash-safe versions, archive reruns, links with
odd anchors, bare years, and a catalog whose folder cannot be read."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from edpanel.functions import columns as C
from edpanel.operators import dimensions as D
from edpanel.operators import changes, grid, links, sinks
from edpanel.plans import quality
from edpanel.session import scratch_path


def test_ratios_equal_python_integers(spark):
    pairs = [(15_000_000_000_007 * k // 9, 15_000_000_000_007) for k in range(10)] + [(4_999_999_999_999_999, 5 * 10**15), (2**62, 2**62 + 1), (-5, 3), (1, 0)]
    got = spark.createDataFrame(pairs, "n long, d long").select("n", "d", C.pct_tenths("n", "d").alias("t")).collect()
    for r in got:
        want = None if r.d == 0 else (1 if r.n >= 0 else -1) * ((2000 * abs(r.n) + r.d) // (2 * r.d))
        assert r.t == want, (r.n, r.d)


def day(y):
    return dt.date(y, 1, 1)


def test_bridge_chains_intervals_and_cycles(spark):
    chain = spark.createDataFrame([(f"P{k}", f"P{k + 1}", day(1950 + k)) for k in range(40)], "old_code string, new_code string, effective_from date")
    rows = spark.createDataFrame([("P0", day(2000), 1), ("P0", day(1960), 1), ("P0", day(1940), 1), ("Q", day(2000), 1)], "org string, period date, n long")
    got = {(r.org, r.period.year) for r in D.apply_bridge(rows, chain, "org", "period", ["n"]).collect()}
    assert got == {("P40", 2000), ("P11", 1960), ("P0", 1940), ("Q", 2000)}
    same = {(r.org, r.period.year) for r in D.apply_bridge(rows, chain, "org", "period", ["n"], comparable=True).collect()}
    assert same == {("P40", 2000), ("P40", 1960), ("P40", 1940), ("Q", 2000)}
    with pytest.raises(ValueError, match="cycle"):
        D.resolve_bridge(chain.union(spark.createDataFrame([("P40", "P0", day(1999))], chain.schema)))


def test_versions_survive_a_crashed_write(spark, tmp_path):
    table = sinks.VersionedTable(spark, str(tmp_path / "t"))
    table.write_next(spark.range(1))
    (tmp_path / "t" / "version=2").mkdir()
    assert table.current_version() == 1 and table.write_next(spark.range(3)) == 3 and table.read().count() == 3


def test_archive_rerun_adds_nothing(spark):
    path = scratch_path(spark, f"archive-{dt.datetime.now().timestamp()}")
    rows = spark.createDataFrame([("d", "f", "h"), ("d", "f", "h"), ("d", "g", "h")], "ingest_date string, file_name string, sha256 string")
    keys = ["ingest_date", "file_name", "sha256"]
    assert [sinks.archive_new(rows, path, "ingest_date", keys) for _ in range(2)] == [2, 0]
    assert spark.read.parquet(path).count() == 2


def test_links_need_a_real_href(spark):
    html = ['<a name="x">the</a><a href="/ok.xls">the</a>', '<a data-href="/bad" href="/ok.xls">the</a>', "<a href=/x.xls>the</a>",
            '<a href="/a?b=1&amp;c=2">t&#104;e &#38; more</a>', '<a title="a > b" href=\'/q.xls\'>the</a>', "<a>the</a>"]
    pages = spark.createDataFrame([(k, "http://h.org/p/q", h) for k, h in enumerate(html)], "page_id long, url string, html string")
    got = {r.page_id: (r.resolved_url, r.link_text) for r in links.resolve_links(pages, "the").collect()}
    assert [got[k][0] for k in range(6)] == ["http://h.org/ok.xls", "http://h.org/ok.xls", "http://h.org/x.xls", "http://h.org/a?b=1&c=2", "http://h.org/q.xls", None]
    assert got[3][1] == "the & more"


def test_bare_year_is_no_period(spark):
    df = spark.createDataFrame([("2015",), ("42156",), ("June 2015",)], "v string")
    assert [r.p for r in df.select(grid.parse_month_text(F.col("v")).alias("p")).collect()] == [None, dt.date(2015, 6, 1), dt.date(2015, 6, 1)]


def test_second_link_step(spark):
    html = ['<a href="/a.pdf">Monthly A&amp;E</a><a href="/b.XLS">the monthly A&amp;E file</a>', '<a href="/c.xls">quarterly</a>', None]
    pages = spark.createDataFrame([(k, "http://h.org/p", h) for k, h in enumerate(html)], "page_id long, url string, html string")
    got = {r.page_id: (r.anchor_pos, r.resolved_url, r.status) for r in links.resolve_files(pages).collect()}
    assert got == {0: (1, "http://h.org/b.XLS", "found"), 1: (None, None, "no_match"), 2: (None, None, "no_match")}


def test_merge_keeps_one_current_version_of_a_repeated_key(spark):
    rows = spark.createDataFrame([("A", 1, 10), ("A", 2, 11), ("B", 1, 5), (None, 3, 1)], "org string, line int, v long")
    rows = changes.with_row_hash(rows, ["org", "v"])
    first = changes.scd2_merge(changes.empty_versions(rows, ["org"], ["v"]), rows, ["org"], "2024-01-01 00:00:00", "s1", ["v"], "line")
    assert sorted((r.org, r.v, r.is_current) for r in first.collect()) == [("A", 11, True), ("B", 5, True)]
    again = changes.scd2_merge(first, rows.where("v <= 10"), ["org"], "2024-02-01 00:00:00", "s2", ["v"], "line")
    assert sorted((r.org, r.v, r.is_current) for r in again.collect()) == [("A", 10, True), ("A", 11, False), ("B", 5, True)]


def test_layout_check(spark):
    want = spark.range(1).selectExpr("id", "'x' as name").schema
    assert quality.shape_mismatches(spark.range(1).selectExpr("id", "'y' as name"), want) == []
    assert quality.shape_mismatches(spark.range(1).selectExpr("'y' as name", "id"), want) == ["column order"]
    assert quality.shape_mismatches(spark.range(1).selectExpr("cast(id as int) as id", "1 as more"), want) == [
        "missing name", "unexpected more", "id is int, not bigint"]
