"""The parse over written frames: each table is read once, small frames are broadcast by their size, the pivot is made once."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F
from test_grid import activity_rows, cells_df, sheet

from edpanel.operators import drift, grid
from edpanel.plans import ingest
from edpanel.sources import grid as grid_src
from edpanel.sources.registry import default_registry


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString() + df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def tables(spark, tmp_path):
    lines = [(k, float(q), 0.08 if q % 3 else 0.01, 0.06 if q % 2 else 0.02, "ANR"[q % 3], dt.date(1996, m, 3), q % 8)
             for k in (1, 2, 3) for m in (5, 6, 7) for q in range(1, 12)]
    lines.append((2, 4.0, 0.01, 0.02, "A", None, 1))
    spark.createDataFrame(lines, "l_suppkey long, l_quantity double, l_discount double, l_tax double, l_returnflag string, l_shipdate date, "
                                 "l_linenumber int").write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(1, "A", 1), (2, "B", 2), (3, "C", None), (3, "D", 1)], "s_suppkey long, s_name string, s_nationkey int").write.parquet(f"{tmp_path}/supplier.parquet")
    spark.createDataFrame([(1, "N", 1), (2, "M", 1)], "n_nationkey int, n_name string, n_regionkey int").write.parquet(f"{tmp_path}/nation.parquet")
    spark.createDataFrame([(1, "R")], "r_regionkey int, r_name string").write.parquet(f"{tmp_path}/region.parquet")
    return str(tmp_path)


def test_render_reads_the_lines_once_and_keeps_repeated_providers(spark, tables):
    cells = ingest.analogue_cells(spark, tables)
    assert not [f for f in cells.inputFiles() if "lineitem" in f]
    codes = cells.where("col = 0 and value = 'S3' and file = 'ae-activity-1996-06.xls'").count()
    assert codes == 4                                   # two names of one code, each with both regions of that code
    england = cells.where("col = 6 and file = 'ae-activity-1996-06.xls'").join(cells.where("value = 'England'").select("file", "row"), ["file", "row"])
    assert [r.value for r in england.collect()] == [str(66 * 6)]


def test_months_of_a_release_are_its_workbooks(spark, tables):
    june = F.col("file").endswith(ingest.REPUBLISHED)
    months = grid_src.workbook_name(F.col("period_date")).endswith(ingest.REPUBLISHED)
    for release in ("first", "revised"):
        want = ingest.release_cells(spark, tables, release).where(june)
        got = ingest.release_cells(spark, tables, release, months)
        assert sorted(tuple(r) for r in got.collect()) == sorted(tuple(r) for r in want.collect()) != []


def test_rows_are_pivoted_once_and_only_when_asked_for(spark):
    cells = cells_df(spark, sheet("f.xls", "data", activity_rows(total_label="Total attendance", extra=True)))
    r = ingest.parse_cells(cells)
    assert r.drift_log.count() > 0 and "wide" not in vars(r)
    for rows in (r.staged, grid.coerce_rejects(grid.drop_footnotes(r.wide), default_registry())):
        assert "SortAggregate" not in plan(rows) and "SortMergeJoin" not in plan(rows)
    assert "Exchange hashpartitioning" not in plan(r.staged)
    planned = ingest.parse_cells(cells, materialize=False)
    assert sorted(map(str, r.staged.collect())) == sorted(map(str, planned.staged.collect()))
    assert sorted(map(str, r.drift_log.collect())) == sorted(map(str, planned.drift_log.collect()))


def test_cells_meet_the_heads_without_a_shuffle_and_stored_cells_are_not_written_again(spark):
    cells = cells_df(spark, sheet("f.xls", "data", activity_rows()))
    r = ingest.parse_cells(cells, stored=True)
    assert r.cells is cells
    r = ingest.parse_cells(cells)
    wide = grid.cells_to_wide(r.cells, r.headers, r.mapping, default_registry())
    assert plan(wide).count("Exchange hashpartitioning") == 1 and "SortMergeJoin" not in plan(wide)


def test_labels_of_a_row_are_read_once_for_all_later_columns(spark):
    df = spark.sql("SELECT 1 AS id, parse_json('{\"Region\": \"x\", \" Appointments  :: Booked Type 1\": \"7\"}') AS _unmapped")
    out = drift.read_across_versions(df, ingest.LATER_COLUMNS)
    assert plan(out).split("== ")[0].count("map_entries(") <= 2 and out.columns == ["id", "_unmapped", "region_name", "booked_type1", "breaches_type2"]
    assert tuple(out.drop("_unmapped").first()) == (1, "x", 7, None)


def test_lines_of_sheets_pass_their_windows_once(spark, tmp_path):
    rows = [("f.xls", "data", 0, 0, "a\nb"), ("f.xls", "data", 3, 1, 'x"y'), ("f.xls", "data", 10_000, 2, "z")]
    grid_src.write_sheets(cells_df(spark, rows), str(tmp_path / "s"))
    back = grid_src.read_sheets(spark, str(tmp_path / "s"))
    assert "Window" not in plan(back)
    assert sorted(tuple(r) for r in back.collect()) == rows
