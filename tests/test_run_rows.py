"""The run's parse by rows of values and its landing by lines give what the cells give, without shuffling cells."""

from __future__ import annotations

import datetime as dt

import pytest

from edpanel.operators import changes, grid
from edpanel.plans import analogue, ingest
from edpanel.sources import grid as grid_src

SHEET = "Provider Data"
TEXTS = [("1", SHEET, 0, 'Period:,,June 1996\n,,"A&E attendances, all"\n"Code",Name,Type 1 Departments - Major A&E,Extra\nS1,"One, ""the first""\nhospital", 7 ,x\n\nS2,Two'),
         ("1", SHEET, 10, "S3, ,5.0\r\n,,\nS4,Four,-,y"),
         ("2", "Notes", 0, "Notes\n,,a"),
         ("2", SHEET, 0, "Code,Name,A&E attendances Type 1")]


def shown(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


@pytest.fixture(scope="module")
def texts(spark):
    return spark.createDataFrame(TEXTS, "file string, sheet string, first_row int, text string")


def test_rows_of_text_hold_the_values(texts):
    rows = {(r.file, r.sheet, r.row): r["values"] for r in grid_src.rows_of_text(texts).collect()}
    assert rows["1", SHEET, 3] == ["S1", 'One, "the first"\nhospital', " 7 ", "x"] and rows["1", SHEET, 4] == [""]
    assert rows["1", SHEET, 10] == ["S3", " ", "5.0"] and rows["1", SHEET, 11] == ["", "", ""]
    cells = grid_src.cells_of_text(texts)
    assert {(r.row, r.col, r.value) for r in cells.where("file = '1' and row >= 10").collect()} == {
        (10, 0, "S3"), (10, 2, "5.0"), (12, 0, "S4"), (12, 1, "Four"), (12, 2, "-"), (12, 3, "y")}
    assert shown(grid.profile_of_rows(grid_src.rows_of_text(texts))) == shown(grid.column_profile(cells))


def test_parse_of_texts_equals_parse_of_cells_and_shuffles_no_cells(texts):
    by_rows, by_cells = ingest.parse_texts(texts), ingest.parse_cells(grid_src.cells_of_text(texts))
    assert by_rows.rows is not None
    assert shown(by_rows.staged) == shown(by_cells.staged) and len(shown(by_rows.staged)) == 4
    assert shown(by_rows.drift_log) == shown(by_cells.drift_log)
    plan = by_rows.wide._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate [row" not in plan and "Aggregate [row" in grid.cells_to_wide(
        by_cells.cells, by_cells.headers, by_cells.mapping, by_cells.registry)._jdf.queryExecution().optimizedPlan().toString()


def test_overlapping_parts_go_through_their_cells(spark, texts):
    again = texts.unionByName(spark.createDataFrame([("1", SHEET, 12, ",,,,z")], texts.schema))
    assert grid_src.parts_overlap(again) and not grid_src.parts_overlap(texts)
    parsed = ingest.parse_texts(again)
    assert parsed.rows is None and shown(parsed.staged) == shown(ingest.parse_texts(texts).staged)


def test_rendered_texts_equal_the_texts_of_the_cells(spark):
    """Providers that share a number, a text to be quoted, an empty name, and rows without a month, a total or any count."""
    n = len(analogue.MEASURES)
    counts = list(range(100, 100 + n))
    rows = [(dt.date(y, m, 1), code, name, "ICB", *counts) for y, m in ((1995, 3), (2000, 4), (2001, 5))
            for code, name in (("S0", "Zero"), ("S1", 'A "quoted", name'), ("S3", ""), ("S-3", "minus"), ("S20001", "far"))]
    rows += [(None, "S1", "x", "ICB", *counts), (None, "S2", "x", "ICB", *counts), (dt.date(2000, 4, 1), "S7", "none", None, *[None] * n)]
    schema = "period_date date, org_code string, org_name string, icb_name string, " + ", ".join(f"{c} long" for c in analogue.MEASURES)
    frame = spark.createDataFrame(rows, schema)
    shared = spark.createDataFrame([(3,)], "number int")
    want = grid_src.sheet_texts(grid_src.render_activity_grid(frame))
    got = grid_src.render_activity_texts(frame, shared)
    assert shown(got) == shown(want) and got.where("first_row = 20000").count() == 3


def test_merge_keeps_the_last_row_of_a_key_and_sorts_the_incoming_rows_once(spark):
    cols = "period_date string, org_code string, row_hash string, v long, published long"
    first = spark.createDataFrame([("p", "a", "h1", 1, 1), ("p", "b", "h2", 2, 1), ("p", "c", "h3", 3, 1)], cols)
    key = ("period_date", "org_code")
    held = changes.scd2_merge(changes.empty_versions(first, key, ["v"]), first, key, "2001-01-01 00:00:00", "one", ["v"], "published")
    later = spark.createDataFrame([("p", "a", "h1", 1, 5), ("p", "a", "h9", 9, 4), ("p", "b", "h8", 8, 2), ("p", "b", "h7", 7, 3), ("p", "b", "h6", 6, None),
                                   ("p", "d", "h5", 5, None), (None, "e", "h4", 4, 1), ("p", "f", "h0", 0, 1)], cols)
    merged = changes.scd2_merge(held, later, key, "2001-02-01 00:00:00", "two", ["v"], "published")
    at, then = "2001-01-01 00:00:00", "2001-02-01 00:00:00"
    assert sorted((r.org_code, r.v, r.source_version, str(r.valid_from), str(r.valid_to), r.is_current) for r in merged.collect()) == [
        ("a", 1, "one", at, "None", True), ("b", 2, "one", at, then, False), ("b", 7, "two", then, "None", True),
        ("c", 3, "one", at, "None", True), ("f", 0, "two", then, "None", True)]
    assert "SortAggregate" not in merged._jdf.queryExecution().executedPlan().toString()
