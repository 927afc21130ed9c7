"""Unmapped columns kept as captured values, and the stop at the first blank row."""

from __future__ import annotations

from pyspark.sql import functions as F

from edpanel.operators import drift, grid, sinks
from edpanel.plans import ingest
from edpanel.sources.registry import ColumnSpec
from test_grid import activity_rows, cells_df, sheet

BOOKED = ColumnSpec("booked", ("appointments :: booked",), "integer")


def test_captured_column_read_under_a_later_version(spark, tmp_path):
    old = activity_rows()
    new = activity_rows(period="July 2015", extra=True)
    for row, v in zip(new, [""] * 5 + ["77", "1,000", "12"]):
        row += [""] * (9 - len(row)) + ([v] if len(row) < 10 else [])
    cells = sheet("old.xls", "Sheet1", old) + sheet("new.xls", "Sheet1", new)
    result = ingest.parse_cells(cells_df(spark, cells), materialize=False)
    rows = ingest.staged_with_unmapped(result).drop("file")
    sinks.replace_periods(rows, str(tmp_path / "staging"))
    back = drift.read_across_versions(spark.read.schema(rows.schema).parquet(str(tmp_path / "staging")), [BOOKED])
    got = {(r.period_date.month, r.org_code): (r.attendances_total, r.booked) for r in back.collect()}
    codes = {c for _, c in got}
    assert len(got) == 4 and all(got[(6, c)][1] is None for c in codes)          # the old sheet has no such column
    path = "$['Appointments :: Booked appointments']"
    july = rows.where("month(period_date) = 7").select("org_code", F.variant_get("_unmapped", path, "string").alias("v"))
    raw = {r.org_code: r.v for r in july.collect()}
    assert raw == {"R1H": "1,000", "RQM": "12"}
    assert {c: got[(7, c)][1] for c in codes} == {"R1H": None, "RQM": 12}        # '1,000' is no integer, as in every column


def test_equal_labels_are_told_apart(spark):
    cells = sheet("f.xls", "S", [["Code", "x", "x"], ["A", "1", "2"], ["B", "", "3"]])
    labels = grid.header_labels(cells_df(spark, cells), spark.createDataFrame([("f.xls", "S", 0)], "file string, sheet string, header_row int"))
    headers = spark.createDataFrame([("f.xls", "S", 0)], "file string, sheet string, header_row int")
    mapping = labels.where("col = 0").select("file", "sheet", "col")
    um = drift.unmapped_capture(cells_df(spark, cells), headers, labels, mapping)
    assert {r.row: r.j for r in um.selectExpr("row", "to_json(_unmapped) j").collect()} == {
        1: '{"x":"1","x #2":"2"}', 2: '{"x #2":"3"}'}


def test_known_value_wins_over_the_captured_one(spark):
    df = spark.sql("SELECT id, CASE WHEN id = 1 THEN 5L END AS booked, parse_json('{\"Appointments :: Booked\": \"8\"}') AS _unmapped "
                   "FROM range(3) UNION ALL SELECT 9, NULL, NULL")
    got = {r.id: r.booked for r in drift.read_across_versions(df, [BOOKED]).collect()}
    assert got == {0: 8, 1: 5, 2: 8, 9: None}


def test_stop_at_blank_row(spark):
    rows = [["t"], ["Code"], ["A"], ["B"], [""], ["C"], [""], ["D"]]
    cells = sheet("f.xls", "S", rows) + sheet("g.xls", "S", [["Code"], [""], ["A"]]) + sheet("h.xls", "S", [["Code"], ["A"]]) \
        + sheet("i.xls", "S", [["none"], [""], ["A"]])
    headers = spark.createDataFrame([("f.xls", "S", 1), ("g.xls", "S", 0), ("h.xls", "S", 0)],
                                    "file string, sheet string, header_row int")
    kept = grid.stop_at_blank_row(cells_df(spark, cells), headers)
    assert sorted((r.file[0], r.row) for r in kept.collect()) == [
        ("f", 0), ("f", 1), ("f", 2), ("f", 3), ("g", 0), ("h", 0), ("h", 1), ("i", 0), ("i", 2)]
