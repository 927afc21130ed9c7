"""Grid parsing on hand-made workbooks (the golden cases of FIXTURES §1.1)."""

from __future__ import annotations

import csv
import datetime as dt
import os

import pytest

from edpanel.operators import grid
from edpanel.plans import ingest
from edpanel.plans.ingest import parse_cells
from edpanel.sources import grid as grid_src
from edpanel.sources.registry import default_registry

BANNER = "A&E attendances"
BANNER2 = "A&E attendances greater than 4 hours from arrival to admission"


def sheet(file, name, rows):
    return [(file, name, r, c, v) for r, row in enumerate(rows) for c, v in enumerate(row) if v not in (None, "")]


def activity_rows(branding=3, period="June 2015", total_label="Total attendances", extra=False, dup=False):
    rows = [["A&E Attendances and Emergency Admissions"], ["Period:", "", period]]
    rows += [[f"Source line {i}"] for i in range(max(branding - 2, 0))]
    banner = ["", "", "", BANNER, "", "", "", BANNER2, ""]
    label = ["Code", "Region", "Name", "Type 1  Departments - Major A&E", "Type 2 Departments",
             "Type 3 Departments", total_label, "Type 1 Departments", "Total Attendances > 4 hours"]
    if extra:
        banner.append("Appointments")
        label.append("Booked appointments")
    if dup:
        banner.append("")
        label.append("Name")
    rows += [banner, label]
    rows += [["-", "", "England", "30", "0", "5", "35", "3", "4"],
             ["R1H", "London", "Barts", "1,234", "-", " 7 ", "1241", "12.5", "100"],
             ["RQM", "London", "Chelsea", "5.0", "", "1", "6", "0", "0"],
             [" ", "", "Blank code", "1", "1", "1", "3", "0", "0"],
             ["Note: provisional"], ["TOTAL", "", "", "9"]]
    return rows


def cells_df(spark, rows):
    return spark.createDataFrame(rows, "file string, sheet string, row int, col int, value string")


def staged(spark, cells):
    r = parse_cells(cells_df(spark, cells), materialize=False)
    return r, {row.org_code: row for row in r.staged.collect()}


def test_data_sheet_picked_and_values_coerced(spark):
    cells = sheet("f.xls", "Notes", [["Notes"], ["x"]]) + sheet("f.xls", "Sheet1", activity_rows())
    r, rows = staged(spark, cells)
    assert [tuple(x) for x in r.sheets.collect()] == [("f.xls", "Sheet1")]
    assert sorted(rows) == ["R1H", "RQM"]
    barts = rows["R1H"]
    assert (barts.attendances_type1, barts.attendances_type2, barts.attendances_type3) == (None, None, 7)
    assert barts.breaches_type1 is None and barts.period_date == dt.date(2015, 6, 1)
    assert rows["RQM"].attendances_type1 == 5


def test_first_matching_sheet_of_the_workbook(spark):
    """The place decides between sheets of one fragment and between equal sizes, not the fragments' order."""
    names = {"a": ["Notes", "Zebra provider", "Alpha provider"], "b": ["My data", "Activity", "Provider"],
             "c": ["Z", "Y", "X"], "d": ["Cover", "Blank provider", "Provider"], "e": ["provider B", "provider A"]}
    sizes = {"Alpha provider": 5, "Provider": 1, "X": 2, "Y": 2, "provider A": 4}
    rows, order = [], []
    for file, sheets in names.items():
        for k, name in enumerate(sheets):
            order += [(file, name, k)] if file != "e" else []
            rows += [] if name == "Blank provider" else sheet(file, name, [["x"]] * sizes.get(name, 1))
    listed = spark.createDataFrame(order, "file string, sheet string, sheet_index int")
    cells = cells_df(spark, rows)
    picked = {r.file: r.sheet for r in grid.pick_sheet(cells, default_registry(), listed).collect()}
    assert picked == {"a": "Zebra provider", "b": "Provider", "c": "Y", "d": "Blank provider", "e": "provider A"}
    assert {r.file: r.sheet for r in grid.pick_sheet(cells, default_registry()).collect()}["a"] == "Alpha provider"
    directory = {(r.file, r.sheet): r for r in grid.sheet_directory(cells, listed).collect()}
    assert directory["d", "Blank provider"].non_blank == 0 and directory["d", "Blank provider"].last_row is None
    assert (directory["a", "Alpha provider"].sheet_index, directory["a", "Alpha provider"].last_row) == (2, 4)
    assert directory["e", "provider A"].sheet_index is None


def test_parse_stops_at_a_blank_row(spark):
    rows = activity_rows()
    rows.insert(-2, [])
    rows.append(["RZZ", "London", "After the gap", "9"])
    cells = cells_df(spark, sheet("f.xls", "data", rows))
    every, cut = (sorted(r.org_code for r in parse_cells(cells, materialize=False, until_blank_row=u).staged.collect()) for u in (False, True))
    assert every == ["R1H", "RQM", "RZZ"] and cut == ["R1H", "RQM"]


def test_branding_rows_do_not_change_output(spark):
    outs = []
    for b in (0, 3, 12):
        _, rows = staged(spark, sheet(f"b{b}.xls", "Provider data", activity_rows(branding=b)))
        outs.append({k: (v.attendances_total, v.breaches_total) for k, v in rows.items()})
    assert outs[0] == outs[1] == outs[2] == {"R1H": (1241, 100), "RQM": (6, 0)}


def test_header_on_row_zero_has_empty_banner(spark):
    cells = sheet("h.xls", "data", [["Code", "Name", "X"], ["R1", "A", "1"]])
    r = parse_cells(cells_df(spark, cells), materialize=False)
    labels = {row.col: (row.banner, row.compound) for row in r.labels.collect()}
    assert labels[2] == ("", "X")


def test_banner_forward_filled_over_merged_columns(spark):
    r, _ = staged(spark, sheet("m.xls", "data", activity_rows()))
    comp = {row.col: row.compound for row in r.labels.collect()}
    assert comp[4] == "A&E attendances :: Type 2 Departments"
    assert comp[3] == "A&E attendances :: Type 1 Departments - Major A&E"  # double space collapsed
    assert comp[8] == BANNER2 + " :: Total Attendances > 4 hours"


def test_drift_rename_extra_duplicate(spark):
    cells = sheet("d.xls", "data", activity_rows(total_label="Total Attendance", extra=True, dup=True))
    r, rows = staged(spark, cells)
    log = {(x.drift_type, x.column_detail, x.action_taken) for x in r.drift_log.collect()}
    assert ("renamed", "A&E attendances :: Total Attendance -> attendances_total", "fuzzy_mapped") in log
    assert ("new_column", "Appointments :: Booked appointments", "warned") in log
    assert ("new_column", "Name", "warned") in log  # the second 'Name' maps to nothing
    assert rows["R1H"].org_name == "Barts" and rows["R1H"].attendances_total == 1241


def test_missing_required_and_missing_anchor_halt(spark):
    no_type1 = [["Code", "Name"], ["R1", "A"]]
    no_anchor = [["Provider", "Name"], ["R1", "A"]]
    cells = sheet("a.xls", "data", no_type1) + sheet("b.xls", "data", no_anchor)
    r = parse_cells(cells_df(spark, cells), materialize=False)
    log = {(x.file, x.drift_type, x.action_taken) for x in r.drift_log.collect()}
    assert ("a.xls", "missing_required", "halted") in log
    assert ("b.xls", "no_header", "halted") in log


def test_percent_columns_normalised_per_workbook(spark):
    def wb(name, val):
        return sheet(name, "data", [["Code", "Name", "Percentage in 4 hours or less (all)"], ["R1", "A", val],
                                     ["R2", "B", val]])
    r = parse_cells(cells_df(spark, wb("frac.xls", "0.713") + wb("pct.xls", "71.3")), materialize=False)
    got = {row.file: float(row.performance_all_pct) for row in r.typed.collect()}
    assert got == {"frac.xls": 71.3, "pct.xls": 71.3}


def write_grid_csv(cells: DataFrame, folder: str) -> None:
    """One CSV file per (file, sheet), written by the csv module."""
    rows = cells.collect()
    sheets: dict[tuple[str, str], dict[int, dict[int, str]]] = {}
    for r in rows:
        sheets.setdefault((r.file, r.sheet), {}).setdefault(r.row, {})[r.col] = r.value
    os.makedirs(folder, exist_ok=True)
    for (f, s), grid in sheets.items():
        width = max(max(cols) for cols in grid.values()) + 1
        with open(os.path.join(folder, f"{f}__{s}.csv"), "w", newline="", encoding="utf-8") as fh:
            w = csv.writer(fh)
            for r in range(max(grid) + 1):
                w.writerow([grid.get(r, {}).get(c, "") for c in range(width)])


AWKWARD = [["Code", "Name, full", 'say "hi"', "Name\nof provider"], ["R1", "A", '"', ",\n,"], [], ["R2", "", "", 'x""y']]


def test_csv_export_round_trip(spark, tmp_path):
    rows = sheet("w.xls", "data__2", AWKWARD)
    write_grid_csv(cells_df(spark, rows), str(tmp_path))
    back = grid_src.read_grid_csv(spark, str(tmp_path))
    assert sorted(tuple(r) for r in back.collect()) == sorted(rows)


def test_written_sheets_round_trip(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(grid_src, "PART_ROWS", 2)
    rows = sheet("w.xls", "data__2", AWKWARD) + sheet("v.xls", "Notes", [[], [], [], ["", "late"]])
    grid_src.write_sheets(cells_df(spark, rows), str(tmp_path / "s"))
    assert sorted(tuple(r) for r in grid_src.read_sheets(spark, str(tmp_path / "s")).collect()) == sorted(rows)


def test_grid_scan_equals_render(spark, sf_dir):
    want, got = (sorted(tuple(r) for r in df.collect()) for df in (ingest.analogue_cells(spark, sf_dir), ingest.q_grid_cells(spark, sf_dir)))
    assert got == want and len(got) > 10_000


def test_load_writes_only_when_no_gate_halts(spark, tmp_path):
    def load(cells, name):
        origins = spark.createDataFrame([("f.xls", "hash", "http://h/f.xls", dt.date(2015, 7, 9))], "file string, sha256 string, source_url string, published_at date")
        ingest.load_staging(parse_cells(cells_df(spark, cells), materialize=False), str(tmp_path / name), origins, "2015-07-10 08:00:00")
    load(sheet("f.xls", "data", activity_rows()), "good")
    rows = {r.org_code: r for r in spark.read.parquet(str(tmp_path / "good")).collect()}
    assert sorted(rows) == ["R1H", "RQM"]
    assert (rows["R1H"].source_file_name, rows["R1H"].source_file_hash, rows["R1H"].attendances_total) == ("f.xls", "hash", 1241)
    assert rows["R1H"].is_current and rows["R1H"].publication_date == dt.date(2015, 7, 9)
    assert rows["R1H"].row_hash != rows["RQM"].row_hash and len(rows["R1H"].row_hash) == 64
    for name, cells in (("period", activity_rows(period="soon")), ("column", [["Code", "Name"], ["R1", "A"]]), ("header", [["Provider"], ["R1"]])):
        with pytest.raises(ingest.LoadHaltedError):
            load(sheet("f.xls", "data", cells), name)
        assert not (tmp_path / name).exists()


def test_footnote_filter_rules(spark):
    df = spark.createDataFrame([("R1", "A"), (None, "x"), (" - ", "x"), ("Total", "x"), ("R2", "England"),
                                ("R3", "Total acute"), ("R4", None), ("R5", "Notes"), ("R6", "Eng")],
                               "org_code string, org_name string")
    kept = [r.org_code for r in grid.drop_footnotes(df).collect()]
    assert kept == ["R1", "R4", "R6"]
