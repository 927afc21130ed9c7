"""Sheets cut over file splits: the cells do not depend on where a file is cut."""

from __future__ import annotations

import csv
import io

import pytest

from edpanel.sources import grid

SHEET = ('Title,,"a, b"\r\n'
         '\n'
         '"two\nlines, ""quoted""",x,\n'
         ',"",é€,"""lead"\n'
         '"spans\n\n\nfour",1,"and\nagain"\n'
         'last,,,9')


def _expected(text, name="book", sheet="S"):
    rows = csv.reader(io.StringIO(text.replace("\r\n", "\n"), newline=""))
    return sorted((name, sheet, r, c, v) for r, row in enumerate(rows) for c, v in enumerate(row) if v.strip(" "))


@pytest.fixture
def split_bytes(spark):
    def use(n):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(n))
        spark.conf.set("spark.sql.files.openCostInBytes", str(1 << 20))
    yield use
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


CUT = 64


def test_cells_do_not_depend_on_the_cut(spark, tmp_path, split_bytes):
    """The sheet behind a first line of 0 to 63 letters, cut every 64 bytes: at every byte once."""
    expected = []
    for pad in range(CUT):
        text = "x" * pad + "\n" + SHEET
        (tmp_path / f"b{pad}__S.csv").write_bytes(text.encode())
        expected += _expected(text, f"b{pad}")
    split_bytes(CUT)
    assert sorted(map(tuple, grid.read_grid_csv(spark, str(tmp_path)).collect())) == sorted(expected)


def test_cells_when_every_byte_is_a_split(spark, tmp_path, split_bytes):
    (tmp_path / "book__S.csv").write_bytes(SHEET.encode())
    split_bytes(1)
    assert sorted(map(tuple, grid.read_grid_csv(spark, str(tmp_path)).collect())) == _expected(SHEET)


def test_long_sheet_is_read_in_many_splits(spark, tmp_path, split_bytes):
    text = "".join(f'{i},"row {i}\nsecond ""line""",{i * 2}\n' for i in range(5000))
    (tmp_path / "long__S.csv").write_text(text)
    (tmp_path / "other.csv").write_text("a,b\n\nc\n")
    split_bytes(10_000)
    df = grid.read_grid_csv(spark, str(tmp_path))
    assert "wholetext" not in df._jdf.queryExecution().toString()
    got = sorted(map(tuple, df.collect()))
    assert got == sorted(_expected(text, "long") + [("other", "Sheet1", 0, 0, "a"), ("other", "Sheet1", 0, 1, "b"),
                                                    ("other", "Sheet1", 2, 0, "c")])


def test_empty_folder_and_empty_sheet(spark, tmp_path):
    (tmp_path / "none__S.csv").write_text("")
    assert grid.read_grid_csv(spark, str(tmp_path)).count() == 0
