"""Column functions: golden cases from the reference's conventions."""

from __future__ import annotations

import datetime as dt
import hashlib

import pytest
from pyspark.sql import functions as F

from edpanel.functions import columns as C
from edpanel.operators import grid


def one_col(spark, values, expr, dtype="string"):
    df = spark.createDataFrame([(v,) for v in values], f"v {dtype}")
    return [r[0] for r in df.select(expr(F.col("v"))).collect()]


def test_coerce_int_golden(spark):
    raw = ["-", "1,234", " 7 ", "5.0", "12.5", "", "NaN", None, "0"]
    assert one_col(spark, raw, C.coerce_int) == [None, None, 7, 5, None, None, None, None, 0]
    assert one_col(spark, raw, C.coerce_int_rejected) == [True, True, False, False, True, False, True, False, False]


def test_coerce_text_keeps_value_untrimmed(spark):
    assert one_col(spark, [" R1H ", "   ", "", None, "x"], C.coerce_text) == [" R1H ", None, None, None, "x"]


def test_pct_rounds_half_away_from_zero_and_guards_zero(spark):
    df = spark.createDataFrame([(1, 8), (2, 3), (0, 0), (None, 5), (5, None), (1, 16), (-1, 8)], "n long, d long")
    got = [r[0] for r in df.select(C.pct("n", "d")).collect()]
    assert got == [12.5, 66.7, None, None, None, 6.3, -12.5]


def test_financial_calendar(spark):
    df = spark.createDataFrame([(dt.date(2024, 4, 1),), (dt.date(2025, 3, 31),), (dt.date(2023, 12, 15),)], "d date")
    rows = df.select(C.financial_year("d"), C.financial_quarter("d"), C.financial_month_number("d"),
                     C.is_winter("d"), C.winter_year("d")).collect()
    assert [tuple(r) for r in rows] == [("2024/25", "Q1", 1, False, None), ("2024/25", "Q4", 12, False, None),
                                        ("2023/24", "Q3", 9, True, 2023)]


def test_release_date_second_thursday_of_next_month(spark):
    df = spark.createDataFrame([(dt.date(2026, 2, 1),), (dt.date(2001, 11, 1),)], "d date")
    assert [r[0] for r in df.select(C.expected_release_date("d")).collect()] == [dt.date(2026, 3, 12),
                                                                                  dt.date(2001, 12, 13)]


def test_row_hash_matches_python_sha256(spark):
    df = spark.createDataFrame([("a", 1, None)], "x string, y int, z string")
    got = df.select(C.row_hash("x", "y", "z")).first()[0]
    assert got == hashlib.sha256("a\x1f1\x1f".encode()).hexdigest()


@pytest.mark.parametrize("url,name", [
    ("https://x.org/files/AE%20Data%20Jan.xls", "AE Data Jan.xls"),
    ("https://x.org/files/", "download.xls"),
    ("https://x.org/a/b.xlsx?download=1#top", "b.xlsx"),
])
def test_url_filename(spark, url, name):
    assert one_col(spark, [url], C.url_filename) == [name]


def test_parse_month_text_styles(spark):
    raw = ["May 26", "June 2015", "Sept '24", "Jun-15", "2015-06-17", "42156", "Period", None]
    got = one_col(spark, raw, grid.parse_month_text)
    assert got == [dt.date(2026, 5, 1), dt.date(2015, 6, 1), dt.date(2024, 9, 1), dt.date(2015, 6, 1),
                   dt.date(2015, 6, 1), dt.date(2015, 6, 1), None, None]


def test_compound_label(spark):
    df = spark.createDataFrame([("A&E  attendances", "Type 1\nDepartments"), ("Banner", "Code"), ("", "Name"),
                                ("Banner", ""), (None, None)], "b string, l string")
    got = [r[0] for r in df.select(grid.compound_label(F.col("b"), F.col("l"))).collect()]
    assert got == ["A&E attendances :: Type 1 Departments", "Code", "Name", "Banner", ""]
