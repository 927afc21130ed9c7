"""Column helpers: every function takes and returns ``Column`` so it stays inside
whole-stage codegen. No Python UDF is registered anywhere in the package.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the source conventions.
ROW_HASH_SEPARATOR = "\x1f"          # unit separator between hashed values
NULL_HASH_TOKEN = ""                 # NULL is hashed as the empty string
DEFAULT_DOWNLOAD_NAME = "download.xls"
MONTH_WORDS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")
# A month word followed by a two- or four-digit year, e.g. "May 26", "June 2015", "Sept '24".
PERIOD_TEXT_PATTERN = r"(?i)\b(jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)[a-z]*\.?[\s\-]+'?(\d{4}|\d{2})\b"
WINTER_MONTHS = (11, 12, 1, 2)
SUMMER_MONTHS = (6, 7, 8)
ACTUAL_DATA_FROM = "2015-06-01"      # earlier months are estimated
COVID_FROM, COVID_TO = "2020-01-01", "2021-12-01"


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---------------------------------------------------------------- ratios
def int_div(a: Column, b: Column) -> Column:
    """``a div b`` for a >= 0, b > 0 as BIGINT, exact for BIGINT and DECIMAL operands."""
    return F.call_function("div", a, b)


def pct_tenths(num: str | Column, den: str | Column) -> Column:
    """100 * num / den in tenths of a percent, rounded half away from zero, as BIGINT.

    Exact integer arithmetic: no binary floating point between the counts and the
    rounded result, so every engine agrees. NULL when den is 0 or NULL.
    """
    n, d = col(num).cast("bigint"), col(den).cast("bigint")
    safe_d = F.when(d == 0, F.lit(1)).otherwise(F.abs(d)).cast("bigint")
    wide_n, wide_d = F.abs(n).cast("decimal(20,0)"), safe_d.cast("decimal(20,0)")  # 2000 * n may pass 2**63
    tenths = int_div(F.lit(2000) * wide_n + wide_d, F.lit(2) * wide_d)
    return F.when(d.isNull() | (d == 0), F.lit(None).cast("bigint")).otherwise(
        (F.signum(n) * F.signum(d)).cast("bigint") * tenths)


def pct(num: str | Column, den: str | Column) -> Column:
    """Safe percentage ``ROUND(num / NULLIF(den, 0) * 100, 1)`` as DOUBLE."""
    return (pct_tenths(num, den) / F.lit(10.0)).cast("double")


def round_half_up_tenths(value_tenths: Column) -> Column:
    """Round a non-negative DOUBLE measured in tenths to a whole tenth, return percent."""
    return (F.floor(value_tenths + F.lit(0.5)) / F.lit(10.0)).cast("double")


def mean_tenths(sum_tenths: Column, n: Column) -> Column:
    """ROUND(AVG(x), 1) for x held as integer tenths, exact, as DOUBLE percent."""
    s, c = sum_tenths.cast("bigint"), n.cast("bigint")
    mag = F.lit(2) * F.abs(s) + c
    safe_c = F.when(c == 0, F.lit(1)).otherwise(c).cast("bigint")
    return F.when(c == 0, F.lit(None).cast("double")).otherwise(
        (F.signum(s) * int_div(mag, F.lit(2) * safe_c) / F.lit(10.0)).cast("double"))


# ------------------------------------------------------ calendar
def month_start(d: str | Column) -> Column:
    return F.trunc(F.to_date(col(d)), "month")


def month_key(d: str | Column) -> Column:
    """yyyymm as INT."""
    dd = F.to_date(col(d))
    return (F.year(dd) * 100 + F.month(dd)).cast("int")


def period_label(d: str | Column) -> Column:
    """'Jan 2024' style label."""
    return F.date_format(F.to_date(col(d)), "MMM yyyy")


def financial_year_start(d: str | Column) -> Column:
    return F.year(F.add_months(F.to_date(col(d)), -3))


def financial_year(d: str | Column) -> Column:
    """April–March year label, e.g. 2024-04-01 -> '2024/25'."""
    start = financial_year_start(d)
    return F.concat(start.cast("string"), F.lit("/"),
                    F.lpad(F.pmod(start + 1, F.lit(100)).cast("string"), 2, "0"))


def financial_quarter(d: str | Column) -> Column:
    """Q1 = Apr–Jun … Q4 = Jan–Mar."""
    return F.concat(F.lit("Q"), F.quarter(F.add_months(F.to_date(col(d)), -3)).cast("string"))


def financial_month_number(d: str | Column) -> Column:
    """1 = April … 12 = March."""
    return F.month(F.add_months(F.to_date(col(d)), -3))


def is_winter(d: str | Column) -> Column:
    return F.month(F.to_date(col(d))).isin(*WINTER_MONTHS)


def winter_year(d: str | Column) -> Column:
    """A Nov–Feb winter belongs to the year of its November (NULL outside winter)."""
    dd = F.to_date(col(d))
    return F.when(is_winter(dd), F.year(F.add_months(dd, -2)))


def season(d: str | Column) -> Column:
    m = F.month(F.to_date(col(d)))
    return (F.when(m.isin(12, 1, 2), "winter").when(m.isin(3, 4, 5), "spring")
            .when(m.isin(6, 7, 8), "summer").otherwise("autumn"))


def data_basis(d: str | Column, actual_from: str = ACTUAL_DATA_FROM) -> Column:
    return F.when(F.to_date(col(d)) >= F.lit(actual_from).cast("date"), "actual").otherwise("estimated")


def is_covid(d: str | Column, start: str = COVID_FROM, end: str = COVID_TO) -> Column:
    dd = F.to_date(col(d))
    return dd.between(F.lit(start).cast("date"), F.lit(end).cast("date"))


def expected_release_date(d: str | Column) -> Column:
    """Second Thursday of the month after the period."""
    first_next = F.add_months(month_start(d), 1)
    first_thursday = F.next_day(F.date_sub(first_next, 1), "Thu")
    return F.date_add(first_thursday, 7)


# ---------------------------------------------------------- hashing (A1, C20)
def row_hash(*cols: str | Column) -> Column:
    """sha256 hex of the values joined by the unit separator, NULL hashed as ''."""
    parts = [F.coalesce(col(c).cast("string"), F.lit(NULL_HASH_TOKEN)) for c in cols]
    return F.sha2(F.concat_ws(ROW_HASH_SEPARATOR, *parts), 256)


def url_filename(url: str | Column) -> Column:
    """Last path segment of a URL, percent-decoded; empty -> 'download.xls' (C21)."""
    path = F.coalesce(F.regexp_extract(col(url), r"^(?:[a-zA-Z][a-zA-Z0-9+.\-]*:)?(?://[^/?#]*)?([^?#]*)", 1),
                      F.lit(""))
    last = F.regexp_extract(path, r"([^/]*)$", 1)
    decoded = F.try_url_decode(last) if hasattr(F, "try_url_decode") else F.url_decode(last)
    return F.coalesce(F.nullif(F.coalesce(decoded, last), F.lit("")), F.lit(DEFAULT_DOWNLOAD_NAME))


# ------------------------------------------------------- coercions
def collapse_ws(c: str | Column) -> Column:
    """Trim and collapse whitespace runs to one space."""
    return F.trim(F.regexp_replace(col(c), r"\s+", " "))


def coerce_text(c: str | Column) -> Column:
    """Blank or whitespace-only -> NULL; otherwise the value untouched (not trimmed)."""
    v = col(c)
    return F.when(F.trim(v) != "", v)


def coerce_int(c: str | Column) -> Column:
    """'-', '1,234', blank, 'NaN', '12.5' -> NULL; ' 7 ' -> 7; '5.0' -> 5 (BIGINT)."""
    v = F.trim(col(c))
    d = v.try_cast("decimal(38,9)")  # only for what is no plain integer: wide decimals are slow
    return F.coalesce(v.try_cast("bigint"), F.when(d == F.floor(d), d.try_cast("bigint")))


def coerce_int_rejected(c: str | Column) -> Column:
    """True when a non-blank raw value did not survive integer coercion."""
    return (coerce_text(c).isNotNull() & coerce_int(c).isNull())


def coerce_pct_raw(c: str | Column) -> Column:
    """Percent text -> DECIMAL(18,6) in the source scale (0–1 or 0–100)."""
    return F.trim(col(c)).try_cast("decimal(18,6)")

