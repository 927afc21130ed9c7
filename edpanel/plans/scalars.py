"""Scalar-function and source queries over the driver tables.

Each query applies one column function (or one source operator) to a whole driver
table, so its work grows with the data. Where the function needs human-formatted text,
the text is derived from the table deterministically (e.g. a date printed in one of
several published styles) and the query checks that the function recovers the value.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from edpanel.functions import columns as C
from edpanel.operators import grid, links
from edpanel.sources.tables import read_table


def fin_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C16 on orders.o_orderdate."""
    o = read_table(spark, sf_dir, "orders", "o_orderkey", "o_orderdate")
    d = F.to_date("o_orderdate")
    return o.select("o_orderkey", C.financial_year(d).alias("financial_year"),
                    C.financial_quarter(d).alias("financial_quarter"),
                    C.financial_month_number(d).alias("financial_year_month_number"),
                    C.is_winter(d).alias("is_winter_month"), C.season(d).alias("season"),
                    C.winter_year(d).alias("winter_year"))


def release_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected release (2nd Thursday of the next month) for every order month."""
    o = read_table(spark, sf_dir, "orders", "o_orderdate")
    return (o.select(C.month_start("o_orderdate").alias("period_date")).distinct()
            .select("period_date", C.expected_release_date("period_date").alias("release_date")))


# Published period styles used to print a date back as text (fixed values).
PERIOD_STYLES = ("MMM-yy", "MMMM yyyy", "yyyy-MM-dd", "serial", "MMM yyyy", "MMM. ''yy")


def _period_text(d: F.Column, k: F.Column) -> F.Column:
    serial = F.datediff(d, F.lit("1899-12-30").cast("date")).cast("string")
    out = F.lit(None).cast("string")
    for i, style in reversed(list(enumerate(PERIOD_STYLES))):
        txt = serial if style == "serial" else F.date_format(d, style)
        out = F.when(k == i, txt).otherwise(out)
    return out


def month_trunc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order dates printed in rotating published styles parse back to their month."""
    o = read_table(spark, sf_dir, "orders", "o_orderkey", "o_orderdate")
    k = F.pmod(F.col("o_orderkey"), F.lit(len(PERIOD_STYLES)))
    txt = o.select("o_orderkey", _period_text(F.to_date("o_orderdate"), k).alias("period_text"))
    return txt.select("o_orderkey", "period_text", grid.parse_month_text(F.col("period_text")).alias("period_date"))


def safe_pct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C19 on every lineitem: (quantity mod 13) / ((line number - 1) x 3) x 100, 1 dp,
    NULL for the zero denominators of first lines."""
    li = read_table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_quantity")
    num = F.pmod(F.col("l_quantity").cast("bigint"), F.lit(13))
    den = (F.col("l_linenumber") - 1) * 3
    return li.select("l_orderkey", "l_linenumber", C.pct(num, den).alias("pct"))


def row_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C20 over customer (integer and string columns)."""
    c = read_table(spark, sf_dir, "customer", "c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    return c.select("c_custkey", C.row_hash("c_custkey", "c_name", "c_nationkey", "c_mktsegment").alias("row_hash"))


def url_filename(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C21 over pages.url."""
    p = read_table(spark, sf_dir, "pages", "page_id", "url")
    return p.select("page_id", C.url_filename("url").alias("file_name"))


def _integer_text(q: F.Column, k: F.Column) -> F.Column:
    """Integers as a spreadsheet prints them, by line number: plain, padded, '5.0',
    thousands separator, '-', a fraction, blank."""
    return (F.when(k == 1, q.cast("string"))
            .when(k == 2, F.concat(F.lit(" "), q.cast("string"), F.lit(" ")))
            .when(k == 3, F.concat(q.cast("string"), F.lit(".0")))
            .when(k == 4, F.format_number(q * 1000, 0))
            .when(k == 5, F.lit("-"))
            .when(k == 6, F.concat(q.cast("string"), F.lit(".5")))
            .otherwise(F.lit("  ")))


def coerce_int(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C9 over lineitem quantities printed in the styles above."""
    li = read_table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_quantity")
    raw = _integer_text(F.col("l_quantity").cast("bigint"), F.col("l_linenumber"))
    t = li.select("l_orderkey", "l_linenumber", raw.alias("raw"))
    return t.select("l_orderkey", "l_linenumber", "raw", C.coerce_int("raw").alias("value"),
                    C.coerce_int_rejected("raw").alias("rejected"))


def coerce_pct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Discounts published as a 0–1 fraction by even 'files' (order key mod 10) and
    as 0–100 by odd ones; both normalise to 0–100 per file."""
    li = read_table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_discount")
    f = F.pmod(F.col("l_orderkey"), F.lit(10))
    disc = F.col("l_discount").cast("decimal(10,4)")
    raw = F.when(f % 2 == 0, disc.cast("string")).otherwise((disc * 100).cast("decimal(10,2)").cast("string"))
    t = li.select("l_orderkey", "l_linenumber", f.alias("file"), raw.alias("raw"))
    return grid.normalise_percent(t.withColumn("value", C.coerce_pct_raw("raw")), ["file"], ["value"]).select(
        "l_orderkey", "l_linenumber", "file", F.col("value").cast("double").alias("value"))


def coerce_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C11: customer names, with every fifth blanked to whitespace (NULL) and every
    seventh padded (kept untrimmed)."""
    c = read_table(spark, sf_dir, "customer", "c_custkey", "c_name")
    k = F.col("c_custkey")
    raw = (F.when(F.pmod(k, F.lit(5)) == 0, F.lit("   "))
           .when(F.pmod(k, F.lit(7)) == 0, F.concat(F.lit(" "), F.col("c_name"), F.lit(" ")))
           .otherwise(F.col("c_name")))
    return c.select("c_custkey", C.coerce_text(raw).alias("value"))


def compound_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C4 over part: banner = manufacturer, label = type (with doubled spaces and line
    breaks), an identity word, or blank."""
    p = read_table(spark, sf_dir, "part", "p_partkey", "p_brand", "p_type")
    k = F.pmod(F.col("p_partkey"), F.lit(6))
    label = (F.when(k == 0, F.lit("Code")).when(k == 1, F.lit(""))
             .when(k == 2, F.regexp_replace("p_type", " ", "  "))
             .when(k == 3, F.regexp_replace("p_type", " ", "\n"))
             .when(k == 4, F.lit("name")).otherwise(F.col("p_type")))
    banner = F.when(F.pmod(F.col("p_partkey"), F.lit(4)) == 0, F.lit("")).otherwise(F.col("p_brand"))
    return p.select("p_partkey", grid.compound_label(banner, label).alias("compound"))


# Analogue footnote patterns on part (fixed values): brand codes ending 1 or 5 stand for
# aggregate rows; names starting 'almond' or exactly 'total' are footnote rows.
PART_CODE_PATTERN = r"(?i)#[0-9]1|#[0-9]5"
PART_NAME_PATTERN = r"(?i)^almond|^total$"


def footnote_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C7 over part: code = brand ('-' for every 9th), name = p_name (NULL for every 10th)."""
    p = read_table(spark, sf_dir, "part", "p_partkey", "p_brand", "p_name")
    k = F.col("p_partkey")
    rows = p.select("p_partkey",
                    F.when(F.pmod(k, F.lit(9)) == 0, F.lit(" - ")).otherwise(F.col("p_brand")).alias("org_code"),
                    F.when(F.pmod(k, F.lit(10)) == 0, F.lit(None).cast("string")).otherwise(F.col("p_name"))
                    .alias("org_name"))
    return grid.drop_footnotes(rows, PART_CODE_PATTERN, PART_NAME_PATTERN)


def ffill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C3 over events: every third value blanked, then filled forward per user by time
    (``last_value IGNORE NULLS``), bucketed by hour so one busy user never lands in one
    task whole."""
    e = read_table(spark, sf_dir, "events", "event_id", "ts", "user_id", "value")
    v = F.when(F.pmod(F.col("event_id"), F.lit(3)) == 0, F.lit(None).cast("double")).otherwise(F.col("value"))
    rows = e.select("event_id", "user_id", "ts", v.alias("raw"))
    filled = grid.forward_fill(rows, ["user_id"], ["ts", "event_id"], "raw", "filled", F.date_trunc("hour", "ts"))
    return filled.select("event_id", "user_id", "raw", "filled")


# ------------------------------------------------------------------ A1, A3
def raw_file_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1: each document is a raw file; size and SHA-256 of its bytes."""
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text")
    return links.content_hashes(docs, "text").select("doc_id", "size_bytes", "sha256")


# Analogue link-search pattern (the monthly-file pattern has no hits in the driver pages).
ANALOGUE_LINK_PATTERN = r"(?i)^(the|la|der)[.,;:!?]*$"


def link_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A3 over pages: first anchor whose text matches, absolutised; pages without one
    are reported with status 'no_match'."""
    p = read_table(spark, sf_dir, "pages", "page_id", "url", "html")
    return links.resolve_links(p, ANALOGUE_LINK_PATTERN)


# Analogue texts and href ending of the second step (fixed values).
ANALOGUE_FILE_TEXTS = ("the", "la", "der")
ANALOGUE_FILE_PATTERN = r"(?i)[aeiou][.,;:!?]*$"


def link_file_step(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A3, second step, over all pages as category pages."""
    p = read_table(spark, sf_dir, "pages", "page_id", "url", "html")
    return links.resolve_files(p, ANALOGUE_FILE_TEXTS, ANALOGUE_FILE_PATTERN)
