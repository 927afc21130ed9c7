"""The analogue star over the driver tables.

Mapping (grain: supplier x month of ``l_shipdate``):

- provider = ``supplier`` (code ``'S' || s_suppkey``), ICB = ``nation``, region = ``region``
- attendances of type 1 / 2 / 3 = quantity of lines with return flag A / N / R
- breaches (waited over four hours) = lines with ``l_tax >= 0.06``
- emergency admissions = lines with ``l_discount >= 0.08``; "other" admissions = ``l_discount < 0.02``
- decision-to-admit waits over 4 h / 12 h = admission lines with ``l_tax >= 0.06`` / ``>= 0.08``

One scan of ``lineitem`` (seven columns), one partial+final aggregation to the
provider x month grain; every KPI then runs on that much smaller fact.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from edpanel.functions import columns as C
from edpanel.sources.tables import read_table

# Fixed values of the analogue: the domain dates moved inside the 1995–2001 span of the
# driver tables, and a small-provider threshold scaled to the analogue's volumes.
TYPE_FLAGS = {"1": "A", "2": "N", "3": "R"}
BREACH_TAX = 0.06
DTA12_TAX = 0.08
ADMISSION_DISCOUNT = 0.08
OTHER_ADMISSION_DISCOUNT = 0.02


@dataclass(frozen=True)
class AnalogueParams:
    actual_data_from: str = "1995-07-01"
    covid_from: str = "2000-01-01"
    covid_to: str = "2000-12-01"
    target_switch: str = "2000-01-01"
    crs_providers: tuple[int, int] = (1, 14)
    crs_from: str = "1997-05-01"
    crs_to: str = "2001-05-01"
    small_provider_threshold: int = 100
    rag_red_below: float = 70.0
    rag_green_from: float = 90.0
    as_of_date: str = "2001-12-20"


PARAMS = AnalogueParams()

MEASURES = (
    "attendances_type1", "attendances_type2", "attendances_type3", "attendances_total",
    "breaches_type1", "breaches_type2", "breaches_type3", "breaches_total",
    "emergency_admissions_type1", "emergency_admissions_type2", "emergency_admissions_type3",
    "emergency_admissions_via_ae", "emergency_admissions_other", "emergency_admissions_total",
    "dta_breaches_4hr", "dta_breaches_12hr",
)


def activity_lines(spark: SparkSession, sf_dir: str, max_line_number: int | None = None) -> DataFrame:
    """lineitem reduced to the columns the fact needs, with the month and integral quantity.

    ``max_line_number`` keeps only lines up to that number: the revision model treats the
    last line of an order as arriving late (first release vs revised release)."""
    li = read_table(spark, sf_dir, "lineitem", "l_suppkey", "l_quantity", "l_discount", "l_tax",
                    "l_returnflag", "l_shipdate", "l_linenumber")
    if max_line_number is not None:
        li = li.where(F.col("l_linenumber") <= max_line_number)
    return li.select(
        F.col("l_suppkey").alias("provider_key"),
        C.month_start("l_shipdate").alias("period_date"),
        F.col("l_quantity").cast("bigint").alias("q"),
        "l_returnflag", "l_tax", "l_discount")


def build_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """fact_ae_activity: one row per provider x month with all activity counts (E5)."""
    return fact_from_lines(activity_lines(spark, sf_dir))


def fact_from_lines(lines: DataFrame) -> DataFrame:
    """Aggregate activity lines to the provider x month grain."""
    q = F.col("q")
    breach = F.col("l_tax") >= BREACH_TAX
    admitted = F.col("l_discount") >= ADMISSION_DISCOUNT
    other = F.col("l_discount") < OTHER_ADMISSION_DISCOUNT

    def total(cond):
        return F.sum(F.when(cond, q).otherwise(F.lit(0))).cast("bigint")

    aggs = []
    for n, flag in TYPE_FLAGS.items():
        aggs.append(total(F.col("l_returnflag") == flag).alias(f"attendances_type{n}"))
    aggs.append(F.sum(q).cast("bigint").alias("attendances_total"))
    for n, flag in TYPE_FLAGS.items():
        aggs.append(total((F.col("l_returnflag") == flag) & breach).alias(f"breaches_type{n}"))
    aggs.append(total(breach).alias("breaches_total"))
    for n, flag in TYPE_FLAGS.items():
        aggs.append(total((F.col("l_returnflag") == flag) & admitted).alias(f"emergency_admissions_type{n}"))
    aggs += [
        total(admitted).alias("emergency_admissions_via_ae"),
        total(other).alias("emergency_admissions_other"),
        total(admitted | other).alias("emergency_admissions_total"),
        total(admitted & breach).alias("dta_breaches_4hr"),
        total(admitted & (F.col("l_tax") >= DTA12_TAX)).alias("dta_breaches_12hr"),
    ]
    fact = lines.groupBy("provider_key", "period_date").agg(*aggs)
    return fact.select("provider_key", C.month_key("period_date").alias("month_key"), "period_date",
                       *MEASURES)


def build_dim_provider(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Provider -> ICB -> region hierarchy (E3). Nation and region are fixed-size (25 / 5 rows)
    reference tables, so they are broadcast; the supplier side is left to the planner."""
    supplier = read_table(spark, sf_dir, "supplier", "s_suppkey", "s_name", "s_nationkey")
    nation = read_table(spark, sf_dir, "nation", "n_nationkey", "n_name", "n_regionkey")
    region = read_table(spark, sf_dir, "region", "r_regionkey", "r_name")
    return (supplier
            .join(F.broadcast(nation), supplier.s_nationkey == nation.n_nationkey, "left")
            .join(F.broadcast(region), F.col("n_regionkey") == region.r_regionkey, "left")
            .select(F.col("s_suppkey").alias("provider_key"),
                    F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("trust_code"),
                    F.col("s_name").alias("trust_name"),
                    F.col("n_nationkey").alias("icb_code"), F.col("n_name").alias("icb_name"),
                    F.col("r_regionkey").alias("region_code"), F.col("r_name").alias("region_name")))


def month_span(rows: DataFrame) -> DataFrame:
    """One row per month between the first and last period of the rows (E1 input): one
    min/max aggregate, so activity lines serve as well as the fact."""
    bounds = rows.agg(F.min("period_date").alias("lo"), F.max("period_date").alias("hi"))
    return bounds.select(F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 MONTH"))).alias("period_date"))


def month_columns(params: AnalogueParams = PARAMS) -> dict[str, F.Column]:
    """Every dim_month attribute as an expression of ``period_date``."""
    d = F.col("period_date")
    return {
        "month_key": C.month_key(d), "period_date": d, "period_label": C.period_label(d),
        "calendar_year": F.year(d), "month_of_year": F.month(d),
        "financial_year": C.financial_year(d), "financial_quarter": C.financial_quarter(d),
        "financial_year_month_number": C.financial_month_number(d),
        "is_winter_month": C.is_winter(d), "season": C.season(d),
        "is_covid_period": C.is_covid(d, params.covid_from, params.covid_to),
        "data_basis": C.data_basis(d, params.actual_data_from),
        "prior_year_period_date": F.add_months(d, -12)}


def build_dim_month(rows: DataFrame, params: AnalogueParams = PARAMS) -> DataFrame:
    """dim_month (E1): calendar, financial-year and pressure flags per month."""
    return month_span(rows).select(*[c.alias(n) for n, c in month_columns(params).items()])


@dataclass
class Star:
    fact: DataFrame
    dim_provider: DataFrame
    lines: DataFrame
    params: AnalogueParams = field(default=PARAMS)

    @property
    def dim_month(self) -> DataFrame:
        return build_dim_month(self.lines, self.params)

    def joined(self, *month_cols: str) -> DataFrame:
        """fact ⋈ dim_provider with the month attributes asked for (E6). Those are functions
        of the period, so they are computed in the projection: a join to dim_month would
        scan the lines once more for its span. Rows without a period match no month and go.
        The provider side is left to AQE's measured-size broadcast decision."""
        cols = month_columns(self.params)
        f = self.fact.where(F.col("period_date").isNotNull())
        return f.join(self.dim_provider, "provider_key").withColumns(
            {c: cols[c] for c in month_cols if c not in ("month_key", "period_date")})


def build_star(spark: SparkSession, sf_dir: str, params: AnalogueParams = PARAMS) -> Star:
    lines = activity_lines(spark, sf_dir)
    return Star(fact_from_lines(lines), build_dim_provider(spark, sf_dir), lines, params)


# ------------------------------------------------------------------ seeds
def targets_seed(spark: SparkSession, params: AnalogueParams = PARAMS) -> DataFrame:
    """targets(measure, valid_from, valid_to, target): 95 % all types before the switch,
    76 % type 1 from it, 12-hour DTA target 0 (K17). A four-row reference table."""
    d = dt.date.fromisoformat
    rows = [("four_hour_all_types", d("1900-01-01"), d(params.target_switch), 95.0),
            ("four_hour_type1", d(params.target_switch), None, 76.0),
            ("dta_12hr_count", d("1900-01-01"), None, 0.0)]
    schema = T.StructType([T.StructField("measure", T.StringType()),
                           T.StructField("valid_from", T.DateType()),
                           T.StructField("valid_to", T.DateType()),
                           T.StructField("target", T.DoubleType())])
    return spark.createDataFrame(rows, schema)


def crs_list(spark: SparkSession, sf_dir: str, params: AnalogueParams = PARAMS) -> DataFrame:
    lo, hi = params.crs_providers
    s = read_table(spark, sf_dir, "supplier", "s_suppkey")
    return (s.where(F.col("s_suppkey").between(lo, hi))
            .select(F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("org_code"),
                    F.lit(params.crs_from).cast("date").alias("from_period"),
                    F.lit(params.crs_to).cast("date").alias("to_period")))


def published_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Published national totals (A7 analogue): the national monthly quantity computed
    straight from lineitem plus 5 x (month mod 4), so some months pass and some fail
    the ±10 reconciliation rule."""
    lines = activity_lines(spark, sf_dir)
    nat = lines.groupBy("period_date").agg(F.sum("q").cast("bigint").alias("national"))
    return nat.select("period_date", F.lit("total_attendances").alias("metric_name"),
                      (F.col("national") + F.lit(5) * F.pmod(F.month("period_date"), F.lit(4)))
                      .cast("bigint").alias("published_value"))
