"""KPIs over the provider x month star.

Every ratio goes through :func:`edpanel.functions.columns.pct` (NULL on a zero or
missing denominator, exact half-away-from-zero rounding). Windows are partitioned by
provider only: at the fact grain a provider holds at most one row per month, so no
window partition grows with the data. Per-period ranks and percentiles go through
value histograms (:mod:`edpanel.operators.ranking`).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from edpanel.functions import columns as C
from edpanel.operators import ranking
from edpanel.plans.analogue import Star

def _measure(name: str):
    return lambda: F.col(name)


T1, T2, T3 = _measure("attendances_type1"), _measure("attendances_type2"), _measure("attendances_type3")
A1, A2, A3 = (_measure("emergency_admissions_type1"), _measure("emergency_admissions_type2"),
              _measure("emergency_admissions_type3"))
TOTAL, BREACHES = _measure("attendances_total"), _measure("breaches_total")

PROVIDER_COLS = ("trust_code", "trust_name")


def _by_provider() -> Window:
    return Window.partitionBy("provider_key").orderBy("period_date")


def with_performance(df: DataFrame) -> DataFrame:
    """Adds within-4h count and the 4-hour performance in tenths and percent (K5)."""
    return (df.withColumn("attendances_within_4hrs", TOTAL() - BREACHES())
            .withColumn("perf_tenths", C.pct_tenths(TOTAL() - BREACHES(), TOTAL()))
            .withColumn("performance_pct", C.pct(TOTAL() - BREACHES(), TOTAL())))


# ------------------------------------------------------------------ K1–K7
# The fact holds one row per provider and month already: no second grouping.
def kpi01_total_attendances(star: Star) -> DataFrame:
    s = star.joined("period_label")
    return s.select("trust_code", "trust_name", "period_label", "period_date",
                    (T1() + T2() + T3()).alias("total_attendances"))


def kpi02_type1_attendances(star: Star) -> DataFrame:
    s = star.joined("period_label")
    return s.select("trust_code", "trust_name", "period_label", "period_date", T1().alias("type1_attendances"))


def admissions_via_ae(df_col_prefix: str = "") -> F.Column:
    """Reported via-A&E total, else the sum of the type columns."""
    return F.coalesce(F.col("emergency_admissions_via_ae"), A1() + A2() + A3())


def kpi03_emergency_admissions(star: Star) -> DataFrame:
    s = star.joined("period_label")
    return s.select("trust_code", "trust_name", "period_label", "period_date",
                    admissions_via_ae().alias("emergency_admissions"))


def conversion_band(pct_col: F.Column) -> F.Column:
    return (F.when(pct_col.isNull(), None).when(pct_col < 20, "low").when(pct_col < 25, "below_normal")
            .when(pct_col <= 35, "normal").when(pct_col <= 40, "high").otherwise("very_high"))


def kpi04_admission_conversion(star: Star) -> DataFrame:
    s = star.joined("period_label")
    rate = C.pct(A1() + A2() + A3(), T1() + T2() + T3())
    return s.select("trust_code", "period_label", "period_date",
                    rate.alias("admission_conversion_rate_pct"),
                    conversion_band(rate).alias("acuity_band"))


def kpi05_four_hour_performance(star: Star) -> DataFrame:
    s = star.joined("period_label")
    return s.select("trust_code", "period_label", "period_date",
                    TOTAL().alias("total_attendances"), BREACHES().alias("total_attendances_gt_4hrs"),
                    (TOTAL() - BREACHES()).alias("attendances_within_4hrs"),
                    C.pct(TOTAL() - BREACHES(), TOTAL()).alias("performance_pct"))


def kpi06_type1_performance(star: Star) -> DataFrame:
    s = star.joined("period_label")
    b1 = F.col("breaches_type1")
    return s.select("trust_code", "period_label", "period_date", T1().alias("type1_attendances"),
                    b1.alias("type1_attendances_gt_4hrs"),
                    C.pct(T1() - b1, T1()).alias("type1_performance_pct"))


def breach_count() -> F.Column:
    """Reported total breaches, else the sum of the type columns."""
    return F.coalesce(BREACHES(), F.col("breaches_type1") + F.col("breaches_type2") + F.col("breaches_type3"))


def kpi07_breach_count(star: Star) -> DataFrame:
    s = star.joined("period_label")
    return s.select("trust_code", "period_label", "period_date", breach_count().alias("attendances_gt_4hrs"))


# ------------------------------------------------------------------ K8 YoY
def kpi08_yoy_lag(star: Star) -> DataFrame:
    """Row-offset LAG(12) as written in the KPI definition (wrong across gaps: V13)."""
    s = star.joined("period_label")
    prior = F.lag(TOTAL(), 12).over(_by_provider())
    return s.select("trust_code", "period_label", "period_date",
                    TOTAL().alias("current_period_attendances"),
                    prior.alias("prior_year_attendances"),
                    C.pct(TOTAL() - prior, prior).alias("yoy_change_pct"))


def kpi08_yoy_calendar(star: Star) -> DataFrame:
    """Same-month-last-year by calendar (K8b): a range frame over the provider's month
    numbers that holds exactly the month twelve before, absent months giving NULL."""
    month_no = F.year("period_date") * 12 + F.month("period_date")
    s = star.joined("period_label").withColumn("_month_no", month_no)
    w = Window.partitionBy("provider_key").orderBy("_month_no").rangeBetween(-12, -12)
    p = F.col("prior_year_attendances")
    return s.withColumn("prior_year_attendances", F.sum(TOTAL()).over(w).cast("bigint")).select(
        "trust_code", "period_label", "period_date",
        TOTAL().alias("current_period_attendances"), p,
        C.pct(TOTAL() - p, p).alias("yoy_change_pct"))


def yoy_report(star: Star) -> DataFrame:
    """The year-on-year report in its printed order (I1): month, then the change from the highest
    down, providers without a prior year last, equal changes by code."""
    order = [F.col("period_date").asc_nulls_first(), F.col("yoy_change_pct").desc_nulls_last(), F.col("trust_code").asc_nulls_first()]
    rows = kpi08_yoy_calendar(star).select("trust_code", "period_date", "current_period_attendances", "yoy_change_pct")
    return ranking.numbered(rows, order)


# ------------------------------------------------------------------ K9 rank
def kpi09_provider_rank(star: Star) -> DataFrame:
    s = with_performance(star.joined("period_label")).where(TOTAL() > 0)
    ranked = ranking.rank_within(s, ["period_date"], "perf_tenths", descending=True,
                                 rank_col="national_rank", count_col="total_providers")
    return ranked.select("trust_code", "trust_name", "period_label", "period_date", "performance_pct",
                         "national_rank", "total_providers")


# ------------------------------------------------------------------ K10–K12
def kpi10_icb_performance(star: Star) -> DataFrame:
    s = star.joined("period_label")
    g = (s.groupBy("icb_code", "icb_name", "period_label", "period_date")
         .agg(F.sum(TOTAL()).cast("bigint").alias("icb_total_attendances"),
              F.sum(TOTAL() - BREACHES()).cast("bigint").alias("icb_within_4hrs")))
    return g.withColumn("icb_performance_pct", C.pct("icb_within_4hrs", "icb_total_attendances"))


def kpi11_type3_share(star: Star) -> DataFrame:
    s = star.joined("period_label")
    return s.select("trust_code", "period_label", "period_date", T3().alias("type3_attendances"),
                    C.pct(T3(), TOTAL()).alias("type3_share_pct"))


QUARTILES = {"p25": (1, 4), "median": (1, 2), "p75": (3, 4)}


def national_distribution(star: Star, threshold: int | None = None) -> DataFrame:
    """Per period: exact P25 / median / P75 of provider performance (tenths), with the sum
    and count behind the mean, all from one value histogram."""
    thr = star.params.small_provider_threshold if threshold is None else threshold
    return distribution(with_performance(star.fact), thr)


def distribution(rows: DataFrame, threshold: int) -> DataFrame:
    """The same of any rows that carry ``perf_tenths``."""
    s = rows.where((TOTAL() > threshold) & F.col("period_date").isNotNull())
    q = ranking.percentile_cont(s, ["period_date"], "perf_tenths", QUARTILES)
    return q.withColumnsRenamed({"total": "sum_tenths", "n": "n_perf"})


def kpi12_national_median(star: Star, threshold: int | None = None) -> DataFrame:
    d = national_distribution(star, threshold)
    return d.select(
        C.period_label("period_date").alias("period_label"), "period_date",
        C.round_half_up_tenths(F.col("median")).alias("median_performance_pct"),
        C.mean_tenths(F.col("sum_tenths"), F.col("n_perf")).alias("mean_performance_pct"),
        C.round_half_up_tenths(F.col("p25")).alias("p25_performance_pct"),
        C.round_half_up_tenths(F.col("p75")).alias("p75_performance_pct"))


# ------------------------------------------------------------------ K13–K20
def geo_rollup(star: Star) -> DataFrame:
    """ICB, region and national totals per month from one aggregation."""
    s = star.joined()
    g = (s.groupingSets([["period_date", "region_name", "icb_name"], ["period_date", "region_name"],
                         ["period_date"]], "period_date", "region_name", "icb_name")
         .agg(F.sum(TOTAL()).cast("bigint").alias("total_attendances"),
              F.sum(TOTAL() - BREACHES()).cast("bigint").alias("within_4hrs"),
              F.grouping_id().alias("gid")))
    level = F.when(F.col("gid") == 0, "icb").when(F.col("gid") == 1, "region").otherwise("national")
    return g.select("period_date", level.alias("geo_level"), "region_name", "icb_name",
                    "total_attendances", "within_4hrs",
                    C.pct("within_4hrs", "total_attendances").alias("performance_pct"))


def fq_rollup(star: Star) -> DataFrame:
    """Financial quarter and year totals (K14): rollup(financial_year, financial_quarter)."""
    s = star.joined("financial_year", "financial_quarter")
    g = (s.rollup("financial_year", "financial_quarter")
         .agg(F.sum(TOTAL()).cast("bigint").alias("total_attendances"),
              F.sum(TOTAL() - BREACHES()).cast("bigint").alias("within_4hrs"),
              F.sum(admissions_via_ae()).cast("bigint").alias("emergency_admissions"),
              F.grouping_id("financial_year", "financial_quarter").alias("gid")))
    level = F.when(F.col("gid") == 0, "quarter").when(F.col("gid") == 1, "year").otherwise("all")
    return g.select(level.alias("rollup_level"), "financial_year", "financial_quarter",
                    "total_attendances", "within_4hrs", "emergency_admissions",
                    C.pct("within_4hrs", "total_attendances").alias("performance_pct"))


def fy_ytd(star: Star) -> DataFrame:
    """Financial year-to-date cumulative attendances per provider."""
    s = star.joined("financial_year")
    w = (Window.partitionBy("provider_key", "financial_year").orderBy("period_date")
         .rowsBetween(Window.unboundedPreceding, 0))
    ytd_total = F.sum(TOTAL()).over(w)
    ytd_within = F.sum(TOTAL() - BREACHES()).over(w)
    return s.select("trust_code", "financial_year", "period_date",
                    TOTAL().alias("total_attendances"), ytd_total.cast("bigint").alias("ytd_attendances"),
                    C.pct(ytd_within, ytd_total).alias("ytd_performance_pct"))


def type_mix(star: Star) -> DataFrame:
    s = star.joined()
    return s.select("trust_code", "period_date",
                    C.pct(T1(), TOTAL()).alias("type1_share_pct"), C.pct(T2(), TOTAL()).alias("type2_share_pct"),
                    C.pct(T3(), TOTAL()).alias("type3_share_pct"))


def target_gap(star: Star, targets: DataFrame) -> DataFrame:
    """Attainment against the 4-hour target in force at the period.

    Before the switch the target is 95 % over all types, afterwards 76 % of type 1.
    ``targets`` is a reference table of a few rows: broadcast range join."""
    s = star.joined()
    measures = s.select(
        "trust_code", "period_date",
        F.explode(F.array(
            F.struct(F.lit("four_hour_all_types").alias("measure"),
                     C.pct_tenths(TOTAL() - BREACHES(), TOTAL()).alias("actual_tenths")),
            F.struct(F.lit("four_hour_type1").alias("measure"),
                     C.pct_tenths(T1() - F.col("breaches_type1"), T1()).alias("actual_tenths")))).alias("m"))
    measures = measures.select("trust_code", "period_date", "m.measure", "m.actual_tenths")
    t = F.broadcast(targets.where(F.col("measure").startswith("four_hour")))
    j = measures.join(t, (measures.measure == t.measure) & (measures.period_date >= t.valid_from)
                      & (t.valid_to.isNull() | (measures.period_date < t.valid_to)))
    target_tenths = F.round(t.target * 10).cast("bigint")
    return j.select("trust_code", "period_date", measures.measure.alias("measure"),
                    t.target.alias("target_pct"),
                    (F.col("actual_tenths") / F.lit(10.0)).alias("actual_pct"),
                    ((F.col("actual_tenths") - target_tenths) / F.lit(10.0)).alias("gap_pp"),
                    (F.col("actual_tenths") >= target_tenths).alias("meets_target"))


def rag_status(pct_col: F.Column, red_below: float = 70.0, green_from: float = 90.0) -> F.Column:
    """Red below 70, amber [70, 90), green from 90 (K18; thresholds are parameters)."""
    return (F.when(pct_col.isNull(), None).when(pct_col < red_below, "red")
            .when(pct_col < green_from, "amber").otherwise("green"))


def rag(star: Star) -> DataFrame:
    s = star.joined()
    perf = C.pct(TOTAL() - BREACHES(), TOTAL())
    return s.select("trust_code", "period_date", perf.alias("performance_pct"),
                    rag_status(perf, star.params.rag_red_below, star.params.rag_green_from).alias("rag"))


def dta_waits(star: Star) -> DataFrame:
    s = star.joined()
    adm = admissions_via_ae()
    return s.select("trust_code", "period_date", adm.alias("emergency_admissions"),
                    F.col("dta_breaches_4hr"), F.col("dta_breaches_12hr"),
                    C.pct("dta_breaches_4hr", adm).alias("dta_4hr_rate_pct"),
                    C.pct("dta_breaches_12hr", adm).alias("dta_12hr_rate_pct"))


def mom(star: Star) -> DataFrame:
    """Month-on-month change: attendances in %, performance in percentage points."""
    s = with_performance(star.joined())
    w = _by_provider()
    prev_total = F.lag(TOTAL(), 1).over(w)
    prev_perf = F.lag("perf_tenths", 1).over(w)
    return s.select("trust_code", "period_date", TOTAL().alias("total_attendances"),
                    prev_total.alias("prior_month_attendances"),
                    C.pct(TOTAL() - prev_total, prev_total).alias("mom_attendance_change_pct"),
                    ((F.col("perf_tenths") - prev_perf) / F.lit(10.0)).alias("mom_performance_change_pp"))
