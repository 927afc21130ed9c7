"""The five published marts (G14), composed from the KPI operators over one star.

Grain is provider x month (or month for the national mart). Per-provider windows are
bounded by the number of months; per-month comparisons use histogram ranks /
percentiles; the national year-on-year change is a calendar self-join of the monthly
series, not an unpartitioned window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from edpanel.functions import columns as C
from edpanel.operators import analytics, kpi, ranking
from edpanel.plans.analogue import Star
from edpanel.session import materialize


def national_trends(star: Star) -> DataFrame:
    f = star.fact
    adm = kpi.admissions_via_ae()
    g = f.groupBy("period_date").agg(
        F.sum("attendances_total").cast("bigint").alias("total_attendances"),
        F.sum("attendances_type1").cast("bigint").alias("type1_attendances"),
        F.sum("breaches_total").cast("bigint").alias("total_breaches"),
        F.sum(adm).cast("bigint").alias("emergency_admissions"))
    prior = g.select(F.add_months("period_date", 12).alias("period_date"),
                     F.col("total_attendances").alias("prior_year_attendances"))
    j = g.join(prior, "period_date", "left")
    tot, p = F.col("total_attendances"), F.col("prior_year_attendances")
    return j.select("period_date", "total_attendances", "type1_attendances", "total_breaches",
                    C.pct(tot - F.col("total_breaches"), tot).alias("performance_pct"),
                    "emergency_admissions", C.pct("emergency_admissions", tot).alias("admission_conversion_pct"),
                    p, C.pct(tot - p, p).alias("yoy_change_pct"))


def provider_rankings(star: Star) -> DataFrame:
    s = kpi.with_performance(star.joined()).where(F.col("attendances_total") > 0)
    ranked = ranking.rank_within(s, ["period_date"], "perf_tenths", descending=True,
                                 rank_col="national_rank", count_col="total_providers")
    prev = F.lag("perf_tenths").over(Window.partitionBy("provider_key").orderBy("period_date"))
    return ranked.select("trust_code", "trust_name", "period_date", "performance_pct", "national_rank",
                         "total_providers",
                         kpi.rag_status(F.col("performance_pct"), star.params.rag_red_below,
                                        star.params.rag_green_from).alias("rag"),
                         ((F.col("perf_tenths") - prev) / F.lit(10.0)).alias("change_pp"))


def emergency_admissions(star: Star) -> DataFrame:
    s = star.joined()
    adm = kpi.admissions_via_ae()
    rate = C.pct(adm, F.col("attendances_total"))
    return s.select("trust_code", "period_date", adm.alias("emergency_admissions"),
                    F.col("emergency_admissions_type1").alias("type1_admissions"),
                    rate.alias("admission_conversion_pct"), kpi.conversion_band(rate).alias("acuity_band"),
                    "dta_breaches_4hr", "dta_breaches_12hr",
                    C.pct("dta_breaches_12hr", adm).alias("dta_12hr_rate_pct"))


def four_hour(star: Star, targets: DataFrame) -> DataFrame:
    """Performance, type-1 performance, breaches and attainment of the target in force."""
    s = star.joined()
    tot, br, t1, b1 = (F.col("attendances_total"), F.col("breaches_total"), F.col("attendances_type1"),
                       F.col("breaches_type1"))
    base = s.select("trust_code", "period_date", tot.alias("total_attendances"), kpi.breach_count().alias("breaches"),
                    C.pct(tot - br, tot).alias("performance_pct"), C.pct(t1 - b1, t1).alias("type1_performance_pct"),
                    C.pct_tenths(tot - br, tot).alias("_all_t"), C.pct_tenths(t1 - b1, t1).alias("_t1_t"))
    t = F.broadcast(targets.where(F.col("measure").startswith("four_hour")))
    j = base.join(t, (base.period_date >= t.valid_from) & (t.valid_to.isNull() | (base.period_date < t.valid_to)), "left")
    actual = F.when(F.col("measure") == "four_hour_type1", F.col("_t1_t")).otherwise(F.col("_all_t"))
    target_t = F.round(F.col("target") * 10).cast("bigint")
    return j.select("trust_code", "period_date", "total_attendances", "breaches", "performance_pct",
                    "type1_performance_pct", F.col("measure").alias("target_measure"), F.col("target").alias("target_pct"),
                    ((actual - target_t) / F.lit(10.0)).alias("gap_pp"), (actual >= target_t).alias("meets_target"))


def command_center(star: Star) -> DataFrame:
    """Latest month per provider: performance, RAG, pressure flags and the gap to the
    national median of that month. The month's rows, one a provider, are written once; the
    median comes from them."""
    latest = F.broadcast(star.lines.agg(F.max("period_date").alias("period_date")))
    flags = materialize(analytics.with_pressure(star).join(latest, "period_date", "left_semi"))
    med = kpi.distribution(flags, star.params.small_provider_threshold).select(
        "period_date", C.round_half_up_tenths(F.col("median")).alias("national_median_pct"))
    j = flags.join(F.broadcast(med), "period_date", "left")
    return j.select("trust_code", "period_date", "performance_pct",
                    kpi.rag_status(F.col("performance_pct"), star.params.rag_red_below,
                                   star.params.rag_green_from).alias("rag"),
                    "above_own_12m_mean", "performance_falling", "dta_12hr_breach", "pressure_score",
                    "national_median_pct",
                    F.round(F.col("performance_pct") - F.col("national_median_pct"), 1).alias("gap_to_median_pp"))
