"""Window analytics beyond the KPIs.

Per-provider windows are bounded by the number of months. Per-period comparisons
(peer means, quantile bands, national quartiles) are aggregations joined back on the
period key, so no single task ever holds a whole period.

Averages of percentages are carried as integer tenths with explicit counts, and every
ratio is computed as one division of integers, so results are exact and
engine-independent.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from edpanel.functions import columns as C
from edpanel.operators import kpi, ranking
from edpanel.plans.analogue import Star
from edpanel.session import materialize

WINTERS_KEPT = 5
TOP_K_WINTER_GAP = 10
MIX_BAND_WIDTH_TENTHS = 200      # 20 percentage points of type-1 share
VOLUME_BANDS = 5
IQR_FENCE = 1.5
Z_LIMIT = 2.0


def _perf(df: DataFrame) -> DataFrame:
    return kpi.with_performance(df)


def _rounded_mean_tenths(sum_col: str, n_col: str) -> F.Column:
    """Integer tenths of ROUND(AVG, 1) for a non-negative sum."""
    s, n = F.col(sum_col), F.col(n_col)
    safe_n = F.when(n == 0, F.lit(1)).otherwise(n)
    return F.when(n > 0, C.int_div(F.lit(2) * s + n, F.lit(2) * safe_n))


def _gap_pp(own_tenths: F.Column, peer_tenths: F.Column) -> F.Column:
    return ((own_tenths - peer_tenths) / F.lit(10.0)).cast("double")


# ----------------------------------------------------------------- G1 trajectory
def trajectory(star: Star) -> DataFrame:
    """3-row rolling mean of performance and the same value 3 rows earlier (two stages)."""
    s = _perf(star.joined())
    w = Window.partitionBy("provider_key").orderBy("period_date")
    roll = w.rowsBetween(-2, 0)
    s = (s.withColumn("roll_sum", F.sum("perf_tenths").over(roll))
         .withColumn("roll_n", F.count("perf_tenths").over(roll)))
    s = (s.withColumn("prior_sum", F.lag("roll_sum", 3).over(w))
         .withColumn("prior_n", F.lag("roll_n", 3).over(w)))
    cur = F.col("roll_sum") * F.col("prior_n")
    pri = F.col("prior_sum") * F.col("roll_n")
    direction = (F.when(F.col("prior_n").isNull() | (F.col("prior_n") == 0) | (F.col("roll_n") == 0), None)
                 .when(cur > pri, "improving").when(cur < pri, "deteriorating").otherwise("stable"))
    return s.select("trust_code", "period_date", "performance_pct",
                    (F.col("roll_sum") / (F.col("roll_n") * F.lit(10.0))).alias("rolling_3m_avg"),
                    (F.col("prior_sum") / (F.col("prior_n") * F.lit(10.0))).alias("prior_3m_avg"),
                    direction.alias("direction"))


# ----------------------------------------------------------------- G2–G5 peers
def _peer_mean(df: DataFrame, keys: list[str], prefix: str) -> DataFrame:
    g = df.groupBy(*keys).agg(F.sum("perf_tenths").alias("_s"), F.count("perf_tenths").alias("_n"))
    return g.select(*keys, _rounded_mean_tenths("_s", "_n").alias(f"{prefix}_mean_tenths"),
                    F.col("_n").alias(f"{prefix}_size"))


def _volume_peers(df: DataFrame, group_col: str, volume_col: str) -> DataFrame:
    """Volume band within the group and the mean performance of that band."""
    perf = F.col("perf_tenths")
    b = ranking.band_within(df, [group_col], volume_col, VOLUME_BANDS, "volume_band",
                            {"_s": perf, "_n": perf.isNotNull().cast("bigint")})
    return b.withColumn("peer_mean_tenths", _rounded_mean_tenths("_s", "_n"))


def peer_volume(star: Star) -> DataFrame:
    """Volume peers: quintile of total attendances within the month, compared with the
    mean performance of the quintile (G2)."""
    s = _perf(star.joined())
    j = _volume_peers(s, "period_date", "attendances_total")
    return j.select("trust_code", "period_date", F.col("attendances_total").alias("total_attendances"),
                    "volume_band", "performance_pct",
                    (F.col("peer_mean_tenths") / F.lit(10.0)).alias("peer_mean_performance_pct"),
                    _gap_pp(F.col("perf_tenths"), F.col("peer_mean_tenths")).alias("gap_to_peer_pp"))


def peer_geo(star: Star) -> DataFrame:
    """Geography peers: gap to the mean performance of the ICB and of the region."""
    s = _perf(star.joined())
    g = s.groupBy("period_date", "icb_code", "region_code").agg(
        F.sum("perf_tenths").alias("_s"), F.count("perf_tenths").alias("_n"))
    reg = Window.partitionBy("period_date", "region_code")
    g = g.withColumn("_rs", F.sum("_s").over(reg)).withColumn("_rn", F.sum("_n").over(reg))
    # one row per month and ICB: both fixed by reference data, so broadcast
    g = g.select("period_date", "icb_code", _rounded_mean_tenths("_s", "_n").alias("icb_mean_tenths"),
                 F.when(F.col("region_code").isNotNull(), _rounded_mean_tenths("_rs", "_rn")).alias("region_mean_tenths"))
    j = s.join(F.broadcast(g), ["period_date", "icb_code"], "left")
    return j.select("trust_code", "period_date", "icb_name", "region_name", "performance_pct",
                    (F.col("icb_mean_tenths") / F.lit(10.0)).alias("icb_mean_performance_pct"),
                    (F.col("region_mean_tenths") / F.lit(10.0)).alias("region_mean_performance_pct"),
                    _gap_pp(F.col("perf_tenths"), F.col("icb_mean_tenths")).alias("gap_to_icb_pp"),
                    _gap_pp(F.col("perf_tenths"), F.col("region_mean_tenths")).alias("gap_to_region_pp"))


def peer_mix(star: Star) -> DataFrame:
    """Type-mix peers: type-1 share in 20-point bands."""
    s = _perf(star.joined())
    share = C.pct_tenths("attendances_type1", "attendances_total")
    s = s.withColumn("type1_share_pct", C.pct("attendances_type1", "attendances_total")).withColumn(
        "mix_band", F.least(C.int_div(share, F.lit(MIX_BAND_WIDTH_TENTHS)), F.lit(4)).cast("int"))
    peers = _peer_mean(s, ["period_date", "mix_band"], "mix")
    # five bands a month: bounded by the calendar
    j = s.join(F.broadcast(peers), ["period_date", "mix_band"], "left")
    return j.select("trust_code", "period_date", "type1_share_pct", "mix_band", "performance_pct",
                    (F.col("mix_mean_tenths") / F.lit(10.0)).alias("mix_peer_mean_performance_pct"),
                    _gap_pp(F.col("perf_tenths"), F.col("mix_mean_tenths")).alias("gap_to_mix_peer_pp"))


def peer_national(star: Star) -> DataFrame:
    """National benchmark: gap to the month's median and mean (K12 joined back, G5)."""
    s = _perf(star.joined())
    d = kpi.national_distribution(star)
    bench = d.select("period_date",
                     F.floor(F.col("median") + 0.5).cast("bigint").alias("median_tenths"),
                     _rounded_mean_tenths("sum_tenths", "n_perf").alias("mean_tenths"))
    j = s.join(F.broadcast(bench), "period_date", "left")
    return j.select("trust_code", "period_date", "performance_pct",
                    (F.col("median_tenths") / F.lit(10.0)).alias("national_median_pct"),
                    (F.col("mean_tenths") / F.lit(10.0)).alias("national_mean_pct"),
                    _gap_pp(F.col("perf_tenths"), F.col("median_tenths")).alias("gap_to_median_pp"),
                    _gap_pp(F.col("perf_tenths"), F.col("mean_tenths")).alias("gap_to_mean_pp"))


# ----------------------------------------------------------------- G6 outliers
def outliers(star: Star) -> DataFrame:
    """Per-month outliers: outside the 1.5 x IQR fences, or |z| > 2."""
    s = _perf(star.joined()).where(F.col("perf_tenths").isNotNull())
    q = ranking.percentile_cont(s, ["period_date"], "perf_tenths", {"q1": (1, 4), "q3": (3, 4)})
    n = F.col("n")
    sd = F.when(n > 1, F.sqrt(F.col("ssd") / F.nullif(n - 1, F.lit(0))) / 10.0)
    q = q.select("period_date", (F.col("total") / n / 10.0).alias("mu"), F.nullif(sd, F.lit(0.0)).alias("sd"),
                 (F.col("q1") - F.lit(IQR_FENCE) * (F.col("q3") - F.col("q1"))).alias("lo_t"),
                 (F.col("q3") + F.lit(IQR_FENCE) * (F.col("q3") - F.col("q1"))).alias("hi_t"))
    j = s.join(F.broadcast(q), "period_date")
    z = (F.col("performance_pct") - F.col("mu")) / F.col("sd")
    return j.select("trust_code", "period_date", "performance_pct",
                    (F.col("lo_t") / 10.0).alias("lower_fence_pct"), (F.col("hi_t") / 10.0).alias("upper_fence_pct"),
                    ((F.col("perf_tenths") < F.col("lo_t")) | (F.col("perf_tenths") > F.col("hi_t"))).alias("iqr_outlier"),
                    F.coalesce(F.abs(z) > Z_LIMIT, F.lit(False)).alias("z_outlier"))


# ----------------------------------------------------------------- G7–G10 winter
def _winter_rows(star: Star) -> DataFrame:
    s = star.joined().withColumn("winter_year", C.winter_year("period_date")).where(F.col("winter_year").isNotNull())
    years = s.select("winter_year").distinct()
    latest = years.orderBy(F.col("winter_year").desc()).limit(WINTERS_KEPT)
    return s.join(F.broadcast(latest), "winter_year")


def winter_history(star: Star) -> DataFrame:
    """Last five Nov–Feb winters per provider (G7). The set of kept winters has at most
    five rows, so it is broadcast."""
    w = _winter_rows(star)
    g = (w.groupBy("trust_code", "winter_year")
         .agg(F.sum("attendances_total").cast("bigint").alias("winter_attendances"),
              F.sum(F.col("attendances_total") - F.col("breaches_total")).cast("bigint").alias("winter_within_4hrs"),
              F.count(F.lit(1)).alias("months_reported")))
    return g.withColumn("winter_performance_pct", C.pct("winter_within_4hrs", "winter_attendances"))


def winter_gap_topk(star: Star, k: int = TOP_K_WINTER_GAP, target_pct: float = 95.0) -> DataFrame:
    """Providers furthest below the 4-hour target over the kept winters, top k.

    ``orderBy().limit(k)`` plans as TakeOrderedAndProject (per-partition top-k, then a
    k-row merge); the rank is numbered on those k rows only."""
    h = winter_history(star)
    g = (h.groupBy("trust_code")
         .agg(F.sum("winter_attendances").alias("att"), F.sum("winter_within_4hrs").alias("within")))
    g = g.withColumn("perf_tenths", C.pct_tenths("within", "att"))
    g = g.withColumn("gap_tenths", F.col("perf_tenths") - F.lit(int(round(target_pct * 10))))
    top = g.where(F.col("gap_tenths").isNotNull()).orderBy(F.col("gap_tenths").asc(), F.col("trust_code").asc()).limit(k)
    rk = Window.orderBy(F.col("gap_tenths").asc(), F.col("trust_code").asc())
    return top.select("trust_code", (F.col("perf_tenths") / 10.0).alias("winter_performance_pct"),
                      (F.col("gap_tenths") / 10.0).alias("gap_to_target_pp"),
                      F.row_number().over(rk).alias("gap_rank"))


def winter_peer(star: Star) -> DataFrame:
    """Winter volume peers: quintile of winter attendances within each winter (G9). The history, one
    row per provider and winter, is written once and read by the histogram and the rows."""
    h = materialize(winter_history(star)).withColumn("perf_tenths", C.pct_tenths("winter_within_4hrs", "winter_attendances"))
    j = _volume_peers(h, "winter_year", "winter_attendances")
    return j.select("trust_code", "winter_year", "winter_attendances", "volume_band", "winter_performance_pct",
                    (F.col("peer_mean_tenths") / 10.0).alias("peer_mean_performance_pct"),
                    _gap_pp(F.col("perf_tenths"), F.col("peer_mean_tenths")).alias("gap_to_peer_pp"))


def early_warning(star: Star) -> DataFrame:
    """September / October months whose 3-month rolling mean is below the prior one."""
    t = trajectory(star)
    t = t.where(F.month("period_date").isin(9, 10))
    return t.select("trust_code", "period_date", "rolling_3m_avg", "prior_3m_avg",
                    F.coalesce(F.col("direction") == "deteriorating", F.lit(False)).alias("early_warning"))


# ----------------------------------------------------------------- G11–G13
def seasonal_forecast(star: Star) -> DataFrame:
    """Seasonal index per provider and month of year, and a projection = index x mean of
    the provider's last 12 reported months (G11). One read of the fact: the last 12 months are
    numbered in the provider window and summed per month of year, and the provider's totals are
    windows over its twelve rows at most."""
    f = star.joined("month_of_year")
    recent = F.row_number().over(Window.partitionBy("provider_key").orderBy(F.col("period_date").desc())) <= 12
    by_moy = (f.withColumn("_recent", recent).groupBy("provider_key", "trust_code", "month_of_year")
              .agg(F.sum("attendances_total").alias("s_m"), F.count(F.lit(1)).alias("c_m"),
                   F.sum(F.when(F.col("_recent"), F.col("attendances_total"))).alias("_s12"), F.count_if("_recent").alias("_c12")))
    own = Window.partitionBy("provider_key")
    j = by_moy.withColumns({"s_all": F.sum("s_m").over(own), "c_all": F.sum("c_m").over(own),
                            "s12": F.sum("_s12").over(own), "c12": F.sum("_c12").over(own)})
    index = (F.col("s_m") * F.col("c_all")).cast("double") / (F.col("c_m") * F.col("s_all")).cast("double")
    proj = ((F.col("s_m") * F.col("c_all") * F.col("s12")).cast("double")
            / (F.col("c_m") * F.col("s_all") * F.col("c12")).cast("double"))
    return j.select("trust_code", "month_of_year", index.alias("seasonal_index"),
                    (F.col("s12").cast("double") / F.col("c12")).alias("trailing_12m_mean"),
                    proj.alias("projected_attendances"))


def winter_delta(star: Star) -> DataFrame:
    """Winter (Nov Y–Feb Y+1) against summer (Jun–Aug Y) per provider: attendance change
    in %, conversion and performance change in percentage points (G12). A month is in one season at
    most, so both come from one conditional aggregate."""
    winter = C.winter_year("period_date")
    summer = F.when(F.month("period_date").isin(6, 7, 8), F.year("period_date"))
    f = star.joined().withColumns({"year": F.coalesce(winter, summer), "_winter": winter.isNotNull()}).where(F.col("year").isNotNull())
    measures = {"s": F.col("attendances_total"), "adm": kpi.admissions_via_ae(), "in": F.col("attendances_total") - F.col("breaches_total")}
    seasons = {"w": F.col("_winter"), "s": ~F.col("_winter")}
    aggs = [F.sum(F.when(cond, m)).alias(f"{n}_{k}") for k, cond in seasons.items() for n, m in measures.items()]
    aggs += [F.count_if(cond).alias(f"c_{k}") for k, cond in seasons.items()]
    j = f.groupBy("trust_code", "year").agg(*aggs).where((F.col("c_w") > 0) & (F.col("c_s") > 0))
    return j.select(
        "trust_code", "year",
        C.pct(F.col("s_w") * F.col("c_s") - F.col("s_s") * F.col("c_w"), F.col("s_s") * F.col("c_w"))
        .alias("attendance_change_pct"),
        ((C.pct_tenths("adm_w", "s_w") - C.pct_tenths("adm_s", "s_s")) / 10.0).alias("conversion_change_pp"),
        ((C.pct_tenths("in_w", "s_w") - C.pct_tenths("in_s", "s_s")) / 10.0).alias("performance_change_pp"))


def pressure_flags(star: Star) -> DataFrame:
    """OPEL-aligned inputs per provider-month (G13): attendances above the provider's own
    prior-12-month mean, performance falling month on month, any 12-hour DTA wait."""
    return with_pressure(star).select("trust_code", "period_date", *PRESSURE_COLS)


PRESSURE_COLS = ("above_own_12m_mean", "performance_falling", "dta_12hr_breach", "pressure_score")


def with_pressure(star: Star) -> DataFrame:
    """The star with performance and the pressure flags of G13."""
    s = _perf(star.joined())
    w = Window.partitionBy("provider_key").orderBy("period_date")
    prior12 = w.rowsBetween(-12, -1)
    s = (s.withColumn("s12", F.sum("attendances_total").over(prior12))
         .withColumn("c12", F.count("attendances_total").over(prior12))
         .withColumn("prev_perf", F.lag("perf_tenths", 1).over(w)))
    above = F.coalesce(F.col("attendances_total") * F.col("c12") > F.col("s12"), F.lit(False))
    falling = F.coalesce(F.col("perf_tenths") < F.col("prev_perf"), F.lit(False))
    dta12 = F.coalesce(F.col("dta_breaches_12hr") > 0, F.lit(False))
    return s.select("trust_code", "period_date", "attendances_total", "perf_tenths", "performance_pct",
                    above.alias("above_own_12m_mean"),
                    falling.alias("performance_falling"), dta12.alias("dta_12hr_breach"),
                    (above.cast("int") + falling.cast("int") + dta12.cast("int")).alias("pressure_score"))
