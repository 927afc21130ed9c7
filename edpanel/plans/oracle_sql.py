"""DuckDB-runnable SQL for every oracle-checked query.

Written independently of the DataFrame code: the same analogue mapping and KPI
formulas, spelled as plain SQL over the pre-registered driver tables.
"""

from __future__ import annotations

from edpanel.sources.registry import DEFAULT_SCHEMA_VERSION


def P(num: str, den: str) -> str:
    """Safe percentage, 1 dp, half away from zero, exact integer arithmetic."""
    return (f"(CASE WHEN ({den}) IS NULL OR ({den}) = 0 THEN NULL ELSE "
            f"CAST(sign({num}) * sign({den}) * ((2000 * abs({num}) + abs({den})) // (2 * abs({den}))) AS DOUBLE) / 10 END)")


def T(num: str, den: str) -> str:
    """Same as P, in integer tenths."""
    return (f"(CASE WHEN ({den}) IS NULL OR ({den}) = 0 THEN NULL ELSE "
            f"CAST(sign({num}) * sign({den}) * ((2000 * abs({num}) + abs({den})) // (2 * abs({den}))) AS BIGINT) END)")


def _sum_if(cond: str) -> str:
    return f"CAST(SUM(CASE WHEN {cond} THEN q ELSE 0 END) AS BIGINT)"


FACT_CTES = f"""
li AS (
  SELECT l_suppkey AS provider_key, CAST(date_trunc('month', l_shipdate) AS DATE) AS period_date,
         CAST(l_quantity AS BIGINT) AS q, l_returnflag AS rf, l_tax AS tax, l_discount AS disc
  FROM lineitem),
fact AS (
  SELECT provider_key, CAST(year(period_date) * 100 + month(period_date) AS INTEGER) AS month_key, period_date,
    {_sum_if("rf = 'A'")} AS attendances_type1,
    {_sum_if("rf = 'N'")} AS attendances_type2,
    {_sum_if("rf = 'R'")} AS attendances_type3,
    CAST(SUM(q) AS BIGINT) AS attendances_total,
    {_sum_if("rf = 'A' AND tax >= 0.06")} AS breaches_type1,
    {_sum_if("rf = 'N' AND tax >= 0.06")} AS breaches_type2,
    {_sum_if("rf = 'R' AND tax >= 0.06")} AS breaches_type3,
    {_sum_if("tax >= 0.06")} AS breaches_total,
    {_sum_if("rf = 'A' AND disc >= 0.08")} AS emergency_admissions_type1,
    {_sum_if("rf = 'N' AND disc >= 0.08")} AS emergency_admissions_type2,
    {_sum_if("rf = 'R' AND disc >= 0.08")} AS emergency_admissions_type3,
    {_sum_if("disc >= 0.08")} AS emergency_admissions_via_ae,
    {_sum_if("disc < 0.02")} AS emergency_admissions_other,
    {_sum_if("disc >= 0.08 OR disc < 0.02")} AS emergency_admissions_total,
    {_sum_if("disc >= 0.08 AND tax >= 0.06")} AS dta_breaches_4hr,
    {_sum_if("disc >= 0.08 AND tax >= 0.08")} AS dta_breaches_12hr
  FROM li GROUP BY provider_key, period_date),
prov AS (
  SELECT s_suppkey AS provider_key, 'S' || CAST(s_suppkey AS VARCHAR) AS trust_code, s_name AS trust_name,
         n_nationkey AS icb_code, n_name AS icb_name, r_regionkey AS region_code, r_name AS region_name
  FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey),
months AS (
  SELECT CAST(unnest(generate_series(CAST(min(period_date) AS TIMESTAMP), CAST(max(period_date) AS TIMESTAMP),
                                     INTERVAL 1 MONTH)) AS DATE) AS period_date FROM fact),
dm AS (
  SELECT CAST(year(period_date) * 100 + month(period_date) AS INTEGER) AS month_key, period_date,
    strftime(period_date, '%b %Y') AS period_label,
    year(period_date) AS calendar_year, month(period_date) AS month_of_year,
    CAST(year(period_date - INTERVAL 3 MONTH) AS VARCHAR) || '/' ||
      lpad(CAST((year(period_date - INTERVAL 3 MONTH) + 1) % 100 AS VARCHAR), 2, '0') AS financial_year,
    'Q' || CAST(quarter(period_date - INTERVAL 3 MONTH) AS VARCHAR) AS financial_quarter,
    month(period_date - INTERVAL 3 MONTH) AS financial_year_month_number,
    month(period_date) IN (11, 12, 1, 2) AS is_winter_month,
    CASE WHEN month(period_date) IN (12, 1, 2) THEN 'winter' WHEN month(period_date) IN (3, 4, 5) THEN 'spring'
         WHEN month(period_date) IN (6, 7, 8) THEN 'summer' ELSE 'autumn' END AS season,
    period_date BETWEEN DATE '2000-01-01' AND DATE '2000-12-01' AS is_covid_period,
    CASE WHEN period_date >= DATE '1995-07-01' THEN 'actual' ELSE 'estimated' END AS data_basis,
    CAST(period_date - INTERVAL 12 MONTH AS DATE) AS prior_year_period_date
  FROM months),
star AS (
  SELECT f.*, p.trust_code, p.trust_name, p.icb_code, p.icb_name, p.region_code, p.region_name,
         dm.period_label, dm.financial_year, dm.financial_quarter, dm.is_winter_month, dm.data_basis,
         dm.is_covid_period, dm.prior_year_period_date, dm.month_of_year
  FROM fact f JOIN prov p USING (provider_key) JOIN dm USING (month_key))
"""


def with_star(body: str) -> str:
    """Prefix the analogue CTEs; ``body`` is either a bare SELECT or more CTEs + SELECT."""
    body = body.strip()
    sep = "\n" if body.upper().startswith("SELECT") else ",\n"
    return f"WITH {FACT_CTES}{sep}{body}"


def kpi_sql() -> dict[str, str]:
    perf = P("attendances_total - breaches_total", "attendances_total")
    perf_t = T("attendances_total - breaches_total", "attendances_total")
    adm = "COALESCE(emergency_admissions_via_ae, emergency_admissions_type1 + emergency_admissions_type2 + emergency_admissions_type3)"
    conv = P("emergency_admissions_type1 + emergency_admissions_type2 + emergency_admissions_type3",
             "attendances_type1 + attendances_type2 + attendances_type3")
    q = {}
    q["fact_build"] = f"WITH {FACT_CTES} SELECT * FROM fact"
    q["dim_month"] = f"WITH {FACT_CTES} SELECT * FROM dm"
    q["provider_hierarchy"] = f"WITH {FACT_CTES} SELECT * FROM prov"
    q["kpi01"] = with_star("""SELECT trust_code, trust_name, period_label, period_date,
        CAST(SUM(attendances_type1 + attendances_type2 + attendances_type3) AS BIGINT) AS total_attendances
        FROM star GROUP BY trust_code, trust_name, period_label, period_date""")
    q["kpi02"] = with_star("""SELECT trust_code, trust_name, period_label, period_date,
        CAST(SUM(attendances_type1) AS BIGINT) AS type1_attendances
        FROM star GROUP BY trust_code, trust_name, period_label, period_date""")
    q["kpi03"] = with_star(f"""SELECT trust_code, trust_name, period_label, period_date,
        CAST(SUM({adm}) AS BIGINT) AS emergency_admissions
        FROM star GROUP BY trust_code, trust_name, period_label, period_date""")
    q["kpi04"] = with_star(f"""c AS (SELECT trust_code, period_label, period_date, {conv} AS r FROM star)
        SELECT trust_code, period_label, period_date, r AS admission_conversion_rate_pct,
          CASE WHEN r IS NULL THEN NULL WHEN r < 20 THEN 'low' WHEN r < 25 THEN 'below_normal'
               WHEN r <= 35 THEN 'normal' WHEN r <= 40 THEN 'high' ELSE 'very_high' END AS acuity_band FROM c""")
    q["kpi05"] = with_star(f"""SELECT trust_code, period_label, period_date,
        attendances_total AS total_attendances, breaches_total AS total_attendances_gt_4hrs,
        attendances_total - breaches_total AS attendances_within_4hrs, {perf} AS performance_pct FROM star""")
    q["kpi06"] = with_star(f"""SELECT trust_code, period_label, period_date,
        attendances_type1 AS type1_attendances, breaches_type1 AS type1_attendances_gt_4hrs,
        {P("attendances_type1 - breaches_type1", "attendances_type1")} AS type1_performance_pct FROM star""")
    q["kpi07"] = with_star("""SELECT trust_code, period_label, period_date,
        CAST(SUM(COALESCE(breaches_total, breaches_type1 + breaches_type2 + breaches_type3)) AS BIGINT)
          AS attendances_gt_4hrs FROM star GROUP BY trust_code, period_label, period_date""")
    q["kpi08_lag"] = with_star(f"""l AS (SELECT trust_code, period_label, period_date,
          attendances_total AS current_period_attendances,
          LAG(attendances_total, 12) OVER (PARTITION BY provider_key ORDER BY period_date) AS prior_year_attendances
        FROM star)
        SELECT *, {P("current_period_attendances - prior_year_attendances", "prior_year_attendances")} AS yoy_change_pct
        FROM l""")
    q["kpi08_calendar"] = with_star(f"""l AS (SELECT s.trust_code, s.period_label, s.period_date,
          s.attendances_total AS current_period_attendances, p.attendances_total AS prior_year_attendances
        FROM star s LEFT JOIN fact p ON p.provider_key = s.provider_key AND p.period_date = s.prior_year_period_date)
        SELECT *, {P("current_period_attendances - prior_year_attendances", "prior_year_attendances")} AS yoy_change_pct
        FROM l""")
    q["yoy_report"] = f"""SELECT trust_code, period_date, current_period_attendances, yoy_change_pct,
          ROW_NUMBER() OVER (ORDER BY period_date ASC NULLS FIRST, yoy_change_pct DESC NULLS LAST, trust_code ASC NULLS FIRST) AS position
        FROM ({q["kpi08_calendar"]})"""
    q["kpi09"] = with_star(f"""SELECT trust_code, trust_name, period_label, period_date,
        {perf} AS performance_pct,
        CAST(RANK() OVER (PARTITION BY period_date ORDER BY {perf_t} DESC) AS INTEGER) AS national_rank,
        CAST(COUNT(*) OVER (PARTITION BY period_date) AS BIGINT) AS total_providers
        FROM star WHERE attendances_total > 0""")
    q["kpi10"] = with_star(f"""g AS (SELECT icb_code, icb_name, period_label, period_date,
          CAST(SUM(attendances_total) AS BIGINT) AS icb_total_attendances,
          CAST(SUM(attendances_total - breaches_total) AS BIGINT) AS icb_within_4hrs
        FROM star GROUP BY icb_code, icb_name, period_label, period_date)
        SELECT *, {P("icb_within_4hrs", "icb_total_attendances")} AS icb_performance_pct FROM g""")
    q["kpi11"] = with_star(f"""SELECT trust_code, period_label, period_date,
        attendances_type3 AS type3_attendances, {P("attendances_type3", "attendances_total")} AS type3_share_pct
        FROM star""")
    q["kpi12"] = with_star(f"""p AS (SELECT period_date, {perf_t} AS t FROM fact WHERE attendances_total > 100),
        g AS (SELECT period_date, quantile_cont(t, 0.5) AS med, quantile_cont(t, 0.25) AS p25,
                quantile_cont(t, 0.75) AS p75, SUM(t) AS s, COUNT(t) AS n FROM p GROUP BY period_date)
        SELECT dm.period_label, g.period_date,
          floor(med + 0.5) / 10 AS median_performance_pct,
          CAST(sign(s) * ((2 * abs(s) + n) // (2 * n)) AS DOUBLE) / 10 AS mean_performance_pct,
          floor(p25 + 0.5) / 10 AS p25_performance_pct, floor(p75 + 0.5) / 10 AS p75_performance_pct
        FROM g JOIN dm USING (period_date)""")
    q["geo_rollup"] = with_star(f"""g AS (SELECT period_date, region_name, icb_name,
          CAST(SUM(attendances_total) AS BIGINT) AS total_attendances,
          CAST(SUM(attendances_total - breaches_total) AS BIGINT) AS within_4hrs,
          GROUPING(region_name, icb_name) AS gid
        FROM star GROUP BY GROUPING SETS ((period_date, region_name, icb_name), (period_date, region_name), (period_date)))
        SELECT period_date, CASE gid WHEN 0 THEN 'icb' WHEN 1 THEN 'region' ELSE 'national' END AS geo_level,
          region_name, icb_name, total_attendances, within_4hrs, {P("within_4hrs", "total_attendances")} AS performance_pct
        FROM g""")
    q["fq_rollup"] = with_star(f"""g AS (SELECT financial_year, financial_quarter,
          CAST(SUM(attendances_total) AS BIGINT) AS total_attendances,
          CAST(SUM(attendances_total - breaches_total) AS BIGINT) AS within_4hrs,
          CAST(SUM({adm}) AS BIGINT) AS emergency_admissions,
          GROUPING(financial_year, financial_quarter) AS gid
        FROM star GROUP BY ROLLUP (financial_year, financial_quarter))
        SELECT CASE gid WHEN 0 THEN 'quarter' WHEN 1 THEN 'year' ELSE 'all' END AS rollup_level,
          financial_year, financial_quarter, total_attendances, within_4hrs, emergency_admissions,
          {P("within_4hrs", "total_attendances")} AS performance_pct FROM g""")
    q["fy_ytd"] = with_star(f"""y AS (SELECT trust_code, financial_year, period_date, attendances_total AS total_attendances,
          SUM(attendances_total) OVER w AS ytd, SUM(attendances_total - breaches_total) OVER w AS ytd_within
        FROM star WINDOW w AS (PARTITION BY provider_key, financial_year ORDER BY period_date
                               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
        SELECT trust_code, financial_year, period_date, total_attendances, CAST(ytd AS BIGINT) AS ytd_attendances,
          {P("ytd_within", "ytd")} AS ytd_performance_pct FROM y""")
    q["type_mix"] = with_star(f"""SELECT trust_code, period_date,
        {P("attendances_type1", "attendances_total")} AS type1_share_pct,
        {P("attendances_type2", "attendances_total")} AS type2_share_pct,
        {P("attendances_type3", "attendances_total")} AS type3_share_pct FROM star""")
    q["target_gap"] = with_star(f"""m AS (
          SELECT trust_code, period_date, 'four_hour_all_types' AS measure, {perf_t} AS a FROM star
          UNION ALL
          SELECT trust_code, period_date, 'four_hour_type1', {T("attendances_type1 - breaches_type1", "attendances_type1")} FROM star),
        t AS (SELECT * FROM (VALUES ('four_hour_all_types', DATE '1900-01-01', DATE '2000-01-01', 95.0),
                                    ('four_hour_type1', DATE '2000-01-01', NULL, 76.0)) v(measure, valid_from, valid_to, target))
        SELECT m.trust_code, m.period_date, m.measure, CAST(t.target AS DOUBLE) AS target_pct,
          CAST(m.a AS DOUBLE) / 10 AS actual_pct, CAST(m.a - CAST(round(t.target * 10) AS BIGINT) AS DOUBLE) / 10 AS gap_pp,
          m.a >= CAST(round(t.target * 10) AS BIGINT) AS meets_target
        FROM m JOIN t ON m.measure = t.measure AND m.period_date >= t.valid_from
          AND (t.valid_to IS NULL OR m.period_date < t.valid_to)""")
    q["rag"] = with_star(f"""r AS (SELECT trust_code, period_date, {perf} AS performance_pct FROM star)
        SELECT *, CASE WHEN performance_pct IS NULL THEN NULL WHEN performance_pct < 70 THEN 'red'
          WHEN performance_pct < 90 THEN 'amber' ELSE 'green' END AS rag FROM r""")
    q["dta_waits"] = with_star(f"""r AS (SELECT trust_code, period_date, {adm} AS emergency_admissions,
          dta_breaches_4hr, dta_breaches_12hr FROM star)
        SELECT *, {P("dta_breaches_4hr", "emergency_admissions")} AS dta_4hr_rate_pct,
          {P("dta_breaches_12hr", "emergency_admissions")} AS dta_12hr_rate_pct FROM r""")
    q["mom"] = with_star(f"""r AS (SELECT trust_code, period_date, attendances_total AS total_attendances,
          LAG(attendances_total) OVER w AS prior_month_attendances,
          {perf_t} - LAG({perf_t}) OVER w AS dpp
        FROM star WINDOW w AS (PARTITION BY provider_key ORDER BY period_date))
        SELECT trust_code, period_date, total_attendances, prior_month_attendances,
          {P("total_attendances - prior_month_attendances", "prior_month_attendances")} AS mom_attendance_change_pct,
          CAST(dpp AS DOUBLE) / 10 AS mom_performance_change_pp FROM r""")
    return q


PERF = P("attendances_total - breaches_total", "attendances_total")
PERF_T = T("attendances_total - breaches_total", "attendances_total")
ADM = ("COALESCE(emergency_admissions_via_ae, emergency_admissions_type1 + emergency_admissions_type2"
       " + emergency_admissions_type3)")
PERF_CTE = f"s AS (SELECT *, {PERF} AS performance_pct, {PERF_T} AS pt FROM star)"
TRAJ_CTES = PERF_CTE + """,
r AS (SELECT *, SUM(pt) OVER w3 AS rs, COUNT(pt) OVER w3 AS rn FROM s
      WINDOW w3 AS (PARTITION BY provider_key ORDER BY period_date ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)),
tp AS (SELECT *, LAG(rs, 3) OVER w AS ps, LAG(rn, 3) OVER w AS pn FROM r
       WINDOW w AS (PARTITION BY provider_key ORDER BY period_date)),
traj AS (SELECT trust_code, provider_key, period_date, performance_pct,
    CAST(rs AS DOUBLE) / (CAST(rn AS DOUBLE) * 10) AS rolling_3m_avg,
    CAST(ps AS DOUBLE) / (CAST(pn AS DOUBLE) * 10) AS prior_3m_avg,
    CASE WHEN pn IS NULL OR pn = 0 OR rn = 0 THEN NULL WHEN rs * pn > ps * rn THEN 'improving'
         WHEN rs * pn < ps * rn THEN 'deteriorating' ELSE 'stable' END AS direction FROM tp)"""
WINTER_CTES = """wr AS (SELECT *, year(period_date - INTERVAL 2 MONTH) AS winter_year FROM star
       WHERE month(period_date) IN (11, 12, 1, 2)),
wy AS (SELECT DISTINCT winter_year FROM wr ORDER BY winter_year DESC LIMIT 5),
wh AS (SELECT trust_code, winter_year, CAST(SUM(attendances_total) AS BIGINT) AS winter_attendances,
         CAST(SUM(attendances_total - breaches_total) AS BIGINT) AS winter_within_4hrs,
         COUNT(*) AS months_reported
       FROM wr JOIN wy USING (winter_year) GROUP BY trust_code, winter_year)"""


def _mean_t(pt: str = "pt") -> str:
    return f"CASE WHEN COUNT({pt}) > 0 THEN (2 * SUM({pt}) + COUNT({pt})) // (2 * COUNT({pt})) END"


def analytics_sql() -> dict[str, str]:
    q = {}
    q["trajectory"] = with_star(TRAJ_CTES + """
        SELECT trust_code, period_date, performance_pct, rolling_3m_avg, prior_3m_avg, direction FROM traj""")
    band = ("CAST(floor(5 * (RANK() OVER (PARTITION BY {g} ORDER BY {v}) - 1) / "
            "COUNT({v}) OVER (PARTITION BY {g})) + 1 AS INTEGER)")
    q["peer_volume"] = with_star(PERF_CTE + f""",
        b AS (SELECT *, {band.format(g='period_date', v='attendances_total')} AS volume_band FROM s),
        m AS (SELECT period_date, volume_band, {_mean_t()} AS mt FROM b GROUP BY period_date, volume_band)
        SELECT trust_code, period_date, attendances_total AS total_attendances, volume_band, performance_pct,
          CAST(mt AS DOUBLE) / 10 AS peer_mean_performance_pct, CAST(pt - mt AS DOUBLE) / 10 AS gap_to_peer_pp
        FROM b LEFT JOIN m USING (period_date, volume_band)""")
    q["peer_geo"] = with_star(PERF_CTE + f""",
        i AS (SELECT period_date, icb_code, {_mean_t()} AS it FROM s GROUP BY period_date, icb_code),
        g AS (SELECT period_date, region_code, {_mean_t()} AS gt FROM s GROUP BY period_date, region_code)
        SELECT trust_code, period_date, icb_name, region_name, performance_pct,
          CAST(it AS DOUBLE) / 10 AS icb_mean_performance_pct, CAST(gt AS DOUBLE) / 10 AS region_mean_performance_pct,
          CAST(pt - it AS DOUBLE) / 10 AS gap_to_icb_pp, CAST(pt - gt AS DOUBLE) / 10 AS gap_to_region_pp
        FROM s LEFT JOIN i USING (period_date, icb_code) LEFT JOIN g USING (period_date, region_code)""")
    q["peer_mix"] = with_star(PERF_CTE + f""",
        b AS (SELECT *, {P("attendances_type1", "attendances_total")} AS type1_share_pct,
                CAST(least({T("attendances_type1", "attendances_total")} // 200, 4) AS INTEGER) AS mix_band FROM s),
        m AS (SELECT period_date, mix_band, {_mean_t()} AS mt FROM b GROUP BY period_date, mix_band)
        SELECT trust_code, period_date, type1_share_pct, mix_band, performance_pct,
          CAST(mt AS DOUBLE) / 10 AS mix_peer_mean_performance_pct, CAST(pt - mt AS DOUBLE) / 10 AS gap_to_mix_peer_pp
        FROM b LEFT JOIN m USING (period_date, mix_band)""")
    q["peer_national"] = with_star(PERF_CTE + f""",
        n AS (SELECT period_date, CAST(floor(quantile_cont(pt, 0.5) + 0.5) AS BIGINT) AS med_t, {_mean_t()} AS mean_t
              FROM s WHERE attendances_total > 100 GROUP BY period_date)
        SELECT trust_code, period_date, performance_pct, CAST(med_t AS DOUBLE) / 10 AS national_median_pct,
          CAST(mean_t AS DOUBLE) / 10 AS national_mean_pct, CAST(pt - med_t AS DOUBLE) / 10 AS gap_to_median_pp,
          CAST(pt - mean_t AS DOUBLE) / 10 AS gap_to_mean_pp
        FROM s LEFT JOIN n USING (period_date)""")
    q["outliers"] = with_star(PERF_CTE + """,
        f AS (SELECT period_date, quantile_cont(pt, 0.25) AS q1, quantile_cont(pt, 0.75) AS q3,
                avg(pt / 10.0) AS mu, stddev_samp(pt / 10.0) AS sd FROM s WHERE pt IS NOT NULL GROUP BY period_date),
        o AS (SELECT s.*, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi, mu, sd
              FROM s JOIN f USING (period_date) WHERE pt IS NOT NULL)
        SELECT trust_code, period_date, performance_pct, lo / 10.0 AS lower_fence_pct, hi / 10.0 AS upper_fence_pct,
          (pt < lo OR pt > hi) AS iqr_outlier, COALESCE(abs((performance_pct - mu) / sd) > 2.0, false) AS z_outlier
        FROM o""")
    q["winter_history"] = with_star(WINTER_CTES + f"""
        SELECT *, {P("winter_within_4hrs", "winter_attendances")} AS winter_performance_pct FROM wh""")
    q["winter_gap_topk"] = with_star(WINTER_CTES + f""",
        g AS (SELECT trust_code, SUM(winter_attendances) AS att, SUM(winter_within_4hrs) AS within FROM wh GROUP BY trust_code),
        t AS (SELECT trust_code, {T("within", "att")} AS pt FROM g),
        k AS (SELECT trust_code, pt, pt - 950 AS gt FROM t WHERE pt IS NOT NULL ORDER BY gt, trust_code LIMIT 10)
        SELECT trust_code, CAST(pt AS DOUBLE) / 10 AS winter_performance_pct, CAST(gt AS DOUBLE) / 10 AS gap_to_target_pp,
          CAST(ROW_NUMBER() OVER (ORDER BY gt, trust_code) AS INTEGER) AS gap_rank FROM k""")
    q["winter_peer"] = with_star(WINTER_CTES + f""",
        h AS (SELECT *, {P("winter_within_4hrs", "winter_attendances")} AS winter_performance_pct,
                {T("winter_within_4hrs", "winter_attendances")} AS pt FROM wh),
        b AS (SELECT *, {band.format(g='winter_year', v='winter_attendances')} AS volume_band FROM h),
        m AS (SELECT winter_year, volume_band, {_mean_t()} AS mt FROM b GROUP BY winter_year, volume_band)
        SELECT trust_code, winter_year, winter_attendances, volume_band, winter_performance_pct,
          CAST(mt AS DOUBLE) / 10 AS peer_mean_performance_pct, CAST(pt - mt AS DOUBLE) / 10 AS gap_to_peer_pp
        FROM b LEFT JOIN m USING (winter_year, volume_band)""")
    q["early_warning"] = with_star(TRAJ_CTES + """
        SELECT trust_code, period_date, rolling_3m_avg, prior_3m_avg,
          COALESCE(direction = 'deteriorating', false) AS early_warning
        FROM traj WHERE month(period_date) IN (9, 10)""")
    q["seasonal_forecast"] = with_star("""
        o AS (SELECT provider_key, SUM(attendances_total) AS s_all, COUNT(*) AS c_all FROM star GROUP BY provider_key),
        m AS (SELECT provider_key, month_of_year, SUM(attendances_total) AS s_m, COUNT(*) AS c_m FROM star
              GROUP BY provider_key, month_of_year),
        l AS (SELECT provider_key, SUM(attendances_total) AS s12, COUNT(*) AS c12 FROM (
                SELECT *, ROW_NUMBER() OVER (PARTITION BY provider_key ORDER BY period_date DESC) AS rn FROM star)
              WHERE rn <= 12 GROUP BY provider_key)
        SELECT p.trust_code, m.month_of_year,
          CAST(s_m * c_all AS DOUBLE) / CAST(c_m * s_all AS DOUBLE) AS seasonal_index,
          CAST(s12 AS DOUBLE) / c12 AS trailing_12m_mean,
          CAST(s_m * c_all * s12 AS DOUBLE) / CAST(c_m * s_all * c12 AS DOUBLE) AS projected_attendances
        FROM m JOIN o USING (provider_key) JOIN l USING (provider_key) JOIN prov p USING (provider_key)""")
    q["winter_delta"] = with_star(f"""
        w AS (SELECT trust_code, year(period_date - INTERVAL 2 MONTH) AS year, SUM(attendances_total) AS s_w,
                COUNT(*) AS c_w, SUM({ADM}) AS adm_w, SUM(attendances_total - breaches_total) AS in_w
              FROM star WHERE month(period_date) IN (11, 12, 1, 2) GROUP BY 1, 2),
        u AS (SELECT trust_code, year(period_date) AS year, SUM(attendances_total) AS s_s, COUNT(*) AS c_s,
                SUM({ADM}) AS adm_s, SUM(attendances_total - breaches_total) AS in_s
              FROM star WHERE month(period_date) IN (6, 7, 8) GROUP BY 1, 2)
        SELECT trust_code, year, {P("s_w * c_s - s_s * c_w", "s_s * c_w")} AS attendance_change_pct,
          CAST({T("adm_w", "s_w")} - {T("adm_s", "s_s")} AS DOUBLE) / 10 AS conversion_change_pp,
          CAST({T("in_w", "s_w")} - {T("in_s", "s_s")} AS DOUBLE) / 10 AS performance_change_pp
        FROM w JOIN u USING (trust_code, year)""")
    q["pressure_flags"] = with_star(PERF_CTE + """,
        x AS (SELECT *, SUM(attendances_total) OVER w12 AS s12, COUNT(attendances_total) OVER w12 AS c12,
                LAG(pt) OVER w AS prev_pt FROM s
              WINDOW w12 AS (PARTITION BY provider_key ORDER BY period_date ROWS BETWEEN 12 PRECEDING AND 1 PRECEDING),
                     w AS (PARTITION BY provider_key ORDER BY period_date)),
        y AS (SELECT trust_code, period_date, COALESCE(attendances_total * c12 > s12, false) AS above_own_12m_mean,
                COALESCE(pt < prev_pt, false) AS performance_falling, COALESCE(dta_breaches_12hr > 0, false) AS dta_12hr_breach
              FROM x)
        SELECT *, CAST(above_own_12m_mean AS INTEGER) + CAST(performance_falling AS INTEGER)
          + CAST(dta_12hr_breach AS INTEGER) AS pressure_score FROM y""")
    return q


_STAGED_MEASURES = ("attendances_type1", "attendances_type2", "attendances_type3", "attendances_total",
                    "breaches_type1", "breaches_total", "emergency_admissions_type1", "emergency_admissions_via_ae",
                    "emergency_admissions_other", "emergency_admissions_total", "dta_breaches_4hr", "dta_breaches_12hr")


def _staged_cte(name: str, where: str) -> str:
    hash_cols = ["period_date", "org_code", "org_name", *_STAGED_MEASURES]
    h = ", ".join(f"COALESCE(CAST({c} AS VARCHAR), '')" for c in hash_cols)
    return f"""{name}_l AS (
  SELECT l_suppkey AS provider_key, CAST(date_trunc('month', l_shipdate) AS DATE) AS period_date,
         CAST(l_quantity AS BIGINT) AS q, l_returnflag AS rf, l_tax AS tax, l_discount AS disc
  FROM lineitem {where}),
{name}_a AS (
  SELECT period_date, 'S' || CAST(provider_key AS VARCHAR) AS org_code, s_name AS org_name,
    {_sum_if("rf = 'A'")} AS attendances_type1, {_sum_if("rf = 'N'")} AS attendances_type2,
    {_sum_if("rf = 'R'")} AS attendances_type3, CAST(SUM(q) AS BIGINT) AS attendances_total,
    {_sum_if("rf = 'A' AND tax >= 0.06")} AS breaches_type1, {_sum_if("tax >= 0.06")} AS breaches_total,
    {_sum_if("rf = 'A' AND disc >= 0.08")} AS emergency_admissions_type1,
    {_sum_if("disc >= 0.08")} AS emergency_admissions_via_ae, {_sum_if("disc < 0.02")} AS emergency_admissions_other,
    {_sum_if("disc >= 0.08 OR disc < 0.02")} AS emergency_admissions_total,
    {_sum_if("disc >= 0.08 AND tax >= 0.06")} AS dta_breaches_4hr,
    {_sum_if("disc >= 0.08 AND tax >= 0.08")} AS dta_breaches_12hr
  FROM {name}_l JOIN supplier ON s_suppkey = provider_key GROUP BY period_date, provider_key, s_name),
{name} AS (SELECT *, sha256(concat_ws(chr(31), {h})) AS row_hash FROM {name}_a)"""


T1_, T2_, T3_ = "TIMESTAMP '2001-12-10 08:00:00'", "TIMESTAMP '2002-01-08 08:00:00'", "TIMESTAMP '2002-02-12 08:00:00'"
REV_CTES = (_staged_cte("first", "WHERE l_linenumber <= 6") + ",\n" + _staged_cte("revised", "") + f""",
v1 AS MATERIALIZED (SELECT period_date, org_code, org_name, attendances_total, breaches_total, row_hash,
         'first' AS source_version, {T1_} AS valid_from, CAST(NULL AS TIMESTAMP) AS valid_to, true AS is_current FROM first),
diff AS MATERIALIZED (SELECT r.*, CASE WHEN v.row_hash IS NULL THEN 'NEW' WHEN v.row_hash = r.row_hash THEN 'UNCHANGED'
           ELSE 'REVISED' END AS change_status
         FROM revised r LEFT JOIN v1 v USING (period_date, org_code)),
rk AS MATERIALIZED (SELECT period_date, org_code FROM diff WHERE change_status = 'REVISED'),
v2 AS MATERIALIZED (
  SELECT v1.* FROM v1 ANTI JOIN rk USING (period_date, org_code)
  UNION ALL
  SELECT period_date, org_code, org_name, attendances_total, breaches_total, row_hash, source_version, valid_from,
         {T2_}, false FROM v1 SEMI JOIN rk USING (period_date, org_code)
  UNION ALL
  SELECT period_date, org_code, org_name, attendances_total, breaches_total, row_hash, 'revised', {T2_},
         CAST(NULL AS TIMESTAMP), true FROM diff WHERE change_status <> 'UNCHANGED')""")


def revisions_sql() -> dict[str, str]:
    def w(body: str) -> str:
        body = body.strip()
        return f"WITH {REV_CTES}{chr(10) if body.upper().startswith('SELECT') else ','}\n{body}"
    q = {}
    q["row_diff"] = w("SELECT period_date, org_code, attendances_total, row_hash, change_status FROM diff")
    q["scd2_merge"] = w("SELECT * FROM v2")
    q["changed_periods"] = w("SELECT DISTINCT period_date FROM diff WHERE change_status <> 'UNCHANGED'")
    q["scheduled_run"] = w("""SELECT period_date, org_code, org_name, attendances_total, breaches_total, row_hash, valid_from, valid_to, is_current FROM v2""")
    q["scd2_current"] = w("SELECT * FROM v2 WHERE is_current")
    q["scd2_asof"] = w("""SELECT * FROM v2 WHERE valid_from <= TIMESTAMP '2001-12-31 00:00:00'
        AND (valid_to IS NULL OR valid_to > TIMESTAMP '2001-12-31 00:00:00')""")
    q["revision_audit"] = w("""succ AS (
          SELECT *, LEAD(valid_from) OVER k AS next_from, LEAD(source_version) OVER k AS next_version,
            LEAD(attendances_total) OVER k AS next_attendances, LEAD(breaches_total) OVER k AS next_breaches
          FROM v2 WINDOW k AS (PARTITION BY period_date, org_code ORDER BY valid_from))
        SELECT period_date, org_code, valid_to AS revised_at, source_version AS old_version, next_version AS new_version,
          attendances_total AS old_attendances_total, next_attendances AS new_attendances_total,
          breaches_total AS old_breaches_total, next_breaches AS new_breaches_total,
          next_attendances - attendances_total AS delta_attendances_total, next_breaches - breaches_total AS delta_breaches_total
        FROM succ WHERE valid_to IS NOT NULL AND next_from = valid_to""")
    q["scd2_rebuild"] = w(f"""snap AS (
          SELECT period_date, org_code, org_name, attendances_total, breaches_total, row_hash, 'first' AS source_version,
                 {T1_} AS snapshot_ts FROM first
          UNION ALL SELECT period_date, org_code, org_name, attendances_total, breaches_total, row_hash, 'revised', {T2_} FROM revised
          UNION ALL SELECT period_date, org_code, org_name, attendances_total, breaches_total, row_hash, 'revert', {T3_} FROM first),
        ch AS (SELECT *, LAG(row_hash) OVER (PARTITION BY period_date, org_code ORDER BY snapshot_ts) AS prev FROM snap),
        kept AS (SELECT * FROM ch WHERE prev IS NULL OR prev <> row_hash)
        SELECT period_date, org_code, org_name, attendances_total, breaches_total, row_hash, source_version,
          snapshot_ts AS valid_from,
          LEAD(snapshot_ts) OVER (PARTITION BY period_date, org_code ORDER BY snapshot_ts) AS valid_to,
          LEAD(snapshot_ts) OVER (PARTITION BY period_date, org_code ORDER BY snapshot_ts) IS NULL AS is_current
        FROM kept""")
    q["scd2_late"] = q["scd2_rebuild"]
    q["source_precedence"] = w(f"""u AS (
          SELECT period_date, org_code, attendances_total, 'history' AS source_kind, {T1_} AS published_at,
                 2 AS source_priority FROM first
          UNION ALL
          SELECT period_date, org_code, attendances_total, 'monthly', {T2_}, 1 FROM revised
          WHERE period_date = (SELECT max(period_date) FROM revised))
        SELECT period_date, org_code, attendances_total, source_kind, published_at, source_priority FROM (
          SELECT *, ROW_NUMBER() OVER (PARTITION BY period_date, org_code ORDER BY published_at DESC, source_priority) AS rn
          FROM u) WHERE rn = 1""")
    return q


DEPARTMENTS = ("Type 1 Departments - Major A&E", "Type 2 Departments - Single Specialty",
               "Type 3 Departments - Other A&E/Minor Injury Unit")


def _workbook_cells(within: str, milli: str) -> str:
    """CTE ``cells``: the published workbooks, cell by cell, as FIXTURES describes them."""
    tenths = T(within, "attendances_total")
    percent = (f"CASE WHEN attendances_total > 0 THEN CASE WHEN year(period_date) % 2 = 0 "
               f"THEN CAST({milli} // 1000 AS VARCHAR) || '.' || lpad(CAST({milli} % 1000 AS VARCHAR), 3, '0') "
               f"ELSE CAST({tenths} // 10 AS VARCHAR) || '.' || CAST({tenths} % 10 AS VARCHAR) END END")
    late = "period_date >= DATE '2001-01-01'"
    total_label = "CASE WHEN period_date < DATE '1996-01-01' THEN 'Total Attendance' ELSE 'Total attendances' END"
    columns = [("'Code'", "trust_code"), ("'Region'", "icb_name"), ("'Name'", "trust_name")]
    columns += [(f"'{t}'", f"attendances_type{k + 1}") for k, t in enumerate(DEPARTMENTS)] + [(total_label, "attendances_total")]
    columns += [(f"'{t}'", f"breaches_type{k + 1}") for k, t in enumerate(DEPARTMENTS)]
    columns += [("'Total Attendances > 4 hours'", "breaches_total"), ("'Percentage in 4 hours or less (all)'", percent)]
    columns += [(f"'{label}'", f"emergency_admissions_{c}") for label, c in (
        ("Emergency Admissions via Type 1 A&E", "type1"), ("Emergency Admissions via Type 2 A&E", "type2"),
        ("Emergency Admissions via Type 3 and 4 A&E", "type3"), ("Total Emergency Admissions via A&E", "via_ae"),
        ("Other Emergency admissions (i.e not via A&E)", "other"), ("Total Emergency Admissions", "total"))]
    columns += [(f"'Number of patients spending >{h} hours from decision to admit to admission'", f"dta_breaches_{h}hr") for h in (4, 12)]
    columns += [(f"CASE WHEN {late} THEN 'Booked Type 1 appointments' END", f"CASE WHEN {late} THEN attendances_type1 END")]
    banners = {3: "'A&E attendances'", 12: "'Emergency Admissions'", 20: f"CASE WHEN {late} THEN 'Appointments' END",
               7: "'A&E attendances greater than 4 hours from arrival to admission, transfer or discharge'"}

    def unnested(pairs, row):
        items = ", ".join(f"{{'c': {c}, 'value': CAST({v} AS VARCHAR)}}" for c, v in pairs)
        return f"{row} AS r, unnest([{items}]) AS x"

    name = "'ae-activity-' || strftime(period_date, '%Y-%m') || '.xls' AS file, b, period_date"
    period = ("CASE month(period_date) % 3 WHEN 0 THEN strftime(period_date, '%B %Y') WHEN 1 THEN strftime(period_date, '%b %Y') "
              "ELSE strftime(period_date, '%b-%Y') END")
    parts = [
        f"SELECT file, sheet, {unnested([(k, v) for k, (_, v) in enumerate(columns)], 'b + 3 + provider_key')} FROM body",
        f"SELECT file, sheet, {unnested([(k, v) for k, (v, _) in enumerate(columns)], 'b + 1')} FROM wb",
        f"SELECT file, sheet, {unnested(banners.items(), 'b')} FROM wb",
        "SELECT file, sheet, " + unnested([(0, "'A&E Attendances and Emergency Admissions'")], "0") + " FROM wb",
        "SELECT file, sheet, " + unnested([(0, "'Period:'"), (2, period)], "1") + " FROM wb",
        "SELECT file, sheet, " + unnested([(0, "'-'"), (2, "'England'"), (6, "total"), (10, "breaches")], "b + 2") + " FROM wb",
        "SELECT file, sheet, " + unnested([(0, "'Note: figures for the latest month are provisional'")], "b + 5 + last") + " FROM wb",
        "SELECT file, sheet, " + unnested([(0, "'Total for England includes independent sector providers'")], "b + 6 + last") + " FROM wb",
        "SELECT file, sheet, " + unnested([(0, "'Source: monthly situation report, release line ' || k")], "k") +
        " FROM (SELECT file, sheet, unnest(generate_series(2, b - 1)) AS k FROM wb)"]
    parts += [f"SELECT file, 'Notes', {unnested([(0, chr(39) + t + chr(39))], str(k))} FROM wb" for k, t in enumerate(
        ("Notes", "Figures are provisional and subject to revision", "Type 1: consultant-led 24-hour service"))]
    return f"""months_b AS (SELECT *, (month(period_date) % 4) * 3 + 2 AS b FROM fact),
        body AS (SELECT {name}, 'Provider Level Data' AS sheet, f.* EXCLUDE (b, period_date), p.* EXCLUDE (provider_key)
          FROM months_b f JOIN prov p USING (provider_key)),
        wb AS (SELECT file, sheet, b, period_date, max(provider_key) AS last, CAST(SUM(attendances_total) AS BIGINT) AS total,
          CAST(SUM(breaches_total) AS BIGINT) AS breaches FROM body GROUP BY ALL),
        cells AS (SELECT file, sheet, r, x.c AS c, x.value AS value FROM ({" UNION ALL ".join(parts)}))"""


def ingest_sql() -> dict[str, str]:
    """Grid block: the rendered workbooks must parse back to the published rows."""
    staged_cols = ("attendances_type1, attendances_type2, attendances_type3, attendances_total, breaches_type1, "
                   "breaches_total, emergency_admissions_type1, emergency_admissions_via_ae, emergency_admissions_other, "
                   "emergency_admissions_total, dta_breaches_4hr, dta_breaches_12hr")
    files = ("SELECT DISTINCT 'ae-activity-' || strftime(period_date, '%Y-%m') || '.xls' AS file, "
             "'Provider Level Data' AS sheet, period_date FROM fact")
    q = {}
    q["cells_to_wide"] = with_star(f"""SELECT f.period_date, p.trust_code AS org_code, p.trust_name AS org_name, {staged_cols}
        FROM fact f JOIN prov p USING (provider_key)""")
    q["pick_sheet"] = with_star(f"SELECT file, sheet FROM ({files})")
    q["header_row"] = with_star(f"""SELECT file, sheet, CAST((month(period_date) % 4) * 3 + 3 AS INTEGER) AS header_row
        FROM ({files})""")
    q["extract_period"] = with_star(f"SELECT file, sheet, period_date FROM ({files})")
    within = "(attendances_total - breaches_total)"
    milli = f"((2000 * {within} + attendances_total) // (2 * attendances_total))"
    src = (f"CASE WHEN attendances_total = 0 THEN NULL WHEN year(period_date) % 2 = 0 "
           f"THEN CAST({milli} AS DOUBLE) / 10 ELSE {P(within, 'attendances_total')} END")
    measures = ", ".join(_STAGED_MEASURES)
    q["sheet_order"] = f"""WITH {REV_CTES}
        SELECT period_date, org_code, org_name, {measures} FROM revised WHERE month(period_date) % 4 <> 0
        UNION ALL SELECT period_date, org_code, org_name, {measures} FROM first WHERE month(period_date) % 4 = 0"""
    held = "SELECT period_date, provider_key AS k, LEAD(provider_key) OVER (PARTITION BY period_date ORDER BY provider_key) AS next_k FROM fact"
    q["parse_until_blank"] = with_star(f"""cut AS (SELECT period_date, min(k) AS last_k FROM (
          SELECT * FROM ({held}) UNION ALL SELECT period_date, -1, min(provider_key) FROM fact GROUP BY period_date)
          WHERE next_k > k + 1 GROUP BY period_date)
        SELECT f.period_date, p.trust_code AS org_code, p.trust_name AS org_name, {measures}
        FROM fact f JOIN prov p USING (provider_key) LEFT JOIN cut c ON c.period_date = f.period_date
        WHERE c.last_k IS NULL OR f.provider_key <= c.last_k""")
    loads = [f"""SELECT period_date, org_code, attendances_total, row_hash, '{r}/' AS folder, DATE '{p}' AS publication_date,
          TIMESTAMP '{t}' AS ingested_at FROM {r} WHERE month(period_date) {is_june} 6""" for r, p, t, is_june in (
        ("first", "2001-12-10", "2001-12-13 08:00:00", "<>"), ("revised", "2002-01-08", "2002-01-10 08:00:00", "="))]
    q["staging_audit"] = f"""WITH {REV_CTES}, loaded AS (SELECT *, 'ae-activity-' || strftime(period_date, '%Y-%m') || '.xls' AS file
          FROM ({" UNION ALL ".join(loads)}))
        SELECT period_date, org_code, attendances_total, file AS source_file_name, sha256(folder || file) AS source_file_hash,
          'https://files.example/' || folder || file AS source_url, ingested_at, publication_date, row_hash, true AS is_current FROM loaded"""
    q["recompute_vs_source"] = with_star(f"""x AS (SELECT f.period_date, p.trust_code AS org_code, {src} AS source_pct,
          {P(within, 'attendances_total')} AS recomputed_pct FROM fact f JOIN prov p USING (provider_key))
        SELECT period_date, org_code, source_pct, recomputed_pct,
          COALESCE(abs(source_pct - recomputed_pct) <= 0.05, false) AS consistent FROM x""")
    cells = _workbook_cells(within, milli)
    q["grid_cells"] = with_star(f"{cells} SELECT file, sheet, CAST(r AS INTEGER) AS row, CAST(c AS INTEGER) AS col, value FROM cells WHERE value IS NOT NULL")
    q["unmapped_capture"] = with_star("""SELECT f.period_date, p.trust_code AS org_code, attendances_type1, p.icb_name AS region_name,
          CASE WHEN f.period_date >= DATE '2001-01-01' THEN attendances_type1 END AS booked_type1, breaches_type2
        FROM fact f JOIN prov p USING (provider_key)""")
    q["stop_at_blank_row"] = with_star(f"""{cells},
        held AS (SELECT file, r, LEAD(r) OVER (PARTITION BY file ORDER BY r) AS next_r FROM (SELECT DISTINCT c.file, r FROM cells c
          JOIN wb ON wb.file = c.file AND r > b WHERE c.sheet = 'Provider Level Data' AND value IS NOT NULL)),
        cut AS (SELECT file, min(r) AS last_r FROM held WHERE next_r > r + 1 GROUP BY file)
        SELECT c.file, c.sheet, CAST(r AS INTEGER) AS row, CAST(c.c AS INTEGER) AS col, value FROM cells c
        LEFT JOIN cut ON cut.file = c.file
        WHERE c.sheet = 'Provider Level Data' AND value IS NOT NULL AND (last_r IS NULL OR r <= last_r)""")
    mapped = [("org_code", 0, "Code"), ("org_name", 2, "Name")]
    mapped += [(f"attendances_type{k + 1}", 3 + k, f"A&E attendances :: {t}") for k, t in enumerate(DEPARTMENTS)]
    mapped += [("attendances_total", 6, "A&E attendances :: Total attendances")]
    over = "A&E attendances greater than 4 hours from arrival to admission, transfer or discharge :: "
    mapped += [("breaches_type1", 7, over + DEPARTMENTS[0]), ("breaches_total", 10, over + "Total Attendances > 4 hours"),
               ("performance_all_pct", 11, over + "Percentage in 4 hours or less (all)")]
    mapped += [(f"emergency_admissions_{c}", k, f"Emergency Admissions :: {label}") for c, k, label in (
        ("type1", 12, "Emergency Admissions via Type 1 A&E"), ("via_ae", 15, "Total Emergency Admissions via A&E"),
        ("other", 16, "Other Emergency admissions (i.e not via A&E)"), ("total", 17, "Total Emergency Admissions"))]
    mapped += [(f"dta_breaches_{h}hr", k, f"Emergency Admissions :: Number of patients spending >{h} hours from decision to admit to admission")
               for h, k in ((4, 18), (12, 19))]
    pairs = ", ".join(f"('{n}', {k}, '{label}')" for n, k, label in mapped)
    q["map_columns"] = with_star(f"""fl AS ({files})
        SELECT file, sheet, m.canonical, m.col, CASE WHEN m.col = 6 AND period_date < DATE '1996-01-01'
          THEN 'A&E attendances :: Total Attendance' ELSE m.compound END AS compound
        FROM fl CROSS JOIN (VALUES {pairs}) m(canonical, col, compound)""")
    q["dq_coerce_rejects"] = with_star(f"""{cells},
        m AS (SELECT file, b, last, canonical, col FROM wb CROSS JOIN (VALUES {pairs}) v(canonical, col, compound) WHERE col > 2)
        SELECT m.file, m.canonical, COUNT(*) FILTER (WHERE col = 4 AND r % 7 = 0) AS rejected, COUNT(value) AS non_blank
        FROM m LEFT JOIN cells c ON c.file = m.file AND c.sheet = 'Provider Level Data' AND c.c = m.col AND c.value IS NOT NULL
          AND c.r BETWEEN m.b + 3 AND m.b + 3 + m.last GROUP BY m.file, m.canonical""")
    q["grid_profile"] = with_star(f"""{cells} SELECT file, sheet, CAST(max(r) + 1 AS INTEGER) AS n_rows, CAST(max(c) + 1 AS INTEGER) AS n_cols,
          COUNT(value) AS non_blank_cells FROM cells WHERE value IS NOT NULL GROUP BY file, sheet""")
    return q


def scalars_sql() -> dict[str, str]:
    """Scalar functions applied to whole driver tables."""
    d = "CAST(o_orderdate AS DATE)"
    fy = f"CAST({d} - INTERVAL 3 MONTH AS DATE)"
    q = {}
    q["fin_year"] = f"""SELECT o_orderkey,
        CAST(year({fy}) AS VARCHAR) || '/' || lpad(CAST((year({fy}) + 1) % 100 AS VARCHAR), 2, '0') AS financial_year,
        'Q' || CAST(quarter({fy}) AS VARCHAR) AS financial_quarter,
        CAST(month({fy}) AS INTEGER) AS financial_year_month_number,
        month({d}) IN (11, 12, 1, 2) AS is_winter_month,
        CASE WHEN month({d}) IN (12, 1, 2) THEN 'winter' WHEN month({d}) IN (3, 4, 5) THEN 'spring'
             WHEN month({d}) IN (6, 7, 8) THEN 'summer' ELSE 'autumn' END AS season,
        CASE WHEN month({d}) IN (11, 12, 1, 2) THEN CAST(year({d} - INTERVAL 2 MONTH) AS INTEGER) END AS winter_year
        FROM orders"""
    nxt = "CAST(period_date + INTERVAL 1 MONTH AS DATE)"
    q["release_date"] = f"""WITH m AS (SELECT DISTINCT CAST(date_trunc('month', o_orderdate) AS DATE) AS period_date FROM orders)
        SELECT period_date, CAST({nxt} + CAST((4 - dayofweek({nxt}) + 7) % 7 + 7 AS INTEGER) AS DATE) AS release_date FROM m"""
    styles = ["strftime(d, '%b-%y')", "strftime(d, '%B %Y')", "strftime(d, '%Y-%m-%d')",
              "CAST(date_diff('day', DATE '1899-12-30', d) AS VARCHAR)", "strftime(d, '%b %Y')",
              "strftime(d, '%b. ''%y')"]
    cases = " ".join(f"WHEN {i} THEN {s}" for i, s in enumerate(styles))
    q["month_trunc"] = f"""WITH o AS (SELECT o_orderkey, {d} AS d FROM orders)
        SELECT o_orderkey, CASE o_orderkey % {len(styles)} {cases} END AS period_text,
               CAST(date_trunc('month', d) AS DATE) AS period_date FROM o"""
    q["safe_pct"] = f"""SELECT l_orderkey, l_linenumber,
        {P("CAST(l_quantity AS BIGINT) % 13", "(l_linenumber - 1) * 3")} AS pct FROM lineitem"""
    q["row_hash"] = """SELECT c_custkey, sha256(concat_ws(chr(31), COALESCE(CAST(c_custkey AS VARCHAR), ''),
        COALESCE(c_name, ''), COALESCE(CAST(c_nationkey AS VARCHAR), ''), COALESCE(c_mktsegment, ''))) AS row_hash
        FROM customer"""
    q["url_filename"] = r"""WITH p AS (SELECT page_id,
          regexp_extract(COALESCE(regexp_extract(url, '^(?:[a-zA-Z][a-zA-Z0-9+.\-]*:)?(?://[^/?#]*)?([^?#]*)', 1), ''),
                         '([^/]*)$', 1) AS last FROM pages)
        SELECT page_id, COALESCE(NULLIF(url_decode(last), ''), 'download.xls') AS file_name FROM p"""
    q["coerce_int"] = """WITH t AS (SELECT l_orderkey, l_linenumber, CAST(l_quantity AS BIGINT) AS q FROM lineitem)
        SELECT l_orderkey, l_linenumber,
          CASE l_linenumber WHEN 1 THEN CAST(q AS VARCHAR) WHEN 2 THEN ' ' || CAST(q AS VARCHAR) || ' '
            WHEN 3 THEN CAST(q AS VARCHAR) || '.0' WHEN 4 THEN format('{:,}', q * 1000) WHEN 5 THEN '-'
            WHEN 6 THEN CAST(q AS VARCHAR) || '.5' ELSE '  ' END AS raw,
          CASE WHEN l_linenumber IN (1, 2, 3) THEN q END AS value,
          l_linenumber IN (4, 5, 6) AS rejected
        FROM t"""
    q["coerce_pct"] = """SELECT l_orderkey, l_linenumber, CAST(l_orderkey % 10 AS INTEGER) AS file,
        CAST(round(l_discount * 100, 4) AS DOUBLE) AS value FROM lineitem"""
    q["coerce_text"] = """SELECT c_custkey, CASE WHEN c_custkey % 5 = 0 THEN NULL
        WHEN c_custkey % 7 = 0 THEN ' ' || c_name || ' ' ELSE c_name END AS value FROM customer"""
    ws = lambda x: f"trim(regexp_replace({x}, '\\s+', ' ', 'g'))"
    q["compound_label"] = f"""WITH t AS (SELECT p_partkey,
          CASE p_partkey % 6 WHEN 0 THEN 'Code' WHEN 1 THEN '' WHEN 2 THEN replace(p_type, ' ', '  ')
            WHEN 3 THEN replace(p_type, ' ', chr(10)) WHEN 4 THEN 'name' ELSE p_type END AS label,
          CASE WHEN p_partkey % 4 = 0 THEN '' ELSE p_brand END AS banner FROM part),
        n AS (SELECT p_partkey, COALESCE({ws('banner')}, '') AS b, COALESCE({ws('label')}, '') AS l FROM t)
        SELECT p_partkey, CASE WHEN l <> '' AND b <> '' AND lower(l) NOT IN ('code', 'region', 'name')
          THEN b || ' :: ' || l WHEN l <> '' THEN l ELSE b END AS compound FROM n"""
    q["footnote_filter"] = """WITH t AS (SELECT p_partkey, CASE WHEN p_partkey % 9 = 0 THEN ' - ' ELSE p_brand END AS org_code,
          CASE WHEN p_partkey % 10 = 0 THEN NULL ELSE p_name END AS org_name FROM part)
        SELECT * FROM t WHERE org_code IS NOT NULL AND trim(org_code) <> '-'
          AND NOT regexp_matches(org_code, '(?i)#[0-9]1|#[0-9]5')
          AND COALESCE(NOT regexp_matches(org_name, '(?i)^almond|^total$'), true)"""
    q["ffill"] = """WITH t AS (SELECT event_id, user_id, ts, CASE WHEN event_id % 3 = 0 THEN NULL ELSE value END AS raw FROM events)
        SELECT event_id, user_id, raw, last_value(raw IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id
          ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS filled FROM t"""
    text = ("trim(regexp_replace(replace(replace(replace(regexp_replace(regexp_extract(anchor, "
            "'(?is)^<a\\b[^>]*>(.*)</a>$', 1), '<[^>]*>', ' ', 'g'), '&nbsp;', ' '), '&quot;', '\"'), '&amp;', '&'), "
            "'\\s+', ' ', 'g'))")
    href = "regexp_extract(anchor, '(?is)\\bhref\\s*=\\s*[\"'']([^\"'']*)[\"'']', 1)"
    q["link_extract"] = f"""WITH a AS (SELECT page_id, url, regexp_extract_all(html, '(?is)<a\\b[^>]*>.*?</a>') AS arr FROM pages),
        e AS (SELECT page_id, url, unnest(generate_series(0, len(arr) - 1)) AS pos, unnest(arr) AS anchor FROM a),
        c AS (SELECT page_id, url, pos, {text} AS link_text, {href} AS href FROM e),
        m AS (SELECT * FROM c WHERE regexp_matches(link_text, '(?i)^(the|la|der)[.,;:!?]*$')
                AND NOT contains(lower(link_text), 'time series')),
        f AS (SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY page_id ORDER BY pos) AS rn FROM m) WHERE rn = 1),
        r AS (SELECT page_id, CAST(pos AS INTEGER) AS anchor_pos, link_text,
          CASE WHEN regexp_matches(href, '^[a-zA-Z][a-zA-Z0-9+.\\-]*:') THEN href
               WHEN starts_with(href, '//') THEN regexp_extract(url, '^([a-zA-Z][a-zA-Z0-9+.\\-]*):', 1) || ':' || href
               WHEN starts_with(href, '/') THEN regexp_extract(url, '^([a-zA-Z][a-zA-Z0-9+.\\-]*://[^/?#]*)', 1) || href
               ELSE regexp_extract(url, '^([^?#]*/)', 1) || href END AS resolved_url FROM f)
        SELECT page_id, anchor_pos, link_text, resolved_url,
          CASE WHEN regexp_matches(resolved_url, '(?i)\\.xlsx?$') THEN 'file' ELSE 'category' END AS link_kind,
          'found' AS status FROM r
        UNION ALL
        SELECT page_id, NULL, NULL, NULL, NULL, 'no_match' FROM pages WHERE page_id NOT IN (SELECT page_id FROM r)"""
    q["link_file_step"] = f"""WITH a AS (SELECT page_id, url, regexp_extract_all(html, '(?is)<a\\b[^>]*>.*?</a>') AS arr FROM pages),
        e AS (SELECT page_id, url, unnest(generate_series(0, len(arr) - 1)) AS pos, unnest(arr) AS anchor FROM a),
        c AS (SELECT page_id, url, pos, {text} AS link_text, {href} AS href FROM e),
        m AS (SELECT page_id, min(pos) AS pos FROM c WHERE href <> '' AND regexp_matches(href, '(?i)[aeiou][.,;:!?]*$')
                AND regexp_matches(lower(link_text), 'the|la|der') GROUP BY page_id),
        r AS (SELECT page_id, CAST(pos AS INTEGER) AS anchor_pos, link_text,
          CASE WHEN regexp_matches(href, '^[a-zA-Z][a-zA-Z0-9+.\\-]*:') THEN href
               WHEN starts_with(href, '//') THEN regexp_extract(url, '^([a-zA-Z][a-zA-Z0-9+.\\-]*):', 1) || ':' || href
               WHEN starts_with(href, '/') THEN regexp_extract(url, '^([a-zA-Z][a-zA-Z0-9+.\\-]*://[^/?#]*)', 1) || href
               ELSE regexp_extract(url, '^([^?#]*/)', 1) || href END AS resolved_url FROM c JOIN m USING (page_id, pos))
        SELECT page_id, anchor_pos, link_text, resolved_url, CASE WHEN anchor_pos IS NULL THEN 'no_match' ELSE 'found' END AS status
        FROM (SELECT page_id FROM pages) LEFT JOIN r USING (page_id)"""
    q["raw_file_hash"] = "SELECT doc_id, strlen(text) AS size_bytes, sha256(text) AS sha256 FROM documents"
    return q


def dimensions_sql() -> dict[str, str]:
    q = {}
    q["dim_provider_scd2"] = with_star("""h AS (
          SELECT 'S' || CAST(s_suppkey AS VARCHAR) AS org_code, f.period_date,
            CASE WHEN s_suppkey % 10 = 0 AND f.period_date >= DATE '1998-01-01' THEN s_name || ' (renamed)'
                 ELSE s_name END AS org_name, n.n_name AS icb_name
          FROM fact f JOIN supplier s ON f.provider_key = s.s_suppkey
          LEFT JOIN nation n ON n.n_nationkey = CASE WHEN s_suppkey % 15 = 0 AND f.period_date >= DATE '1999-07-01'
                                                     THEN (s_nationkey + 1) % 25 ELSE s_nationkey END),
        c AS (SELECT *, CASE WHEN ROW_NUMBER() OVER w = 1 THEN 1
                             WHEN LAG(org_name) OVER w IS NOT DISTINCT FROM org_name
                              AND LAG(icb_name) OVER w IS NOT DISTINCT FROM icb_name THEN 0 ELSE 1 END AS chg
              FROM h WINDOW w AS (PARTITION BY org_code ORDER BY period_date)),
        v AS (SELECT *, CAST(SUM(chg) OVER (PARTITION BY org_code ORDER BY period_date
                                            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS INTEGER) AS version_no FROM c),
        g AS (SELECT org_code, version_no, min(period_date) AS valid_from, any_value(org_name) AS org_name,
                     any_value(icb_name) AS icb_name FROM v GROUP BY org_code, version_no)
        SELECT org_code, version_no, org_name, icb_name, valid_from,
          LEAD(valid_from) OVER (PARTITION BY org_code ORDER BY version_no) AS valid_to,
          LEAD(valid_from) OVER (PARTITION BY org_code ORDER BY version_no) IS NULL AS is_current FROM g""")
    # The walk follows, per reported row, the links in force in its period (or all links)
    # until none is left.
    for name, in_force in (("org_bridge", "AND w.period_date >= b.effective_from"), ("org_bridge_comparable", "")):
        q[name] = with_star(f"""b AS (SELECT 'S' || CAST(s_suppkey AS VARCHAR) AS old_code,
          'S' || CAST(s_suppkey - 1 AS VARCHAR) AS new_code,
          CASE s_suppkey % 25 WHEN 0 THEN DATE '1999-01-01' WHEN 24 THEN DATE '2000-07-01'
                              ELSE DATE '1997-01-01' END AS effective_from
          FROM supplier WHERE s_suppkey % 25 IN (0, 23, 24)),
        r AS (SELECT p.trust_code AS org_code, f.period_date, attendances_total, breaches_total
              FROM fact f JOIN prov p USING (provider_key)),
        walk(org_code, period_date, cur, depth) AS (
          SELECT org_code, period_date, org_code, 0 FROM r
          UNION ALL
          SELECT w.org_code, w.period_date, b.new_code, w.depth + 1
          FROM walk w JOIN b ON w.cur = b.old_code {in_force}),
        last AS (SELECT org_code, period_date, arg_max(cur, depth) AS cur FROM walk GROUP BY org_code, period_date)
        SELECT last.cur AS org_code, r.period_date,
          CAST(SUM(attendances_total) AS BIGINT) AS attendances_total, CAST(SUM(breaches_total) AS BIGINT) AS breaches_total,
          COUNT(DISTINCT r.org_code) AS n_source_codes
        FROM r JOIN last ON r.org_code = last.org_code AND r.period_date = last.period_date
        GROUP BY last.cur, r.period_date""").replace("WITH ", "WITH RECURSIVE ", 1)
    # What a provider was called in a month is what it published that month.
    published = f"""h AS (
          SELECT 'S' || CAST(s_suppkey AS VARCHAR) AS org_code, f.period_date, f.attendances_total, f.breaches_total,
            CASE WHEN s_suppkey % 10 = 0 AND f.period_date >= DATE '1998-01-01' THEN s_name || ' (renamed)'
                 ELSE s_name END AS org_name, n.n_name AS icb_name
          FROM fact f JOIN supplier s ON f.provider_key = s.s_suppkey
          LEFT JOIN nation n ON n.n_nationkey = CASE WHEN s_suppkey % 15 = 0 AND f.period_date >= DATE '1999-07-01'
                                                     THEN (s_nationkey + 1) % 25 ELSE s_nationkey END)"""
    q["fact_provider_version"] = with_star(published + """,
        c AS (SELECT *, CASE WHEN ROW_NUMBER() OVER w = 1
                               OR LAG(org_name) OVER w IS DISTINCT FROM org_name
                               OR LAG(icb_name) OVER w IS DISTINCT FROM icb_name THEN 1 ELSE 0 END AS chg
              FROM h WINDOW w AS (PARTITION BY org_code ORDER BY period_date))
        SELECT org_code, period_date, attendances_total, breaches_total,
          CAST(SUM(chg) OVER (PARTITION BY org_code ORDER BY period_date
                              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS INTEGER) AS version_no,
          org_name, icb_name FROM c""")
    q["geo_rollup_asof"] = with_star(published + f""",
        g AS (SELECT period_date, icb_name, GROUPING(icb_name) AS gid,
          CAST(SUM(attendances_total) AS BIGINT) AS total_attendances,
          CAST(SUM(attendances_total - breaches_total) AS BIGINT) AS within_4hrs
          FROM h GROUP BY GROUPING SETS ((period_date, icb_name), (period_date)))
        SELECT period_date, CASE gid WHEN 0 THEN 'icb' ELSE 'national' END AS geo_level, icb_name,
          total_attendances, within_4hrs, {P("within_4hrs", "total_attendances")} AS performance_pct FROM g""")
    q["crs_exclusion"] = with_star(f"""x AS (SELECT f.period_date, attendances_total AS t,
          attendances_total - breaches_total AS w,
          (f.provider_key BETWEEN 1 AND 14 AND f.period_date BETWEEN DATE '1997-05-01' AND DATE '2001-05-01') AS ft
          FROM fact f JOIN prov p USING (provider_key)),
        g AS (SELECT period_date, CAST(SUM(t) AS BIGINT) AS total_all, CAST(SUM(w) AS BIGINT) AS within_all,
          CAST(SUM(CASE WHEN NOT ft THEN t END) AS BIGINT) AS total_excl,
          CAST(SUM(CASE WHEN NOT ft THEN w END) AS BIGINT) AS within_excl, count_if(ft) AS field_test_rows
          FROM x GROUP BY period_date)
        SELECT period_date, total_all, {P("within_all", "total_all")} AS performance_all_pct, total_excl,
          {P("within_excl", "total_excl")} AS performance_excl_pct, field_test_rows FROM g""")
    q["partial_flag"] = with_star("""SELECT p.trust_code, f.period_date,
          CASE WHEN attendances_type1 = 0 THEN 3 ELSE 0 END AS n_missing_measures,
          CASE WHEN attendances_type1 = 0 THEN 'partial' ELSE 'complete' END AS submission_status
        FROM fact f JOIN prov p USING (provider_key)""")
    parts = []
    for t in ("1", "2", "3"):
        parts.append(f"""SELECT p.trust_code, f.period_date, '{t}' AS department_type, attendances_type{t} AS attendances,
          breaches_type{t} AS breaches, emergency_admissions_type{t} AS emergency_admissions
          FROM fact f JOIN prov p USING (provider_key)""")
    q["type_unpivot"] = with_star(" UNION ALL ".join(parts))
    history = q["dim_provider_scd2"]
    attributes = history[history.index("SELECT 'S' ||"):history.index("),\n        c AS")]
    q["dim_provider_late"] = with_star(f"""h AS ({attributes}),
        l AS (SELECT * FROM h WHERE period_date IN ('1997-06-01', '1998-06-01', '1999-06-01', '2000-06-01')),
        k AS (SELECT * FROM l WINDOW w AS (PARTITION BY org_code ORDER BY period_date)
              QUALIFY ROW_NUMBER() OVER w = 1 OR LAG(org_name) OVER w IS DISTINCT FROM org_name OR LAG(icb_name) OVER w IS DISTINCT FROM icb_name)
        SELECT org_code, org_name, icb_name, strftime(period_date, '%Y-%m') AS source_version, period_date AS valid_from,
          LEAD(period_date) OVER n AS valid_to, LEAD(period_date) OVER n IS NULL AS is_current
        FROM k WINDOW n AS (PARTITION BY org_code ORDER BY period_date)""")
    q["missing_submissions"] = with_star("""SELECT p.trust_code, m.period_date FROM prov p CROSS JOIN months m
        EXCEPT SELECT p.trust_code, f.period_date FROM fact f JOIN prov p USING (provider_key)""")
    q["actual_only"] = with_star(f"""SELECT trust_code, period_date, attendances_total,
          {P("attendances_total - breaches_total", "attendances_total")} AS performance_pct, is_covid_period
        FROM star WHERE data_basis = 'actual'""")
    return q


def quality_sql() -> dict[str, str]:
    q = {}
    cols = ("l_orderkey", "l_partkey", "l_suppkey", "l_quantity", "l_shipdate")
    q["dq_not_null"] = " UNION ALL ".join(
        f"SELECT 'lineitem' AS table_name, '{c}' AS column_name, count_if({c} IS NULL) AS null_count, "
        f"count(*) AS row_count FROM lineitem" for c in cols)
    q["dq_unique"] = """SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem
        GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1"""
    rels = (("lineitem.l_suppkey -> supplier", "lineitem", "l_suppkey", "supplier", "s_suppkey"),
            ("lineitem.l_partkey -> part", "lineitem", "l_partkey", "part", "p_partkey"),
            ("lineitem.l_orderkey -> orders", "lineitem", "l_orderkey", "orders", "o_orderkey"),
            ("orders.o_custkey -> customer", "orders", "o_custkey", "customer", "c_custkey"))
    q["dq_relationship"] = " UNION ALL ".join(
        f"SELECT '{n}' AS relationship, count(*) AS orphan_rows FROM {ct} c "
        f"WHERE NOT EXISTS (SELECT 1 FROM {pt} p WHERE p.{pc} = c.{cc})" for n, ct, cc, pt, pc in rels)
    q["reconcile_national"] = with_star("""o AS (SELECT period_date, CAST(SUM(attendances_total) AS BIGINT) AS our_value
          FROM fact GROUP BY period_date),
        p AS (SELECT period_date, 'total_attendances' AS metric_name,
          CAST(SUM(q) + 5 * (month(period_date) % 4) AS BIGINT) AS published_value FROM li GROUP BY period_date)
        SELECT COALESCE(o.period_date, p.period_date) AS period_date, metric_name, our_value, published_value,
          our_value - published_value AS variance,
          CASE WHEN abs(our_value - published_value) <= 10 THEN 'PASS' ELSE 'FAIL' END AS status
        FROM o FULL JOIN p ON o.period_date = p.period_date""")
    q["reconcile_internal"] = with_star("""SELECT p.trust_code, f.period_date, attendances_total AS reported_total,
          attendances_type1 + attendances_type2 + attendances_type3 AS type_sum,
          attendances_type1 + attendances_type2 + attendances_type3 = attendances_total AS attendances_consistent,
          emergency_admissions_type1 + emergency_admissions_type2 + emergency_admissions_type3
            = emergency_admissions_via_ae AS admissions_consistent
        FROM fact f JOIN prov p USING (provider_key)""")
    fyq = lambda d: (f"CAST(year({d} - INTERVAL 3 MONTH) AS VARCHAR) || '/' || "  # noqa: E731
                     f"lpad(CAST((year({d} - INTERVAL 3 MONTH) + 1) % 100 AS VARCHAR), 2, '0') AS financial_year, "
                     f"'Q' || CAST(quarter({d} - INTERVAL 3 MONTH) AS VARCHAR) AS financial_quarter")
    q["reconcile_quarterly"] = with_star(f"""o AS (SELECT {fyq('period_date')}, CAST(SUM(attendances_total) AS BIGINT) AS our_value
          FROM fact GROUP BY ALL),
        lq AS (SELECT {fyq('period_date')}, CAST(SUM(q) AS BIGINT) AS q FROM li GROUP BY ALL),
        p AS (SELECT financial_year, financial_quarter,
          CAST(q + 3 * CAST(substr(financial_quarter, 2, 1) AS INTEGER) AS BIGINT) AS published_value FROM lq)
        SELECT COALESCE(o.financial_year, p.financial_year) AS financial_year,
          COALESCE(o.financial_quarter, p.financial_quarter) AS financial_quarter, our_value, published_value,
          our_value - published_value AS variance,
          CASE WHEN abs(our_value - published_value) <= 10 THEN 'PASS' ELSE 'FAIL' END AS status
        FROM o FULL JOIN p ON o.financial_year = p.financial_year AND o.financial_quarter = p.financial_quarter""")
    measures = ("attendances_type1", "attendances_type2", "attendances_type3", "attendances_total", "breaches_type1",
                "breaches_type2", "breaches_type3", "breaches_total", "emergency_admissions_type1",
                "emergency_admissions_type2", "emergency_admissions_type3", "emergency_admissions_via_ae",
                "emergency_admissions_other", "emergency_admissions_total", "dta_breaches_4hr", "dta_breaches_12hr")
    neg = " OR ".join(f"{m} < 0" for m in measures)
    perf = P("attendances_total - breaches_total", "attendances_total")
    rules = (("performance_outside_0_100", f"{perf} < 0 OR {perf} > 100"), ("negative_count", neg),
             ("breaches_exceed_attendances", "breaches_total > attendances_total"),
             ("type_sum_exceeds_total", "attendances_type1 + attendances_type2 + attendances_type3 > attendances_total"),
             ("dta_12hr_exceeds_4hr", "dta_breaches_12hr > dta_breaches_4hr"))
    q["dq_range"] = with_star(" UNION ALL ".join(
        f"SELECT '{n}' AS rule, count_if({c}) AS violations FROM fact" for n, c in rules))
    q["dq_volume"] = with_star("""per AS (SELECT period_date, count(*) AS n_providers FROM fact GROUP BY period_date),
        w AS (SELECT *, SUM(n_providers) OVER t AS s, COUNT(n_providers) OVER t AS n FROM per
              WINDOW t AS (ORDER BY period_date ROWS BETWEEN 12 PRECEDING AND 1 PRECEDING))
        SELECT period_date, n_providers, CASE WHEN n > 0 THEN CAST(s AS DOUBLE) / n END AS trailing_mean,
          COALESCE(n_providers < 0.9 * (CAST(s AS DOUBLE) / NULLIF(n, 0)), false) AS volume_drop FROM w""")
    prev = "CAST(date_trunc('month', DATE '2001-12-20') - INTERVAL 1 MONTH AS DATE)"
    nxt = f"CAST({prev} + INTERVAL 1 MONTH AS DATE)"
    rel = f"({nxt} + CAST((4 - dayofweek({nxt}) + 7) % 7 + 7 AS INTEGER))"
    q["dq_freshness"] = with_star(f"""n AS (SELECT max(period_date) AS newest_period,
          CASE WHEN {rel} <= DATE '2001-12-20' THEN {prev} ELSE CAST({prev} - INTERVAL 1 MONTH AS DATE) END AS expected_period
          FROM fact)
        SELECT newest_period, expected_period, CAST(date_diff('month', newest_period, expected_period) AS INTEGER) AS months_behind,
          CASE WHEN date_diff('month', newest_period, expected_period) <= 0 THEN 'fresh' ELSE 'stale' END AS status FROM n""")
    q["dq_duplicates"] = with_star("""SELECT f.period_date, p.trust_code, count(*) AS n_rows
        FROM fact f JOIN prov p USING (provider_key) GROUP BY f.period_date, p.trust_code HAVING count(*) > 1""")
    q["dq_gaps"] = with_star("""g AS (SELECT p.trust_code, f.period_date,
          LEAD(f.period_date) OVER (PARTITION BY p.trust_code ORDER BY f.period_date) AS nxt
          FROM fact f JOIN prov p USING (provider_key))
        SELECT trust_code, CAST(period_date + INTERVAL 1 MONTH AS DATE) AS gap_start,
          CAST(nxt - INTERVAL 1 MONTH AS DATE) AS gap_end, CAST(date_diff('month', period_date, nxt) - 1 AS INTEGER) AS missing_months
        FROM g WHERE nxt > period_date + INTERVAL 1 MONTH""")
    q["dq_low"] = with_star("""w AS (SELECT p.trust_code, f.period_date, attendances_total,
          SUM(attendances_total) OVER t AS s, COUNT(attendances_total) OVER t AS n
          FROM fact f JOIN prov p USING (provider_key)
          WINDOW t AS (PARTITION BY f.provider_key ORDER BY f.period_date ROWS BETWEEN 12 PRECEDING AND 1 PRECEDING))
        SELECT trust_code, period_date, attendances_total, CAST(s AS DOUBLE) / n AS trailing_mean FROM w
        WHERE n > 0 AND 10 * attendances_total * n < s""")
    q["dq_accepted_values"] = """SELECT 'lineitem' AS table_name, 'l_returnflag' AS column_name, l_returnflag AS value, COUNT(*) AS n_rows
        FROM lineitem WHERE l_returnflag NOT IN ('A', 'N', 'R') GROUP BY l_returnflag
        UNION ALL SELECT 'lineitem', 'l_linestatus', l_linestatus, COUNT(*) FROM lineitem WHERE l_linestatus NOT IN ('F', 'O') GROUP BY l_linestatus
        UNION ALL SELECT 'orders', 'o_orderstatus', o_orderstatus, COUNT(*) FROM orders WHERE o_orderstatus NOT IN ('F', 'O') GROUP BY o_orderstatus"""
    checks = (("not_null", "fail", "sum(null_count)", "dq_not_null"), ("unique", "warn", "count(*)", "dq_unique"),
              ("relationship", "fail", "sum(orphan_rows)", "dq_relationship"),
              ("reconcile_national", "warn", "count_if(status = 'FAIL')", "reconcile_national"),
              ("range", "fail", "sum(violations)", "dq_range"), ("duplicates", "fail", "count(*)", "dq_duplicates"),
              ("gaps", "warn", "count(*)", "dq_gaps"), ("low_values", "warn", "count(*)", "dq_low"),
              ("freshness", "warn", "sum(greatest(months_behind, 0))", "dq_freshness"),
              ("accepted_values", "fail", "sum(n_rows)", "dq_accepted_values"),
              ("reconcile_internal", "fail", "count_if(NOT (attendances_consistent AND admissions_consistent))", "reconcile_internal"),
              ("reconcile_quarterly", "warn", "count_if(status = 'FAIL')", "reconcile_quarterly"), ("volume", "warn", "count_if(volume_drop)", "dq_volume"))
    parts = [f"SELECT '{n}' AS check_name, '{t}' AS tier, CAST(COALESCE((SELECT {agg} FROM ({q[src]})), 0) AS BIGINT) AS failures"
             for n, t, agg, src in checks]
    q["dq_report"] = ("SELECT *, CASE WHEN failures = 0 THEN 'pass' ELSE tier END AS status FROM ("
                      + " UNION ALL ".join(parts) + ")")
    return q


def operations_sql() -> dict[str, str]:
    files = r"""files AS (SELECT page_id, regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.\-]*://([^/?#:]*)', 1) AS source_name,
          sha256(html) AS sha256, url AS resolved_url,
          COALESCE(NULLIF(url_decode(regexp_extract(COALESCE(regexp_extract(url,
            '^(?:[a-zA-Z][a-zA-Z0-9+.\-]*:)?(?://[^/?#]*)?([^?#]*)', 1), ''), '([^/]*)$', 1)), ''), 'download.xls')
            AS original_filename FROM pages),
        cat AS (SELECT source_name, sha256, original_filename, resolved_url FROM files WHERE page_id % 3 = 0)"""
    q = {}
    q["file_skip"] = f"""WITH {files}
        SELECT page_id, source_name, sha256, CASE WHEN (source_name, sha256) IN (SELECT (source_name, sha256) FROM cat)
          THEN 'skip' ELSE 'ingest' END AS action FROM files"""
    q["catalog_insert_ignore"] = f"""WITH {files}
        SELECT * FROM cat UNION ALL
        SELECT source_name, sha256, arg_min(original_filename, original_filename), arg_min(resolved_url, original_filename)
        FROM files WHERE (source_name, sha256) NOT IN (SELECT (source_name, sha256) FROM cat)
        GROUP BY source_name, sha256"""
    q["url_change"] = f"""WITH {files}, l AS (SELECT page_id, source_name, resolved_url,
          LAG(resolved_url) OVER (PARTITION BY source_name ORDER BY page_id) AS previous_url FROM files)
        SELECT *, previous_url IS NOT NULL AND previous_url IS DISTINCT FROM resolved_url AS url_changed FROM l"""
    q["staging_replace"] = f"""WITH {REV_CTES}
        SELECT period_date, org_code, org_name, {", ".join(_STAGED_MEASURES)} FROM revised"""
    q["run_audit_latest"] = """SELECT user_id AS run_id, min(ts) AS started_at,
          CASE WHEN arg_max(event_type, ts) <> 'running' THEN max(ts) END AS finished_at,
          arg_max(event_type, ts) AS status, arg_max(CAST(floor(value) AS BIGINT), ts) AS rows_loaded,
          arg_max(props, ts) AS notes
        FROM events GROUP BY user_id"""
    downloads = files.replace(" FROM pages)", r""", strlen(html) AS size_bytes, len(regexp_extract_all(html, '<p>')) AS row_count,
          CASE page_id % 3 WHEN 0 THEN '2001-12-13' WHEN 1 THEN '2001-12-14' ELSE '2001-12-15' END AS ingest_date FROM pages)""", 1)
    q["manifest"] = f"""WITH {downloads}, m AS (SELECT *, 'raw/ingest_date=' || ingest_date || '/' || original_filename AS raw_storage_path FROM files)
        SELECT page_id, raw_storage_path, CAST(to_json({{'source_name': source_name, 'source_url': resolved_url,
          'original_filename': original_filename, 'data_month': ingest_date[1:7], 'ingest_timestamp': '2001-12-15T08:00:00+00:00',
          'size_bytes': size_bytes, 'sha256': sha256, 'raw_storage_path': raw_storage_path,
          'schema_version': '{DEFAULT_SCHEMA_VERSION}', 'row_count': row_count}}) AS VARCHAR) AS manifest FROM m"""
    q["archive_roundtrip"] = f"""WITH {downloads}
        SELECT DISTINCT ingest_date, source_name, original_filename, size_bytes, sha256 FROM files"""
    q["stream_ingest_once"] = f"""WITH {downloads}
        SELECT DISTINCT source_name, size_bytes, sha256 FROM files WHERE sha256 IS NOT NULL"""
    q["retention_drop"] = f"""WITH {downloads}
        SELECT page_id, ingest_date, size_bytes, sha256 FROM files WHERE ingest_date >= '2001-12-14'"""
    q["seed_provider"] = with_star("SELECT provider_key, trust_code, trust_name, icb_name FROM prov")
    q["retention_prune"] = """SELECT event_id, ts FROM events
        WHERE ts >= CAST(DATE '2024-01-31' - INTERVAL 14 DAY AS DATE)"""
    return q


def marts_sql() -> dict[str, str]:
    perf = P("attendances_total - breaches_total", "attendances_total")
    perf_t = T("attendances_total - breaches_total", "attendances_total")
    adm = "COALESCE(emergency_admissions_via_ae, emergency_admissions_type1 + emergency_admissions_type2 + emergency_admissions_type3)"
    rag = lambda x: (f"CASE WHEN {x} IS NULL THEN NULL WHEN {x} < 70 THEN 'red' "  # noqa: E731
                     f"WHEN {x} < 90 THEN 'amber' ELSE 'green' END")
    q = {}
    q["mart_national_trends"] = with_star(f"""g AS (SELECT period_date, CAST(SUM(attendances_total) AS BIGINT) AS total_attendances,
          CAST(SUM(attendances_type1) AS BIGINT) AS type1_attendances, CAST(SUM(breaches_total) AS BIGINT) AS total_breaches,
          CAST(SUM({adm}) AS BIGINT) AS emergency_admissions FROM fact GROUP BY period_date)
        SELECT g.period_date, g.total_attendances, g.type1_attendances, g.total_breaches,
          {P("g.total_attendances - g.total_breaches", "g.total_attendances")} AS performance_pct, g.emergency_admissions,
          {P("g.emergency_admissions", "g.total_attendances")} AS admission_conversion_pct,
          p.total_attendances AS prior_year_attendances,
          {P("g.total_attendances - p.total_attendances", "p.total_attendances")} AS yoy_change_pct
        FROM g LEFT JOIN g p ON p.period_date = CAST(g.period_date - INTERVAL 12 MONTH AS DATE)""")
    q["mart_provider_rankings"] = with_star(f"""r AS (SELECT trust_code, trust_name, period_date, provider_key,
          {perf} AS performance_pct, {perf_t} AS pt FROM star WHERE attendances_total > 0)
        SELECT trust_code, trust_name, period_date, performance_pct,
          CAST(RANK() OVER (PARTITION BY period_date ORDER BY pt DESC) AS INTEGER) AS national_rank,
          CAST(COUNT(*) OVER (PARTITION BY period_date) AS BIGINT) AS total_providers, {rag("performance_pct")} AS rag,
          CAST(pt - LAG(pt) OVER (PARTITION BY provider_key ORDER BY period_date) AS DOUBLE) / 10 AS change_pp
        FROM r""")
    q["mart_emergency_admissions"] = with_star(f"""r AS (SELECT trust_code, period_date, {adm} AS emergency_admissions,
          emergency_admissions_type1 AS type1_admissions, attendances_total, dta_breaches_4hr, dta_breaches_12hr FROM star)
        SELECT trust_code, period_date, emergency_admissions, type1_admissions,
          {P("emergency_admissions", "attendances_total")} AS admission_conversion_pct,
          CASE WHEN {P("emergency_admissions", "attendances_total")} IS NULL THEN NULL
               WHEN {P("emergency_admissions", "attendances_total")} < 20 THEN 'low'
               WHEN {P("emergency_admissions", "attendances_total")} < 25 THEN 'below_normal'
               WHEN {P("emergency_admissions", "attendances_total")} <= 35 THEN 'normal'
               WHEN {P("emergency_admissions", "attendances_total")} <= 40 THEN 'high' ELSE 'very_high' END AS acuity_band,
          dta_breaches_4hr, dta_breaches_12hr, {P("dta_breaches_12hr", "emergency_admissions")} AS dta_12hr_rate_pct FROM r""")
    t1 = T("attendances_type1 - breaches_type1", "attendances_type1")
    q["mart_four_hour"] = with_star(f"""b AS (SELECT trust_code, period_date, attendances_total AS total_attendances,
          COALESCE(breaches_total, breaches_type1 + breaches_type2 + breaches_type3) AS breaches,
          {perf} AS performance_pct, {P("attendances_type1 - breaches_type1", "attendances_type1")} AS type1_performance_pct,
          {perf_t} AS all_t, {t1} AS t1_t FROM star),
        t AS (SELECT * FROM (VALUES ('four_hour_all_types', DATE '1900-01-01', DATE '2000-01-01', 95.0),
                                    ('four_hour_type1', DATE '2000-01-01', NULL, 76.0)) v(measure, valid_from, valid_to, target)),
        j AS (SELECT b.*, t.measure, t.target, CASE WHEN t.measure = 'four_hour_type1' THEN t1_t ELSE all_t END AS a,
                CAST(round(t.target * 10) AS BIGINT) AS tt
              FROM b LEFT JOIN t ON b.period_date >= t.valid_from AND (t.valid_to IS NULL OR b.period_date < t.valid_to))
        SELECT trust_code, period_date, total_attendances, breaches, performance_pct, type1_performance_pct,
          measure AS target_measure, CAST(target AS DOUBLE) AS target_pct, CAST(a - tt AS DOUBLE) / 10 AS gap_pp,
          a >= tt AS meets_target FROM j""")
    pf = analytics_sql()["pressure_flags"]
    k12 = kpi_sql()["kpi12"]
    q["mart_command_center"] = with_star(f"""lt AS (SELECT max(period_date) AS period_date FROM fact),
        p AS (SELECT trust_code, period_date, {perf} AS performance_pct FROM star WHERE period_date = (SELECT period_date FROM lt)),
        pf AS (SELECT * FROM ({pf})), k AS (SELECT period_date, median_performance_pct FROM ({k12}))
        SELECT p.trust_code, p.period_date, p.performance_pct, {rag("p.performance_pct")} AS rag,
          pf.above_own_12m_mean, pf.performance_falling, pf.dta_12hr_breach, pf.pressure_score,
          k.median_performance_pct AS national_median_pct,
          round(p.performance_pct - k.median_performance_pct, 1) AS gap_to_median_pp
        FROM p JOIN pf ON p.trust_code = pf.trust_code AND p.period_date = pf.period_date
        LEFT JOIN k ON k.period_date = p.period_date""")
    return q


def drift_sql() -> dict[str, str]:
    """Drift of the rendered workbooks: fixed by the render rules (renamed total label
    before 1996, an extra column from 2001, five columns the registry does not map)."""
    files = ("fl AS (SELECT DISTINCT 'ae-activity-' || strftime(period_date, '%Y-%m') || '.xls' AS file, "
             "'Provider Level Data' AS sheet, period_date FROM fact)")
    breach = "A&E attendances greater than 4 hours from arrival to admission, transfer or discharge"
    unmapped = ["Region", f"{breach} :: Type 2 Departments - Single Specialty",
                f"{breach} :: Type 3 Departments - Other A&E/Minor Injury Unit",
                "Emergency Admissions :: Emergency Admissions via Type 2 A&E",
                "Emergency Admissions :: Emergency Admissions via Type 3 and 4 A&E"]
    vals = ", ".join(f"('{u}')" for u in unmapped)
    unexpected = f"""SELECT file, sheet, 'new_column' AS drift_type, u.d AS column_detail, 'warned' AS action_taken
          FROM fl CROSS JOIN (VALUES {vals}) u(d)
        UNION ALL
        SELECT file, sheet, 'new_column', 'Appointments :: Booked Type 1 appointments', 'warned' FROM fl
          WHERE period_date >= DATE '2001-01-01'"""
    renamed_label = "A&E attendances :: Total Attendance"
    q = {}
    q["drift_rename"] = with_star(f"""{files}
        SELECT file, sheet, 'attendances_total' AS canonical, 6 AS col, '{renamed_label}' AS compound,
          round(1 - levenshtein(lower('{renamed_label}'), 'a&e attendances :: total attendances')
                / greatest(length('{renamed_label}'), length('a&e attendances :: total attendances')), 3) AS similarity
        FROM fl WHERE period_date < DATE '1996-01-01'""")
    q["drift_unexpected"] = with_star(f"{files}\n{unexpected}")
    q["drift_missing"] = with_star(f"""{files}
        SELECT file, sheet, 'missing_required' AS drift_type, 'attendances_type1' AS column_detail, 'halted' AS action_taken
        FROM fl WHERE month(period_date) = 3""")
    q["drift_log"] = with_star(f"""{files}
        {unexpected}
        UNION ALL
        SELECT file, sheet, 'renamed', '{renamed_label} -> attendances_total', 'fuzzy_mapped' FROM fl
          WHERE period_date < DATE '1996-01-01'""")
    return q
