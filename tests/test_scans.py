"""How often each query reads the fact table and the line table, counted in the optimised plan
(before any exchange reuse, so the figures do not depend on it)."""

from __future__ import annotations

import pytest

from edpanel.plans import catalog, layers

ONE_SCAN = ["kpi01", "kpi02", "kpi03", "kpi04", "kpi05", "kpi06", "kpi07", "kpi08_lag",
            "kpi08_calendar", "kpi10", "kpi11", "kpi12", "geo_rollup", "fq_rollup", "fy_ytd", "type_mix", "target_gap",
            "rag", "dta_waits", "mom", "trajectory", "early_warning", "pressure_flags",
            "seasonal_forecast", "winter_delta"]
TWO_SCANS = ["kpi09", "peer_geo", "peer_mix", "peer_national", "outliers", "winter_history", "winter_gap_topk", "missing_submissions"]
PROVIDER_WINDOWS = ["kpi08_lag", "kpi08_calendar", "trajectory", "early_warning", "pressure_flags", "mom", "fy_ytd"]


def scans(df, column) -> int:
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    return sum("Relation " in row and column in row for row in plan.splitlines())


@pytest.mark.parametrize("name,most", [*[(n, 1) for n in ONE_SCAN], *[(n, 2) for n in TWO_SCANS]])
def test_star_queries_read_the_fact_table_only(name, most, spark, sf_dir):
    df = catalog.queries()[name](spark, sf_dir)
    assert scans(df, "l_orderkey") == 0 and 1 <= scans(df, "emergency_admissions_type1") <= most


@pytest.mark.parametrize("name,most", [("fact_build", 1), ("dim_month", 1), ("dq_report", 5)])
def test_line_scans(name, most, spark, sf_dir):
    assert 1 <= scans(catalog.queries()[name](spark, sf_dir), "l_orderkey") <= most


def exchanges_under_windows(df) -> int:
    """Exchanges between the scan of the bucketed fact and the plan's top."""
    rows = df._jdf.queryExecution().executedPlan().toString().splitlines()
    depth = [len(r) - len(r.lstrip(" +-:")) for r in rows]
    found = 0
    for k, row in enumerate(rows):
        if "Bucketed: true" in row:
            at = depth[k]
            for i in range(k, -1, -1):
                if depth[i] < at:
                    at = depth[i]
                    found += "Exchange" in rows[i] and "BroadcastExchange" not in rows[i]
    return found


@pytest.mark.parametrize("name", PROVIDER_WINDOWS)
def test_provider_windows_need_no_exchange(name, spark, sf_dir):
    df = catalog.queries()[name](spark, sf_dir)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Window" in plan and "Bucketed: true" in plan and exchanges_under_windows(df) == 0


def test_bucketing_survives_the_rewrite_of_a_period(spark, sf_dir):
    """One month is published again: only its rows change, and windows still need no exchange."""
    from pyspark.sql import Window
    from pyspark.sql import functions as F
    source = layers.fact_table(spark, sf_dir)
    name = "marts.rewrite_test"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    rows = spark.table(source)
    path = layers.scratch_path(spark, "layers/rewrite_test")
    (rows.repartition(layers.LEAST_BUCKETS, layers.BUCKET_KEY).write.mode("overwrite").option("path", path).partitionBy(layers.YEAR)
     .bucketBy(layers.LEAST_BUCKETS, layers.BUCKET_KEY).sortBy(layers.BUCKET_KEY, "period_date").saveAsTable(name))
    before = {(r.provider_key, r.period_date): r for r in rows.collect()}
    month = sorted({k[1] for k in before})[20]
    again = rows.where(F.col("period_date") == F.lit(month)).where("provider_key % 3 > 0").withColumn("breaches_total", F.col("breaches_total") + 1000)
    layers.replace_fact_periods(spark, name, again.drop(layers.YEAR))
    after = {(r.provider_key, r.period_date): r for r in spark.table(name).collect()}
    want = {k: v.breaches_total + 1000 * (k[1] == month) for k, v in before.items() if k[1] != month or k[0] % 3 > 0}
    assert {k: v.breaches_total for k, v in after.items()} == want
    assert all(after[k] == before[k] for k in after if k[1] != month)
    lagged = spark.table(name).withColumn("before", F.lag("breaches_total").over(Window.partitionBy("provider_key").orderBy("period_date")))
    assert exchanges_under_windows(lagged) == 0 and "Bucketed: true" in lagged._jdf.queryExecution().executedPlan().toString()
    lagged.count()
    spark.sql(f"DROP TABLE {name}")


def test_changed_sources_give_a_new_table(spark, sf_dir, tmp_path):
    import shutil
    shutil.copytree(sf_dir, tmp_path / "sf")
    state = layers.source_state(spark, str(tmp_path / "sf"))
    assert state == layers.source_state(spark, f"{tmp_path}/sf/") != layers.source_state(spark, sf_dir)
    shutil.copy(f"{sf_dir}/orders.parquet", tmp_path / "sf" / "supplier.parquet")
    assert layers.source_state(spark, str(tmp_path / "sf")) != state
