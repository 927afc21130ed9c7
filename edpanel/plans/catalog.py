"""The query catalog: name -> (spark, sf_dir) -> DataFrame, and name -> DuckDB SQL.

Each entry reads the driver tables (or data Spark derives from them) in full.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from edpanel.operators import analytics, kpi, marts
from edpanel.plans import analogue, dimensions, ingest, layers, operations, quality, revisions, scalars
from edpanel.plans import oracle_sql

QueryFn = Callable[[SparkSession, str], DataFrame]


def _star_query(fn: Callable[[analogue.Star], DataFrame]) -> QueryFn:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(layers.star(spark, sf_dir))
    run.__name__ = fn.__name__
    return run


def _kpi_queries() -> dict[str, QueryFn]:
    return {
        "fact_build": lambda s, d: analogue.build_fact(s, d),
        "dim_month": lambda s, d: analogue.build_dim_month(analogue.activity_lines(s, d)),
        "provider_hierarchy": lambda s, d: analogue.build_dim_provider(s, d),
        "kpi01": _star_query(kpi.kpi01_total_attendances),
        "kpi02": _star_query(kpi.kpi02_type1_attendances),
        "kpi03": _star_query(kpi.kpi03_emergency_admissions),
        "kpi04": _star_query(kpi.kpi04_admission_conversion),
        "kpi05": _star_query(kpi.kpi05_four_hour_performance),
        "kpi06": _star_query(kpi.kpi06_type1_performance),
        "kpi07": _star_query(kpi.kpi07_breach_count),
        "kpi08_lag": _star_query(kpi.kpi08_yoy_lag),
        "kpi08_calendar": _star_query(kpi.kpi08_yoy_calendar),
        "yoy_report": _star_query(kpi.yoy_report),
        "kpi09": _star_query(kpi.kpi09_provider_rank),
        "kpi10": _star_query(kpi.kpi10_icb_performance),
        "kpi11": _star_query(kpi.kpi11_type3_share),
        "kpi12": _star_query(kpi.kpi12_national_median),
        "geo_rollup": _star_query(kpi.geo_rollup),
        "fq_rollup": _star_query(kpi.fq_rollup),
        "fy_ytd": _star_query(kpi.fy_ytd),
        "type_mix": _star_query(kpi.type_mix),
        "target_gap": lambda s, d: kpi.target_gap(layers.star(s, d), analogue.targets_seed(s)),
        "rag": _star_query(kpi.rag),
        "dta_waits": _star_query(kpi.dta_waits),
        "mom": _star_query(kpi.mom),
    }


def _analytics_queries() -> dict[str, QueryFn]:
    names = ["trajectory", "peer_volume", "peer_geo", "peer_mix", "peer_national", "outliers",
             "winter_history", "winter_gap_topk", "winter_peer", "early_warning", "seasonal_forecast",
             "winter_delta", "pressure_flags"]
    return {n: _star_query(getattr(analytics, n)) for n in names}


def _revision_queries() -> dict[str, QueryFn]:
    names = ["row_diff", "scd2_merge", "changed_periods", "scd2_current", "scd2_asof", "revision_audit",
             "scd2_rebuild", "scd2_late", "source_precedence"]
    return {n: getattr(revisions, n) for n in names}


def _ingest_queries() -> dict[str, QueryFn]:
    names = ["grid_cells", "grid_profile", "pick_sheet", "header_row", "map_columns", "extract_period",
             "cells_to_wide", "drift_missing", "drift_unexpected", "drift_rename", "drift_log", "dq_coerce_rejects", "unmapped_capture", "stop_at_blank_row",
             "recompute_vs_source", "sheet_order", "parse_until_blank", "staging_audit"]
    return {n: getattr(ingest, f"q_{n}") for n in names}


def _scalar_queries() -> dict[str, QueryFn]:
    names = ["fin_year", "release_date", "month_trunc", "safe_pct", "row_hash", "url_filename", "coerce_int",
             "coerce_pct", "coerce_text", "compound_label", "footnote_filter", "ffill", "raw_file_hash",
             "link_extract", "link_file_step"]
    return {n: getattr(scalars, n) for n in names}


def _dimension_queries() -> dict[str, QueryFn]:
    names = ["dim_provider_scd2", "dim_provider_late", "org_bridge", "org_bridge_comparable", "fact_provider_version", "geo_rollup_asof",
             "crs_exclusion", "partial_flag", "type_unpivot",
             "missing_submissions", "actual_only"]
    return {n: getattr(dimensions, n) for n in names}


def _quality_queries() -> dict[str, QueryFn]:
    names = ["dq_not_null", "dq_unique", "dq_relationship", "dq_accepted_values", "reconcile_national", "reconcile_internal",
             "reconcile_quarterly", "dq_range", "dq_volume", "dq_freshness", "dq_duplicates", "dq_gaps", "dq_low",
             "dq_report"]
    return {n: getattr(quality, n) for n in names}


def _operation_queries() -> dict[str, QueryFn]:
    names = ["file_skip", "catalog_insert_ignore", "url_change", "manifest", "archive_roundtrip", "staging_replace",
             "run_audit_latest", "retention_prune", "retention_drop", "table_file_hash", "seed_provider", "stream_ingest_once", "scheduled_run"]
    return {n: getattr(operations, n) for n in names}


def _mart_query(name: str, build: Callable[[SparkSession, analogue.Star], DataFrame]) -> QueryFn:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return layers.mart(spark, sf_dir, name, lambda: build(spark, layers.star(spark, sf_dir)))
    return run


def _mart_queries() -> dict[str, QueryFn]:
    return {name: _mart_query(name, build) for name, build in {
        "mart_national_trends": lambda s, star: marts.national_trends(star),
        "mart_provider_rankings": lambda s, star: marts.provider_rankings(star),
        "mart_emergency_admissions": lambda s, star: marts.emergency_admissions(star),
        "mart_four_hour": lambda s, star: marts.four_hour(star, analogue.targets_seed(s)),
        "mart_command_center": lambda s, star: marts.command_center(star),
    }.items()}


def queries() -> dict[str, QueryFn]:
    q: dict[str, QueryFn] = {}
    q.update(_mart_queries())
    q.update(_operation_queries())
    q.update(_quality_queries())
    q.update(_dimension_queries())
    q.update(_scalar_queries())
    q.update(_ingest_queries())
    q.update(_revision_queries())
    q.update(_kpi_queries())
    q.update(_analytics_queries())
    return q


def oracles() -> dict[str, str]:
    o: dict[str, str] = {}
    o.update(oracle_sql.kpi_sql())
    o.update(oracle_sql.analytics_sql())
    o.update(oracle_sql.revisions_sql())
    o.update(oracle_sql.ingest_sql())
    o.update(oracle_sql.scalars_sql())
    o.update(oracle_sql.dimensions_sql())
    o.update(oracle_sql.quality_sql())
    o.update(oracle_sql.operations_sql())
    o.update(oracle_sql.marts_sql())
    o.update(oracle_sql.drift_sql())
    return {k: v for k, v in o.items() if k in queries()}
