"""Dimension-model queries over the analogue star.

Derived inputs, all computed from the driver tables:

- provider attribute history: every reported (provider, month) with the provider's
  name and ICB as published that month; providers with key divisible by 10 are renamed
  from RENAME_FROM, those divisible by 15 move to the next nation's ICB from MOVE_FROM.
- org bridge: of every 25 providers the last three merge into the one below, each from
  its own date in MERGERS, so that chains of one, two and three links occur, the later
  link of a chain being in force before or after the earlier one.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from edpanel.functions import columns as C
from edpanel.operators import dimensions as D
from edpanel.operators import changes, kpi, sinks
from edpanel.plans import analogue, layers
from edpanel.session import materialize, scratch_path
from edpanel.sources.tables import read_table

# Analogue change dates (fixed values).
RENAME_FROM = "1998-01-01"
RENAME_SUFFIX = " (renamed)"
MOVE_FROM = "1999-07-01"
MERGERS = ((0, "1999-01-01"), (24, "2000-07-01"), (23, "1997-01-01"))   # (key mod 25, from)


def provider_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact = layers.fact(spark, sf_dir).select("provider_key", "period_date")
    sup = read_table(spark, sf_dir, "supplier", "s_suppkey", "s_name", "s_nationkey")
    nation = read_table(spark, sf_dir, "nation", "n_nationkey", "n_name")
    j = fact.join(sup, fact.provider_key == sup.s_suppkey)
    p, k = F.col("period_date"), F.col("s_suppkey")
    moved = (F.pmod(k, F.lit(15)) == 0) & (p >= F.lit(MOVE_FROM).cast("date"))
    j = j.withColumn("icb_nation", F.when(moved, F.pmod(F.col("s_nationkey") + 1, F.lit(25))).otherwise(F.col("s_nationkey")))
    j = j.join(F.broadcast(nation), F.col("icb_nation") == nation.n_nationkey, "left")
    renamed = (F.pmod(k, F.lit(10)) == 0) & (p >= F.lit(RENAME_FROM).cast("date"))
    return j.select(F.concat(F.lit("S"), k.cast("string")).alias("org_code"), "period_date",
                    F.when(renamed, F.concat(F.col("s_name"), F.lit(RENAME_SUFFIX))).otherwise(F.col("s_name"))
                    .alias("org_name"), F.col("n_name").alias("icb_name"))


def dim_provider_scd2(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = D.scd2_from_history(provider_history(spark, sf_dir), "org_code", "period_date", ["org_name", "icb_name"])
    return v.drop("provider_version_key")


# The months whose publications of the provider list are loaded, in order of arrival (fixed values).
LIST_MONTHS = ("1997-06-01", "2000-06-01", "1998-06-01", "1999-06-01")


def dim_provider_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E2 from publications that arrive out of order: each provider list goes into the versions of earlier
    loads by its own month, and the table is what a rebuild in order of month gives. Every load writes
    the next version of the table."""
    key, attrs = ["org_code"], ["org_name", "icb_name"]
    lists = changes.with_row_hash(provider_history(spark, sf_dir).where(F.col("period_date").isin(*(dt.date.fromisoformat(m) for m in LIST_MONTHS))), attrs)
    lists = materialize(lists)
    versions = changes.empty_sighted_versions(lists, key, attrs)
    table = sinks.VersionedTable(spark, scratch_path(spark, f"versions/{uuid.uuid4().hex}"))
    for month in LIST_MONTHS:
        published = lists.where(F.col("period_date") == F.lit(month).cast("date"))
        merged = changes.scd2_late_merge(versions, published, key, f"{month} 00:00:00", month[:7], attrs)
        versions = table.read(table.write_next(merged), merged.schema)
    return versions.select(*key, *attrs, "source_version", F.col("valid_from").cast("date").alias("valid_from"),
                           F.col("valid_to").cast("date").alias("valid_to"), "is_current")


def org_bridge_seed(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = read_table(spark, sf_dir, "supplier", "s_suppkey")
    k = F.col("s_suppkey")
    since = F.lit(None).cast("date")
    for rest, day in MERGERS:
        since = F.when(F.pmod(k, F.lit(25)) == rest, F.lit(day).cast("date")).otherwise(since)
    return s.select(
        F.concat(F.lit("S"), k.cast("string")).alias("old_code"),
        F.concat(F.lit("S"), (k - 1).cast("string")).alias("new_code"),
        since.alias("effective_from")).where(F.col("effective_from").isNotNull())


def org_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    star = layers.star(spark, sf_dir)
    return star.fact.join(star.dim_provider, "provider_key").select(
        F.col("trust_code").alias("org_code"), "period_date", "attendances_total", "breaches_total")


def org_bridge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.apply_bridge(org_rows(spark, sf_dir), org_bridge_seed(spark, sf_dir), "org_code", "period_date",
                          ["attendances_total", "breaches_total"])


def org_bridge_comparable(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Comparable series: every period under the last successor, across the merger."""
    return D.apply_bridge(org_rows(spark, sf_dir), org_bridge_seed(spark, sf_dir), "org_code", "period_date",
                          ["attendances_total", "breaches_total"], comparable=True)


def fact_provider_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact under the provider version in force in each period (E5)."""
    return D.with_version_in_force(org_rows(spark, sf_dir), dim_provider_scd2(spark, sf_dir), "org_code",
                                   "period_date", ["version_no", "org_name", "icb_name"])


def geo_rollup_asof(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ICB and national totals per month, each provider under the ICB of the time."""
    f = fact_provider_version(spark, sf_dir)
    within = F.col("attendances_total") - F.col("breaches_total")
    g = (f.groupingSets([["period_date", "icb_name"], ["period_date"]], "period_date", "icb_name")
         .agg(F.sum("attendances_total").cast("bigint").alias("total_attendances"),
              F.sum(within).cast("bigint").alias("within_4hrs"), F.grouping_id().alias("gid")))
    return g.select("period_date", F.when(F.col("gid") == 0, "icb").otherwise("national").alias("geo_level"),
                    "icb_name", "total_attendances", "within_4hrs",
                    C.pct("within_4hrs", "total_attendances").alias("performance_pct"))


def crs_exclusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """National 4-hour performance per month with and without field-test providers."""
    star = layers.star(spark, sf_dir)
    rows = star.fact.join(star.dim_provider, "provider_key").select("trust_code", "period_date",
                                                                    "attendances_total", "breaches_total")
    flagged = D.flag_field_test(rows, analogue.crs_list(spark, sf_dir), "trust_code", "period_date")
    within = F.col("attendances_total") - F.col("breaches_total")
    keep = ~F.col("is_field_test")
    g = flagged.groupBy("period_date").agg(
        F.sum("attendances_total").cast("bigint").alias("total_all"), F.sum(within).cast("bigint").alias("within_all"),
        F.sum(F.when(keep, F.col("attendances_total"))).cast("bigint").alias("total_excl"),
        F.sum(F.when(keep, within)).cast("bigint").alias("within_excl"),
        F.count_if(F.col("is_field_test")).alias("field_test_rows"))
    return g.select("period_date", "total_all", C.pct("within_all", "total_all").alias("performance_all_pct"),
                    "total_excl", C.pct("within_excl", "total_excl").alias("performance_excl_pct"), "field_test_rows")


TYPE1_MEASURES = ("attendances_type1", "breaches_type1", "emergency_admissions_type1")


def partial_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows with no type-1 activity are treated as not reporting their type-1 measures
    (NULL); submission status counts NULL measures over all activity columns."""
    star = layers.star(spark, sf_dir)
    f = star.fact.join(star.dim_provider, "provider_key")
    f = f.withColumn("_no_t1", F.col("attendances_type1") == 0)
    for c in TYPE1_MEASURES:
        f = f.withColumn(c, F.when(F.col("_no_t1"), F.lit(None).cast("bigint")).otherwise(F.col(c)))
    n_null, status = D.submission_status(analogue.MEASURES)
    return f.select("trust_code", "period_date", n_null.alias("n_missing_measures"), status.alias("submission_status"))


def type_unpivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    star = layers.star(spark, sf_dir)
    f = star.fact.join(star.dim_provider, "provider_key")
    return D.unpivot_types(f, ["trust_code", "period_date"], {
        "attendances": ["attendances_type1", "attendances_type2", "attendances_type3"],
        "breaches": ["breaches_type1", "breaches_type2", "breaches_type3"],
        "emergency_admissions": ["emergency_admissions_type1", "emergency_admissions_type2",
                                 "emergency_admissions_type3"]})


def missing_submissions(spark: SparkSession, sf_dir: str) -> DataFrame:
    star = layers.star(spark, sf_dir)
    present = star.fact.join(star.dim_provider, "provider_key").select("trust_code", "period_date")
    return D.missing_periods(present, star.dim_provider.select("trust_code"), "trust_code", "period_date",
                             D.all_months(star.lines, "period_date"))


def actual_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Default analysis filter: actual-basis months only; COVID months kept and flagged."""
    star = layers.star(spark, sf_dir)
    s = kpi.with_performance(star.joined("data_basis", "is_covid_period"))
    return s.where(F.col("data_basis") == "actual").select(
        "trust_code", "period_date", "attendances_total", "performance_pct", "is_covid_period")
