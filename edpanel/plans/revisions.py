"""Revision model over the analogue: successive publications of the same months.

- first release: activity without the late-arriving last line of each order (line 7);
- revised release: all lines (some provider-months change, some appear for the first time);
- revert: the first release published again (the revision withdrawn).

Staged rows use the staging layout (period, org code/name, counts); the key is
``(period_date, org_code)`` and the hash covers all staged business columns.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from edpanel.operators import changes, sinks
from edpanel.plans import analogue
from edpanel.session import scratch_path

LATE_LINE = 7
KEY = ("period_date", "org_code")
STAGED_MEASURES = (
    "attendances_type1", "attendances_type2", "attendances_type3", "attendances_total",
    "breaches_type1", "breaches_total", "emergency_admissions_type1", "emergency_admissions_via_ae",
    "emergency_admissions_other", "emergency_admissions_total", "dta_breaches_4hr", "dta_breaches_12hr",
)
HASH_COLS = ("period_date", "org_code", "org_name", *STAGED_MEASURES)
CARRY = ("org_name", "attendances_total", "breaches_total")
# Fixed publication instants of the three releases.
T_FIRST, T_REVISED, T_REVERT = "2001-12-10 08:00:00", "2002-01-08 08:00:00", "2002-02-12 08:00:00"
AS_OF = "2001-12-31 00:00:00"


def staged(spark: SparkSession, sf_dir: str, release: str) -> DataFrame:
    """Staged rows of one release, hashed."""
    max_line = LATE_LINE - 1 if release in ("first", "revert") else None
    fact = analogue.fact_from_lines(analogue.activity_lines(spark, sf_dir, max_line))
    prov = analogue.build_dim_provider(spark, sf_dir).select("provider_key", "trust_code", "trust_name")
    rows = fact.join(prov, "provider_key").select(
        "period_date", F.col("trust_code").alias("org_code"), F.col("trust_name").alias("org_name"),
        *STAGED_MEASURES)
    return changes.with_row_hash(rows, HASH_COLS)


def versions_after_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The versions table as the load of the first release leaves it: written to the shared
    folder by ``is_current``, so later merges read current rows and history apart."""
    first = staged(spark, sf_dir, "first")
    merged = changes.scd2_merge(changes.empty_versions(first, KEY, CARRY), first, KEY, T_FIRST, "first", CARRY)
    table = sinks.VersionedTable(spark, scratch_path(spark, f"versions/{uuid.uuid4().hex}"))
    return table.read(table.write_next(merged, "is_current"), merged.schema)


def versions_after_revised(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changes.scd2_merge(versions_after_first(spark, sf_dir), staged(spark, sf_dir, "revised"), KEY,
                              T_REVISED, "revised", CARRY)


def row_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = changes.row_diff(staged(spark, sf_dir, "revised"), versions_after_first(spark, sf_dir), KEY)
    return d.select(*KEY, "attendances_total", "row_hash", "change_status")


def scd2_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return versions_after_revised(spark, sf_dir)


def changed_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = changes.row_diff(staged(spark, sf_dir, "revised"), versions_after_first(spark, sf_dir), KEY)
    return changes.changed_periods(d)


def scd2_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changes.scd2_current(versions_after_revised(spark, sf_dir))


def scd2_asof(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changes.scd2_as_of(versions_after_revised(spark, sf_dir), AS_OF)


def revision_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changes.revision_audit(versions_after_revised(spark, sf_dir), KEY, ("attendances_total", "breaches_total"))


def snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = []
    for release, ts in (("first", T_FIRST), ("revised", T_REVISED), ("revert", T_REVERT)):
        parts.append(staged(spark, sf_dir, release).select(
            *KEY, *CARRY, "row_hash", F.lit(release).alias("source_version"),
            changes.ts_literal(ts).alias("snapshot_ts")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def scd2_rebuild(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changes.scd2_rebuild(snapshots(spark, sf_dir), KEY, CARRY)


def scd2_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The releases loaded out of order, the revised one last: the history of a rebuild in order.
    Each load writes the next version of the table, as a scheduled load does."""
    first = staged(spark, sf_dir, "first")
    versions = changes.empty_sighted_versions(first, KEY, CARRY)
    table = sinks.VersionedTable(spark, scratch_path(spark, f"versions/{uuid.uuid4().hex}"))
    for rows, ts, release in ((first, T_FIRST, "first"), (staged(spark, sf_dir, "revert"), T_REVERT, "revert"),
                              (staged(spark, sf_dir, "revised"), T_REVISED, "revised")):
        merged = changes.scd2_late_merge(versions, rows, KEY, ts, release, CARRY)
        versions = table.read(table.write_next(merged), merged.schema)
    return versions.drop("seen")


def source_precedence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """History file (first release, all months) and monthly file (revised release, newest
    month only): the later publication wins per (period, org)."""
    history = staged(spark, sf_dir, "first").select(
        *KEY, "attendances_total", F.lit("history").alias("source_kind"),
        changes.ts_literal(T_FIRST).alias("published_at"), F.lit(2).alias("source_priority"))
    monthly_all = staged(spark, sf_dir, "revised")
    newest = monthly_all.agg(F.max("period_date").alias("period_date"))
    monthly = monthly_all.join(F.broadcast(newest), "period_date").select(
        *KEY, "attendances_total", F.lit("monthly").alias("source_kind"),
        changes.ts_literal(T_REVISED).alias("published_at"), F.lit(1).alias("source_priority"))
    return changes.source_precedence(history.unionByName(monthly), KEY, "published_at", "source_priority")
