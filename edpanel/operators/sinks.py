"""Sinks (B1–B10): staging layout and writers.

Writers only use the DataFrame writer: dynamic partition overwrite for replace-by-period,
append-only partitions for the raw archive, and a new version directory per SCD2 merge
(Parquet has no in-place MERGE). Nothing is collected to the driver.
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from edpanel.functions import columns as C
from edpanel.session import path_exists

STAGING_SCHEMA = T.StructType([
    T.StructField("period_date", T.DateType()),
    T.StructField("org_code", T.StringType()),
    T.StructField("org_name", T.StringType()),
    *[T.StructField(c, T.LongType()) for c in (
        "attendances_type1", "attendances_type2", "attendances_type3", "attendances_total",
        "breaches_type1", "breaches_total")],
    T.StructField("performance_all_pct", T.DecimalType(18, 6)),
    *[T.StructField(c, T.LongType()) for c in (
        "emergency_admissions_type1", "emergency_admissions_via_ae", "emergency_admissions_other",
        "emergency_admissions_total", "dta_breaches_4hr", "dta_breaches_12hr")],
])
AUDIT_COLUMNS = ("source_file_name", "source_file_hash", "source_url", "ingested_at")


def conform_staging(df: DataFrame, keep: Sequence[str] = ("file",)) -> DataFrame:
    """Fixed staging layout (B5): absent columns become typed NULLs, fixed order."""
    check_unique_columns(df)
    cols = [(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in STAGING_SCHEMA.fields]
    extra = [c for c in keep if c in df.columns]
    return df.select(*cols, *extra)


def check_unique_columns(df: DataFrame) -> None:
    """Duplicate-column guard (B6): a driver check of the schema, no data touched."""
    seen, dupes = set(), []
    for c in df.columns:
        if c.lower() in seen:
            dupes.append(c)
        seen.add(c.lower())
    if dupes:
        raise ValueError(f"duplicate columns in staging frame: {dupes}")


def add_audit_columns(df: DataFrame, file_name: str | F.Column, file_hash: str | F.Column,
                      url: str | F.Column, ingested_at: str) -> DataFrame:
    """Audit columns with one timestamp per load."""
    def lit(v):
        return v if isinstance(v, F.Column) else F.lit(v)
    return df.select("*", lit(file_name).cast("string").alias("source_file_name"),
                     lit(file_hash).cast("string").alias("source_file_hash"),
                     lit(url).cast("string").alias("source_url"),
                     F.lit(ingested_at).cast("timestamp").alias("ingested_at"))


LOAD_COLUMNS = (*AUDIT_COLUMNS, "publication_date", "row_hash", "is_current")


def add_load_columns(rows: DataFrame, origins: DataFrame, ingested_at: str, hash_cols: Sequence[str]) -> DataFrame:
    """All audit columns of a load (B4): those of :func:`add_audit_columns`, the date on which the row's file
    was published, the hash of the row's business columns, and ``is_current``, as a load replaces its periods whole.

    ``origins`` (file, sha256, source_url, published_at) has a row a file. A file without origin keeps its
    rows, with NULL in what the origin would give."""
    o = origins.select("file", F.col("sha256").alias("_sha"), F.col("source_url").alias("_url"),
                       F.col("published_at").cast("date").alias("publication_date"))
    named = rows.join(o, "file", "left").withColumn("row_hash", C.row_hash(*hash_cols)).withColumn("is_current", F.lit(True))
    audited = add_audit_columns(named, F.col("file"), F.col("_sha"), F.col("_url"), ingested_at)
    return audited.select(*[c for c in rows.columns if c != "file"], *LOAD_COLUMNS)


def replace_periods(df: DataFrame, path: str, partition_col: str = "period_date") -> None:
    """Replace every period present in ``df`` and leave the others untouched.
    Dynamic partition overwrite makes a rerun idempotent; an empty frame is a no-op. Rows are rebalanced
    by period first: a period is one file up to the advisory size of AQE, which cuts larger ones, so
    there are no tasks x periods small files and a hot period is no single task."""
    (df.hint("rebalance", partition_col).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(partition_col).parquet(path))


def append_partitioned(df: DataFrame, path: str, partition_col: str) -> None:
    """Immutable append-only archive partitioned by ``partition_col`` (B1)."""
    df.write.mode("append").partitionBy(partition_col).parquet(path)


def archive_new(df: DataFrame, path: str, partition_col: str, keys: Sequence[str]) -> int:
    """Archive the rows whose ``keys`` the archive does not hold yet, so a rerun adds nothing
    (B1); returns how many were added."""
    if path_exists(df.sparkSession, path):
        held = df.sparkSession.read.schema(df.schema).parquet(path).select(*keys)
        df = df.join(held, list(keys), "left_anti").select(*df.columns)
    counted = Observation()
    append_partitioned(df.dropDuplicates(list(keys)).observe(counted, F.count(F.lit(1)).alias("added")), path, partition_col)
    return counted.get["added"]


def manifest_json(df: DataFrame, fields: Sequence[str]) -> DataFrame:
    """One JSON manifest document per archived file (B2); NULL fields stay as null."""
    return df.select("*", F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}).alias("manifest"))


def run_audit_latest(events: DataFrame) -> DataFrame:
    """Current state per pipeline run from append-only start/finish events."""
    g = events.groupBy("run_id").agg(
        F.min("event_ts").alias("started_at"),
        F.max_by(F.struct("status", "rows_loaded", "notes", "event_ts"), "event_ts").alias("last"))
    return g.select("run_id", "started_at",
                    F.when(F.col("last.status") != "running", F.col("last.event_ts")).alias("finished_at"),
                    F.col("last.status").alias("status"), F.col("last.rows_loaded").alias("rows_loaded"),
                    F.col("last.notes").alias("notes"))


def retention_prune(df: DataFrame, ts_col: str, as_of: str, keep_days: int) -> DataFrame:
    """Rows inside the rolling retention window."""
    return df.where(F.col(ts_col) >= F.date_sub(F.lit(as_of).cast("date"), keep_days))


def drop_expired_partitions(spark: SparkSession, path: str, partition_col: str, as_of: str, keep_days: int) -> list[str]:
    """Drop the date partitions of a table that lie before the retention window (B10), by the names of their
    folders: no data file is read. Folders that name no date (rows without one among them) stay. Returns the dropped
    dates; a rerun drops nothing."""
    first_kept = dt.date.fromisoformat(as_of) - dt.timedelta(days=keep_days)
    jvm = spark._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    dropped = []
    for status in fs.listStatus(root):
        column, _, value = status.getPath().getName().partition("=")
        if status.isDirectory() and column == partition_col and re.fullmatch(r"\d{4}-\d{2}-\d{2}", value):
            if dt.date.fromisoformat(value) < first_kept and fs.delete(status.getPath(), True):
                dropped.append(value)
    spark.catalog.refreshByPath(path)
    return sorted(dropped)


class VersionedTable:
    """A table written as numbered version directories ``<path>/version=<n>``.

    A merge result is written to the next version; Spark's commit leaves a ``_SUCCESS``
    marker, and readers take the highest committed version, so a crashed write is never
    seen and the previous version stays readable (the 'pointer flip')."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _fs(self):
        jvm = self.spark.sparkContext._jvm
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        p = jvm.org.apache.hadoop.fs.Path(self.path)
        return p.getFileSystem(conf), p, jvm

    def versions(self, committed: bool = True) -> list[int]:
        fs, p, jvm = self._fs()
        if not fs.exists(p):
            return []
        out = []
        for st in fs.listStatus(p):
            name = st.getPath().getName()
            if name.startswith("version=") and (not committed or fs.exists(jvm.org.apache.hadoop.fs.Path(st.getPath(), "_SUCCESS"))):
                out.append(int(name.split("=", 1)[1]))
        return sorted(out)

    def current_version(self) -> int | None:
        v = self.versions()
        return v[-1] if v else None

    def read(self, version: int | None = None, schema: T.StructType | None = None) -> DataFrame | None:
        v = self.current_version() if version is None else version
        reader = self.spark.read.schema(schema) if schema else self.spark.read
        return None if v is None else reader.parquet(f"{self.path}/version={v}")

    def write_next(self, df: DataFrame, *partition_by: str) -> int:
        nxt = max(self.versions(committed=False), default=0) + 1  # past the folder of a crashed write
        df.write.mode("errorifexists").partitionBy(*partition_by).parquet(f"{self.path}/version={nxt}")
        return nxt
