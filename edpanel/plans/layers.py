"""Layered materialisation (B9): catalog tables in the databases ``staging``, ``marts``, ``meta``
and ``reference``.

The fact is written once per state of its source files, partitioned by year and bucketed and
sorted by provider, and every star query reads it: the per-provider windows then need no
exchange. Marts are written once from it. Tables live under the shared checkpoint folder; a
table is registered only after its write has ended, so a crashed write is never read. The name
ends in a digest of the source files (path, length, modification time): changed sources give a
new table.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from edpanel.plans import analogue
from edpanel.session import scratch_path
from edpanel.sources.tables import read_table, table_path

LAYERS = ("staging", "marts", "meta", "reference")
FACT = "fact_ae_activity"
BUCKET_KEY, YEAR = "provider_key", "period_year"
ROWS_PER_BUCKET, LEAST_BUCKETS, MOST_BUCKETS = 200_000, 8, 8192
MONTHS = 84                       # months of the analogue, for the size of a bucket
SOURCES = ("lineitem", "supplier", "nation", "region")


def source_state(spark: SparkSession, sf_dir: str, tables: tuple[str, ...] = SOURCES) -> str:
    """Digest of the source files' names, lengths and modification times, from their listing alone."""
    jvm, conf = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    seen = [sf_dir.rstrip("/")]
    for table in tables:
        path = jvm.org.apache.hadoop.fs.Path(table_path(sf_dir, table))
        listed = jvm.org.apache.commons.lang3.ArrayUtils.toString(path.getFileSystem(conf).listStatus(path))  # one call, whatever the number of files
        seen.append(re.sub(r"access_time=\d+; ", "", listed))
    return hashlib.sha256("\n".join(seen).encode()).hexdigest()[:16]


def table_name(spark: SparkSession, sf_dir: str, layer: str, name: str) -> str:
    return f"{layer}.{name}_{source_state(spark, sf_dir)}"


def ensure_databases(spark: SparkSession) -> None:
    for database in LAYERS:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")


def bucket_count(providers: int, months: int = MONTHS) -> int:
    return min(MOST_BUCKETS, max(LEAST_BUCKETS, -(-providers * months // ROWS_PER_BUCKET)))


def fact_table(spark: SparkSession, sf_dir: str) -> str:
    """The fact's table name; the table is written where this state of the sources has none."""
    name = table_name(spark, sf_dir, "marts", FACT)
    if not spark.catalog.tableExists(name):
        ensure_databases(spark)
        buckets = bucket_count(read_table(spark, sf_dir, "supplier", "s_suppkey").count())
        rows = analogue.build_fact(spark, sf_dir).withColumn(YEAR, F.year("period_date"))
        (rows.repartition(buckets, BUCKET_KEY).write.format("parquet").option("path", scratch_path(spark, f"layers/{FACT}-{uuid.uuid4().hex}"))
         .partitionBy(YEAR).bucketBy(buckets, BUCKET_KEY).sortBy(BUCKET_KEY, "period_date").saveAsTable(name))
    return name


def fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.table(fact_table(spark, sf_dir)).drop(YEAR)


def replace_fact_periods(spark: SparkSession, name: str, rows: DataFrame) -> None:
    """Replace the periods present in ``rows`` (the fact's columns) in table ``name``. Their years are
    gathered in the shared folder first, then overwritten as whole partitions in the table's own bucketing."""
    rows = rows.withColumn(YEAR, F.year("period_date"))
    columns = spark.table(name).columns
    held = spark.table(name).join(F.broadcast(rows.select(YEAR).distinct()), YEAR, "left_semi")
    held = held.join(F.broadcast(rows.select("period_date").distinct()), "period_date", "left_anti")  # one row a month
    path = scratch_path(spark, f"layers/rewrite-{uuid.uuid4().hex}")
    held.select(*columns).unionByName(rows.select(*columns)).write.parquet(path)
    described = spark.sql(f"DESCRIBE EXTENDED {name}").where("col_name = 'Num Buckets'").first()
    merged = spark.read.schema(spark.table(name).schema).parquet(path).select(*columns)
    merged.repartition(int(described.data_type), BUCKET_KEY).write.mode("overwrite").insertInto(name)
    spark.catalog.refreshTable(name)


def star(spark: SparkSession, sf_dir: str) -> analogue.Star:
    """The star over the materialised fact; its months are the fact's own."""
    rows = fact(spark, sf_dir)
    return analogue.Star(rows, analogue.build_dim_provider(spark, sf_dir), rows)


def mart(spark: SparkSession, sf_dir: str, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    """A mart as a table of the ``marts`` database, written once from the fact."""
    table = table_name(spark, sf_dir, "marts", name)
    if not spark.catalog.tableExists(table):
        ensure_databases(spark)
        build().write.format("parquet").option("path", scratch_path(spark, f"layers/{name}-{uuid.uuid4().hex}")).saveAsTable(table)
    return spark.table(table)
