"""Incremental, idempotent file ingest.

A file-source stream over a landing folder with ``trigger(availableNow=True)``: each
run processes the files that arrived since the last run (the stream checkpoint keeps
the seen paths), then stops. Inside ``foreachBatch`` the batch is hashed and anti-joined
against the file catalog on (source, sha256), so a file re-uploaded under a new name is
still skipped; new files are appended to the catalog. Both folders live under the shared
checkpoint location, so a restarted driver or lost executor resumes from the last
committed batch.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from edpanel.session import path_exists

BINARY_FILE_SCHEMA = T.StructType([
    T.StructField("path", T.StringType()),
    T.StructField("modificationTime", T.TimestampType()),
    T.StructField("length", T.LongType()),
    T.StructField("content", T.BinaryType()),
])
LANDING_SCHEMA = "source_name string, file_name string, content binary"
CATALOG_SCHEMA = T.StructType([
    T.StructField("source_name", T.StringType()),
    T.StructField("file_name", T.StringType()),
    T.StructField("size_bytes", T.LongType()),
    T.StructField("sha256", T.StringType()),
    T.StructField("batch_id", T.LongType()),
])


def _read_catalog(spark: SparkSession, catalog_path: str) -> DataFrame:
    if not path_exists(spark, catalog_path):  # no catalog written yet; any other failure raises
        return spark.createDataFrame([], CATALOG_SCHEMA)
    return spark.read.schema(CATALOG_SCHEMA).parquet(catalog_path)


def _catalogue(files: DataFrame, catalog_path: str, batch_id: int) -> None:
    """Append the files (source_name, file_name, size_bytes, sha256) whose content the catalog
    does not hold; within a batch the first file name per content wins."""
    seen = _read_catalog(files.sparkSession, catalog_path).select("source_name", "sha256")
    fresh = (files.join(seen, ["source_name", "sha256"], "left_anti")
             .groupBy("source_name", "sha256").agg(F.min_by(F.struct("file_name", "size_bytes"), "file_name").alias("f"))
             .select("source_name", "f.file_name", "f.size_bytes", "sha256", F.lit(batch_id).cast("long").alias("batch_id")))
    fresh.write.mode("append").parquet(catalog_path)


def _run_available(stream: DataFrame, process: Callable[[DataFrame, int], None], checkpoint_path: str) -> None:
    (stream.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint_path)
     .trigger(availableNow=True).start().awaitTermination())


def ingest_available(spark: SparkSession, landing_glob: str, catalog_path: str, checkpoint_path: str,
                     source_name: str = "landing", max_files_per_trigger: int = 1000) -> DataFrame:
    """Process every file not yet seen, then return the catalog. A file is one row, and files
    beyond 2 GiB raise; :func:`ingest_rows_available` takes files landed as table rows."""
    stream = (spark.readStream.format("binaryFile").schema(BINARY_FILE_SCHEMA)
              .option("maxFilesPerTrigger", max_files_per_trigger).load(landing_glob))

    def process(batch: DataFrame, batch_id: int) -> None:
        files = batch.select(F.lit(source_name).alias("source_name"), F.regexp_extract("path", r"([^/]+)$", 1).alias("file_name"),
                             F.col("length").alias("size_bytes"), F.sha2("content", 256).alias("sha256"))
        _catalogue(files, catalog_path, batch_id)

    _run_available(stream, process, checkpoint_path)
    return _read_catalog(spark, catalog_path)


def ingest_rows_available(spark: SparkSession, landing: str, catalog_path: str, checkpoint_path: str,
                          max_files_per_trigger: int = 1000) -> DataFrame:
    """The same for files landed as rows (source_name, file_name, content) of a Parquet folder;
    rows without content are no file."""
    stream = spark.readStream.schema(LANDING_SCHEMA).option("maxFilesPerTrigger", max_files_per_trigger).parquet(landing)

    def process(batch: DataFrame, batch_id: int) -> None:
        files = batch.where(F.col("content").isNotNull()).select(
            "source_name", "file_name", F.octet_length("content").cast("long").alias("size_bytes"), F.sha2("content", 256).alias("sha256"))
        _catalogue(files, catalog_path, batch_id)

    _run_available(stream, process, checkpoint_path)
    return _read_catalog(spark, catalog_path)
