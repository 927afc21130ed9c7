"""Session defaults shared by tests, the bench and the query catalog."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every plan in this package assumes: UTC wall clock (DuckDB oracles are
# zone-naive), ANSI arithmetic (so an unguarded /0 fails loudly instead of nulling),
# adaptive execution for runtime broadcast / coalesce / skew-join decisions.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "edpanel") -> SparkSession:
    """Build (or reuse) a session with the package defaults.

    On a cluster the master and resource settings come from spark-submit; ``master``
    is only passed by tests and the local bench.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
        builder = builder.config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        builder = builder.config("spark.driver.memory", os.environ.get("EDPANEL_DRIVER_MEMORY", "16g"))
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in SESSION_DEFAULTS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    for key, value in SESSION_DEFAULTS.items():
        spark.conf.set(key, value)
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    A cluster names a shared folder there; only when it is unset on a local master (a
    test run) do we create a scratch folder of our own.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="edpanel-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    spark.sparkContext.setCheckpointDir(path)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A folder under the shared checkpoint location for written intermediate tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/edpanel/{name}"


def materialize(df):
    """Cut lineage with a reliable checkpoint in the shared ``spark.checkpoint.dir``.

    Used where a derived input feeds many branches (the rendered grid, per-sheet header
    frames): downstream plans then start from the written data, which survives executor
    loss and keeps the plans small.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def store(df):
    """Write ``df`` as Parquet to the shared folder and read it back. Later plans prune the columns, push their filters
    down to the written files and know their size, so a small frame is broadcast without a shuffle of what it meets."""
    path = scratch_path(df.sparkSession, f"stored/{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists on its file system."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)
