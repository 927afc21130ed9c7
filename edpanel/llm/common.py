"""Helpers shared by the training-data operators: written tables and files in the shared
folder, Arrow batch slicing, one place that bounds the bytes of an Arrow batch."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession

from edpanel.session import scratch_path

BATCH_BYTES = 8 << 20
BATCH_ROWS = 2000
SLICE_BYTES = 4 << 20


def tuned(spark: SparkSession) -> SparkSession:
    """Bound the bytes of every Arrow batch, so long texts never meet in one huge batch."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark


def fresh_folder(spark: SparkSession, name: str) -> str:
    """A new folder in the shared location (``spark.checkpoint.dir``) for one call."""
    return f"{scratch_path(tuned(spark), name)}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a new table in the shared folder and read it back: lineage ends there
    and a lost executor costs no recomputation."""
    path = fresh_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_written(df: DataFrame) -> None:
    """Delete a table made by :func:`written` that no later plan reads."""
    spark = df.sparkSession
    jvm, conf = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if "/edpanel/" in folder:
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(conf).delete(path, True)


def write_blob(folder: str, name: str, data: bytes, attempt: int) -> None:
    """Write one file of a task. The name and the bytes depend on the task's rows only, the
    rename is atomic: a retried or speculative attempt puts the same file in place again."""
    fs, root = pafs.FileSystem.from_uri(folder)
    fs.create_dir(f"{root}/_tmp", recursive=True)
    tmp = f"{root}/_tmp/{name}.{attempt}"
    with fs.open_output_stream(tmp) as out:
        out.write(data)
    fs.move(tmp, f"{root}/{name}")


def slices(batches: Iterator[pa.RecordBatch], limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in pieces of about ``limit`` bytes (one row at least)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        step = max(1, int(batch.num_rows * limit / max(limit, batch.nbytes)))
        for at in range(0, batch.num_rows, step):
            yield batch.slice(at, step)


def split_on_hash(rows: int, per_part: int) -> int:
    """Parts that hold about ``per_part`` rows each."""
    return max(1, -(-rows // per_part))
