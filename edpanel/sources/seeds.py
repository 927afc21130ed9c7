"""Reference seeds: small CSV tables with a declared schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def read_seed(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """A seed table with a header line. A header that differs from the schema's names, and a value that
    is not of its column's type, is an error when the seed is read; empty fields are NULL."""
    return (spark.read.schema(schema).option("header", True).option("enforceSchema", False)
            .option("mode", "FAILFAST").csv(path))


def write_seed(df: DataFrame, path: str) -> None:
    df.write.option("header", True).csv(path)
