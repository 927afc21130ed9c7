"""Incremental ingest idempotence, the quality gate, and histogram ranks."""

from __future__ import annotations

import random
import shutil

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from edpanel.operators import ranking
from edpanel.plans import quality
from edpanel.streaming.ingest import ingest_available


def test_stream_ingest_is_idempotent(spark, sf_dir, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    for t in ("region", "nation"):
        shutil.copy(f"{sf_dir}/{t}.parquet", landing / f"{t}.parquet")
    cat, ck = str(tmp_path / "catalog"), str(tmp_path / "ck")
    first = ingest_available(spark, str(landing / "*.parquet"), cat, ck)
    assert first.count() == 2
    # Same content under a new name, plus one new file: only the new file is added.
    shutil.copy(landing / "region.parquet", landing / "region_copy.parquet")
    shutil.copy(f"{sf_dir}/supplier.parquet", landing / "supplier.parquet")
    second = ingest_available(spark, str(landing / "*.parquet"), cat, ck)
    assert sorted(r.file_name for r in second.collect()) == ["nation.parquet", "region.parquet", "supplier.parquet"]
    third = ingest_available(spark, str(landing / "*.parquet"), cat, ck)
    assert third.count() == 3


def test_quality_gate_raises_on_fail_tier(spark):
    rep = spark.createDataFrame([("range", "fail", 2, "fail"), ("gaps", "warn", 3, "warn")],
                                "check_name string, tier string, failures long, status string")
    with pytest.raises(quality.QualityGateError):
        quality.gate(rep)
    ok = rep.where("tier = 'warn'")
    assert quality.gate(ok) is ok


def test_report_on_driver_tables(spark, sf_dir):
    rep = {r.check_name: r for r in quality.dq_report(spark, sf_dir).collect()}
    assert rep["unique"].failures > 0          # (l_orderkey, l_linenumber) repeats in the driver data
    assert rep["duplicates"].failures == 0


def test_histogram_rank_equals_window_rank(spark):
    rnd = random.Random(7)
    rows = [(g, rnd.randint(0, 30)) for g in range(3) for _ in range(200)]
    df = spark.createDataFrame(rows, "g int, v int").withColumn("id", F.monotonically_increasing_id())
    want = df.withColumn("r", F.rank().over(Window.partitionBy("g").orderBy(F.col("v").desc())))
    got = ranking.rank_within(df, ["g"], "v")
    w = {(r.id, r.r) for r in want.collect()}
    assert {(r.id, r.rank) for r in got.collect()} == w
