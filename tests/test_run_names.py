"""Workbooks of one name in one batch, and the releases that the scheduled run lands."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from edpanel.plans import operations, revisions
from edpanel.streaming import run

T1, T2 = revisions.T_FIRST, revisions.T_REVISED
HEAD = "Period:,,June 1996\n,,A&E attendances\nCode,Name,Type 1 Departments - Major A&E\n"


def land(spark, landing, url, published, *texts, name="june.xls"):
    """One workbook, its sheet in parts, in a Parquet file of its own."""
    rows = [("monthly", name, url, published, "Provider Data", first, text) for first, text in texts]
    schema = run.LANDING.replace("timestamp_ntz", "string")
    (spark.createDataFrame(rows, schema).withColumn("published_at", F.col("published_at").cast("timestamp_ntz")).select(*[c.split()[0] for c in run.LANDING.split(", ")])
     .coalesce(1).write.mode("append").parquet(landing))


def shown(rows, *columns):
    return sorted(tuple(str(x) for x in r) for r in rows.select(*columns).collect())


def test_a_workbook_that_lands_again_beside_its_revision_is_skipped(spark, tmp_path):
    landing, root = str(tmp_path / "landing"), str(tmp_path / "house")
    first, revised = (0, HEAD + "S1,One,10\nS2,Two,20"), (0, HEAD + "S1,One,10\nS2,Two,21\nS3,Three,30")
    land(spark, landing, "u/first", T1, first)
    run.run_available(spark, landing, root)
    land(spark, landing, "u/first", T2, first)
    land(spark, landing, "u/revised", T2, revised)
    house = run.run_available(spark, landing, root)
    assert shown(house.versions(), "org_code", "attendances_type1", "valid_from", "is_current") == [
        ("S1", "10", T1, "True"), ("S2", "20", T1, "False"), ("S2", "21", T2, "True"), ("S3", "30", T2, "True")]
    assert shown(house.earlier("catalog", run.CATALOG), "source_url", "row_count", "batch_id") == [("u/first", "2", "0"), ("u/revised", "3", "1")]
    land(spark, landing, "u/later", "2002-02-01 00:00:00", revised)
    house = run.run_available(spark, landing, root)
    assert {r.status for r in house.earlier("audit", run.AUDIT).where("run_id = 'batch-2'").collect()} == {"running", "skipped"}


def test_new_workbooks_of_one_name_are_parsed_apart(spark, tmp_path):
    landing, root = str(tmp_path / "landing"), str(tmp_path / "house")
    land(spark, landing, "u/june", T1, (0, HEAD + "S1,One,10"))
    land(spark, landing, "u/july", T1, (0, HEAD.replace("June", "July") + "S1,One,11\nS2,Two,12"))
    land(spark, landing, "u/bad", T1, (0, HEAD.replace("Code", "Cipher") + "S1,One,99"))
    house = run.run_available(spark, landing, root)
    assert shown(house.versions(), "period_date", "org_code", "attendances_type1") == [
        ("1996-06-01", "S1", "10"), ("1996-07-01", "S1", "11"), ("1996-07-01", "S2", "12")]
    assert shown(house.earlier("catalog", run.CATALOG), "file_name", "source_url", "data_month", "row_count") == [
        ("june.xls", "u/july", "1996-07-01", "2"), ("june.xls", "u/june", "1996-06-01", "1")]
    assert shown(house.earlier("drift", run.DRIFT).where("action_taken = 'halted'"), "file", "drift_type")[0] == ("june.xls", "no_header")
    assert [r.notes for r in house.earlier("audit", run.AUDIT).where("status = 'success'").collect()] == ["3 rows changed; 1 files halted"]


def test_scheduled_run_lands_the_whole_first_release_again(spark, sf_dir, monkeypatch, tmp_path):
    root = str(tmp_path / uuid.uuid4().hex)
    monkeypatch.setattr(operations, "scratch_path", lambda spark, name: root)
    operations.scheduled_run(spark, sf_dir).count()
    landed = spark.read.schema(run.LANDING).parquet(f"{root}/landing").where("source_url like '%/first/%'")
    first, again = (landed.where(F.col("published_at") == F.lit(t).cast("timestamp_ntz")).select("file_name", "sheet", "first_row", "text") for t in (T1, T2))
    assert first.count() == again.count() > 0 and first.exceptAll(again).isEmpty()
