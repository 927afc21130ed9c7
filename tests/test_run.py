"""The whole incremental run: equal to the version oracle, halted files, the publish gate, and
crashes between any two steps."""

from __future__ import annotations

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from edpanel.plans import ingest, operations, revisions
from edpanel.sources import grid as grid_src
from edpanel.streaming import run

T1, T2 = revisions.T_FIRST, revisions.T_REVISED
MONTHS = "file in ('ae-activity-1996-03.xls', 'ae-activity-1996-04.xls')"


@pytest.fixture(scope="module")
def releases(spark, sf_dir, tmp_path_factory):
    """Two workbooks in two releases, as landed rows."""
    root = tmp_path_factory.mktemp("releases")
    for release in ("first", "revised"):
        operations.land_release(spark, sf_dir, release, T1 if release == "first" else T2, f"{root}/{release}", F.expr(MONTHS))
    return {r: spark.read.schema(run.LANDING).parquet(f"{root}/{r}").cache() for r in ("first", "revised")}


def land(rows, landing):
    rows.repartition("file_name").write.mode("append").parquet(str(landing))


def state(house):
    versions = house.versions()
    audit = house.earlier("audit", run.AUDIT).drop("batch_id")
    tables = {"versions": versions, "staging": house.staging().drop("source_version"), "catalog": house.earlier("catalog", run.CATALOG),
              "audit": audit, "drift": house.earlier("drift", run.DRIFT)}
    return {n: sorted(map(str, (t.select(*sorted(t.columns)).collect()))) for n, t in tables.items() if t is not None}


@pytest.fixture(scope="module")
def undisturbed(spark, releases, tmp_path_factory):
    root = tmp_path_factory.mktemp("undisturbed")
    for r in ("first", "revised"):
        land(releases[r], root / "landing")
        house = run.run_available(spark, str(root / "landing"), str(root / "house"))
    return house


def test_two_releases(spark, sf_dir, releases, undisturbed):
    house = undisturbed
    want = revisions.scd2_merge(spark, sf_dir).where("date_format(period_date, 'yyyy-MM') in ('1996-03', '1996-04')")
    cols = ["period_date", "org_code", "attendances_total", "row_hash", "valid_from", "valid_to", "is_current"]
    assert sorted(map(str, house.versions().select(*cols).collect())) == sorted(map(str, want.select(*cols).collect()))
    current = house.versions().where("is_current")
    staged = house.staging()
    assert sorted(map(str, staged.select(*sorted(run.HASHED)).collect())) == sorted(map(str, current.select(*sorted(run.HASHED)).collect()))
    audit = {(r.run_id, r.status): r for r in house.earlier("audit", run.AUDIT).collect()}
    assert set(audit) == {(f"batch-{k}", s) for k in (0, 1) for s in ("running", "success")}
    changed = house.versions().where("source_version = 'batch-1'").count()
    assert audit["batch-1", "success"].notes == f"{changed} rows changed; 0 files halted" and 0 < changed < staged.count()
    catalog = house.earlier("catalog", run.CATALOG).collect()
    assert sorted((r.file_name, str(r.data_month), r.batch_id) for r in catalog) == [
        (f"ae-activity-1996-{m}.xls", f"1996-{m}-01", b) for m in ("03", "04") for b in (0, 1)]


class Crash(RuntimeError):
    pass


STEPS = [f"{sink} {what}" for sink in ("fresh", "audit_running", "pending", "versions", "staging", "catalog", "audit_success") for what in ("written", "entered")]


@pytest.mark.parametrize("steps", [STEPS[0::3], STEPS[1::3], STEPS[2::3]])
def test_crash_after_any_step_changes_nothing(spark, releases, undisturbed, tmp_path, steps):
    """The second release's batch is cut off after each of ``steps`` in turn, then ends."""
    land(releases["first"], tmp_path / "landing")
    run.run_available(spark, str(tmp_path / "landing"), str(tmp_path / "house"))
    land(releases["revised"], tmp_path / "landing")
    left = list(steps)

    def after(batch_id, step):
        if left and step == left[0]:
            left.pop(0)
            raise Crash(step)
    for k in range(len(steps) + 1):
        if k < len(steps):
            with pytest.raises(StreamingQueryException):
                run.run_available(spark, str(tmp_path / "landing"), str(tmp_path / "house"), after=after)
        else:
            house = run.run_available(spark, str(tmp_path / "landing"), str(tmp_path / "house"), after=after)
    assert not left and state(house) == state(undisturbed)


def test_repeats_are_skipped_and_bad_files_halt(spark, releases, tmp_path):
    landing, root = str(tmp_path / "landing"), str(tmp_path / "house")
    lost = releases["first"].withColumn("text", F.when(F.col("file_name").contains("-03"), F.regexp_replace("text", "(?i)code", "Cipher")).otherwise(F.col("text")))
    land(lost, landing)
    house = run.run_available(spark, landing, root)
    assert [r.file_name for r in house.earlier("catalog", run.CATALOG).collect()] == ["ae-activity-1996-04.xls"]
    assert {r.file for r in house.earlier("drift", run.DRIFT).where("action_taken = 'halted'").collect()} == {"ae-activity-1996-03.xls"}
    before = state(house)
    land(lost.where("file_name like '%-04.xls'").withColumn("file_name", F.lit("copy.xls")), landing)
    house = run.run_available(spark, landing, root)
    assert [r.status for r in house.earlier("audit", run.AUDIT).where("run_id = 'batch-1'").orderBy("status").collect()] == ["running", "skipped"]
    assert {n: v for n, v in state(house).items() if n != "audit"} == {n: v for n, v in before.items() if n != "audit"}


def test_gate_leaves_the_old_version_readable(spark, releases, tmp_path):
    """Pending rows that break a rule are written and measured once, and never published."""
    landing, root = str(tmp_path / "landing"), str(tmp_path / "house")
    land(releases["first"], landing)
    house = run.run_available(spark, landing, root)
    before = state(house)
    cells = grid_src.cells_of_text(releases["revised"].withColumnRenamed("file_name", "file"))
    total = F.col("value").try_cast("int")
    bad = cells.withColumn("value", F.when((F.col("col") == 10) & total.isNotNull(), (total + 10 ** 6).cast("string")).otherwise(F.col("value")))
    rows = grid_src.sheet_texts(bad).select(F.lit("monthly").alias("source_name"), F.col("file").alias("file_name"), F.lit("u").alias("source_url"),
                                            F.lit(T2).cast("timestamp_ntz").alias("published_at"), "sheet", F.col("first_row").cast("int").alias("first_row"), "text")
    land(rows, landing)
    house = run.run_available(spark, landing, root)
    audit = {r.status: r.notes for r in house.earlier("audit", run.AUDIT).where("run_id = 'batch-1'").collect()}
    assert set(audit) == {"running", "failed"} and audit["failed"].startswith("breaches_exceed_attendances: ")
    after = state(house)
    assert all(after[n] == before[n] for n in ("versions", "staging", "catalog"))
    land(releases["revised"].withColumn("source_url", F.lit("again")), landing)
    fixed = run.run_available(spark, landing, root)
    assert fixed.versions().where("source_version = 'batch-2'").count() > 0
