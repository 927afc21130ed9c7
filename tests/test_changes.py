"""Revision handling on the hand-made snapshot sequence of FIXTURES §1.5."""

from __future__ import annotations

from edpanel.operators import changes

KEY = ["period", "org"]
HASH = ["period", "org", "v"]


def snap(spark, rows):
    df = spark.createDataFrame(rows, "period string, org string, v long")
    return changes.with_row_hash(df, HASH)


def statuses(diff):
    return sorted((r.org, r.change_status) for r in diff.collect())


def test_three_snapshots(spark):
    s1 = snap(spark, [("2024-01", "A", 10), ("2024-01", "B", 20), ("2024-01", "C", None)])
    s2 = snap(spark, [("2024-01", "A", 11), ("2024-01", "B", 20), ("2024-01", "C", None), ("2024-01", "D", 5)])
    s3 = snap(spark, [("2024-01", "A", 10), ("2024-01", "C", 0), ("2024-01", "D", 5)])

    v1 = changes.scd2_merge(changes.empty_versions(s1, KEY, ["v"]), s1, KEY, "2024-02-01 08:00:00", "s1", ["v"])
    d2 = changes.row_diff(s2, v1, KEY)
    assert statuses(d2) == [("A", "REVISED"), ("B", "UNCHANGED"), ("C", "UNCHANGED"), ("D", "NEW")]
    v2 = changes.scd2_merge(v1, s2, KEY, "2024-03-01 08:00:00", "s2", ["v"])
    d3 = changes.row_diff(s3, v2, KEY)
    assert statuses(d3) == [("A", "REVISED"), ("C", "REVISED"), ("D", "UNCHANGED")]
    v3 = changes.scd2_merge(v2, s3, KEY, "2024-04-01 08:00:00", "s3", ["v"])
    current = {r.org: r.v for r in changes.scd2_current(v3).collect()}
    assert current == {"A": 10, "B": 20, "C": 0, "D": 5}          # absent B stays current
    assert v3.count() == 7                                         # A x3, B, C x2, D
    # Replaying S3 changes nothing.
    assert [s for _, s in statuses(changes.row_diff(s3, v3, KEY))] == ["UNCHANGED"] * 3
    # As of mid-February the first snapshot is in force.
    asof = {r.org: r.v for r in changes.scd2_as_of(v3, "2024-02-15 00:00:00").collect()}
    assert asof == {"A": 10, "B": 20, "C": None}
    audit = {(r.org, r.old_v, r.new_v) for r in changes.revision_audit(v3, KEY, ["v"]).collect()}
    assert audit == {("A", 10, 11), ("A", 11, 10), ("C", None, 0)}


def test_rebuild_matches_incremental_merge(spark):
    from pyspark.sql import functions as F
    s1 = snap(spark, [("p", "A", 1), ("p", "B", 2)]).withColumn("snapshot_ts", F.lit("2024-01-01").cast("timestamp_ntz"))
    s2 = snap(spark, [("p", "A", 3), ("p", "B", 2)]).withColumn("snapshot_ts", F.lit("2024-02-01").cast("timestamp_ntz"))
    s3 = snap(spark, [("p", "A", 1), ("p", "B", 2)]).withColumn("snapshot_ts", F.lit("2024-03-01").cast("timestamp_ntz"))
    allsnap = s1.withColumn("source_version", F.lit("s1")).unionByName(s2.withColumn("source_version", F.lit("s2"))) \
        .unionByName(s3.withColumn("source_version", F.lit("s3")))
    rebuilt = changes.scd2_rebuild(allsnap, KEY, ["v"])
    got = sorted((r.org, r.v, r.is_current) for r in rebuilt.collect())
    assert got == [("A", 1, False), ("A", 1, True), ("A", 3, False), ("B", 2, True)]


def test_catalog_insert_ignore_and_skip(spark):
    cat = spark.createDataFrame([("src", "h1", "a.xls")], "source_name string, sha256 string, original_filename string")
    inc = spark.createDataFrame([("src", "h1", "a2.xls"), ("src", "h2", "c.xls"), ("src", "h2", "b.xls")],
                                "source_name string, sha256 string, original_filename string")
    out = sorted(tuple(r) for r in changes.catalog_insert_ignore(cat, inc).collect())
    assert out == [("src", "h1", "a.xls"), ("src", "h2", "b.xls")]
    skip = sorted((r.original_filename, r.action) for r in changes.file_skip(inc, cat).collect())
    assert skip == [("a2.xls", "skip"), ("b.xls", "ingest"), ("c.xls", "ingest")]
