"""File hashes by stream, seeds, registry files, sized writes and dropped partitions."""

from __future__ import annotations

import glob
import hashlib
import os

import pytest

from edpanel.operators import grid, links, sinks
from edpanel.plans import operations
from edpanel.sources import registry, seeds


def test_file_hashes_by_stream(spark, tmp_path):
    contents = {"a.bin": b"\0", "b c.bin": os.urandom(3_000_000), "sub/d.bin": b"x" * (links.CHUNK_BYTES + 1)}
    for name, data in contents.items():
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_bytes(data)
    (tmp_path / "empty.bin").write_bytes(b"")                       # passed over by the scan
    # The source raises on content past this length; the listing reads none.
    spark.conf.set("spark.sql.sources.binaryFile.maxLength", "1000")
    try:
        got = {r.file_name: (r.size_bytes, r.sha256) for r in links.file_hashes(spark, str(tmp_path)).collect()}
    finally:
        spark.conf.unset("spark.sql.sources.binaryFile.maxLength")
    assert got == {os.path.basename(n): (len(d), hashlib.sha256(d).hexdigest()) for n, d in contents.items()}


def test_table_file_hash_covers_every_file(spark, sf_dir):
    expected = sorted((os.path.basename(p), os.path.getsize(p), hashlib.sha256(open(p, "rb").read()).hexdigest())
                      for top in glob.glob(f"{sf_dir}/*.parquet")
                      for p in ([top] if os.path.isfile(top) else glob.glob(f"{top}/**/*.parquet", recursive=True)))
    assert sorted(map(tuple, operations.table_file_hash(spark, sf_dir).collect())) == expected


def test_seed_schema_is_checked(spark, tmp_path):
    schema = "measure string, valid_from date, target double"
    good, header, value = tmp_path / "good.csv", tmp_path / "header.csv", tmp_path / "value.csv"
    good.write_text('measure,valid_from,target\n"four, hour",2004-01-01,95\ndta,,0.5\n')
    header.write_text("measure,target,valid_from\nx,1,2004-01-01\n")
    value.write_text("measure,valid_from,target\nx,2004-01-01,many\n")
    got = [(r.measure, str(r.valid_from), r.target) for r in seeds.read_seed(spark, str(good), schema).collect()]
    assert got == [("four, hour", "2004-01-01", 95.0), ("dta", "None", 0.5)]
    for bad in (header, value):
        with pytest.raises(Exception):
            seeds.read_seed(spark, str(bad), schema).collect()


def test_registry_structure():
    raw = {"schema_version": 7, "sheet_anchor_column": "Org", "preferred_sheet_contains": ["Provider"],
           "columns": [{"maps_to": "a", "source_label_contains": "^a$", "required": True},
                       {"maps_to": "b", "patterns": ["x", "y"], "dtype": "integer"}]}
    reg = registry.registry_from_dict(raw)
    assert (reg.schema_version, reg.anchor, reg.preferred_sheets, reg.canonical) == ("7", "Org", ("provider",), ["a", "b"])
    assert reg.columns[0].required and reg.columns[1].patterns == ("x", "y") and reg.dtype("b") == "integer"
    with pytest.raises(ValueError):
        registry.registry_from_dict({"columns": [{"maps_to": "a", "patterns": "x", "dtype": "money"}]})
    assert registry.load_registry() == registry.default_registry()


def test_inspect_rows(spark):
    cells = spark.createDataFrame([("f", "s", r, 0, "v") for r in range(30)], "file string, sheet string, row int, col int, value string")
    assert grid.inspect_rows(cells).count() == 25 and grid.inspect_rows(cells, 3).count() == 3


def test_replaced_periods_are_few_files(spark, tmp_path):
    path = str(tmp_path / "staging")
    rows = spark.range(3000, numPartitions=16).selectExpr("id", "date_add(DATE'2024-01-01', CAST(id % 3 AS INT)) AS period_date")
    sinks.replace_periods(rows, path)
    files = glob.glob(f"{path}/period_date=*/*.parquet")
    assert len(files) == 3
    sinks.replace_periods(rows.where("id % 3 = 1").limit(5), path)              # one period again, the others stay
    assert {str(r.period_date): r["count"] for r in spark.read.parquet(path).groupBy("period_date").count().collect()} == {
        "2024-01-01": 1000, "2024-01-02": 5, "2024-01-03": 1000}
    sinks.replace_periods(rows.limit(0), path)
    assert spark.read.parquet(path).count() == 2005


def test_expired_partitions_dropped_by_name(spark, tmp_path):
    path = tmp_path / "archive"
    spark.sql("SELECT id, IF(id = 9, NULL, date_add(DATE'2024-01-01', CAST(id AS INT))) AS d FROM range(10)").write.partitionBy("d").parquet(str(path))
    # A damaged file in an expired folder shows that no data file is read.
    for name in glob.glob(f"{path}/d=2024-01-01/*.parquet"):
        with open(name, "wb") as f:
            f.write(b"damaged")
    for crc in glob.glob(f"{path}/d=2024-01-01/.*.crc"):
        os.remove(crc)
    assert sinks.drop_expired_partitions(spark, str(path), "d", "2024-01-09", 3) == [f"2024-01-0{k}" for k in range(1, 6)]
    assert sinks.drop_expired_partitions(spark, str(path), "d", "2024-01-09", 3) == []
    assert sorted(r.id for r in spark.read.parquet(str(path)).collect()) == [5, 6, 7, 8, 9]
