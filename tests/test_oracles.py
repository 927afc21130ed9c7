"""Every oracle-backed query against its DuckDB SQL on the small driver tables.
The driver runs the same comparison at sf0.01; this keeps it green locally."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry

ORACLES = entry.oracle_sql()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(name, spark, sf_dir, duck, compare):
    sdf = entry.queries()[name](spark, sf_dir)
    srows, scols = [tuple(r) for r in sdf.collect()], sdf.columns
    res = duck.execute(ORACLES[name])
    ocols, orows = [d[0] for d in res.description], res.fetchall()
    assert sorted(scols) == sorted(ocols)
    assert len(srows) == len(orows)
    assert compare.digest(srows, scols)[0] == compare.digest(orows, ocols)[0]


def test_every_query_has_a_stable_schema(spark, sf_dir):
    qs = entry.queries()
    assert set(ORACLES) <= set(qs)
    for name in sorted(set(qs) - set(ORACLES)):
        df = qs[name](spark, sf_dir)
        assert df.columns, name
        df.limit(1).collect()


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() >= 0 and "performance_pct" in df.columns
