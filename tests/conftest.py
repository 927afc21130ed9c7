"""Shared fixtures: one local Spark session for the whole run, DuckDB over the driver
tables, and the oracle comparison helpers of scripts/compare_oracle.py."""

from __future__ import annotations

import importlib.util
import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SMALL_SF = os.environ.get("EDPANEL_TEST_SF", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from edpanel.session import get_session
    s = get_session("local[*]", 8, app_name="edpanel-tests")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf_dir():
    if not os.path.exists(os.path.join(SMALL_SF, "lineitem.parquet")):
        pytest.skip(f"driver tables not found under {SMALL_SF}")
    return SMALL_SF


@pytest.fixture(scope="session")
def duck(sf_dir):
    import duckdb
    from edpanel.sources.tables import TABLES
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


@pytest.fixture(scope="session")
def compare():
    spec = importlib.util.spec_from_file_location("compare_oracle", os.path.join(ROOT, "scripts", "compare_oracle.py"))
    mod = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(mod)
    return mod
