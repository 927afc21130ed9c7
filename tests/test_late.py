"""Publications in any order of arrival give the history of a rebuild in order."""

from __future__ import annotations

import itertools
import random

from pyspark.sql import functions as F

from edpanel.operators import changes

KEY = ["period", "org"]
STAMPS = ["2024-01-01 08:00:00", "2024-02-01 08:00:00", "2024-03-01 08:00:00", "2024-04-01 08:00:00"]
OUT = ("period", "org", "v", "source_version", "valid_from", "valid_to", "is_current")


def _rows(df):
    return sorted((tuple(r) for r in df.select(*OUT).collect()), key=str)


def _snapshot(spark, rows):
    df = spark.createDataFrame(rows, "period string, org string, v long")
    return changes.with_row_hash(df, ["period", "org", "v"])


def _rebuilt(snaps):
    parts = [s.withColumns({"source_version": F.lit(f"s{i}"), "snapshot_ts": changes.ts_literal(STAMPS[i])})
             for i, s in enumerate(snaps)]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return changes.scd2_rebuild(out, KEY, ["v"])


def _merged(snaps, order):
    v = changes.empty_sighted_versions(snaps[0], KEY, ["v"])
    for i in order:
        v = changes.scd2_late_merge(v, snaps[i], KEY, STAMPS[i], f"s{i}", ["v"])
    return v


def test_every_arrival_order_equals_rebuild(spark):
    """One org per pattern of four snapshots over {absent, 1, 2, NULL}, all 256 of them."""
    patterns = list(itertools.product((None, 1, 2, "null"), repeat=4))
    snaps = [_snapshot(spark, [("p", f"o{n}", None if p[i] == "null" else p[i]) for n, p in enumerate(patterns) if p[i]])
             .cache() for i in range(4)]
    expected = _rows(_rebuilt(snaps))
    orders = list(itertools.permutations(range(4)))
    for order in random.Random(7).sample(orders, 4) + [(3, 2, 1, 0)]:
        assert _rows(_merged(snaps, order)) == expected, order


def test_replay_null_keys_and_empty(spark):
    first = _snapshot(spark, [("p", "A", 1), (None, "A", 9), ("p", None, 9)])
    second = _snapshot(spark, [("p", "A", 2)])
    v = _merged([first, second], [0, 1])
    assert [(r.v, r.is_current) for r in v.orderBy("valid_from").collect()] == [(1, False), (2, True)]
    for i, snap in enumerate((first, second)):                       # an instant already seen changes nothing
        assert _rows(changes.scd2_late_merge(v, snap, KEY, STAMPS[i], "again", ["v"])) == _rows(v)
    clash = _snapshot(spark, [("p", "A", 7)])
    assert _rows(changes.scd2_late_merge(v, clash, KEY, STAMPS[0], "clash", ["v"])) == _rows(v)
    assert _rows(changes.scd2_late_merge(v, first.limit(0), KEY, STAMPS[2], "empty", ["v"])) == _rows(v)
