"""Change detection and revision history (D1–D9, D15), set-based.

The versions table (one row per observed version of a key) carries
``row_hash, valid_from, valid_to, is_current`` with half-open ``[valid_from,
valid_to)`` intervals and one batch timestamp per load. Every step is a join on the
natural key; windows are partitioned by key, and a key holds at most one row per
publication, so no partition grows with the data.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from edpanel.functions import columns as C

NEW, REVISED, UNCHANGED = "NEW", "REVISED", "UNCHANGED"
VERSION_COLS = ("row_hash", "source_version", "valid_from", "valid_to", "is_current")


def ts_literal(ts: str) -> Column:
    """A batch timestamp as TIMESTAMP_NTZ (zone-free, like the catalog's UTC instants)."""
    return F.lit(ts).cast("timestamp_ntz")


def with_row_hash(df: DataFrame, hash_cols: Sequence[str]) -> DataFrame:
    """Row hash over the business columns in registry order (keys included, C20)."""
    return df.withColumn("row_hash", C.row_hash(*hash_cols))


def _non_null_keys(df: DataFrame, key_cols: Sequence[str]) -> DataFrame:
    cond = F.lit(True)
    for k in key_cols:
        cond = cond & F.col(k).isNotNull()
    return df.where(cond)


# ----------------------------------------------------------------- D1 / B7
def file_skip(incoming: DataFrame, catalog: DataFrame, keys: Sequence[str] = ("source_name", "sha256")) -> DataFrame:
    """Level 1: mark incoming files whose (source, sha256) is already catalogued."""
    seen = catalog.select(*keys).distinct().withColumn("_seen", F.lit(True))
    j = incoming.join(seen, list(keys), "left")
    return j.withColumn("action", F.when(F.col("_seen"), "skip").otherwise("ingest")).drop("_seen")


def catalog_insert_ignore(catalog: DataFrame, incoming: DataFrame,
                          keys: Sequence[str] = ("source_name", "sha256")) -> DataFrame:
    """Append only files whose key is not catalogued yet (INSERT … ON CONFLICT DO NOTHING).
    Within one batch the first row per key (by file name) wins: a ``min_by`` aggregate,
    combined map-side, so a key repeated many times never lands in one task whole."""
    rest = [c for c in catalog.columns if c not in keys]
    fresh = (incoming.join(catalog.select(*keys), list(keys), "left_anti")
             .groupBy(*keys).agg(F.min_by(F.struct(*rest), F.col("original_filename")).alias("_r"))
             .select(*keys, "_r.*"))
    return catalog.unionByName(fresh.select(*catalog.columns))


# ----------------------------------------------------------------- D3–D9
def row_diff(incoming: DataFrame, versions: DataFrame, key_cols: Sequence[str]) -> DataFrame:
    """Level 2: each incoming row (NULL keys skipped) as NEW / REVISED / UNCHANGED against
    the current version of its key. Keys absent from the incoming batch are untouched."""
    cur = versions.where(F.col("is_current")).select(*key_cols, F.col("row_hash").alias("_cur_hash"))
    inc = _non_null_keys(incoming, key_cols)
    j = inc.join(cur, list(key_cols), "left")
    status = (F.when(F.col("_cur_hash").isNull(), NEW)
              .when(F.col("_cur_hash") == F.col("row_hash"), UNCHANGED).otherwise(REVISED))
    return j.withColumn("change_status", status).drop("_cur_hash")


def scd2_merge(versions: DataFrame, incoming: DataFrame, key_cols: Sequence[str], batch_ts: str,
               source_version: str, carry_cols: Sequence[str] = (), source_order: str = "row_hash") -> DataFrame:
    """Level 3: expire REVISED current rows at ``batch_ts``, insert NEW and REVISED rows.

    One full outer join of the current versions with the incoming rows, each pair giving
    its next versions; history passes by (a table partitioned by ``is_current`` reads it
    apart). Of incoming rows that share a key the last by ``source_order`` wins, so a key
    has one current version. Returns the complete next versions table, which the caller
    writes as a new table version (no in-place MERGE on Parquet)."""
    ts, fields, cols = ts_literal(batch_ts), [*carry_cols, "row_hash"], [*carry_cols, *VERSION_COLS]
    cur = versions.where(F.col("is_current")).select(*key_cols, *[F.col(c).alias(f"_cur_{c}") for c in cols], F.lit(True).alias("_held"))
    later = F.lead(F.lit(1)).over(Window.partitionBy(*key_cols).orderBy(source_order))
    inc = _non_null_keys(incoming, key_cols).where(F.col(source_order).isNotNull()).withColumn("_later", later).where(F.col("_later").isNull())
    inc = inc.select(*key_cols, *[F.col(c).alias(f"_inc_{c}") for c in fields], F.lit(True).alias("_came"))
    held, came = F.col("_held").isNotNull(), F.col("_came").isNotNull()
    changed = came & (~held | (F.col("_cur_row_hash") != F.col("_inc_row_hash")))
    # A pair gives its current row (False), expired where it changed, and the new row (True): flat columns, no structs of rows.
    gives = (F.when(changed & held, F.array(F.lit(False), F.lit(True))).when(changed, F.array(F.lit(True))).when(held, F.array(F.lit(False))))
    pairs = cur.join(inc, list(key_cols), "full").withColumn("_changed", changed).select("*", F.explode(gives).alias("_new"))
    new, expired = F.col("_new"), F.coalesce("_changed", F.lit(False))
    fresh = {**{c: F.col(f"_inc_{c}") for c in fields}, "source_version": F.lit(source_version), "valid_from": ts,
             "valid_to": F.lit(None).cast("timestamp_ntz"), "is_current": F.lit(True)}
    old = {**{c: F.col(f"_cur_{c}") for c in cols}, "valid_to": F.when(expired, ts).otherwise(F.col("_cur_valid_to")),
           "is_current": F.when(expired, F.lit(False)).otherwise(F.col("_cur_is_current"))}
    merged = pairs.select(*key_cols, *[F.when(new, fresh[c]).otherwise(old[c]).alias(c) for c in cols])
    return versions.where(~F.col("is_current")).select(*key_cols, *cols).unionByName(merged)


def empty_versions(incoming: DataFrame, key_cols: Sequence[str], carry_cols: Sequence[str] = ()) -> DataFrame:
    """A versions table with no rows and the right schema."""
    return (incoming.select(*key_cols, *carry_cols, "row_hash").where(F.lit(False))
            .withColumn("source_version", F.lit(None).cast("string"))
            .withColumn("valid_from", F.lit(None).cast("timestamp_ntz"))
            .withColumn("valid_to", F.lit(None).cast("timestamp_ntz"))
            .withColumn("is_current", F.lit(None).cast("boolean")))


def changed_periods(diff: DataFrame, period_col: str = "period_date") -> DataFrame:
    """The periods with at least one NEW or REVISED row (drives partition overwrite)."""
    return diff.where(F.col("change_status") != UNCHANGED).select(period_col).distinct()


def scd2_current(versions: DataFrame) -> DataFrame:
    """D6."""
    return versions.where(F.col("is_current"))


def scd2_as_of(versions: DataFrame, as_of: str) -> DataFrame:
    """The version in force at ``as_of``: valid_from <= T < valid_to (open end = current)."""
    t = ts_literal(as_of)
    return versions.where((F.col("valid_from") <= t) & (F.col("valid_to").isNull() | (F.col("valid_to") > t)))


def revision_audit(versions: DataFrame, key_cols: Sequence[str], value_cols: Sequence[str]) -> DataFrame:
    """Each revision of a key with the value before and after it. The successor of a
    version is the one whose valid_from equals its valid_to (equi-join on key + instant)."""
    old = versions.where(F.col("valid_to").isNotNull()).select(
        *key_cols, F.col("valid_to").alias("revised_at"), F.col("source_version").alias("old_version"),
        *[F.col(c).alias(f"old_{c}") for c in value_cols])
    new = versions.select(*key_cols, F.col("valid_from").alias("revised_at"),
                          F.col("source_version").alias("new_version"),
                          *[F.col(c).alias(f"new_{c}") for c in value_cols])
    j = old.join(new, [*key_cols, "revised_at"])
    return j.select(*key_cols, "revised_at", "old_version", "new_version",
                    *[x for c in value_cols for x in (f"old_{c}", f"new_{c}")],
                    *[(F.col(f"new_{c}") - F.col(f"old_{c}")).alias(f"delta_{c}") for c in value_cols])


def scd2_rebuild(snapshots: DataFrame, key_cols: Sequence[str], carry_cols: Sequence[str] = ()) -> DataFrame:
    """Full history from ordered snapshots ``(key, carry, row_hash, source_version,
    snapshot_ts)``: keep a row when its hash differs from the key's previous snapshot row,
    close it at the next kept row. Absent keys stay current (same as the merge)."""
    w = Window.partitionBy(*key_cols).orderBy("snapshot_ts")
    s = _non_null_keys(snapshots, key_cols).withColumn("_prev", F.lag("row_hash").over(w))
    kept = s.where(F.col("_prev").isNull() | (F.col("_prev") != F.col("row_hash")))
    nxt = F.lead("snapshot_ts").over(w)
    out = kept.select(*key_cols, *carry_cols, "row_hash", "source_version",
                      F.col("snapshot_ts").alias("valid_from"), nxt.alias("valid_to"))
    return out.withColumn("is_current", F.col("valid_to").isNull())


SEEN = "array<struct<ts:timestamp_ntz,source_version:string>>"


def empty_sighted_versions(incoming: DataFrame, key_cols: Sequence[str], carry_cols: Sequence[str] = ()) -> DataFrame:
    """An empty versions table for :func:`scd2_late_merge`: with the sightings of each version."""
    return empty_versions(incoming, key_cols, carry_cols).withColumn("seen", F.lit(None).cast(SEEN))


def scd2_late_merge(versions: DataFrame, snapshot: DataFrame, key_cols: Sequence[str], snapshot_ts: str,
                    source_version: str, carry_cols: Sequence[str] = (), source_order: str = "row_hash") -> DataFrame:
    """A publication of any date merged into the history (D9, E2): what :func:`scd2_rebuild` gives
    for all snapshots, whatever the order of their arrival.

    A version keeps its sightings (``seen``: the snapshots that carried it, one each), since a
    snapshot that changes nothing still matters once a differing one is dated before it. At the
    instant of the snapshot a key's version is confirmed (same hash), split around the new one (sighted again
    later), cut short (not sighted later; a next version of the new hash starts earlier instead), or preceded.
    Versions closed by then pass by; of the others only a key's first two can change, and a key has at most one
    version a publication. Rows with NULL keys are skipped, of rows that share a key the last by
    ``source_order`` counts, and an instant that a key has seen keeps what was seen first."""
    ts, fields = ts_literal(snapshot_ts), [*carry_cols, "row_hash"]
    cols = [*carry_cols, *VERSION_COLS, "seen"]
    closed = F.col("valid_to").isNotNull() & (F.col("valid_to") <= ts)
    sight = F.struct(ts.alias("ts"), F.lit(source_version).alias("source_version"))
    rest = versions.where(~closed).groupBy(*key_cols).agg(
        F.array_sort(F.collect_list(F.struct("valid_from", F.struct(*cols).alias("v")))).alias("_vs"))
    inc = _non_null_keys(snapshot, key_cols).groupBy(*key_cols).agg(F.max_by(F.struct(*fields), source_order).alias("_inc"))
    row = F.col("_inc")
    late = F.struct(*[row[c].alias(c) for c in fields], F.lit(source_version).alias("source_version"),
                    ts.alias("valid_from"), F.lit(None).cast("timestamp_ntz").alias("valid_to"),
                    F.lit(True).alias("is_current"), F.array(sight).cast(SEEN).alias("seen"))
    j = rest.join(inc, list(key_cols), "full").select(
        *key_cols, "_inc", F.when(row.isNotNull(), late).alias("_late"),
        F.transform(F.coalesce("_vs", F.array()), lambda x: x["v"]).alias("_vs"))
    j = j.withColumns({"_a": F.get("_vs", F.lit(0)), "_b": F.get("_vs", F.lit(1))})
    a, b, new, vs, h = F.col("_a"), F.col("_b"), F.col("_late"), F.col("_vs"), row["row_hash"]

    def until(v: Column, end: Column) -> Column:
        return v.withField("valid_to", end).withField("is_current", end.isNull())

    def earlier(v: Column) -> Column:
        """A version of the late row's hash, now starting at the late snapshot."""
        return (v.withField("valid_from", ts).withField("source_version", F.lit(source_version))
                .withField("seen", F.concat(F.array(sight), v["seen"])))

    def after(n: int) -> Column:
        return F.slice(vs, n + 1, F.greatest(F.size(vs) - n, F.lit(0)))

    before, later = F.filter(a["seen"], lambda s: s["ts"] < ts), F.filter(a["seen"], lambda s: s["ts"] > ts)
    again = F.get(later, F.lit(0))
    head = until(a, ts).withField("seen", before)
    tail = (a.withField("valid_from", again["ts"]).withField("source_version", again["source_version"])
            .withField("seen", later))
    confirmed = a.withField("seen", F.concat(before, F.array(sight), later))
    surgery = (F.when(row.isNull() | F.exists(a["seen"], lambda s: s["ts"] == ts), vs)
               .when(a.isNull(), F.array(new))
               .when((a["valid_from"] > ts) & (a["row_hash"] == h), F.concat(F.array(earlier(a)), after(1)))
               .when(a["valid_from"] > ts, F.concat(F.array(until(new, a["valid_from"])), vs))
               .when(a["row_hash"] == h, F.concat(F.array(confirmed), after(1)))
               .when(F.size(later) > 0, F.concat(F.array(head, until(new, again["ts"]), tail), after(1)))
               .when(b["row_hash"] == h, F.concat(F.array(head, earlier(b)), after(2)))
               .otherwise(F.concat(F.array(head, until(new, a["valid_to"])), after(1))))
    merged = j.select(*key_cols, F.explode(surgery).alias("_v")).select(*key_cols, "_v.*")
    return versions.where(closed).select(*key_cols, *cols).unionByName(merged.select(*key_cols, *cols))



# ----------------------------------------------------------------- D15
def source_precedence(rows: DataFrame, key_cols: Sequence[str], publication_col: str,
                      priority_col: str) -> DataFrame:
    """Keep one row per key: latest publication first, then the lowest priority number
    (monthly file over history file for the same publication date)."""
    w = Window.partitionBy(*key_cols).orderBy(F.col(publication_col).desc(), F.col(priority_col).asc())
    return rows.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def url_change(resolutions: DataFrame, source_col: str, order_col: str, url_col: str,
               bucket: F.Column) -> DataFrame:
    """Flag a resolution whose URL differs from the previous one of the same source.

    ``bucket`` must be monotone in ``order_col``. Rows look back inside their (source,
    bucket); only a bucket's first row takes the last row of the bucket before it, carried
    over one row per bucket, so a source with a third of all rows fills no task alone."""
    key = [source_col, "_bucket"]
    b = resolutions.withColumn("_bucket", bucket).withColumn("_link", F.struct(F.col(url_col).alias("u")))
    last = b.groupBy(*key).agg(F.max_by("_link", order_col).alias("_last"))
    carry = last.select(*key, F.lag("_last").over(Window.partitionBy(source_col).orderBy("_bucket")).alias("_carry"))
    b = b.withColumn("_before", F.lag("_link").over(Window.partitionBy(*key).orderBy(order_col)))
    on = [F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")) for c in key]
    j = b.alias("l").join(carry.alias("r"), on, "left")
    prev = F.coalesce("_before", "_carry")["u"]
    return j.select(*[F.col(f"l.{c}") for c in resolutions.columns], prev.alias("previous_url"),
                    (prev.isNotNull() & ~prev.eqNullSafe(F.col(url_col))).alias("url_changed"))
