"""Dimension operators.

Windows here are partitioned by a provider code (bounded by the number of months);
seed tables (bridge, field-test list) are reference data of a few dozen rows and are
broadcast; everything else is an equi-join or a keyed aggregate.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from edpanel.functions import columns as C
from edpanel.session import materialize


def scd2_from_history(history: DataFrame, key: str, order_col: str, attr_cols: Sequence[str]) -> DataFrame:
    """Gaps-and-islands SCD2 (E2): one version per run of unchanged attributes in the
    ordered history of each key. A reverted attribute opens a new version."""
    w = Window.partitionBy(key).orderBy(order_col)
    h = history.select(key, order_col, *attr_cols, C.row_hash(*attr_cols).alias("_attr"))
    h = h.withColumn("_chg", F.when(F.lag("_attr").over(w).eqNullSafe(F.col("_attr")), 0).otherwise(1))
    h = h.withColumn("version_no", F.sum("_chg").over(w.rowsBetween(Window.unboundedPreceding, 0)).cast("int"))
    v = h.groupBy(key, "version_no").agg(F.min(order_col).alias("valid_from"),
                                         *[F.first(c).alias(c) for c in attr_cols])
    wv = Window.partitionBy(key).orderBy("version_no")
    v = v.withColumn("valid_to", F.lead("valid_from").over(wv))
    return v.select(key, "version_no", *attr_cols, "valid_from", "valid_to",
                    F.col("valid_to").isNull().alias("is_current"),
                    F.xxhash64(key, "valid_from").alias("provider_version_key"))


def with_version_in_force(rows: DataFrame, versions: DataFrame, key: str, period_col: str,
                          version_cols: Sequence[str]) -> DataFrame:
    """Each row with the version of its key in force in its period (E5): valid_from <= period
    < valid_to, an open end being current. The join is on the key, with the interval as a
    further condition, so it shuffles by key and a key meets only its own versions. Versions
    of a key do not overlap, so rows keep their number; a row without a version keeps NULLs."""
    v = versions.select(F.col(key).alias("_key"), "valid_from", "valid_to", *version_cols)
    p = F.col(period_col)
    j = rows.join(v, (F.col(key) == F.col("_key")) & (p >= F.col("valid_from"))
                  & (F.col("valid_to").isNull() | (p < F.col("valid_to"))), "left")
    return j.drop("_key", "valid_from", "valid_to")


def resolve_bridge(bridge: DataFrame) -> DataFrame:
    """Every predecessor with all its successors (E4): old_code, new_code, hop and the half-open
    interval [effective_from, effective_to) in which that successor stands for it. A successor
    takes over when the last link up to it is in force. Chains of any length are followed until
    no link is left; a cycle raises."""
    links = materialize(bridge.select("old_code", "new_code", "effective_from").distinct())
    step = links.select(F.col("old_code").alias("_via"), F.col("new_code").alias("_next"), F.col("effective_from").alias("_from"))
    found, front, hop = links.withColumn("hop", F.lit(1)), links, 1
    while not front.isEmpty():
        if not front.where("old_code = new_code").isEmpty():
            raise ValueError("the organisation bridge has a cycle")
        hop += 1
        front = materialize(front.join(step, F.col("new_code") == F.col("_via")).select(
            "old_code", F.col("_next").alias("new_code"), F.greatest("effective_from", "_from").alias("effective_from")))
        found = found.union(front.withColumn("hop", F.lit(hop)))
    order = Window.partitionBy("old_code").orderBy("effective_from", "hop")
    return materialize(found.withColumn("effective_to", F.lead("effective_from").over(order)))


def apply_bridge(rows: DataFrame, bridge: DataFrame, code_col: str, period_col: str,
                 sum_cols: Sequence[str], comparable: bool = False) -> DataFrame:
    """Re-key rows to successor codes and re-aggregate (E4): to the code in force in the row's
    period, or as a ``comparable`` series all periods to the last successor."""
    br = resolve_bridge(bridge)
    if comparable:
        br = br.groupBy("old_code").agg(F.max_by("new_code", "hop").alias("new_code"))
        hit = F.col(code_col) == br.old_code
    else:
        hit = ((F.col(code_col) == br.old_code) & (F.col(period_col) >= br.effective_from)
               & (br.effective_to.isNull() | (F.col(period_col) < br.effective_to)))
    j = rows.join(br, hit, "left")
    succ = F.coalesce(F.col("new_code"), F.col(code_col))
    return (j.groupBy(succ.alias(code_col), F.col(period_col))
            .agg(*[F.sum(c).cast("bigint").alias(c) for c in sum_cols],
                 F.countDistinct(code_col).alias("n_source_codes")))


def flag_field_test(rows: DataFrame, crs: DataFrame, code_col: str, period_col: str) -> DataFrame:
    """Field-test flag (E8): a broadcast range join on (code, from <= period <= to)."""
    c = F.broadcast(crs.select(F.col("org_code").alias("_crs_code"), "from_period", "to_period"))
    j = rows.join(c, (F.col(code_col) == F.col("_crs_code"))
                  & F.col(period_col).between(F.col("from_period"), F.col("to_period")), "left")
    return j.withColumn("is_field_test", F.col("_crs_code").isNotNull()).drop("_crs_code", "from_period", "to_period")


def submission_status(measure_cols: Sequence[str]) -> tuple[F.Column, F.Column]:
    """(number of NULL measures, 'complete' / 'partial' / 'none') for one row."""
    n_null = sum((F.col(c).isNull().cast("int") for c in measure_cols), F.lit(0))
    status = (F.when(n_null == 0, "complete").when(n_null == len(measure_cols), "none").otherwise("partial"))
    return n_null, status


def unpivot_types(df: DataFrame, id_cols: Sequence[str], measures: dict[str, Sequence[str]],
                  types: Sequence[str] = ("1", "2", "3")) -> DataFrame:
    """Department type as a dimension (E10): ``measures`` maps an output column to its
    per-type source columns, e.g. ``{"attendances": [t1, t2, t3]}``."""
    structs = [F.struct(F.lit(t).alias("department_type"),
                        *[F.col(cols[i]).alias(name) for name, cols in measures.items()])
               for i, t in enumerate(types)]
    return df.select(*id_cols, F.explode(F.array(*structs)).alias("_u")).select(*id_cols, "_u.*")


def missing_periods(present: DataFrame, entities: DataFrame, key: str, period_col: str, span: F.Column) -> DataFrame:
    """(key, month) pairs with no row (E11, H9), without forming the key x month grid: one
    aggregate per key gathers its months (bounded by the calendar), and what they leave of ``span``, the
    array of all months, is exploded. Keys with no row at all get the whole span, and the
    output has one row per missing pair."""
    rows = present.select(key, F.col(period_col).cast("date").alias("_month"))
    rows = rows.unionByName(entities.select(key, F.lit(None).cast("date").alias("_month")))
    months = rows.groupBy(key).agg(F.collect_set("_month").alias("_held"))
    return months.select(key, F.explode(F.array_except(span, F.col("_held"))).alias(period_col))


def all_months(rows: DataFrame, period_col: str) -> F.Column:
    """All months from the first to the last of ``rows``, as a scalar subquery."""
    months = F.sequence(F.min(period_col).cast("date"), F.max(period_col).cast("date"), F.expr("INTERVAL 1 MONTH"))
    return rows.agg(months.alias("months")).scalar()
