"""Data-quality and reconciliation queries.

Every check is a keyed aggregate, an anti-join or a per-provider window; the report
unions one row per check. :func:`gate` is the only driver-side step: it collects that
report (one row per check) and raises when a fail-tier check failed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from edpanel.functions import columns as C
from edpanel.operators import kpi
from edpanel.plans import analogue, layers
from edpanel.sources.tables import read_table

RECONCILE_TOLERANCE = 10            # |ours - published| <= 10 passes (fixed value)
VOLUME_DROP_RATIO = 0.9             # provider count below 90 % of the trailing mean warns
LOW_VALUE_RATIO = 10                # value < mean / 10 is implausibly low
NOT_NULL_COLUMNS = ("l_orderkey", "l_partkey", "l_suppkey", "l_quantity", "l_shipdate")


def dq_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem", *NOT_NULL_COLUMNS)
    g = li.agg(F.count(F.lit(1)).alias("row_count"),
               *[F.count_if(F.col(c).isNull()).alias(c) for c in NOT_NULL_COLUMNS])
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("null_count")) for c in NOT_NULL_COLUMNS])
    return g.select(F.lit("lineitem").alias("table_name"), F.explode(pairs).alias("p"), "row_count").select(
        "table_name", "p.column_name", "p.null_count", "row_count")


def dq_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber")
    return (li.groupBy("l_orderkey", "l_linenumber").agg(F.count(F.lit(1)).alias("n_rows"))
            .where(F.col("n_rows") > 1))


RELATIONSHIPS = (  # (name, child table, child column, parent table, parent column)
    ("lineitem.l_suppkey -> supplier", "lineitem", "l_suppkey", "supplier", "s_suppkey"),
    ("lineitem.l_partkey -> part", "lineitem", "l_partkey", "part", "p_partkey"),
    ("lineitem.l_orderkey -> orders", "lineitem", "l_orderkey", "orders", "o_orderkey"),
    ("orders.o_custkey -> customer", "orders", "o_custkey", "customer", "c_custkey"),
)


def dq_relationship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Child rows without a parent, per relationship. Each child table is read once: its
    foreign keys are unpivoted and counted per key before the shuffle, so a hot key
    arrives as one row per task, and the anti-join runs on (relationship, key)."""
    children = parents = None
    for table in dict.fromkeys(r[1] for r in RELATIONSHIPS):
        rels = [r for r in RELATIONSHIPS if r[1] == table]
        child = read_table(spark, sf_dir, table, *[r[2] for r in rels])
        pairs = F.array(*[F.struct(F.lit(r[0]).alias("relationship"), F.col(r[2]).cast("bigint").alias("key"))
                          for r in rels])
        c = (child.select(F.explode(pairs).alias("p")).groupBy("p.relationship", "p.key")
             .agg(F.count(F.lit(1)).alias("n_rows")))
        children = c if children is None else children.unionByName(c)
    for name, _, _, table, column in RELATIONSHIPS:
        k = read_table(spark, sf_dir, table, column).select(F.lit(name).alias("relationship"),
                                                            F.col(column).cast("bigint").alias("key"))
        parents = k if parents is None else parents.unionByName(k)
    orphans = children.join(parents, ["relationship", "key"], "left_anti")
    found = orphans.groupBy("relationship").agg(F.sum("n_rows").alias("orphan_rows"))
    names = spark.createDataFrame([(r[0],) for r in RELATIONSHIPS], "relationship string")
    return names.join(found, "relationship", "left").select(
        "relationship", F.coalesce("orphan_rows", F.lit(0)).cast("bigint").alias("orphan_rows"))


ACCEPTED_VALUES = (  # (table, column, accepted values); NULL is the business of the not-null check
    ("lineitem", "l_returnflag", ("A", "N", "R")),
    ("lineitem", "l_linestatus", ("F", "O")),
    ("orders", "o_orderstatus", ("F", "O")),
)


def dq_accepted_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H1: rows per value outside a column's accepted set; one pass per table, counted per value
    before the shuffle."""
    out = None
    for table in dict.fromkeys(r[0] for r in ACCEPTED_VALUES):
        rules = [r for r in ACCEPTED_VALUES if r[0] == table]
        bad = F.array(*[F.struct(F.lit(c).alias("column_name"), F.when(~F.col(c).isin(*ok), F.col(c)).alias("value"))
                        for _, c, ok in rules])
        rows = (read_table(spark, sf_dir, table, *[r[1] for r in rules]).select(F.explode(bad).alias("p")).select("p.*")
                .where(F.col("value").isNotNull()).groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n_rows"))
                .select(F.lit(table).alias("table_name"), "column_name", "value", "n_rows"))
        out = rows if out is None else out.unionByName(rows)
    return out


def shape_mismatches(df: DataFrame, expected: T.StructType) -> list[str]:
    """How the layout of ``df`` differs from ``expected`` (names, order, types); the schema
    is compared, no data is read."""
    have, want = [(f.name, f.dataType) for f in df.schema], [(f.name, f.dataType) for f in expected]
    out = [f"missing {n}" for n, _ in want if n not in dict(have)] + [f"unexpected {n}" for n, _ in have if n not in dict(want)]
    out += [f"{n} is {t.simpleString()}, not {dict(want)[n].simpleString()}" for n, t in have if n in dict(want) and t != dict(want)[n]]
    return out if out or have == want else ["column order"]


def _national(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact = layers.fact(spark, sf_dir)
    return fact.groupBy("period_date").agg(F.sum("attendances_total").cast("bigint").alias("our_value"))


def _status(variance: F.Column) -> F.Column:
    return F.when(F.abs(variance) <= RECONCILE_TOLERANCE, "PASS").otherwise("FAIL")


def reconcile_national(spark: SparkSession, sf_dir: str) -> DataFrame:
    pub = analogue.published_totals(spark, sf_dir)
    j = _national(spark, sf_dir).join(pub, "period_date", "full")
    v = F.col("our_value") - F.col("published_value")
    return j.select("period_date", "metric_name", "our_value", "published_value", v.alias("variance"),
                    _status(v).alias("status"))


def reconcile_internal(spark: SparkSession, sf_dir: str) -> DataFrame:
    star = layers.star(spark, sf_dir)
    f = star.fact.join(star.dim_provider, "provider_key")
    type_sum = F.col("attendances_type1") + F.col("attendances_type2") + F.col("attendances_type3")
    adm_sum = (F.col("emergency_admissions_type1") + F.col("emergency_admissions_type2")
               + F.col("emergency_admissions_type3"))
    return f.select("trust_code", "period_date", F.col("attendances_total").alias("reported_total"),
                    type_sum.alias("type_sum"), (type_sum == F.col("attendances_total")).alias("attendances_consistent"),
                    (adm_sum == F.col("emergency_admissions_via_ae")).alias("admissions_consistent"))


def official_quarterly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Official quarterly series (A7 analogue): quarterly quantity straight from lineitem
    plus 3 x the quarter number, so some quarters fail the tolerance."""
    lines = analogue.activity_lines(spark, sf_dir)
    g = lines.groupBy(C.financial_year("period_date").alias("financial_year"),
                      C.financial_quarter("period_date").alias("financial_quarter")).agg(
        F.sum("q").cast("bigint").alias("q"))
    return g.select("financial_year", "financial_quarter",
                    (F.col("q") + F.lit(3) * F.substring("financial_quarter", 2, 1).cast("int")).cast("bigint")
                    .alias("published_value"))


def reconcile_quarterly(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact = layers.fact(spark, sf_dir)
    ours = fact.groupBy(C.financial_year("period_date").alias("financial_year"),
                        C.financial_quarter("period_date").alias("financial_quarter")).agg(
        F.sum("attendances_total").cast("bigint").alias("our_value"))
    j = ours.join(official_quarterly(spark, sf_dir), ["financial_year", "financial_quarter"], "full")
    v = F.col("our_value") - F.col("published_value")
    return j.select("financial_year", "financial_quarter", "our_value", "published_value", v.alias("variance"),
                    _status(v).alias("status"))


def range_rules() -> dict[str, F.Column]:
    """Rule name -> condition that breaks it, for one fact row with its performance (H6)."""
    neg = F.lit(False)
    for c in analogue.MEASURES:
        neg = neg | (F.col(c) < 0)
    type_sum = F.col("attendances_type1") + F.col("attendances_type2") + F.col("attendances_type3")
    return {
        "performance_outside_0_100": (F.col("performance_pct") < 0) | (F.col("performance_pct") > 100),
        "negative_count": neg,
        "breaches_exceed_attendances": F.col("breaches_total") > F.col("attendances_total"),
        "type_sum_exceeds_total": type_sum > F.col("attendances_total"),
        "dta_12hr_exceeds_4hr": F.col("dta_breaches_12hr") > F.col("dta_breaches_4hr"),
    }


def dq_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = kpi.with_performance(layers.fact(spark, sf_dir))
    rules = range_rules()
    g = f.agg(*[F.count_if(cond).alias(name) for name, cond in rules.items()])
    pairs = F.array(*[F.struct(F.lit(n).alias("rule"), F.col(n).alias("violations")) for n in rules])
    return g.select(F.explode(pairs).alias("r")).select("r.rule", "r.violations")


def dq_volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Providers reporting per month against the trailing 12-month mean. The window runs
    over the per-month aggregate (one row per month)."""
    fact = layers.fact(spark, sf_dir)
    per = fact.groupBy("period_date").agg(F.count(F.lit(1)).alias("n_providers"))
    w = Window.orderBy("period_date").rowsBetween(-12, -1)
    per = per.withColumn("_s", F.sum("n_providers").over(w)).withColumn("_n", F.count("n_providers").over(w))
    mean = F.col("_s") / F.col("_n")
    return per.select("period_date", "n_providers", F.when(F.col("_n") > 0, mean).alias("trailing_mean"),
                      F.coalesce(F.col("n_providers") < F.lit(VOLUME_DROP_RATIO) * mean, F.lit(False)).alias("volume_drop"))


def _expected_period(as_of: F.Column) -> F.Column:
    prev = F.add_months(F.trunc(as_of, "month"), -1)
    return F.when(C.expected_release_date(prev) <= as_of, prev).otherwise(F.add_months(prev, -1))


def dq_freshness(spark: SparkSession, sf_dir: str, as_of: str | None = None) -> DataFrame:
    """Newest loaded month against the newest month already released at ``as_of``."""
    as_of_d = F.lit(as_of or analogue.PARAMS.as_of_date).cast("date")
    fact = layers.fact(spark, sf_dir)
    newest = fact.agg(F.max("period_date").alias("newest_period"))
    behind = F.months_between(F.col("expected_period"), F.col("newest_period")).cast("int")
    return newest.select("newest_period", _expected_period(as_of_d).alias("expected_period")).select(
        "newest_period", "expected_period", behind.alias("months_behind"),
        F.when(behind <= 0, "fresh").otherwise("stale").alias("status"))


def dq_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    star = layers.star(spark, sf_dir)
    f = star.fact.join(star.dim_provider, "provider_key")
    return (f.groupBy("period_date", "trust_code").agg(F.count(F.lit(1)).alias("n_rows"))
            .where(F.col("n_rows") > 1))


def dq_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Missing months inside each provider's own series (consecutive-month gaps)."""
    star = layers.star(spark, sf_dir)
    f = star.fact.join(star.dim_provider, "provider_key").select("trust_code", "period_date")
    w = Window.partitionBy("trust_code").orderBy("period_date")
    g = f.withColumn("_next", F.lead("period_date").over(w)).where(
        F.col("_next") > F.add_months(F.col("period_date"), 1))
    return g.select("trust_code", F.add_months("period_date", 1).alias("gap_start"),
                    F.add_months("_next", -1).alias("gap_end"),
                    (F.months_between("_next", "period_date").cast("int") - 1).alias("missing_months"))


def dq_low(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Attendances below a tenth of the provider's trailing 12-month mean."""
    star = layers.star(spark, sf_dir)
    f = star.fact.join(star.dim_provider, "provider_key")
    w = Window.partitionBy("provider_key").orderBy("period_date").rowsBetween(-12, -1)
    f = f.withColumn("_s", F.sum("attendances_total").over(w)).withColumn("_n", F.count("attendances_total").over(w))
    low = F.lit(LOW_VALUE_RATIO) * F.col("attendances_total") * F.col("_n") < F.col("_s")
    return f.where((F.col("_n") > 0) & low).select(
        "trust_code", "period_date", "attendances_total", (F.col("_s") / F.col("_n")).alias("trailing_mean"))


# (check, tier): fail stops the pipeline, warn is reported.
CHECK_TIERS = (("not_null", "fail"), ("unique", "warn"), ("relationship", "fail"), ("reconcile_national", "warn"),
               ("range", "fail"), ("duplicates", "fail"), ("gaps", "warn"), ("low_values", "warn"),
               ("freshness", "warn"), ("accepted_values", "fail"), ("reconcile_internal", "fail"),
               ("reconcile_quarterly", "warn"), ("volume", "warn"))


def _fact_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row with the failures of every check on the fact, from one pass: per-provider
    windows, then one aggregate per month, then the published months joined in."""
    star = layers.star(spark, sf_dir)
    f = kpi.with_performance(star.fact).join(star.dim_provider.select("provider_key", "trust_code"),
                                             "provider_key", "left")
    known = F.col("trust_code").isNotNull()
    w = Window.partitionBy("provider_key").orderBy("period_date")
    p, trailing = F.col("period_date"), w.rowsBetween(-12, -1)
    f = (f.withColumn("_next", F.lead("period_date").over(w)).withColumn("_prev", F.lag("period_date").over(w))
         .withColumn("_prev2", F.lag("period_date", 2).over(w))
         .withColumn("_s", F.sum("attendances_total").over(trailing))
         .withColumn("_n", F.count("attendances_total").over(trailing)))
    second = p.eqNullSafe(F.col("_prev")) & p.isNotNull() & ~p.eqNullSafe(F.col("_prev2"))
    low = F.lit(LOW_VALUE_RATIO) * F.col("attendances_total") * F.col("_n") < F.col("_s")
    broken = sum((F.coalesce(c, F.lit(False)).cast("bigint") for c in range_rules().values()), F.lit(0))
    per_month = f.groupBy("period_date").agg(
        F.sum("attendances_total").cast("bigint").alias("our_value"), F.sum(broken).alias("range"),
        F.count_if(known & second).alias("duplicates"),
        F.count_if(known & (F.col("_next") > F.add_months(p, 1))).alias("gaps"),
        F.count_if(known & (F.col("_n") > 0) & low).alias("low_values"))
    j = per_month.withColumn("newest", p).join(analogue.published_totals(spark, sf_dir), "period_date", "full")
    expected = _expected_period(F.lit(analogue.PARAMS.as_of_date).cast("date"))
    behind = F.months_between(F.first(expected), F.max("newest")).cast("int")
    failed = _status(F.col("our_value") - F.col("published_value")) == "FAIL"
    return j.agg(F.count_if(failed).alias("reconcile_national"),
                 *[F.sum(c).alias(c) for c in ("range", "duplicates", "gaps", "low_values")],
                 F.greatest(behind, F.lit(0)).alias("freshness"))


def _line_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Not-null and uniqueness of the lines in one pass, grouped by the line key."""
    key, rest = ["l_orderkey", "l_linenumber"], [c for c in NOT_NULL_COLUMNS if c != "l_orderkey"]
    li = read_table(spark, sf_dir, "lineitem", *key, *rest)
    nulls = sum((F.col(c).isNull().cast("bigint") for c in NOT_NULL_COLUMNS), F.lit(0))
    g = li.groupBy(*key).agg(F.count(F.lit(1)).alias("n_rows"), F.sum(nulls).alias("n_null"))
    return g.agg(F.sum("n_null").alias("not_null"), F.count_if(F.col("n_rows") > 1).alias("unique"))


def dq_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per check with its failures and status (H11). The lines are read for their own
    checks, their foreign keys, accepted values and the two published series; the rest is the fact table."""
    tiers = dict(CHECK_TIERS)
    out = None
    for df in (_line_checks(spark, sf_dir),
               dq_relationship(spark, sf_dir).agg(F.sum("orphan_rows").alias("relationship")),
               dq_accepted_values(spark, sf_dir).agg(F.sum("n_rows").alias("accepted_values")),
               reconcile_internal(spark, sf_dir).agg(F.count_if(~(F.col("attendances_consistent") & F.col("admissions_consistent"))).alias("reconcile_internal")),
               reconcile_quarterly(spark, sf_dir).agg(F.count_if(F.col("status") == "FAIL").alias("reconcile_quarterly")),
               dq_volume(spark, sf_dir).agg(F.count_if("volume_drop").alias("volume")),
               _fact_checks(spark, sf_dir)):
        rows = F.array(*[F.struct(F.lit(c).alias("check_name"), F.lit(tiers[c]).alias("tier"),
                                  F.coalesce(F.col(c).cast("bigint"), F.lit(0).cast("bigint")).alias("failures"))
                         for c in df.columns])
        part = df.select(F.explode(rows).alias("r")).select("r.*")
        out = part if out is None else out.unionByName(part)
    return out.withColumn("status", F.when(F.col("failures") == 0, "pass").otherwise(F.col("tier")))


class QualityGateError(RuntimeError):
    pass


def gate(report: DataFrame) -> DataFrame:
    """Stop before any write when a fail-tier check failed (H11). The report holds one
    row per check, so collecting it is bounded."""
    rows = report.collect()
    failed = [r.check_name for r in rows if r.status == "fail"]
    if failed:
        raise QualityGateError(f"quality gate failed: {', '.join(failed)}")
    return report
