"""Merkle manifest of a dataset: one tree per group over its ordered leaves, one tree over the
groups' roots, and for every row the siblings that prove it.

A level is folded with windows. Nodes stay at the row of their first leaf: at level l the rows
whose slot is a multiple of 2 ** l hold a node, ``lag`` and ``lead`` of the fixed offset 2 ** l
give a node's sibling (masked by its place in the pair and by the length of the level), and the
first child's row hashes the parent. A window covers one block of 2 ** BLOCK_BITS leaves of a
group, so all levels of a block take one shuffle and one sort and no task sees a whole group;
the blocks' nodes are the leaves of the next round. On the way down each block's path is joined
to its rows by (group, block).

An odd node at the end of a level is hashed alone; a level of one node is the root. Leaves are
numbered by a range partitioning with counts per partition.

Defined results: a null value is written ``-``, so it differs from an empty string; rows with a
null key come first in their group; a null group is a group of its own and comes first; equal
rows are equal leaves and take a place each; an empty table gives no row; extra columns do not
enter a hash and columns that clash with result names are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from edpanel.llm.common import tuned, written

BLOCK_BITS = 10
LEFT, RIGHT = "L", "R"
RESULTS = ("leaf", "subroot", "root", "path")


def record_hash(values: list[Column]) -> Column:
    """Hex digest of a record: each value as byte count, colon, text; ``-`` for null."""
    texts = [v.cast("string") for v in values]
    return F.sha2(F.concat(*(F.when(t.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t))
                             for t in texts)), 256)


def numbered(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` with ``slot`` (gapless from 0 within ``g``, by ``order``) and ``n`` (rows of the group).

    Rows are dealt by range; each part's runs of a group are counted and added up per group.
    The scan position is the last key, so rows that are equal in all columns still split."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = ["g", *order, "_at"]
    placed = written(rows.withColumn("_at", F.monotonically_increasing_id()).repartitionByRange(parts, *keys).sortWithinPartitions(*keys)
                     .withColumn("_part", F.spark_partition_id()).withColumn("_k", F.monotonically_increasing_id()).drop("_at"), "placed")
    per_group = Window.partitionBy("g")
    runs = placed.groupBy("g", "_part").agg(F.min("_k").alias("_first"), F.count("*").alias("_rows")).select(
        "g", "_part", "_first", F.sum("_rows").over(per_group).alias("n"),
        F.coalesce(F.sum("_rows").over(per_group.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    return (placed.join(runs, ["g", "_part"]).withColumn("slot", F.col("_k") - F.col("_first") + F.col("_before"))
            .drop("_part", "_k", "_first", "_before"))


def fold_blocks(nodes: DataFrame, bits: int = BLOCK_BITS) -> DataFrame:
    """``nodes`` (g, slot, n, node) with ``block``, ``path`` (a row's siblings inside its block,
    lowest first: side and digest, empty where a node is alone) and, at each block's first row,
    ``up``: the block's node."""
    block = Window.partitionBy("g", "block").orderBy("slot")
    df = nodes.withColumn("block", F.expr(f"shiftright(slot, {bits})")).withColumn("_n", F.col("node"))
    for level in range(bits):
        step = 1 << level
        df = df.withColumns({"_b": F.lag("_n", step).over(block), "_f": F.lead("_n", step).over(block)})
        many = F.expr(f"shiftright(n + {step - 1}, {level}) > 1")
        second = F.expr(f"shiftright(slot, {level}) % 2 = 1")
        sibling = F.when(second, F.concat(F.lit(LEFT), "_b")).otherwise(F.coalesce(F.concat(F.lit(RIGHT), "_f"), F.lit("")))
        parent = F.when(many, F.sha2(F.concat("_n", F.coalesce("_f", F.lit(""))), 256)).otherwise(F.col("_n"))
        df = df.withColumns({f"_s{level}": F.when(F.expr(f"slot % {step} = 0") & many, sibling),
                             "_n": F.when(F.expr(f"slot % {2 * step} = 0"), parent)}).drop("_b", "_f")
    so_far = block.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    df = df.withColumns({f"_s{level}": F.last(f"_s{level}", ignorenulls=True).over(so_far) for level in range(bits)})
    return (df.withColumn("path", F.array_compact(F.array(*(f"_s{level}" for level in range(bits)))))
            .withColumnRenamed("_n", "up").drop(*(f"_s{level}" for level in range(bits))))


def climb(nodes: DataFrame, bits: int = BLOCK_BITS) -> list[DataFrame]:
    """The folded rounds from the leaves up; in the last each group is one block."""
    rounds = [written(fold_blocks(nodes, bits), "merkle")]
    largest = rounds[0].agg(F.max("n")).first()[0] or 0
    while largest > 1 << bits:
        above = rounds[-1].where("up is not null").select(
            "g", F.col("block").alias("slot"), F.expr(f"shiftright(n + {(1 << bits) - 1}, {bits})").alias("n"), F.col("up").alias("node"))
        rounds.append(written(fold_blocks(above, bits), "merkle"))
        largest = -(-largest >> bits)
    return rounds


def group_roots(rounds: list[DataFrame]) -> DataFrame:
    """(g, subroot): one row per group."""
    return rounds[-1].where("slot = 0").select("g", F.col("up").alias("subroot"))


def descend(rounds: list[DataFrame], crown: DataFrame) -> DataFrame:
    """The leaf rows with all columns of ``crown`` (one row per g, with ``above``: the path over
    the group's root) and ``path`` up to the root."""
    last = crown.withColumn("block", F.lit(0).cast("long"))
    carried = [c for c in crown.columns if c not in ("g", "above")]
    for k in range(len(rounds) - 1, -1, -1):
        rows = rounds[k].join(last, ["g", "block"]).withColumn("path", F.concat("path", "above")).drop("above")
        if not k:
            return rows.drop("block", "up")
        last = rows.select("g", F.col("slot").alias("block"), F.col("path").alias("above"), *carried)
    raise ValueError("no rounds")


def manifest(df: DataFrame, leaf: Column, key: str, group: str, bits: int = BLOCK_BITS) -> DataFrame:
    """``df`` with leaf, subroot, root and path (siblings from the leaf to the root). Leaves
    ascend by ``key`` within ``group``; groups ascend bytewise. Keep ``df`` narrow: its columns
    travel with the leaves."""
    tuned(df.sparkSession)
    df = df.withColumn("leaf", leaf).drop(*(c for c in ("subroot", "root", "path") if c in df.columns))
    name = F.col(group).cast("string")
    rows = df.select(F.struct(*df.columns).alias("row"), F.col(key).alias("_key"), F.col("leaf").alias("node"),
                     F.when(name.isNull(), F.lit("")).otherwise(F.concat(F.lit("="), name)).alias("g"))
    leaves = climb(numbered(written(rows, "leaves"), ["_key", "node"]), bits)
    subroots = group_roots(leaves).select(F.lit("").alias("g"), F.col("g").alias("name"), F.col("subroot").alias("node"))
    groups = climb(numbered(subroots, ["name"]), bits)
    top = group_roots(groups).select("g", F.col("subroot").alias("root"), F.array().cast("array<string>").alias("above"))
    crown = descend(groups, top).select(F.col("name").alias("g"), F.col("node").alias("subroot"), "root", F.col("path").alias("above"))
    return descend(leaves, crown).select("row.*", "subroot", "root", "path")


def proof_hash(path: Column) -> Column:
    """Digest of the siblings' digests in a row."""
    return F.sha2(F.array_join(F.transform(path, lambda p: F.substr(p, F.lit(2))), ""), 256)


def folded(leaf: Column, path: Column) -> Column:
    """The root that ``leaf`` and its siblings give."""
    def step(node, p):
        other = F.substr(p, F.lit(2))
        return F.sha2(F.when(F.startswith(p, F.lit(LEFT)), F.concat(other, node)).otherwise(F.concat(node, other)), 256)

    return F.aggregate(path, leaf, step)
