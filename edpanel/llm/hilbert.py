"""Sharding along a Hilbert curve, with DataFrame functions only.

Several metadata dimensions are quantised to ``bits`` bits each; a fold over the bit levels
turns a cell into its index on the curve (a state machine whose tables follow from the Gray
code). Rows are ordered by (index, salt, doc_id) and cut into runs of equal row counts, so a
shard covers a compact box of all dimensions and files can be pruned on any of them.

The global rank needs no task that sees all rows: rows are counted per (index, salt), those
counts get running sums in two levels (at most 2 ** (dimensions * bits) indexes), and rows are
numbered within their own (index, salt). The salt, of doc_id and text digest, splits a cell that many
rows share; the number of salts grows with the rows. Only rows equal in both keep one salt.

Defined results: shard sizes differ by one row at most; a null number goes to cell 0, a null
string to the cell of the empty string; a null text has size 16; repeated rows take a slot
each, in any order among equal ones; an empty table gives no row; input columns that clash
with result names are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SHARDS = 40
BITS = 4
SALTS = 256                        # at least; more where a salt would hold over ROWS_PER_SALT rows of one cell
ROWS_PER_SALT = 100_000


def _tables(dims: int) -> tuple[list[int], list[int]]:
    """Rank on the curve and next state, by state * 2 ** dims + octant. A state is the entry
    corner and direction of the sub-cube; Gray code steps give those of its parts."""
    size = 1 << dims

    def turn(v: int, k: int) -> int:  # rotate left
        return ((v << k % dims) | (v >> (dims - k % dims))) & (size - 1)

    def ones(v: int) -> int:  # trailing set bits
        return (~v & (v + 1)).bit_length() - 1

    ranks, states = [], []
    for state in range(size * dims):
        entry, way = divmod(state, dims)
        for octant in range(size):
            gray = turn(octant ^ entry, dims - (way + 1) % dims)
            rank = gray
            for k in range(1, dims):
                rank ^= gray >> k
            corner = 0 if rank == 0 else 2 * ((rank - 1) // 2) ^ (2 * ((rank - 1) // 2) >> 1)
            step = 0 if rank == 0 else ones(rank if rank % 2 else rank - 1) % dims
            ranks.append(rank)
            states.append((entry ^ turn(corner, way + 1)) * dims + (way + step + 1) % dims)
    return ranks, states


def curve_index(cells: list[Column], bits: int = BITS) -> Column:
    """Index on the Hilbert curve of a cell with coordinates of ``bits`` bits."""
    dims = len(cells)
    ranks, states = (F.array(*map(F.lit, t)) for t in _tables(dims))
    first = F.struct(F.lit(0).cast("long").alias("index"), F.lit(0).alias("state"))

    def level(acc, bit):
        octant = sum((F.call_function("shiftright", c, bit).bitwiseAND(F.lit(1)) * (1 << j) for j, c in enumerate(cells)), F.lit(0))
        at = acc["state"] * (1 << dims) + octant + 1
        return F.struct((acc["index"] * (1 << dims) + F.element_at(ranks, at)).cast("long").alias("index"),
                        F.element_at(states, at).alias("state"))

    return F.aggregate(F.sequence(F.lit(bits - 1), F.lit(0), F.lit(-1)), first, level, lambda acc: acc["index"])


def log_cell(value: Column, bits: int = BITS) -> Column:
    """Cell of a count by its order of magnitude (powers of two)."""
    size = F.coalesce(value, F.lit(0)).cast("double")
    return F.least(F.floor(F.log2(F.greatest(size, F.lit(1.0)))), F.lit((1 << bits) - 1)).cast("int")


def hash_cell(value: Column, bits: int = BITS) -> Column:
    """Cell of a category."""
    return F.pmod(F.xxhash64(F.coalesce(value.cast("string"), F.lit(""))), F.lit(1 << bits)).cast("int")


def assign(df: DataFrame, cells: list[Column], shards: int = SHARDS, bits: int = BITS, salts: int | None = None) -> DataFrame:
    """``df`` with curve (long), shard (int) and slot (long, gapless from 0 in its shard)."""
    df = df.drop("curve", "shard", "slot")
    if salts is None:
        salts = max(SALTS, -(-df.count() // ROWS_PER_SALT))
    order = [F.col(c) for c in ("doc_id", "text_crc32") if c in df.columns]
    rows = (df.withColumn("curve", curve_index(cells, bits))
            .withColumn("_salt", F.pmod(F.xxhash64(*order), F.lit(salts)).cast("int")))
    counts = rows.groupBy("curve", "_salt").agg(F.count("*").alias("n"))
    within = Window.partitionBy("curve").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    before = Window.orderBy("curve").rowsBetween(Window.unboundedPreceding, -1)
    cell = counts.groupBy("curve").agg(F.sum("n").alias("n"))  # 2 ** (dimensions * bits) rows at most
    cell = cell.select("curve", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_cell"),
                       F.sum("n").over(Window.partitionBy()).alias("_all"))
    offsets = (counts.withColumn("_run", F.coalesce(F.sum("n").over(within), F.lit(0))).join(cell, "curve")
               .select("curve", "_salt", (F.col("_cell") + F.col("_run")).alias("_before"), "_all"))
    numbered = rows.withColumn("_own", F.row_number().over(Window.partitionBy("curve", "_salt").orderBy(*order)) - 1)
    rank = F.col("_before") + F.col("_own")
    shard = F.expr(f"((_before + _own) * {shards}) div _all")
    start = F.expr(f"(shard * _all + {shards - 1}) div {shards}")
    return (numbered.join(offsets, ["curve", "_salt"]).withColumn("shard", shard.cast("int")).withColumn("slot", rank - start)
            .drop("_salt", "_own", "_before", "_all"))


def write_shards(df: DataFrame, path: str) -> None:
    """Write assigned rows as one folder per shard, in slot order over the files of a folder. Tasks hold
    ranges of (shard, slot), which is unique, so a shard may be larger than a task."""
    df.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
