"""Exact positions in a global order without sorting all rows in one task.

Rows are ordered by a value and, within ties, by the MD5 of their key. To find the
k-th row, values are counted first; the rows tied at the wanted value are counted by
the leading digits of their hash, which spreads even a very large tie evenly; only the
rows of one such cell are ranked.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from churnline.session import stored

HASH_DIGITS = 4  # 65,536 cells


def tie_break(key: str) -> Column:
    return F.md5(F.col(key).cast("string"))


def running_totals(
    points: DataFrame, value: str, sums: list[str], descending: bool = False, by: list[str] | None = None
) -> DataFrame:
    """Add ``<sum>_before`` columns: totals of all rows earlier in the order of the distinct ``value``.

    Rows are dealt to partitions by ranges of the value and written in that order, each with its
    place; then partition totals give every partition its offset, and totals within a partition
    the rest. Only one row per partition (and group) meets in one task. With ``by`` each group
    has an order of its own.
    """
    by = by or []
    order = [*by, F.col(value).desc() if descending else F.col(value).asc()]
    ranged = points.repartitionByRange(*order).sortWithinPartitions(*order)
    # The upper bits of the place are the partition's number. Written, so that both readers see one division.
    placed = stored(ranged.withColumn("place", F.monotonically_increasing_id()), "ranges")
    placed = placed.withColumn("range", F.shiftright("place", 33))
    earlier = Window.rowsBetween(Window.unboundedPreceding, -1)
    across = earlier.partitionBy(*by).orderBy("range")
    offsets = placed.groupBy(*by, "range").agg(*[F.sum(c).alias(c) for c in sums])
    offsets = offsets.select(*by, "range", *[F.coalesce(F.sum(c).over(across), F.lit(0)).alias(f"{c}_offset") for c in sums])
    within = earlier.partitionBy(*by, "range").orderBy("place")
    return placed.join(offsets, [*by, "range"]).select(
        *points.columns,
        *[(F.col(f"{c}_offset") + F.coalesce(F.sum(c).over(within), F.lit(0))).alias(f"{c}_before") for c in sums],
    )


def order_cuts(
    rows: DataFrame,
    value: str,
    key: str,
    label: str,
    positions: Callable[[Column], Column],
    descending: bool = False,
) -> DataFrame:
    """The rows at given positions of the order (value, hash of key, key).

    ``positions`` maps the row count to a short array of 1-based positions. Returns
    ``k``, the row's ``value``, ``hash`` and ``key``, and ``captured``: the label sum
    of the first k rows.
    """
    points = rows.groupBy(value).agg(F.count(F.lit(1)).alias("n"), F.sum(label).alias("pos"))
    asked = sorted(set(points.agg(positions(F.sum("n")).alias("ks")).first()["ks"] or []) - {None})
    placed = running_totals(points, value, ["n", "pos"], descending)

    def inside(k: Column) -> Column:
        return (k > F.col("n_before")) & (k <= F.col("n_before") + F.col("n"))

    # Plain comparisons find the few rows that hold a position; only those look at the array.
    holds = reduce(or_, [inside(F.lit(k)) for k in asked], F.lit(False))
    ks = F.array(*[F.lit(k) for k in asked]).cast("array<bigint>")
    wanted = placed.where(holds).select(value, "n_before", "pos_before", F.filter(ks, inside).alias("ks"))
    wanted = stored(wanted, "wanted")
    hashed = rows.select(value, F.col(key).alias("key"), tie_break(key).alias("hash"), F.col(label).alias("label"))
    # One row per wanted value, at most one per asked position: safe to broadcast, and no row is copied.
    tied = hashed.join(F.broadcast(wanted.select(value)), value).withColumn("cell", F.left("hash", F.lit(HASH_DIGITS)))

    cells = tied.groupBy(value, "cell").agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("pos"))
    by_cell = Window.partitionBy(value).orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    before = {c: F.col(f"{c}_before") + F.coalesce(F.sum(c).over(by_cell), F.lit(0)) for c in ("n", "pos")}
    cells = cells.join(F.broadcast(wanted), value)
    cells = cells.select(value, "cell", "n", "ks", *[c.alias(f"{name}_before") for name, c in before.items()])
    # The cells in which an asked position lies, each once.
    cells = cells.withColumn("ks", F.filter("ks", inside)).where(F.size("ks") > 0).drop("n")

    ranked = tied.join(F.broadcast(cells), [value, "cell"])
    by_hash = Window.partitionBy(value, "cell").orderBy("hash", "key").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        ranked.withColumn("k", F.col("n_before") + F.count(F.lit(1)).over(by_hash))
        .withColumn("captured", F.col("pos_before") + F.sum("label").over(by_hash))
        .where(F.array_contains("ks", F.col("k")))
        .select("k", value, "hash", "key", "captured")
    )


def sequence_numbers(rows: DataFrame, groups: list[str], key: str) -> DataFrame:
    """Add ``position``: 1, 2, ... within each group, in hash order of the key.

    Rows are numbered inside hash cells and shifted by the cells before, so a group may
    hold any share of the data.
    """
    hashed = rows.withColumns({"hash": tie_break(key)}).withColumn("cell", F.left("hash", F.lit(HASH_DIGITS)))
    cells = hashed.groupBy(*groups, "cell").agg(F.count(F.lit(1)).alias("n"))
    by_cell = Window.partitionBy(*groups).orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    offsets = cells.select(*groups, "cell", F.coalesce(F.sum("n").over(by_cell), F.lit(0)).alias("offset"))
    in_cell = Window.partitionBy(*groups, "cell").orderBy("hash", key)
    # At most 65,536 offsets per group, and groups are few: classes within splits.
    return (
        hashed.join(F.broadcast(offsets), [*groups, "cell"])
        .withColumn("position", F.col("offset") + F.row_number().over(in_cell))
        .select(*rows.columns, "position")
    )
