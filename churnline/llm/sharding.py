"""Operator 1, sharding: minimax contiguous partition of ordered atomic groups.

Equal texts form one group, ordered by a 64-bit hash of the text. The largest shard is
made as small as any contiguous partition allows: a binary search over the capacity,
each value checked greedily. The check works on cells of the hash order with their byte
sums; only cells in which a cut can fall are split further, until the answer is exact,
so the driver holds a number of cells that depends on the number of shards, not of rows.

Null and empty texts have 16 bytes each and are two groups of their own. Repeated rows
are equal texts. An empty table gives no rows. With fewer groups than shards some
shards stay empty. The input's other columns pass through ``with_shards`` untouched.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from churnline.llm.common import free_name, table, written

SHARDS = 40
ROW_BYTES = 16
LEVEL_BITS = (16, 26, 36, 46, 56, 64)


def group_key(text: str = "text") -> Column:
    return F.xxhash64(F.col(text).isNull(), F.col(text))


def row_size(text: str = "text") -> Column:
    return (F.coalesce(F.octet_length(text), F.lit(0)) + ROW_BYTES).cast("long")


def _cells(groups: DataFrame, bits: int) -> np.ndarray:
    """Rows (first key, bytes, largest group, groups) of the cells of ``bits`` leading bits."""
    cell = F.shiftright("key", 64 - bits) if bits < 64 else F.col("key")
    found = groups.groupBy(cell.alias("cell")).agg(F.sum("bytes"), F.max("bytes"), F.count("*")).collect()
    rows = np.array([tuple(r) for r in found], dtype=np.int64).reshape(-1, 4)
    rows[:, 0] <<= 64 - bits
    return rows[np.argsort(rows[:, 0])]


def _greedy(ends: np.ndarray, capacity: int, shards: int) -> np.ndarray | None:
    """Numbers of cells before each cut when every shard takes all it can; None if that fails."""
    cuts, at, before = [], 0, 0
    for _ in range(shards):
        nxt = int(np.searchsorted(ends, before + capacity, side="right"))
        if nxt == at and at < len(ends):
            return None
        cuts.append(nxt)
        at, before = nxt, int(ends[nxt - 1]) if nxt else 0
    return np.array(cuts) if at == len(ends) else None


def _capacity(sizes: np.ndarray, shards: int, low: int) -> int:
    """Smallest capacity, ``low`` at least, for which ``shards`` shards hold all cells."""
    ends = np.cumsum(sizes)
    high = max(low, int(ends[-1]))
    while low < high:
        middle = (low + high) // 2
        if _greedy(ends, middle, shards) is None:
            low = middle + 1
        else:
            high = middle
    return high


def _cut_zone(cells: np.ndarray, shards: int, low: int, high: int, largest: int) -> np.ndarray:
    """Cells of several groups in which a greedy cut falls for some capacity from ``low`` to ``high``."""
    ends = np.cumsum(cells[:, 1])
    starts = ends - cells[:, 1]
    zone = np.zeros(len(cells), dtype=bool)
    first = last = 0
    for _ in range(shards):
        holds = min(int(np.searchsorted(ends, first + low, side="right")), len(cells) - 1)
        first = max(int(starts[holds]) if ends[-1] > first + low else int(ends[-1]), first + low - largest, first)
        last = min(last + high, int(ends[-1]))
        zone |= (ends > first) & (starts < last)
    return zone & (cells[:, 3] > 1)


def plan_cuts(groups: DataFrame, shards: int) -> tuple[list[int], int]:
    """First keys of shards 1, 2, ... and the smallest possible size of the largest shard.

    ``groups`` has (key long, bytes long), one row per group. Cuts keep every shard within
    that size and otherwise come as near to even sizes as they can.
    """
    cells = _cells(groups, LEVEL_BITS[0])
    if not len(cells):
        return [], 0
    total, largest = int(cells[:, 1].sum()), int(cells[:, 2].max())
    low = max(-(-total // shards), largest)
    for bits, finer in zip(LEVEL_BITS, LEVEL_BITS[1:]):
        high = _capacity(cells[:, 1], shards, low)
        zone = _cut_zone(cells, shards, low, high, largest)
        if low == high or not zone.any():
            break
        wanted = groups.sparkSession.createDataFrame([(int(k),) for k in cells[zone, 0]], "first long")
        cell = F.shiftleft(F.shiftright("key", 64 - bits), 64 - bits)
        # As many rows as cells in the zone, which the number of shards bounds.
        inside = groups.join(F.broadcast(wanted), cell == F.col("first"), "left_semi")
        cells = np.concatenate([cells[~zone], _cells(inside, finer)])
        cells = cells[np.argsort(cells[:, 0])]
    return _even_cuts(cells, shards, _capacity(cells[:, 1], shards, low))


def _even_cuts(cells: np.ndarray, shards: int, capacity: int) -> tuple[list[int], int]:
    ends = np.cumsum(cells[:, 1])
    total = int(ends[-1])
    # Earliest cuts that leave no more than the remaining shards can hold.
    least, position = [], total
    for _ in range(shards - 1):
        at = int(np.searchsorted(ends, position - capacity, side="left"))
        position = 0 if position <= capacity else int(ends[at])
        least.append(position)
    cuts, before = [], 0
    for left, earliest in zip(range(shards, 1, -1), reversed(least)):
        target = before + (total - before) / left
        at = int(np.searchsorted(ends, target))
        options = [0, *(int(e) for e in ends[max(0, at - 1) : at + 1])]
        near = min(options, key=lambda e: abs(e - target))
        reach = int(np.searchsorted(ends, before + capacity, side="right"))
        before = min(max(near, earliest, before), int(ends[reach - 1]) if reach else 0)
        cuts.append(before)
    starts = ends - cells[:, 1]
    at = np.searchsorted(starts, cuts)
    return [int(cells[i, 0]) if i < len(cells) else None for i in at], capacity


def with_shards(docs: DataFrame, shards: int = SHARDS, text: str = "text", column: str = "shard") -> DataFrame:
    """``docs`` with the shard of each row; ``column`` is lengthened if ``docs`` has a column of that name."""
    column = free_name(docs, column)
    key = group_key(text)
    groups = written(docs.select(key.alias("key"), row_size(text).alias("bytes")).groupBy("key").agg(F.sum("bytes").alias("bytes")), "groups")
    cuts, _ = plan_cuts(groups, shards)
    passed = [F.when(key >= F.lit(c), 1).otherwise(0) for c in cuts if c is not None]
    number = F.lit(0)
    for one in passed:
        number = number + one
    return docs.withColumn(column, number.cast("int"))


def with_slots(sharded: DataFrame, shard: str = "shard", slot: str = "slot") -> DataFrame:
    """Rows numbered from 0 in each shard, by file and place in the file; ``slot`` is lengthened if it is taken.

    The rows are written as they lie, sorted by shard in each task; counts per file and
    shard then give every row its number without a sort of a whole shard.
    """
    file, place, slot = (free_name(sharded, name) for name in ("file", "place", slot))
    stored = written(sharded.sortWithinPartitions(shard), "shards")
    rows = stored.select("*", F.col("_metadata.file_path").alias(file), F.col("_metadata.row_index").alias(place))
    runs = rows.groupBy(F.col(file), F.col(shard)).agg(F.count("*").alias("n"), F.min(place).alias("first"))
    before = F.sum("n").over(Window.partitionBy(shard).orderBy(file).rowsBetween(Window.unboundedPreceding, -1))
    shift = free_name(sharded, "shift")
    runs = runs.select(file, shard, (F.coalesce(before, F.lit(0)) - F.col("first")).alias(shift))
    numbered = rows.join(runs, [file, shard])
    return numbered.select(*[c for c in sharded.columns], (F.col(place) + F.col(shift)).alias(slot))


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS) -> None:
    """Whole rows, texts included, in one folder per shard."""
    with_shards(docs, shards).write.partitionBy(free_name(docs, "shard")).parquet(path)


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    sharded = with_shards(docs).select(
        "doc_id",
        row_size().alias("size"),
        F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"),
        F.lit("bytes").alias("law"),
        "shard",
    )
    return with_slots(sharded).withColumn("grown_shard", F.lit(None).cast("int"))
