"""The boosted trees of ``GBTClassifier``, grown from histograms of packed rows.

The trees are Spark's: the same candidate thresholds, the same rows drawn for each tree and
columns for each node (Spark's generators, by partition and place of a row), the same gains,
limits and leaves. Only the passes over the rows differ. Each row is packed once: the bins of
its columns become a few numbers, so that a pass counts all columns by a few array operations
on blocks of rows. Packed blocks are dealt evenly to the cores and cached by Spark.

A pass is one small job per level of a tree. What a block needs beside its rows (margin,
residual and draw of each row) lies in a file of the executor that caches it. The file is a memory only:
where it is missing, it is made again from the trees so far. Only sums per bin reach the driver;
their number depends on columns, bins and nodes.

Columns that part the rows of a node alike have the same gain. Spark takes the one that
rounding favours, which may change from run to run; here it is the first that was drawn. What
is drawn later depends on such choices, so where there are ties the trees after them differ.
"""

from __future__ import annotations

import fcntl
import heapq
import json
import math
import os
import pickle
import shutil
import sys
import tempfile
import time
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel, TaskContext, cloudpickle
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnline.operators import ensembles
from churnline.session import fresh_path

# Executors need not have this package installed: its functions travel with the tasks.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BLOCK = 1 << 16  # rows packed together
LANE_STEPS = 32  # states per lane: 16 rows, as a row takes two
EPSILON = 2.0**-52  # Spark calls smaller impurities pure
TIE = 1e-13  # gains closer than this share of the node's mean square are ties
STATS = 3  # sums per bin and label: rows, residuals, their squares

# ---- Spark's random numbers ----------------------------------------------------------


def _murmur(data: bytes, seed: int) -> int:
    """Scala's MurmurHash3 of whole words."""
    mask, h = 0xFFFFFFFF, seed
    for i in range(0, len(data), 4):
        k = int.from_bytes(data[i : i + 4], "little") * 0xCC9E2D51 & mask
        k = (k << 15 | k >> 17) & mask
        h ^= k * 0x1B873593 & mask
        h = (h << 13 | h >> 19) & mask
        h = h * 5 + 0xE6546B64 & mask
    h ^= len(data)
    h = (h ^ h >> 16) * 0x85EBCA6B & mask
    h = (h ^ h >> 13) * 0xC2B2AE35 & mask
    return h ^ h >> 16


def first_state(seed: int) -> int:
    """The state of Spark's XORShiftRandom after seeding."""
    data = (seed & (1 << 64) - 1).to_bytes(8, "big")
    low = _murmur(data, 0x3C074A61)
    return _murmur(data, low) << 32 | low


def next_state(state: int) -> int:
    state ^= state << 21 & (1 << 64) - 1
    state ^= state >> 35
    return state ^ (state << 4 & (1 << 64) - 1)


def java_longs(seed: int) -> Iterator[int]:
    """``nextLong`` of java.util.Random."""
    state = (seed ^ 0x5DEECE66D) & (1 << 48) - 1

    def word() -> int:
        nonlocal state
        state = state * 0x5DEECE66D + 0xB & (1 << 48) - 1
        return (state >> 16) - (state >> 47 << 32)

    while True:
        high = word() << 32
        yield (high + word() + (1 << 63)) % (1 << 64) - (1 << 63)


def drawn_columns(width: int, wanted: int, seed: int) -> list[int]:
    """``wanted`` of ``width`` columns, as Spark's reservoir has them."""
    state, taken = first_state(seed), list(range(wanted))
    for column in range(wanted, width):
        state = next_state(state)
        high = state & (1 << 26) - 1
        state = next_state(state)
        place = int(((high << 27) + (state & (1 << 27) - 1)) * 2.0**-53 * (column + 1))
        if place < wanted:
            taken[place] = column
    return taken


def _advanced(states: np.ndarray, table: np.ndarray) -> np.ndarray:
    """States moved on by the number of steps that the table (8 bytes x 256 values) stands for."""
    parts = states.view(np.uint8).reshape(-1, 8)  # least byte first
    if sys.byteorder == "big":
        parts = parts[:, ::-1]
    out = table[0].take(parts[:, 0])
    for i in range(1, 8):
        out ^= table[i].take(parts[:, i])
    return out


def jump_tables(count: int) -> np.ndarray:
    """Tables for LANE_STEPS x 2^k steps, k under ``count``. A step is linear, so tables can be squared."""

    def table(columns: np.ndarray) -> np.ndarray:
        found = np.zeros((8, 256), dtype=np.uint64)
        for i in range(8):
            for bit in range(8):
                on = np.arange(256) >> bit & 1 == 1
                found[i][on] ^= columns[8 * i + bit]
        return found

    columns = np.array([next_state(1 << bit) for bit in range(64)], dtype=np.uint64)
    tables = []
    for k in range(LANE_STEPS.bit_length() - 1 + count):
        step = table(columns)
        if k >= LANE_STEPS.bit_length() - 1:
            tables.append(step)
        columns = _advanced(columns, step)
    return np.array(tables)


def drawn_rows(seed: int, block: int, n: int, rate: float, tables: np.ndarray) -> np.ndarray:
    """Which of the ``n`` rows of a partition's block Spark draws, with its generator seeded so."""
    lanes_a_block = (2 * BLOCK // LANE_STEPS).bit_length() - 1
    lanes = np.array([first_state(seed)], dtype=np.uint64)
    for bit in range(block.bit_length()):
        if block >> bit & 1:
            lanes = _advanced(lanes, tables[lanes_a_block + bit])
    doublings = 0
    while 2 * n > LANE_STEPS * len(lanes):
        lanes = np.concatenate([lanes, _advanced(lanes, tables[doublings])])
        doublings += 1
    limit = np.uint64(math.ceil(rate * 2.0**53))
    shift = {bits: np.uint64(bits) for bits in (4, 21, 27, 35)}
    high_bits, low_bits = np.uint64((1 << 26) - 1), np.uint64((1 << 27) - 1)
    moved, high = np.empty_like(lanes), np.empty_like(lanes)
    out = np.empty((LANE_STEPS // 2, len(lanes)), dtype=bool)
    for step in range(LANE_STEPS):
        lanes ^= np.left_shift(lanes, shift[21], out=moved)
        lanes ^= np.right_shift(lanes, shift[35], out=moved)
        lanes ^= np.left_shift(lanes, shift[4], out=moved)
        if step % 2:
            high += np.bitwise_and(lanes, low_bits, out=moved)
            np.less(high, limit, out=out[step // 2])
        else:
            np.bitwise_and(lanes, high_bits, out=high)
            high <<= shift[27]
    return out.T.ravel()[:n]


# ---- candidate thresholds ------------------------------------------------------------


def _thresholds(values: np.ndarray, weights: np.ndarray, expected: float, most: int) -> np.ndarray:
    """Thresholds of one column from sampled values, after Spark: at most ``most``, evenly filled bins.

    ``expected`` is the weight of the sample; what the values that are not zero leave of it is zero's.
    """
    there = values != 0.0
    distinct, place = np.unique(values[there], return_inverse=True)
    if not len(distinct):
        return np.array([])
    counts = np.bincount(place, weights=weights[there])
    rest = expected - math.fsum(weights[there])
    if rest > EPSILON * there.sum() * 100:
        at = int(np.searchsorted(distinct, 0.0))
        distinct, counts = np.insert(distinct, at, 0.0), np.insert(counts, at, rest)
    middles = (distinct[:-1] + distinct[1:]) / 2.0
    if len(middles) <= most:
        return middles
    stride = target = expected / (most + 1)
    found, reached = [], counts[0]
    for middle, count in zip(middles, counts[1:]):
        before, reached = reached, reached + count
        if abs(before - target) < abs(reached - target):
            found.append(middle)
            target += stride
    return np.array(found)


def candidate_thresholds(rows: DataFrame, n: int, pos: int, positive: float, bins: int, seed: int) -> list[np.ndarray]:
    """Thresholds by column, from Spark's sample of about max(10,000, bins^2) rows."""
    wanted = max(bins * bins, 10000)
    share = min(1.0, wanted / n)
    drawn = rows.select("x", "label")
    if share < 1.0:
        number = next_state(first_state(seed)) & 0xFFFFFFFF
        spark = rows.sparkSession
        some = drawn._jdf.toJavaRDD().sample(False, share, number - (number >> 31 << 32))
        drawn = DataFrame(spark._jsparkSession.createDataFrame(some, drawn._jdf.schema()), spark)
    table = drawn.toArrow()
    values = _matrix(table.column("x").combine_chunks(), len(table)) if len(table) else np.zeros((0, 0))
    weights = np.where(table.column("label").to_numpy() > 0, positive, 1.0)
    expected = share * (n - pos + pos * positive)
    return [_thresholds(values[:, c], weights, expected, bins - 1) for c in range(values.shape[1])]


# ---- packed rows ---------------------------------------------------------------------

# Columns packed into one number: (column, bins) each, the first one's bins the fastest to change.
Group = list[tuple[int, int]]


def packed_groups(sizes: dict[int, int], cells: int) -> list[Group]:
    """Columns (by number of bins) dealt to groups of at most ``cells`` combinations, first fit."""
    groups: list[tuple[int, Group]] = []
    for column, size in sorted(sizes.items(), key=lambda s: (-s[1], s[0])):
        for i, (used, group) in enumerate(groups):
            if used * size <= cells:
                groups[i] = (used * size, [*group, (column, size)])
                break
        else:
            groups.append((size, [(column, size)]))
    return [group for _, group in groups]


def _matrix(lists: pa.ListArray, n: int) -> np.ndarray:
    """Rows x columns of a list column; a missing value is an error, as it is to VectorAssembler."""
    values = lists.flatten().to_numpy(zero_copy_only=False).reshape(n, -1).astype(float, copy=False)
    if np.isnan(values).any():
        raise ValueError("null or NaN among the features")
    return values


def packed_codes(x: np.ndarray, groups: list[Group], thresholds: list[np.ndarray]) -> np.ndarray:
    """Groups x rows: the bins of each group's columns as one number."""
    codes = np.zeros((len(groups), len(x)), dtype=np.uint16)
    for code, group in zip(codes, groups):
        stride = 1
        for column, size in group:
            cuts, values = thresholds[column], x[:, column]
            bins = values > cuts[0] if size == 2 else np.searchsorted(cuts, values)
            code += (bins * stride).astype(np.uint16)
            stride *= size
    return codes


def marginals(cells: np.ndarray, group: Group) -> list[np.ndarray]:
    """Sums by bin of each column of a group, from sums by combination (the last axis)."""
    if len(group) == 1:
        return [cells]
    half = len(group) // 2
    low = math.prod(size for _, size in group[:half])
    both = cells.reshape(*cells.shape[:-1], -1, low)
    return marginals(both.sum(axis=-2), group[:half]) + marginals(both.sum(axis=-1), group[half:])


# ---- passes over the packed rows -----------------------------------------------------

# Nodes of a tree as rows walk it, root first: (group, modulus, least, left, right, value). A row goes right
# if its group's number, by modulus, is ``least`` or more. The group is -1 in a leaf.


def walked(codes: np.ndarray, nodes: np.ndarray, levels: int, said: np.ndarray) -> np.ndarray:
    """What ``said`` (small numbers by place) has for the node that each row is in after ``levels`` steps.

    Every node asks all rows: a few operations on short numbers, cheaper than looking up each row's node.
    """
    kind = said.dtype.type

    def reached(at: int, left: int) -> np.ndarray:
        group, modulus, least, *below = nodes[at, :5].astype(int).tolist()
        if not left or group < 0:
            return said[at]
        number = codes[group] // np.uint16(modulus)
        number *= np.uint16(modulus)
        np.subtract(codes[group], number, out=number)
        first, second = (reached(child, left - 1) for child in below)
        goes = (number >= np.uint16(least)).astype(kind)
        np.negative(goes, out=goes)
        goes &= first ^ second
        goes ^= first
        return goes

    found = reached(0, levels)
    return found if found.ndim else np.full(codes.shape[1], found)


def _local_folder(fit: str) -> str:
    # The executor's own folders, which Spark deletes with it.
    top = os.environ.get("SPARK_LOCAL_DIRS", "").split(",")[0] or tempfile.gettempdir()
    return f"{top}/boosting-{fit}"


def _forget(blocks: Iterator[tuple], fit: str) -> None:
    for _ in blocks:  # a task that leaves rows unread costs Spark its worker
        pass
    shutil.rmtree(_local_folder(fit), ignore_errors=True)


class Passes:
    """What every pass knows: how rows are packed and drawn, and how far the trees have grown."""

    def __init__(self, fit: str, groups: list[Group], levels: int, rate: float, seed: int, step: float, tables: np.ndarray):
        self.fit, self.groups, self.levels, self.rate = fit, groups, levels, rate
        self.seed, self.step, self.tables = seed, step, tables
        self.width = max(math.prod(size for _, size in g) for g in groups)

    def state(self, key: tuple[int, int], codes: np.ndarray, label: np.ndarray, trees: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """(residual, drawn) of a block's rows after the given trees."""
        n, number, folder = codes.shape[1], len(trees), _local_folder(self.fit)
        os.makedirs(folder, exist_ok=True)
        # Trees so far (-1 while it is written), margins, residuals, draws. Written over in place: new files cost more.
        with open(os.open(f"{folder}/{key[0]}-{key[1]}", os.O_RDWR | os.O_CREAT), "r+b", buffering=0) as file:
            fcntl.flock(file, fcntl.LOCK_EX)  # two attempts of one task
            kept = np.fromfile(file, np.uint8)
            known = int(kept[:8].view(np.int64)[0]) if len(kept) == 8 + 17 * n else -1
            if not 0 <= known <= number:
                known, kept = -1, np.zeros(8 + 17 * n, dtype=np.uint8)
            margin, residual, drawn = kept[8 : 8 + 8 * n].view(float), kept[8 + 8 * n : 8 + 16 * n].view(float), kept[8 + 16 * n :]
            if known == number:
                return residual, drawn
            for i in range(max(0, known), number):
                value = trees[i][:, 5] * (self.step if i else 1.0)
                kind = np.uint8 if len(value) <= 256 else np.uint16
                place = walked(codes, trees[i], self.levels, np.arange(len(value), dtype=kind))
                margin += value.take(place, mode="clip")
            sign = label * 2.0 - 1.0
            residual[:] = sign
            if number:
                np.multiply(2.0 * sign, margin, out=residual)
                np.exp(residual, out=residual)
                residual += 1.0
                np.divide(4.0 * sign, residual, out=residual)
            if self.rate < 1.0:
                drawn = drawn_rows(self.seed + number + key[0] + 1, key[1], n, self.rate, self.tables).view(np.uint8)
            else:
                drawn = np.ones(n, dtype=np.uint8)
            for at, part in ((0, np.array([-1])), (8, margin), (8 + 8 * n, residual), (8 + 16 * n, drawn), (0, np.array([number]))):
                os.pwrite(file.fileno(), np.ascontiguousarray(part).data, at)
            return residual, drawn

    def sums(self, blocks: Iterator[tuple], trees: list[np.ndarray], nodes: np.ndarray, level: int, slots: list[int], opened: int) -> np.ndarray:
        """Sums (STATS x open nodes x labels x bins, by column) of a partition's drawn rows.

        ``nodes`` is the tree as grown so far; ``slots`` numbers its open nodes by place and is
        ``opened``, their count, at all others.
        """
        np.empty(30 << 20, dtype=np.uint8)  # freed at once: now the C library keeps freed memory of this size for the arrays below
        count, cells = len(self.groups), 2 * (opened + 1) * self.width
        kind = np.uint8 if opened < 127 else np.uint16
        slot_of, total = np.array(slots, dtype=kind), np.zeros((count, STATS, cells))
        for key, (n, body) in blocks:
            codes = np.frombuffer(body, np.uint16, n * count).reshape(count, n)
            label = np.frombuffer(body, np.uint8, offset=codes.nbytes)
            residual, drawn = self.state(key, codes, label, trees)
            slot = walked(codes, nodes, level, slot_of)
            slot ^= (slot ^ kind(opened)) & (drawn.astype(kind) - kind(1))
            slot += slot
            slot += label
            start = slot.astype(np.intp)
            start *= self.width
            square, at = residual * residual, np.empty(n, dtype=np.intp)
            for code, into in zip(codes, total):
                np.add(start, code, out=at)
                into[0] += np.bincount(at, minlength=cells)
                into[1] += np.bincount(at, residual, cells)
                into[2] += np.bincount(at, square, cells)
        found = {}
        for group, sums in zip(self.groups, total):
            used = sums.reshape(STATS, opened + 1, 2, self.width)[:, :opened, :, : math.prod(size for _, size in group)]
            by_column = marginals(used, group)
            found |= dict(zip([column for column, _ in group], by_column))
        return np.concatenate([found[c] for c in sorted(found)], axis=-1)


def packed_rows(rows: DataFrame, groups: list[Group], thresholds: list[np.ndarray]) -> RDD:
    """((partition, block), (rows, codes and labels as bytes)), dealt evenly to the cores and cached."""

    def block(part: int, number: int, codes: np.ndarray, labels: np.ndarray) -> pa.RecordBatch:
        body = codes.tobytes() + labels.astype(np.uint8).tobytes()
        arrays = [pa.array([part]), pa.array([number]), pa.array([len(labels)]), pa.array([body], pa.binary())]
        return pa.RecordBatch.from_arrays(arrays, names=["part", "block", "n", "body"])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, held, waiting = TaskContext.get().partitionId(), 0, 0, []
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column("x"), batch.num_rows)
            waiting.append((packed_codes(x, groups, thresholds), batch.column("label").to_numpy() > 0))
            held += batch.num_rows
            while held >= BLOCK:
                codes, labels = np.concatenate([c for c, _ in waiting], axis=1), np.concatenate([v for _, v in waiting])
                yield block(part, number, codes[:, :BLOCK], labels[:BLOCK])
                number, held, waiting = number + 1, held - BLOCK, [(codes[:, BLOCK:], labels[BLOCK:])]
        if held:
            yield block(part, number, np.concatenate([c for c, _ in waiting], axis=1), np.concatenate([v for _, v in waiting]))

    blocks = rows.select("x", "label").mapInArrow(pack, "part long, block long, n long, body binary").rdd
    keyed = blocks.map(lambda r: ((r[0], r[1]), (r[2], bytes(r[3])))).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        # One entry per block.
        sizes = keyed.map(lambda b: (b[0], b[1][0])).collect()
        loads = [(0, p) for p in range(min(rows.sparkSession.sparkContext.defaultParallelism, len(sizes)))]
        place = {}
        for key, n in sorted(sizes, key=lambda s: (-s[1], s[0])):
            load, p = heapq.heappop(loads)
            place[key] = p
            heapq.heappush(loads, (load + n, p))
        dealt = keyed.partitionBy(len(loads), lambda key: place[key]).persist(StorageLevel.MEMORY_AND_DISK)
        dealt.count()
    finally:
        keyed.unpersist()
    return dealt


# ---- growing -------------------------------------------------------------------------


def _impurity(stats: np.ndarray) -> float:
    weight, total, squares, _ = stats
    return float((squares - total * total / weight) / weight) if weight else 0.0


def best_split(sums: np.ndarray, bins: np.ndarray, drawn: list[int], scale: float, least: tuple[float, float, float]) -> tuple | None:
    """(gain, column, last bin to the left, sums of both children), None if no split is allowed.

    ``sums`` is (weight, residuals, squares, rows) x bins, ``bins`` their places by column, padded
    with an empty bin; ``drawn`` are rows of ``bins``, ``scale`` is the node's mean square and ``least`` the
    rows, weight and gain asked for. Gains that rounding alone can make are 0.
    """
    if not drawn:
        return None
    padded = np.concatenate([sums, np.zeros((len(sums), 1))], axis=1)
    left = np.cumsum(padded[:, bins[drawn]], axis=2)
    right = left[:, :, -1:] - left
    rows, weight, gain_asked = least
    allowed = np.roll(bins[drawn] < sums.shape[1], -1, axis=1)  # a column's last bin has none after it
    allowed[:, -1] = False
    allowed &= (left[3] >= rows) & (right[3] >= rows) & (left[0] >= weight) & (right[0] >= weight)
    with np.errstate(divide="ignore", invalid="ignore"):
        both = left[0] + right[0]
        gap = left[1] / left[0] - right[1] / right[0]
        gain = np.nan_to_num(left[0] * right[0] / (both * both) * gap * gap)
    gain = np.where(allowed & (gain >= gain_asked), gain, -np.inf)
    best = gain.max()
    if best == -np.inf:
        return None
    first = int(np.argmax(gain.ravel() >= best - TIE * scale))
    column, cut = divmod(first, gain.shape[1])
    return float(gain[column, cut]) if best > 4 * EPSILON * scale else 0.0, drawn[column], cut, left[:, column, cut], right[:, column, cut]


def _leaf(stats: np.ndarray | None) -> dict:
    return {"stats": stats, "impurity": None if stats is None else _impurity(stats), "gain": -1.0, "split": None, "left": -1, "right": -1}


def _prediction(node: dict) -> float:
    weight, total = node["stats"][:2]
    return float(total / weight) if weight else 0.0


def _columns_per_node(strategy: str, width: int) -> int:
    named = {"auto": width, "all": width, "sqrt": math.ceil(math.sqrt(width)), "onethird": math.ceil(width / 3)}
    named["log2"] = max(1, math.ceil(math.log2(width)))
    if (wanted := named.get(strategy.lower())) is not None:
        return wanted
    try:
        return min(int(strategy), width)
    except ValueError:
        return math.ceil(float(strategy) * width)


def fit(rows: DataFrame, width: int, classifier: GBTClassifier) -> GBTClassificationModel:
    """What ``classifier`` fits to ``rows`` (x array<double> of ``width``, label 0 or 1), positives weighted up."""
    of_label = [F.count_if(F.col("label") == value) for value in (1, 0)]
    n, pos, neg = rows.agg(F.count(F.lit(1)), *of_label).first()
    if not n or pos + neg < n:
        raise ValueError("no rows to fit" if not n else "labels other than 0 and 1")
    positive = (n - pos) / max(1, pos)
    seed, depth = classifier.getSeed(), classifier.getMaxDepth()
    wanted = _columns_per_node(classifier.getFeatureSubsetStrategy(), width)
    thresholds = candidate_thresholds(rows, n, pos, positive, min(classifier.getMaxBins(), n), seed)
    thresholds += [np.array([])] * (width - len(thresholds))
    sizes = {c: len(t) + 1 for c, t in enumerate(thresholds) if len(t)} or {0: 1}
    # Combinations times nodes of the widest level stay within a core's cache.
    groups = packed_groups(sizes, min(4096, (1 << 14) >> max(0, depth - 1)))
    home = {c: (g, math.prod(s for _, s in group[:i])) for g, group in enumerate(groups) for i, (c, _) in enumerate(group)}
    used = sorted(sizes)
    starts = np.cumsum([0, *[sizes[c] for c in used]])
    bins = np.array([[starts[i] + b if b < sizes[c] else starts[-1] for b in range(max(sizes.values()))] for i, c in enumerate(used)])
    least = (classifier.getMinInstancesPerNode(), classifier.getMinWeightFractionPerNode() * (n - pos + pos * positive), classifier.getMinInfoGain())
    dealt = packed_rows(rows, groups, thresholds)
    name = uuid.uuid4().hex
    blocks_bits = max(1, n // BLOCK).bit_length()
    tables = jump_tables((2 * BLOCK // LANE_STEPS).bit_length() - 1 + blocks_bits)
    passes = Passes(name, groups, depth, classifier.getSubsamplingRate(), seed, classifier.getStepSize(), tables)
    # Pickled once, not for every pass.
    shared = rows.sparkSession.sparkContext.broadcast(cloudpickle.dumps(passes))

    def walkable(tree: list[dict]) -> np.ndarray:
        rows_of = []
        for node in tree:
            test = (-1, 1, 0)
            if node["split"] is not None:
                column, cut = node["split"]
                group, stride = home[column]
                test = (group, stride * sizes[column], stride * (cut + 1))
            rows_of.append((*test, node["left"], node["right"], _prediction(node) if node["stats"] is not None else 0.0))
        return np.array(rows_of, dtype=float)

    def level_sums(trees: list[np.ndarray], tree: list[dict], level: int, opened: list[int]) -> np.ndarray:
        """(weight, residuals, squares, rows) x open nodes x bins."""
        nodes, count = walkable(tree), len(opened)
        slots = [count] * len(tree)
        for slot, at in enumerate(opened):
            slots[at] = slot
        work = lambda blocks: [pickle.loads(shared.value).sums(blocks, trees, nodes, level, slots, count)]
        total = sum(dealt.mapPartitions(work).collect())
        weighted = total[:, :, 0] + positive * total[:, :, 1]
        return np.stack([*weighted, total[0].sum(axis=1)])

    def grow(number: int, trees: list[np.ndarray]) -> list[dict]:
        draws = java_longs(seed + number)
        tree, opened, level = [_leaf(None)], [0], 0
        while opened:
            drawn = [drawn_columns(width, wanted, next(draws)) if wanted < width else range(width) for _ in opened]
            found = level_sums(trees, tree, level, opened)
            later = []
            for slot, at in enumerate(opened):
                node, sums = tree[at], found[:, slot]
                if node["stats"] is None:
                    node |= _leaf(sums[:, : starts[1]].sum(axis=1))
                allowed = [used.index(c) for c in drawn[slot] if c in sizes]
                weight, _, squares, _ = node["stats"]
                best = best_split(sums, bins, allowed, squares / weight if weight else 0.0, least)
                if best is None:
                    node["impurity_saved"] = -1.0
                elif best[0] > 0:
                    node |= {"gain": best[0], "split": (used[best[1]], best[2]), "left": len(tree), "right": len(tree) + 1}
                    for child in (_leaf(best[3]), _leaf(best[4])):
                        tree.append(child)
                        if level + 1 < depth and abs(child["impurity"]) >= EPSILON:
                            later.insert(0, len(tree) - 1)
            opened, level = later, level + 1
        return tree

    try:
        trees: list[np.ndarray] = []
        grown = []
        for number in range(classifier.getMaxIter()):
            grown.append(grow(number, trees))
            trees.append(walkable(grown[-1]))
    finally:
        dealt.foreachPartition(lambda blocks: _forget(blocks, name))
        dealt.unpersist()
        shared.unpersist()
    return saved_model(rows.sparkSession, classifier, width, [_saved_nodes(tree, thresholds) for tree in grown])


# ---- the model -----------------------------------------------------------------------

_TREE_DEFAULTS = (
    "cacheNodeIds", "checkpointInterval", "featuresCol", "impurity", "labelCol", "leafCol", "maxBins", "maxDepth",
    "maxMemoryInMB", "minInfoGain", "minInstancesPerNode", "minWeightFractionPerNode", "predictionCol", "seed",
)
_NODE = (
    "treeID int, nodeData struct<id: int, prediction: double, impurity: double, impurityStats: array<double>, rawCount: bigint, "
    "gain: double, leftChild: int, rightChild: int, split: struct<featureIndex: int, leftCategoriesOrThreshold: array<double>, numCategories: int>>"
)


def _saved_nodes(tree: list[dict], thresholds: list[np.ndarray]) -> list[tuple]:
    """Nodes as Spark saves them, numbered from the root; leaves that say the same become one."""

    def pruned(at: int) -> dict:
        node = tree[at]
        if node["split"] is None:
            return node
        left, right = pruned(node["left"]), pruned(node["right"])
        if left["split"] is None and right["split"] is None and _prediction(left) == _prediction(right):
            return {**node, "split": None, "gain": -1.0, "left": -1, "right": -1}
        return {**node, "left": left, "right": right}

    out: list[tuple] = []

    def number(node: dict) -> int:
        at = len(out)
        out.append(())
        below, split = (-1, -1), (-1, [], -1)
        if node["split"] is not None:
            column, cut = node["split"]
            below = (number(node["left"]), number(node["right"]))
            split = (column, [float(thresholds[column][cut])], -1)
        stats = [float(v) for v in node["stats"][:3]]
        impurity = node.get("impurity_saved", node["impurity"])
        out[at] = (at, _prediction(node), impurity, stats, int(node["stats"][3]), node["gain"], *below, split)
        return at

    number(pruned(0))
    return out


def saved_model(spark: SparkSession, classifier: GBTClassifier, width: int, trees: list[list[tuple]]) -> GBTClassificationModel:
    """The trees as Spark's own model, by way of its saved form."""
    path = fresh_path(spark, "boosted")
    given = {p.name: v for p, v in classifier._paramMap.items()}
    default = {p.name: v for p, v in classifier._defaultParamMap.items()}

    def described(kind: str, uid: str, params: dict, defaults: dict, **more: int) -> str:
        about = {"class": f"org.apache.spark.ml.{kind}", "timestamp": int(time.time() * 1000), "sparkVersion": spark.version}
        return json.dumps({**about, "uid": uid, "paramMap": params, "defaultParamMap": defaults, **more})

    about = described("classification.GBTClassificationModel", classifier.uid, given, default, numFeatures=width, numTrees=len(trees))
    spark.createDataFrame([(about,)], "value string").coalesce(1).write.text(f"{path}/metadata")
    own = [{n: v for n, v in params.items() if n in _TREE_DEFAULTS} for params in (given, default)]
    kinds = [
        (i, described("regression.DecisionTreeRegressionModel", f"dtr_{uuid.uuid4().hex[:12]}", *own), classifier.getStepSize() if i else 1.0)
        for i in range(len(trees))
    ]
    spark.createDataFrame(kinds, "_1 int, _2 string, _3 double").coalesce(1).write.parquet(f"{path}/treesMetadata")
    nodes = [(i, node) for i, tree in enumerate(trees) for node in tree]
    spark.createDataFrame(nodes, _NODE).coalesce(1).write.parquet(f"{path}/data")
    return GBTClassificationModel.load(path)


def tree_nodes(model: GBTClassificationModel) -> DataFrame:
    """Every node of every tree, read back from the model's saved form."""
    spark = SparkSession.active()
    path = fresh_path(spark, "trees")
    model.write().save(path)
    weights = spark.createDataFrame([(i, float(w)) for i, w in enumerate(model.treeWeights)], "tree int, weight double")
    nodes = spark.read.parquet(f"{path}/data").select(
        F.col("treeID").alias("tree"),
        F.col("nodeData.id").alias("node"),
        F.col("nodeData.prediction").alias("prediction"),
        F.get("nodeData.impurityStats", F.lit(0)).alias("cover"),
        F.col("nodeData.gain").alias("gain"),
        F.col("nodeData.leftChild").alias("left"),
        F.col("nodeData.rightChild").alias("right"),
        F.col("nodeData.split.featureIndex").alias("feature"),
        F.get("nodeData.split.leftCategoriesOrThreshold", F.lit(0)).alias("threshold"),
    )
    return nodes.join(F.broadcast(weights), "tree")


def scored(model: GBTClassificationModel, rows: DataFrame, columns: list[str], keep: list[str]) -> DataFrame:
    """(keep..., score): the model's probabilities. The node table goes to every task, rows stay in their partitions."""
    trees = rows.sparkSession.sparkContext.broadcast(ensembles.tabled(ensembles.trees_of(tree_nodes(model).toPandas())))
    score_all, number = ensembles.prefix_scores, model.getNumTrees

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch.column(len(keep)), batch.num_rows).T.copy()
                score = pa.array(score_all(x, trees.value, [number])[0])
                yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], score], names=[*keep, "score"])

    given = rows.select(*keep, F.array(*[F.col(c).cast("double") for c in columns]))
    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*keep).schema]
    return given.mapInArrow(work, ", ".join([*kinds, "score double"]))
