"""Operator 12, Merkle dataset manifest: trees of digests in van Emde Boas layout.

Every document is a leaf of its source's tree, ordered by id; runs of FAN nodes become their
hash until one is left, and the subroots of all sources, in order, are the leaves of one more
tree with the dataset's root. Trees are cut into aligned blocks of BLOCK_LEVELS levels. A
block is one row and one array of digests in van Emde Boas order: the tree is split at half
its height, the top part comes first, then each bottom part, all laid out likewise. Node
addresses are arithmetic on depth and index and serve both building and looking up siblings.
Roots of blocks are the leaves of the next band of blocks, up to one root.

A document's proof are the siblings on its way to the root. They are read top-down: each
block hands to its children what lies above them, and the lowest blocks meet their documents.
Every task holds a block at a time (FAN^BLOCK_LEVELS leaves), whatever a source's size.

Places in a source come from a range sort over all partitions and counts per partition, so a
source may hold any share of the rows. Rows without a source form a source before all others,
rows without an id come first in theirs and are not tampered with. Repeated rows are leaves of
their own, rows that share an id are ordered by their digest. Null and empty texts differ in
their leaf. Texts are hashed whole, however long. Columns other than the hashed ones play no
part, whatever their names. An empty table gives no rows and no root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from churnline.llm.common import table, written

FAN = 3
#: Levels of a block: 6,561 leaves.
BLOCK_LEVELS = 8
#: What a leaf hashes, in order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
DIGEST = 32


# ---- layout ----------------------------------------------------------------------------


def size_of(levels: int) -> int:
    """Nodes of a full tree with this many levels of nodes."""
    return (FAN**levels - 1) // (FAN - 1)


def address(depth: int, index: np.ndarray, levels: int) -> np.ndarray:
    """Places of the nodes ``index`` at ``depth`` in a block with ``levels`` levels of nodes."""
    if levels == 1:
        return np.zeros_like(index)
    top = levels // 2
    if depth < top:
        return address(depth, index, top)
    wide = FAN ** (depth - top)
    bottom = levels - top
    return size_of(top) + index // wide * size_of(bottom) + address(depth - top, index % wide, bottom)


def level_sizes(leaves: int, height: int) -> list[int]:
    """Nodes on each level from the leaves up, where the last runs are not full."""
    return [-(-leaves // FAN**k) for k in range(height + 1)]


def build_block(digests: list[bytes], height: int) -> bytes:
    """All nodes over some leaves; places of missing nodes are zero."""
    nodes = np.zeros((size_of(height + 1), DIGEST), dtype=np.uint8)
    level = digests
    for k in range(height + 1):
        if k:
            text = [d.hex() for d in level]
            level = [hashlib.sha256("".join(text[i : i + FAN]).encode()).digest() for i in range(0, len(text), FAN)]
        nodes[address(height - k, np.arange(len(level)), height + 1)] = np.frombuffer(b"".join(level), np.uint8).reshape(-1, DIGEST)
    return nodes.tobytes()


def stored_levels(nodes: bytes, leaves: int, height: int) -> list[list[str]]:
    """Digests as hex text, level by level from the leaves up, without the block's root."""
    stored = np.frombuffer(nodes, np.uint8).reshape(-1, DIGEST)
    levels = []
    for k, n in enumerate(level_sizes(leaves, height)[:-1]):
        text = stored[address(height - k, np.arange(n), height + 1)].tobytes().hex()
        levels.append([text[i : i + 2 * DIGEST] for i in range(0, len(text), 2 * DIGEST)])
    return levels


Step = tuple[int, list[str]]  # the node's place in its run, and its siblings


def steps(levels: list[list[str]], leaf: int) -> list[Step]:
    """The way of a leaf through its block."""
    out = []
    for level in levels:
        parent, own = divmod(leaf, FAN)
        run = level[parent * FAN : parent * FAN + FAN]
        out.append((own, run[:own] + run[own + 1 :]))
        leaf = parent
    return out


def packed(way: list[Step]) -> bytes:
    return b"".join(bytes([own * FAN + len(others)]) + bytes.fromhex("".join(others)) for own, others in way)


def unpacked(raw: bytes) -> list[Step]:
    way, at = [], 0
    while at < len(raw):
        own, others = divmod(raw[at], FAN)
        end = at + 1 + others * DIGEST
        text = raw[at + 1 : end].hex()
        way.append((own, [text[i : i + 2 * DIGEST] for i in range(0, len(text), 2 * DIGEST)]))
        at = end
    return way


def folded(digest: str, way: list[Step]) -> str:
    """The root that a leaf leads to."""
    for own, others in way:
        digest = hashlib.sha256("".join([*others[:own], digest, *others[own:]]).encode()).hexdigest()
    return digest


# ---- leaves ----------------------------------------------------------------------------


def leaf_digest(columns: dict[str, Column]) -> Column:
    """Digest of a document's fields; ``columns`` replaces some of them."""
    parts = []
    for name in FIELDS:
        value = columns.get(name, F.col(name)).cast("string")
        parts.append(F.when(value.isNull(), "-").otherwise(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value)))
    return F.unhex(F.sha2(F.concat(*parts).cast("binary"), 256))


def tree_of(source: str = "source") -> Column:
    """Key of a source's tree: in order of the sources' bytes, that of no source first."""
    return F.when(F.col(source).isNull(), "").otherwise(F.concat(F.lit("s"), F.col(source).cast("string")))


def placed(leaves: DataFrame, order: list[str]) -> DataFrame:
    """``leaves`` (tree, digest, ...) with their place in the tree, its size and its height."""
    order = ["tree", *order, "tie"]
    stored = written(leaves, "leaves").withColumn("tie", F.monotonically_increasing_id())
    # Rows equal in all else are told apart by where they lie: they need not meet in one task.
    ordered = stored.repartitionByRange(*order).sortWithinPartitions(*order).drop("tie")
    ordered = written(ordered.withColumn("at", F.monotonically_increasing_id()), "ordered").withColumn("part", F.shiftright("at", 33))
    runs = ordered.groupBy("tree", "part").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    # A row per tree and partition.
    whole = Window.partitionBy("tree")
    before = F.coalesce(F.sum("n").over(whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    runs = runs.select("tree", "part", (before - F.col("first")).alias("shift"), F.sum("n").over(whole).alias("size"))
    powers = F.array(*[F.lit(FAN**k) for k in range(39)])
    height = F.size(F.filter(powers, lambda p: p < F.col("size")))
    found = ordered.join(runs, ["tree", "part"]).withColumn("place", F.col("at") + F.col("shift"))
    return written(found.drop("at", "part", "shift").withColumn("height", height), "placed")


# ---- building --------------------------------------------------------------------------

_BLOCK = "tree string, block long, height int, leaves int, above int, nodes binary"


def _block_of(levels: int) -> Column:
    return F.expr(f"place div {FAN**levels}")


def _built(group: pa.Table, levels: int) -> pa.Table:
    group = group.sort_by("place")
    first = {c: group.column(c)[0].as_py() for c in ("tree", "block", "height")}
    height = min(levels, first["height"])
    nodes = build_block(group.column("digest").to_pylist(), height)
    row = {"tree": first["tree"], "block": first["block"], "height": height, "leaves": len(group), "above": first["height"] - height, "nodes": nodes}
    kinds = [pa.string(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary()]
    return pa.table({n: pa.array([v], k) for (n, v), k in zip(row.items(), kinds)})


def bands(leaves: DataFrame, levels: int = BLOCK_LEVELS) -> list[DataFrame]:
    """Blocks of all trees, the lowest band first; ``above`` says how many levels are over a block."""
    found = []
    level = leaves.select("tree", "place", "digest", "height")
    while True:
        grouped = level.withColumn("block", _block_of(levels)).groupBy("tree", "block")
        blocks = written(grouped.applyInArrow(lambda group: _built(group, levels), _BLOCK), f"blocks{len(found)}")
        found.append(blocks)
        open_blocks = blocks.where("above > 0")
        if open_blocks.isEmpty():
            return found
        level = open_blocks.select("tree", F.col("block").alias("place"), root_of_block().alias("digest"), F.col("above").alias("height"))


def root_of_block() -> Column:
    # The root has address 0.
    return F.substring("nodes", 1, DIGEST)


@dataclass
class Manifest:
    """Placed leaves and blocks of the sources' trees, and those of the tree over them."""

    leaves: DataFrame
    sources: list[DataFrame]
    subroots: DataFrame
    dataset: list[DataFrame]
    block_levels: int

    def root(self) -> str | None:
        """The dataset's root as hex text, None without documents."""
        row = self.dataset[-1].select(F.lower(F.hex(root_of_block())).alias("root")).first()
        return row and row["root"]

    def blocks(self) -> DataFrame:
        """The manifest to keep: all blocks by scope (source or dataset) and band."""
        named = [(scope, band, rows) for scope, found in (("source", self.sources), ("dataset", self.dataset)) for band, rows in enumerate(found)]
        parts = [rows.select(F.lit(scope).alias("scope"), F.lit(band).alias("band"), *rows.columns) for scope, band, rows in named]
        whole = parts[0]
        for part in parts[1:]:
            whole = whole.unionByName(part)
        return whole


def manifest(docs: DataFrame, claimed: Column | None = None, block_levels: int = BLOCK_LEVELS) -> Manifest:
    """Trees over ``docs``; ``claimed`` is a digest to check in a leaf's place (its own if not given)."""
    rows = docs.select(F.col("doc_id"), tree_of().alias("tree"), leaf_digest({}).alias("digest"), (leaf_digest({}) if claimed is None else claimed).alias("claimed"))
    leaves = placed(rows, ["doc_id", "digest"])
    sources = bands(leaves, block_levels)
    closed = [b.where("above = 0").select("tree", root_of_block().alias("digest")) for b in sources]
    subroots = closed[0]
    for more in closed[1:]:
        subroots = subroots.unionByName(more)
    subroots = placed(subroots.select(F.lit("").alias("tree"), F.col("tree").alias("source_tree"), "digest"), ["source_tree"])
    return Manifest(leaves, sources, subroots, bands(subroots, block_levels), block_levels)


# ---- proofs ----------------------------------------------------------------------------


def _handed_down(blocks: DataFrame, block_levels: int) -> DataFrame:
    """(tree, place, subroot, way): for each leaf of each block, the way from it to the root."""

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                levels = stored_levels(row["nodes"], row["leaves"], row["height"])
                n, first = row["leaves"], row["block"] * FAN**block_levels
                ways = [packed(steps(levels, i)) + row["way"] for i in range(n)]
                columns = [pa.array([row["tree"]] * n, pa.string()), pa.array(range(first, first + n), pa.int64()), pa.array([row["subroot"]] * n, pa.binary()), pa.array(ways, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["tree", "place", "subroot", "way"])

    return blocks.mapInArrow(walk, "tree string, place long, subroot binary, way binary")


def ways_to_blocks(found: Manifest) -> DataFrame:
    """The lowest blocks of the sources' trees, each with its source's subroot and the way from its root on."""
    nothing = F.lit(b"")
    ways = None
    for blocks in reversed(found.dataset):
        if ways is None:
            ready = blocks.select("*", nothing.alias("subroot"), nothing.alias("way"))
        else:
            ready = blocks.join(ways.withColumnRenamed("place", "block"), ["tree", "block"])
        ways = written(_handed_down(ready, found.block_levels), "ways")
    of_source = ways.join(found.subroots.select("tree", "place", "source_tree", "digest"), ["tree", "place"])
    of_source = of_source.select(F.col("source_tree").alias("tree"), F.lit(0).cast("long").alias("block"), F.col("digest").alias("subroot"), "way")
    ways = None
    for blocks in reversed(found.sources):
        # Trees that end in this band take their subroot's way, others that of the block above.
        given = blocks.where("above = 0").join(of_source, ["tree", "block"])
        if ways is not None:
            given = given.unionByName(blocks.where("above > 0").join(ways.withColumnRenamed("place", "block"), ["tree", "block"]))
        if blocks is found.sources[0]:
            return written(given, "lowest")
        ways = written(_handed_down(given, found.block_levels), "ways")


_PROVED = [("doc_id", pa.int64()), ("leaf", pa.string()), ("subroot", pa.string()), ("proof", pa.string()), ("folded_root", pa.string())]


def _proved(docs: pa.Table, blocks: pa.Table, block_levels: int) -> pa.Table:
    block = blocks.to_pylist()[0]
    levels = stored_levels(block["nodes"], block["leaves"], block["height"])
    rest = unpacked(block["way"])
    first, subroot, rows = block["block"] * FAN**block_levels, block["subroot"].hex(), []
    for doc, place, leaf, claimed in zip(*(docs.column(c).to_pylist() for c in ("doc_id", "place", "digest", "claimed"))):
        way = steps(levels, place - first) + rest
        proof = "".join(d for _, others in way for d in others)
        rows.append((doc, leaf.hex(), subroot, proof, folded(claimed.hex(), way)))
    return pa.table({n: pa.array(c, k) for (n, k), c in zip(_PROVED, zip(*rows))})


def proofs(found: Manifest) -> DataFrame:
    """(doc_id, leaf, subroot, proof, folded_root) of every leaf; ``proof`` is the siblings' hex text in order."""
    by, found_levels = ["tree", "block"], found.block_levels
    leaves = found.leaves.select("doc_id", "tree", "place", "digest", "claimed", _block_of(found.block_levels).alias("block")).groupBy(by)
    pairs = leaves.cogroup(ways_to_blocks(found).groupBy(by))
    return pairs.applyInArrow(lambda docs, blocks: _proved(docs, blocks, found_levels), "doc_id long, leaf string, subroot string, proof string, folded_root string")


def tampered_text() -> Column:
    """The text without line feeds, where crc32 of the id is even."""
    even = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    return F.when(even, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = manifest(table(spark, sf_dir, "documents"), leaf_digest({"text": tampered_text()}))
    root = F.lit(found.root()).cast("string")
    return proofs(found).select(
        "doc_id", "leaf", "subroot", root.alias("root"), F.sha2(F.col("proof").cast("binary"), 256).alias("proof_sha256"), "folded_root",
        (F.col("folded_root") == root).alias("verified"),
    )


# ---- the same as SQL -------------------------------------------------------------------


def op12_sql(levels: int = 12) -> str:
    """SQL for sources of 3^``levels`` documents at most, and as many sources."""
    field = lambda c: f"coalesce(strlen({c}::VARCHAR)::VARCHAR || ':' || {c}::VARCHAR, '-')"
    leaf = lambda text: "sha256(" + " || ".join(field(text if c == "text" else c) for c in FIELDS) + ")"
    run = "max(d) FILTER (WHERE p % 3 = {0})"
    parts = [
        "WITH RECURSIVE steps AS (SELECT i, i AS v, 0 AS k FROM range(256) r(i) UNION ALL"
        " SELECT i, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END, k + 1 FROM steps WHERE k < 8)",
        "crc AS (SELECT list(v ORDER BY i) AS t FROM steps WHERE k = 8)",
        "odd AS (SELECT DISTINCT doc_id, list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ord(c)::BIGINT)),"
        " lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])) & 1 = 0 AS odd FROM documents, crc)",
        "docs AS (SELECT d.*, CASE WHEN o.odd = false THEN replace(text, chr(10), '') ELSE text END AS text2"
        " FROM documents d LEFT JOIN odd o ON d.doc_id = o.doc_id)",
        f"leaves AS (SELECT doc_id, source, {leaf('text')} AS leaf, {leaf('text2')} AS claimed FROM docs)",
        "numbered AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM leaves)",
        "s0 AS (SELECT source AS g, pos AS p, leaf AS d, count(*) OVER (PARTITION BY source) AS n FROM numbered)",
    ]

    def climb(name: str, ways: str) -> str:
        for k in range(levels):
            parts.append(
                f"{name}r{k} AS (SELECT g, p // 3 AS p, max(n) AS n, {', '.join(run.format(i) + f' AS d{i}' for i in range(3))} FROM {name}{k} GROUP BY g, p // 3)"
            )
            parts.append(
                f"{name}{k + 1} AS (SELECT g, p, CASE WHEN n = 1 THEN d0 ELSE sha256(d0 || coalesce(d1, '') || coalesce(d2, '')) END AS d, CASE WHEN n = 1 THEN 1 ELSE (n + 2) // 3 END AS n FROM {name}r{k})"
            )
        for k in range(levels):
            given = lambda i, own: f"CASE WHEN w.pos % 3 = {i} THEN {own} ELSE coalesce(r.d{i}, '') END"
            parts.append(
                f"{ways}{k + 1} AS (SELECT w.* REPLACE (w.pos // 3 AS pos,"
                f" CASE WHEN r.n = 1 THEN w.folded ELSE sha256({' || '.join(given(i, 'w.folded') for i in range(3))}) END AS folded,"
                f" CASE WHEN r.n = 1 THEN w.proof ELSE w.proof || {' || '.join(given(i, chr(39) * 2) for i in range(3))} END AS proof)"
                f" FROM {ways}{k} w JOIN {name}r{k} r ON w.g IS NOT DISTINCT FROM r.g AND r.p = w.pos // 3)"
            )
        return f"{ways}{levels}"

    parts.append("w0 AS (SELECT doc_id, source AS g, leaf, pos, claimed AS folded, '' AS proof FROM numbered)")
    below = climb("s", "w")
    parts.append(f"tops AS (SELECT g AS source, d AS subroot, row_number() OVER (ORDER BY encode(g) NULLS FIRST) - 1 AS pos FROM s{levels})")
    parts.append("t0 AS (SELECT 0 AS g, pos AS p, subroot AS d, count(*) OVER () AS n FROM tops)")
    parts.append(f"v0 AS (SELECT w.doc_id, w.leaf, t.subroot, 0 AS g, t.pos, w.folded, w.proof FROM {below} w JOIN tops t ON w.g IS NOT DISTINCT FROM t.source)")
    above = climb("t", "v")
    return (
        ", ".join(parts)
        + f" SELECT v.doc_id, v.leaf, v.subroot, r.d AS root, sha256(v.proof) AS proof_sha256, v.folded AS folded_root, v.folded = r.d AS verified FROM {above} v, t{levels} r"
    )
