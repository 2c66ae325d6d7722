"""Operator 7, SimHash near-dedup by a Gray-order hierarchical index.

Fingerprint: bit i is set if it is set in over half of the XXH64 hashes (seed 42) of the
text's word shingles. Two fingerprints are linked at MAX_BITS differing bits or fewer; a
component is all that links reach.

Index. Each fingerprint stands in several views; a view moves some blocks of bits to the
front, chosen so that two linked fingerprints agree on the front of at least one view
(MAX_BITS differences leave that many blocks untouched). In a view, codes are sorted by
their Gray rank. Upper nodes share the front; below each stand up to 256 nodes that share
the next bits of the rank and keep a mask of the bits on which all their members agree,
with the pattern of those bits. Search goes down from pairs of nodes: differences under
both masks are accumulated, and pairs beyond MAX_BITS are pruned with all their members.

Components first: neighbours in Gray order within MAX_BITS join at once, so thousands of
near copies become one component before any pair of them is formed, and pairs of nodes
that lie wholly in one component are pruned too. The search is exact: no bucket is cut.

Null and empty texts have fingerprint 0 and are linked like others. Texts with fewer words
than a shingle hash as one. Repeated rows and ties share a component. Ids may be null; the
component is then the smallest id that is not. Other columns are not touched.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from churnline.llm.common import ascii_lower, components, free_name, table, words, written

SHINGLE = 3
MAX_BITS = 3
NODE_BITS = 8
#: Members of an upper node that are aimed at; more fingerprints take more blocks and longer fronts.
NODE_MEMBERS = 64


def shingle_hashes(text: Column, shingle: int = SHINGLE) -> Column:
    """Array of the hashes of all word shingles, repeats included."""
    w = words(ascii_lower(text))
    return F.transform(F.array(w), lambda a: _hashes(a, shingle))[0]


def _hashes(w: Column, shingle: int) -> Column:
    many = F.transform(
        F.sequence(F.lit(0), F.size(w) - shingle),
        lambda i: F.xxhash64(F.concat_ws(" ", *[F.get(w, i + k) for k in range(shingle)])),
    )
    none = F.array().cast("array<bigint>")
    return F.when(F.size(w) >= shingle, many).when(F.size(w) > 0, F.array(F.xxhash64(F.array_join(w, " ")))).otherwise(none)


def _signed(bits: int) -> int:
    return bits - (1 << 64) if bits >> 63 else bits


def fingerprints(rows: DataFrame, keys: list[str], text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """``keys`` and the fingerprint ``fp`` (long) of each row; ``keys`` must tell rows apart."""
    hashed = rows.select(*keys, F.explode_outer(shingle_hashes(F.col(text), shingle)).alias("h"))
    # 32 sums of two 32-bit counters each, instead of 64.
    pair = F.lit(1 << 32 | 1)
    sums = [F.sum(F.shiftrightunsigned("h", j).bitwiseAND(pair)).alias(f"s{j}") for j in range(32)]
    counted = hashed.groupBy(*keys).agg(F.count("h").alias("n"), *sums)
    low = lambda j: F.col(f"s{j}").bitwiseAND(F.lit(0xFFFFFFFF))
    high = lambda j: F.shiftrightunsigned(f"s{j}", 32)
    bits = [F.when(2 * (low(b) if b < 32 else high(b - 32)) > F.col("n"), F.lit(_signed(1 << b))).otherwise(F.lit(0)) for b in range(64)]
    return counted.select(*keys, reduce(lambda a, b: a.bitwiseOR(b), bits).cast("long").alias("fp"))


def differing(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def _plan(n: int, max_bits: int) -> tuple[list[tuple[int, int]], int]:
    """Blocks (start, length) and how many of them stand in front of a view."""
    blocks = max_bits + 1
    while blocks < 16 and n / 2 ** (64 * (blocks - max_bits) // blocks) > NODE_MEMBERS:
        blocks += 1
    edges = [64 * i // blocks for i in range(blocks + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])], blocks - max_bits


def _views(fps: DataFrame, blocks: list[tuple[int, int]], front: int) -> DataFrame:
    """(fp, view, front of the code, node, Gray rank of the code): a row per choice of front blocks."""
    codes = []
    for view, chosen in enumerate(combinations(range(len(blocks)), front)):
        order = [*chosen, *(i for i in range(len(blocks)) if i not in chosen)]
        code, place = F.lit(0).cast("long"), 64
        for i in order:
            start, length = blocks[i]
            place -= length
            part = F.shiftrightunsigned("fp", start).bitwiseAND(F.lit((1 << length) - 1))
            code = code.bitwiseOR(F.shiftleft(part, place))
        rest = 64 - sum(blocks[i][1] for i in chosen)
        codes.append(F.struct(F.lit(view).alias("view"), code.alias("code"), F.lit(rest).alias("rest")))
    rows = fps.select("fp", F.explode(F.array(*codes)).alias("v")).select("fp", "v.*", F.col("v.code").alias("rank"))
    for step in (1, 2, 4, 8, 16, 32):
        rows = rows.withColumn("rank", F.col("rank").bitwiseXOR(F.shiftrightunsigned("rank", step)))
    node = F.expr(f"shiftrightunsigned(rank, rest - {NODE_BITS})").bitwiseAND(F.lit((1 << NODE_BITS) - 1))
    return rows.select("fp", "view", F.expr("shiftrightunsigned(code, rest)").alias("front"), node.alias("node"), "rank")


def fingerprint_components(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(fp, component): the smallest fingerprint linked to each distinct ``fp``, directly or not."""
    fps = fps.select("fp")
    blocks, front = _plan(fps.count(), max_bits)
    views = written(_views(fps, blocks, front), "views")

    # Neighbours in Gray order join the first of their run.
    order = Window.partitionBy("view", "front").orderBy("rank")
    before = F.lag("fp").over(order)
    runs = views.withColumn("starts", before.isNull() | (differing(F.col("fp"), before) > max_bits))
    head = F.last(F.when(F.col("starts"), F.col("fp")), ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0))
    near = runs.select(F.col("fp").alias("a"), head.alias("b")).where("a <> b").distinct()
    joined = components(near).select(F.col("node").alias("fp"), "component")
    members = views.join(joined, "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    members = written(members.select("view", "front", "node", "fp", "component"), "members")

    # Nodes with the bits their members share; upper nodes within one component are done.
    nodes = members.groupBy("view", "front", "node").agg(
        F.bit_and("fp").alias("pattern"),
        F.bitwise_not(F.bit_and("fp").bitwiseXOR(F.bit_or("fp"))).alias("mask"),
        F.min("component").alias("low"),
        F.max("component").alias("high"),
    )
    upper = Window.partitionBy("view", "front")
    open_nodes = nodes.withColumn("all_low", F.min("low").over(upper)).withColumn("all_high", F.max("high").over(upper))
    nodes = written(open_nodes.where("all_low <> all_high").drop("all_low", "all_high"), "nodes")
    a, b = nodes.alias("a"), nodes.alias("b")
    apart = (F.col("a.low") != F.col("b.high")) | (F.col("a.high") != F.col("b.low"))
    shared = F.col("a.mask").bitwiseAND(F.col("b.mask"))
    close = F.bit_count(F.col("a.pattern").bitwiseXOR(F.col("b.pattern")).bitwiseAND(shared)) <= max_bits
    same = (F.col("a.view") == F.col("b.view")) & (F.col("a.front") == F.col("b.front")) & (F.col("a.node") <= F.col("b.node"))
    pairs = a.join(b, same & apart & close).select(
        "a.view", "a.front", "a.node", F.col("b.node").alias("other"), F.col("b.pattern").alias("pattern"), F.col("b.mask").alias("mask")
    )
    # From nodes to members: first one side against the other node's pattern, then members.
    beyond = F.bit_count(F.col("fp").bitwiseXOR(F.col("pattern")).bitwiseAND(F.col("mask")))
    one = members.join(pairs, ["view", "front", "node"]).where(beyond <= max_bits)
    one = one.select("view", "front", F.col("other").alias("node"), F.col("fp").alias("fp_a"), F.col("component").alias("a"))
    links = one.join(members, ["view", "front", "node"]).where((F.col("a") != F.col("component")) & (differing(F.col("fp_a"), F.col("fp")) <= max_bits))
    merged = components(links.select("a", F.col("component").alias("b")).distinct())
    merged = merged.select(F.col("node").alias("component"), F.col("component").alias("whole"))
    own = members.where("view = 0").select("fp", "component")
    return own.join(merged, "component", "left").select("fp", F.coalesce("whole", "component").alias("component"))


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """One row per document: doc_id, same (hash of the text), fp, component (its smallest fp), component_id."""
    rows = docs.select("doc_id", "text", F.monotonically_increasing_id().alias("row"), F.xxhash64("text").alias("same"))
    prints = written(fingerprints(rows, ["row", "doc_id", "same"], shingle=shingle), "fingerprints")
    return _named(prints, max_bits)


def _named(prints: DataFrame, max_bits: int) -> DataFrame:
    distinct = written(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct")
    found = fingerprint_components(distinct, max_bits).join(distinct, "fp")
    least = found.groupBy("component").agg(F.min("least").alias("component_id"))
    by_fp = found.join(least, "component").select("fp", "component", "component_id")
    return prints.join(by_fp, "fp").select("doc_id", "same", "fp", "component", "component_id")


def one_of_each(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """One document of each component, that of the smallest id, with all its columns."""
    named = near_duplicates(docs, shingle, max_bits)
    # Ids may be null or repeated, so they do not tell components apart.
    kept = named.groupBy("component").agg(F.min(F.struct("doc_id", "same")).alias("k"))
    id_, same = free_name(docs, "kept_id"), free_name(docs, "kept_same")
    kept = kept.select(F.col("k.doc_id").alias(id_), F.col("k.same").alias(same))
    rows = docs.join(kept, docs["doc_id"].eqNullSafe(kept[id_]) & (F.xxhash64(docs["text"]) == kept[same]), "left_semi")
    # Rows that repeat id and text as well.
    again = named.groupBy("doc_id", "same").count().where("count > 1").select(F.col("doc_id").alias(id_), F.col("same").alias(same))
    if again.isEmpty():
        return rows
    again = written(again, "again")
    twice = rows["doc_id"].eqNullSafe(again[id_]) & (F.xxhash64(rows["text"]) == again[same])
    return rows.join(again, twice, "left_anti").unionByName(rows.join(again, twice, "left_semi").dropDuplicates(["doc_id", "text"]))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = near_duplicates(table(spark, sf_dir, "documents"))
    return named.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
