"""Operator 2, LM scoring: context-tree weighting over bytes.

A text is its UTF-8 bytes and an end mark; each byte is eight binary decisions. The context
of a decision is the bits decided before it in the byte and the bytes before it, up to DEPTH.
A node (context, bits decided) counts zeros and ones over all training texts and estimates
the next bit by Krichevsky-Trofimov; its weighted probability is half its own estimate and
half the product of its children's, so all depths are mixed with weights the data choose.

Training is distributed: byte strings of DEPTH + 1 are counted in all training texts, folded
into the deepest nodes, and folded upwards one depth at a time with the logarithms of the
weighted probabilities. All nodes are kept, so the model grows with the corpus.

Scoring needs the probability of each byte string that occurs. Distinct strings meet the nodes
of their contexts in buckets dealt by the last TOP_BYTES + 1 bytes; nodes of shorter contexts
(2^24 at most) are sent to all. Strings that make up one in HOT_STRINGS of all places or more
(HOT_STRINGS at most) are then sent to the scoring tasks with their values; the others are
joined per text, so none of that join's keys is frequent.

Unigram base scores use the counts of all training words. Words that make up one in HOT_SHARE
of them or more (HOT_SHARE words at most) are sent along; the others are joined.

Null and empty texts score the end alone. Repeated rows are scored alike and learned from as
often as they occur. With no training text each bit has probability one half. Texts are whole.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from churnline.llm.common import fold, table, written

DEPTH = 5
FOLDS = 10
END = b"\xff"  # in no UTF-8 text
HOT_STRINGS = 1 << 23
HOT_SHARE = 1 << 20
TOP_BYTES = 2
BUCKET_STRINGS = 50_000
#: (string, counts) rows that a task adds up at once, 16 bytes each.
MERGE_AT = 2_000_000
MERGE_WORDS = 250_000
BLOCK_BYTES = 1_500_000
SCORED_BYTES = 2_500_000
#: The counted end of a text; white space, so no word equals it.
END_WORD = "\n"


def strings(texts: list[bytes], depth: int = DEPTH) -> tuple[np.ndarray, np.ndarray]:
    """The byte at each place with the ``depth`` bytes before it, as one number; and places per text.

    The lowest byte is the place's own; before a text stand end marks.
    """
    gap = END * depth
    raw = np.frombuffer(gap + b"".join(t + END + gap for t in texts), dtype=np.uint8).astype(np.int64)
    packed = raw[depth:].copy()
    for k in range(1, depth + 1):
        packed |= raw[depth - k : len(raw) - k] << (8 * k)
    lengths = np.array([len(t) + 1 for t in texts], dtype=np.int64)
    own = np.ones(len(packed), dtype=bool)
    ends = np.cumsum(lengths + depth)
    own[(ends[:, None] - np.arange(1, depth + 1)).ravel()] = False
    return packed[own], lengths


def blocks(texts: list[bytes], block_bytes: int) -> Iterator[slice]:
    """Runs of texts of about ``block_bytes``."""
    start = size = 0
    for i, t in enumerate(texts):
        size += len(t) + 1
        if size >= block_bytes or i == len(texts) - 1:
            yield slice(start, i + 1)
            start, size = i + 1, 0


def long_strings(text: bytes, depth: int) -> Iterator[np.ndarray]:
    """As ``strings`` of one text, in pieces of BLOCK_BYTES that each begin with the bytes before."""
    whole = END * depth + text + END
    for start in range(depth, len(whole), BLOCK_BYTES):
        raw = np.frombuffer(whole[start - depth : start + BLOCK_BYTES], dtype=np.uint8).astype(np.int64)
        packed = raw[depth:].copy()
        for k in range(1, depth + 1):
            packed |= raw[depth - k : len(raw) - k] << (8 * k)
        yield packed


def _added(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums by key, sorted. ``counts`` holds the total above bit 32 and the training count below: both add up in one number."""
    order = np.argsort(keys)
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else order
    return keys[first], np.add.reduceat(counts, first) if len(keys) else counts


def corpus_counts(docs: DataFrame, train: Column, depth: int = DEPTH) -> DataFrame:
    """(string, word, n, total): training counts of byte strings and of words, the other column null.

    ``total`` counts a string in all texts; strings that training lacks have ``n`` 0.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[tuple[np.ndarray, np.ndarray]] = []
        words: Counter[bytes] = Counter()

        def rows(*columns: pa.Array) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(list(columns), names=["string", "word", "n", "total"])

        def flush() -> Iterator[pa.RecordBatch]:
            for keys, counts in parts:
                yield rows(pa.array(keys), pa.nulls(len(keys), pa.string()), pa.array(counts & 0xFFFFFFFF), pa.array(counts >> 32))
            parts.clear()
            yield from flush_words()

        def flush_words() -> Iterator[pa.RecordBatch]:
            if words:
                names, n = pa.array(list(words), pa.binary()).cast(pa.string()), pa.array(words.values(), pa.int64())
                yield rows(pa.nulls(len(names), pa.int64()), names, n, n)
            words.clear()

        def runs(texts: list[bytes], learn: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
            """Strings and whether they are learned from, in blocks."""
            for part in blocks(texts, BLOCK_BYTES):
                if sum(map(len, texts[part])) < 2 * BLOCK_BYTES:
                    found, lengths = strings(texts[part], depth)
                    yield found, np.repeat(learn[part], lengths)
                else:
                    for text, own in zip(texts[part], learn[part]):
                        for found in long_strings(text, depth):
                            yield found, np.full(len(found), own)

        for batch in batches:
            texts = [(t.as_py() or "").encode() for t in batch.column("text")]
            learn = batch.column("learn").to_numpy(zero_copy_only=False).astype(bool)
            for found, own in runs(texts, learn):
                parts.append(_added(found, own.astype(np.int64) | 1 << 32))
                if sum(len(p[0]) for p in parts) > MERGE_AT:
                    parts[:] = [_added(*(np.concatenate([p[i] for p in parts]) for i in (0, 1)))]
                    if len(parts[0][0]) > MERGE_AT // 2:
                        yield from flush()
            for t, own in zip(texts, learn):
                if own:
                    words.update(t.lower().split())
                    words[END_WORD.encode()] += 1
                if len(words) > MERGE_WORDS:
                    yield from flush_words()
        if parts:
            parts[:] = [_added(*(np.concatenate([p[i] for p in parts]) for i in (0, 1)))]
        yield from flush()

    given = docs.select("text", F.coalesce(train, F.lit(False)).alias("learn"))
    found = given.mapInArrow(count, "string long, word string, n long, total long")
    return written(found.groupBy("string", "word").agg(F.sum("n").alias("n"), F.sum("total").alias("total")), "counts")


def _log_gamma(x: Column) -> Column:
    """ln gamma for x >= 1/2: Stirling's series eight places on."""
    y = x + 8
    series = 1 / (12 * y) - 1 / (360 * y * y * y) + 1 / (1260 * y * y * y * y * y)
    down = F.log(x * (x + 1) * (x + 2) * (x + 3)) + F.log((x + 4) * (x + 5) * (x + 6) * (x + 7))
    return (y - 0.5) * F.log(y) - y + 0.5 * math.log(2 * math.pi) + series - down


def log_kt(zeros: Column, ones: Column) -> Column:
    """ln of the Krichevsky-Trofimov probability of a sequence with these counts."""
    return _log_gamma(zeros + 0.5) + _log_gamma(ones + 0.5) - _log_gamma(zeros + ones + 1.0) - math.log(math.pi)


def nodes(counts: DataFrame, depth: int = DEPTH) -> DataFrame:
    """(key, one, stop) of all nodes: estimate of a one, and weight of the own estimate.

    ``key`` holds the depth, the context bytes and, in its lowest byte, a one bit followed by
    the bits decided.
    """
    rows = counts.where("string is not null and n > 0").select("string", "n")
    decisions = F.explode(F.array(*[F.struct(F.lit(8 - i).alias("left"), F.lit(1 << i).alias("top")) for i in range(8)]))
    rows = rows.select("string", "n", decisions.alias("d")).select("string", "n", "d.left", "d.top")
    decided = F.expr("(string & 255) >> left").bitwiseOR(F.col("top"))
    one = F.expr("(string >> (left - 1)) & 1")
    at = F.expr("shiftleft(string >> 8, 8)").bitwiseOR(decided)
    level = rows.select(at.alias("at"), (F.col("n") * (1 - one)).alias("zeros"), (F.col("n") * one).alias("ones"))
    level = level.groupBy("at").agg(F.sum("zeros").alias("zeros"), F.sum("ones").alias("ones")).withColumn("below", F.lit(None).cast("double"))
    kept = None
    for d in range(depth, -1, -1):
        level = level.withColumn("own", log_kt(F.col("zeros"), F.col("ones")))
        gap = F.col("below") - F.col("own")
        both = F.greatest("below", "own") + F.log1p(F.exp(-F.abs(gap))) - math.log(2)
        level = level.select("at", "zeros", "ones", F.coalesce(both, "own").alias("weighted"), F.coalesce(1 / (1 + F.exp(gap)), F.lit(1.0)).alias("stop"))
        level = written(level, f"depth{d}")
        estimate = (F.col("ones") + 0.5) / (F.col("zeros") + F.col("ones") + 1)
        sent = level.select(F.col("at").bitwiseOR(F.lit(d << 48)).alias("key"), estimate.alias("one"), "stop")
        kept = sent if kept is None else kept.unionByName(sent)
        if d:
            # One context byte fewer: the oldest goes.
            parent = F.col("at").bitwiseAND(F.lit((1 << 8 * d) - 1))
            level = level.groupBy(parent.alias("at")).agg(F.sum("zeros").alias("zeros"), F.sum("ones").alias("ones"), F.sum("weighted").alias("below"))
    return kept


Nodes = tuple[np.ndarray, np.ndarray, np.ndarray]


def sorted_nodes(given: pa.Table) -> Nodes:
    """(key, one, stop) as arrays, sorted by key."""
    keys, one, stop = (given.column(c).to_numpy() for c in ("key", "one", "stop"))
    order = np.argsort(keys)
    return keys[order], one[order], stop[order]


class Model:
    """Nodes of short and of long contexts, each sorted by key; the log10 probability of a byte after its context."""

    def __init__(self, short: Nodes, long: Nodes, depth: int):
        self.short, self.long, self.depth = short, long, depth

    def log10(self, strings: np.ndarray) -> np.ndarray:
        total = np.zeros(len(strings))
        byte, context = strings & 255, strings >> 8
        for i in range(8):
            decided = (1 << i) | (byte >> (8 - i))
            bit = (byte >> (7 - i)) & 1
            p = np.full(len(strings), 0.5)
            below = np.zeros(len(strings), dtype=bool)
            for d in range(self.depth, -1, -1):
                keys, ones, stops = self.short if d <= TOP_BYTES else self.long
                if not len(keys):
                    continue
                key = ((context & ((1 << 8 * d) - 1)) << 8) | decided | (d << 48)
                at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
                here = keys[at] == key
                one, stop = ones[at], stops[at]
                mixed = np.where(below, stop * one + (1 - stop) * p, one)
                p = np.where(here, mixed, p)
                below |= here
            total += np.log10(np.where(bit == 1, p, 1 - p))
        return total


def string_values(counts: DataFrame, kept: DataFrame, depth: int = DEPTH) -> DataFrame:
    """(string, total, value): the log10 probability of the last byte of each string that occurs."""
    found = counts.where("string is not null").select("string", "total")
    buckets = max(1, -(-found.count() // BUCKET_STRINGS))
    recent = lambda c: F.shiftright(c, 8).bitwiseAND(F.lit((1 << 8 * (TOP_BYTES + 1)) - 1))
    bucket = lambda c: F.pmod(F.xxhash64(recent(c)), F.lit(buckets)).alias("bucket")
    columns = ("key", "one", "stop")
    short = F.shiftright("key", 48) <= TOP_BYTES
    # Contexts of TOP_BYTES bytes at most: 2^24 nodes if every context occurred.
    shared = counts.sparkSession.sparkContext.broadcast(sorted_nodes(kept.where(short).select(*columns).toArrow()))

    def valued(asked: pa.Table, given: pa.Table) -> pa.Table:
        model = Model(shared.value, sorted_nodes(given), depth)
        return asked.select(["string", "total"]).append_column("value", pa.array(model.log10(asked.column("string").to_numpy())))

    left = found.select(bucket("string"), "string", "total").groupBy("bucket")
    right = kept.where(~short).select(bucket("key"), *columns).groupBy("bucket")
    return written(left.cogroup(right).applyInArrow(valued, "string long, total long, value double").where("string is not null"), "values")


_LONGS = pa.list_(pa.int64())
_SCORED = [
    ("score", pa.float64(), "double"),
    ("n_bytes", pa.int64(), "long"),
    ("n_tokens", pa.int64(), "long"),
    ("hot_known", pa.int64(), "long"),
    ("hot_score", pa.float64(), "double"),
    ("words", pa.list_(pa.string()), "array<string>"),
    ("times", _LONGS, "array<long>"),
    ("strings", _LONGS, "array<long>"),
    ("places", _LONGS, "array<long>"),
]


def scorer(hot_strings: pa.Table, hot_words: pa.Table, depth: int = DEPTH):
    """Column function: sums over a text's hot strings and hot words, and its other strings and words."""
    order = np.argsort(hot_strings.column("string").to_numpy())
    ordered = (hot_strings.column("string").to_numpy()[order], hot_strings.column("value").to_numpy()[order])
    shared = SparkSession.active().sparkContext.broadcast((*ordered, hot_words))

    def looked_up(keys: np.ndarray, values: np.ndarray, texts: list[bytes]) -> Iterator[tuple[float, list, list]]:
        found, lengths = strings(texts, depth)
        distinct, codes = _sorted_codes(found)
        if len(keys):
            at = np.minimum(np.searchsorted(keys, distinct), len(keys) - 1)
            hot = keys[at] == distinct
            value = np.where(hot, values[at], 0.0)
        else:
            hot, value = np.zeros(len(distinct), dtype=bool), np.zeros(len(distinct))
        sums = np.add.reduceat(value[codes], np.cumsum(lengths) - lengths)
        rare = np.flatnonzero(~hot[codes])
        text = np.searchsorted(np.cumsum(lengths), rare, side="right")
        pairs, places = np.unique(text * len(distinct) + codes[rare], return_counts=True)
        edges = np.searchsorted(pairs, np.arange(1, len(texts)) * len(distinct))
        return zip(sums.tolist(), np.split(distinct[pairs % len(distinct)], edges), np.split(places, edges))

    @F.arrow_udf("struct<" + ",".join(f"{name}:{kind}" for name, _, kind in _SCORED) + ">")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        keys, values, hot = shared.value
        get = dict(zip(hot.column("word").cast(pa.binary()).to_pylist(), hot.column("value").to_pylist())).get
        for batch in batches:
            rows = []
            texts = [(t.as_py() or "").encode() for t in batch]
            for part in blocks(texts, SCORED_BYTES):
                for text, (total, others, places) in zip(texts[part], looked_up(keys, values, texts[part])):
                    words = text.lower().split()
                    known, base, rest = 0, 0.0, []
                    for w in (*words, END_WORD.encode()):
                        value = get(w)
                        if value is None:
                            rest.append(w)
                        else:
                            known += 1
                            base += value
                    rare = Counter(rest)
                    rows.append((total, len(text), len(words) + 1, known, base, [w.decode() for w in rare], list(rare.values()), others, places))
            columns = list(zip(*rows)) or [()] * len(_SCORED)
            yield pa.StructArray.from_arrays([pa.array(c, t) for c, (_, t, _) in zip(columns, _SCORED)], fields=[pa.field(n, t) for n, t, _ in _SCORED])

    return score


def _sorted_codes(found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    codes, distinct = pd.factorize(found)
    order = np.argsort(distinct)
    place = np.empty(len(order), dtype=np.int64)
    place[order] = np.arange(len(order))
    return distinct[order], place[codes]


def score(docs: DataFrame, train: Column, depth: int = DEPTH) -> DataFrame:
    """doc_id, score, n_bytes, bits_per_byte, n_tokens, n_known, train_tokens, base_score of each document.

    ``train`` says which rows of ``docs`` are learned from.
    """
    counts = corpus_counts(docs, train, depth)
    words = counts.where("word is not null").select("word", "n")
    tokens, distinct = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count_if(F.col("n") > 0)).first()
    log10 = lambda n: F.log10((n + 0.1) / F.lit(tokens + 0.1 * (distinct + 1)))
    least = max(1, -(-tokens // HOT_SHARE))
    # HOT_SHARE words at most.
    hot_words = words.where(F.col("n") >= least).select("word", log10(F.col("n")).alias("value")).toArrow()
    values = string_values(counts, nodes(counts, depth), depth)
    least_places = max(1, -(-(values.agg(F.sum("total")).first()[0] or 0) // HOT_STRINGS))
    # HOT_STRINGS strings at most.
    hot_strings = values.where(F.col("total") >= least_places).select("string", "value").toArrow()
    given = docs.select("doc_id", "text", F.monotonically_increasing_id().alias("row"))
    scored = written(given.select("row", "doc_id", scorer(hot_strings, hot_words, depth)("text").alias("s")).select("row", "doc_id", "s.*"), "scored")
    # No word of this join makes up more than one in HOT_SHARE of the training tokens.
    rare = scored.select("row", F.explode(F.arrays_zip("words", "times")).alias("w")).select("row", F.col("w.words").alias("word"), F.col("w.times").alias("times"))
    counted = rare.join(words.where(F.col("n") < least), "word", "left")
    n = F.coalesce("n", F.lit(0))
    by_word = counted.select("row", F.when(n > 0, F.col("times")).otherwise(0).alias("known"), (F.col("times") * log10(n)).alias("base"), F.lit(0.0).alias("more"))
    # No string of this join makes up more than one in HOT_STRINGS of all places.
    others = scored.select("row", F.explode(F.arrays_zip("strings", "places")).alias("s")).select("row", F.col("s.strings").alias("string"), F.col("s.places").alias("places"))
    by_string = others.join(values.where(F.col("total") < least_places), "string").select(
        "row", F.lit(0).cast("long").alias("known"), F.lit(0.0).alias("base"), (F.col("places") * F.col("value")).alias("more")
    )
    sums = by_word.unionByName(by_string).groupBy("row").agg(*[F.sum(c).alias(c) for c in ("known", "base", "more")])
    both = scored.drop("words", "times", "strings", "places").join(sums, "row", "left")
    both = both.withColumn("score", F.col("score") + F.coalesce("more", F.lit(0.0)))
    return both.select(
        "doc_id",
        "n_tokens",
        (F.col("hot_known") + F.coalesce("known", F.lit(0))).alias("n_known"),
        F.lit(tokens).cast("long").alias("train_tokens"),
        (F.col("hot_score") + F.coalesce("base", F.lit(0.0))).alias("base_score"),
        "score",
        "n_bytes",
        (-F.col("score") * math.log2(10) / (F.col("n_bytes") + 1)).alias("bits_per_byte"),
    )


def op2_context_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = fold("doc_id", FOLDS) == 0
    return score(docs, ~held_out).withColumn("held_out", held_out)
