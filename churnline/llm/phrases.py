"""Operator 11, phrase collocation mining: Toivonen's sample, border and full passes.

A sample of the documents (one in SAMPLE, by a hash) proposes words and word pairs that it
holds SAMPLE_LEAST times. A full pass then counts, over all texts, what is proposed and its
negative border: all words, the pairs of two proposed words and the triples of two proposed
pairs, so a phrase outside the proposals is counted as soon as its parts are inside. Words and
pairs of the border that turn out frequent are border failures: they join the proposals, and a
further pass counts the phrases that become reachable thereby and those only, until no failure
is left. These passes count 64-bit hashes, so a figure is never too low, and too high only
where hashes meet. A last pass counts exactly, as text, whatever reached LEAST by its hash.
Every frequent phrase is among them, whatever the sample and the hashes.

Proposals and survivors are kept as bits by hash, of a fixed size (2^FILTER_BITS). Two phrases
with one bit only mean that more is counted; the order of passes uses the same bits
throughout, so nothing is counted twice.

Texts of one language form one stream with breaks between pieces and texts. It is read in
blocks of BLOCK_BYTES, the last words of a block carried over, so very long texts need no more
memory than their own bytes. Counts are summed per block, per task and then by key.

Scores need the counts of a phrase's parts. Parts that make up one in HOT_SHARE of all words or
more (3 * HOT_SHARE at most) are sent along, the others joined. All figures are integers, with
products as 38-digit decimals.

Null and empty texts have no words. A null language is ``und``. Repeated rows count as often as
they occur. Equal scores and counts are ordered by the phrase's bytes. Only text, lang and
doc_id (sampling only, may be null) are read. An empty table, or no phrase of LEAST
occurrences, gives no rows.
"""

from __future__ import annotations

import string
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from churnline.llm.common import table, written

LEAST = 10
#: A longer phrase with this share (percent) of a phrase's occurrences replaces it.
ABSORBED = 50
TOP = 2000
SAMPLE = 8
SAMPLE_LEAST = 2
FILTER_BITS = 25
BLOCK_BYTES = 3_000_000
HOT_SHARE = 1 << 16
RANK_PARTS = 64
NO_LANG = "und"

_BREAK = b"\n"  # stands for all that ends a piece, so it is in no word
_TABLE = bytes.maketrans(string.ascii_uppercase.encode() + b".,;:!?\x0b\x0c\r\t", string.ascii_lowercase.encode() + _BREAK * 9 + b" ")


# ---- hashes and bits ---------------------------------------------------------------------


def _mixed(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Hash of a phrase from those of its beginning and its last word."""
    x = first * np.uint64(0x9E3779B97F4A7C15) ^ (second + np.uint64(0x7F4A7C15)) * np.uint64(0xC2B2AE3D27D4EB4F)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return x ^ x >> np.uint64(32)


def _word_hashes(words: list[bytes], lang: str) -> np.ndarray:
    seed = xxhash.xxh32_intdigest(lang)
    return np.fromiter((xxhash.xxh64_intdigest(w, seed) for w in words), np.uint64, len(words))


def _keys(hashes: np.ndarray, size: int) -> pa.Array:
    """Hashes as keys: the two lowest bits say how many words the phrase has."""
    return pa.array((hashes & ~np.uint64(3) | np.uint64(size)).view(np.int64))


class Bits:
    """Sets of words, pairs and triples, each as 2^``bits`` bits by the leading bits of the hash."""

    def __init__(self, bits: int, sets: list[np.ndarray]):
        self.bits, self.sets = bits, sets

    @staticmethod
    def of(keys: DataFrame, bits: int) -> Bits:
        """The bits of a table's ``key``; one row for 64 bits of a set at most comes to the driver."""
        at = F.shiftrightunsigned("key", 64 - bits)
        cells = keys.groupBy(F.pmod("key", F.lit(4)).alias("size"), F.shiftright(at, 6).alias("cell"))
        rows = cells.agg(F.bit_or(F.expr(f"shiftleft(1L, int(shiftrightunsigned(key, {64 - bits}) & 63))")).alias("bits")).toArrow()
        size, cell, held = (rows.column(i).to_numpy() for i in range(3))
        sets = []
        for n in (1, 2, 3):
            found = np.zeros((1 << bits) // 64, dtype=np.uint64)
            found[cell[size == n]] = held[size == n].view(np.uint64)
            sets.append(found)
        return Bits(bits, sets)

    def has(self, hashes: np.ndarray, size: int) -> np.ndarray:
        at = hashes >> np.uint64(64 - self.bits)
        return (self.sets[size - 1][at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1) == 1

    def joined(self, other: Bits) -> Bits:
        return Bits(self.bits, [a | b for a, b in zip(self.sets, other.sets)])

    def parts(self) -> Bits:
        """Only words and pairs."""
        return Bits(self.bits, self.sets[:2])

    def covers_parts(self, other: Bits) -> bool:
        """Whether all words and pairs of ``other`` are in here."""
        return not any((b & ~a).any() for a, b in zip(self.parts().sets, other.parts().sets))


# ---- reading texts -----------------------------------------------------------------------


def _streams(batches: Iterator[pa.RecordBatch], block_bytes: int) -> Iterator[tuple[str, int, bytes]]:
    """(language, carried, text) in blocks; later blocks of a text begin with up to two carried tokens."""
    waiting: dict[str, list[bytes]] = {}
    held = 0
    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").cast(pa.binary())):
            data = text.as_py().translate(_TABLE)
            if len(data) > block_bytes:
                yield from _pieces(lang, data, block_bytes)
                continue
            waiting.setdefault(lang, []).append(data)
            held += len(data)
            if held > block_bytes:
                for name in list(waiting):
                    yield name, 0, _BREAK.join(waiting.pop(name))
                held = 0
    for name in list(waiting):
        yield name, 0, _BREAK.join(waiting.pop(name))


def _pieces(lang: str, data: bytes, block_bytes: int) -> Iterator[tuple[str, int, bytes]]:
    """A long text in blocks, cut between words; the last two tokens are carried over."""
    start, carried = 0, []
    while start < len(data):
        end = start + block_bytes
        cuts = [at for mark in (b" ", _BREAK) if (at := data.find(mark, end)) >= 0]
        end = min(cuts, default=len(data))
        yield lang, len(carried), b" ".join([*carried, data[start:end]])
        # The last two tokens lie behind the third mark from the end, or further on.
        at, last = end, []
        while len(last) < 2 and at > start:
            at = max(start, data.rfind(b" ", start, at), data.rfind(_BREAK, start, at))
            last = data[at:end].replace(_BREAK, b" \n ").split(b" ")
            last = [t for t in last if t]
        carried, start = (carried + last)[-2:], end


def _tokens(data: bytes) -> pa.DictionaryArray:
    """The words and breaks of a block, in order."""
    spaced = pa.array([data.replace(_BREAK, b" \n ")], pa.large_binary())
    found = pc.split_pattern(spaced, b" ").flatten()
    return found.filter(pc.greater(pc.binary_length(found), 0)).dictionary_encode()


class Block:
    """Distinct words of a block, the codes of its places, and its runs of two and three words."""

    def __init__(self, lang: str, carried: int, data: bytes):
        found = _tokens(data)
        self.words = found.dictionary
        codes = found.indices.to_numpy(zero_copy_only=False).astype(np.int32)
        stop = self.words.index(pa.scalar(_BREAK, self.words.type)).as_py()
        self.counts = np.bincount(codes[carried:], minlength=len(self.words))
        if stop >= 0:
            self.counts[stop] = 0
        self.hashes = _word_hashes(self.words.to_pylist(), lang)
        word = codes != stop
        first = max(0, carried - 1)
        pair = word[:-1] & word[1:]
        self.left, self.right = codes[:-1], codes[1:]
        # Pairs and triples that end before the first new word were counted with the block before.
        pair[:first] = False
        self.pair = np.flatnonzero(pair)
        inside = word[:-2] & word[1:-1] & word[2:]
        inside[: max(0, carried - 2)] = False
        self.triple = np.flatnonzero(inside)

    def phrases(self, *codes: np.ndarray) -> pa.Array:
        """The phrases of words with these codes, space-joined."""
        parts = [self.words.take(pa.array(c)) for c in codes]
        return pc.binary_join_element_wise(*parts, pa.scalar(b" ", self.words.type)) if len(parts) > 1 else parts[0]

    def hashes_of(self, *codes: np.ndarray) -> np.ndarray:
        found = self.hashes[codes[0]]
        for more in codes[1:]:
            found = _mixed(found, self.hashes[more])
        return found

    def pairs_by_place(self) -> tuple[np.ndarray, np.ndarray]:
        """For each place the code of its pair, and the hashes of these pairs."""
        codes, distinct = pd.factorize(self.left.astype(np.int64) * len(self.words) + self.right)
        return codes, self.hashes_of(distinct // len(self.words), distinct % len(self.words)) if len(distinct) else self.hashes[:0]

    def distinct_pairs(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Both words and the count of the distinct pairs that begin at ``at``."""
        keys = self.left[at].astype(np.int64) * len(self.words) + self.right[at]
        codes, distinct = pd.factorize(keys)
        return distinct // len(self.words), distinct % len(self.words), np.bincount(codes, minlength=len(distinct))

    def distinct_triples(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        n = len(self.words)
        codes, pairs = pd.factorize(self.left[at].astype(np.int64) * n + self.right[at])
        keys, distinct = pd.factorize(codes.astype(np.int64) * n + self.right[at + 1])
        pair = pairs[distinct // n] if len(distinct) else distinct
        return pair // n, pair % n, distinct % n, np.bincount(keys, minlength=len(distinct))


def _given(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce("lang", F.lit(NO_LANG)).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))


# ---- passes ------------------------------------------------------------------------------

_HASHED = "key long, n long"
_COUNTS = "lang string, size int, phrase string, n long"


def _hashed(block: Block, size: int, codes: list[np.ndarray], n: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([_keys(block.hashes_of(*codes), size), pa.array(n.astype(np.int64))], names=["key", "n"])


def _summed(docs: DataFrame, work, least: int) -> DataFrame:
    counted = _given(docs).mapInArrow(work, _HASHED).groupBy("key").agg(F.sum("n").alias("n"))
    return counted.where(F.col("n") >= least)


def sampled_proposals(docs: DataFrame, sample: int, least: int, block_bytes: int) -> DataFrame:
    """(key, n) of the words and pairs that the sampled documents hold ``least`` times."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, carried, data in _streams(batches, block_bytes):
            block = Block(lang, carried, data)
            here = np.flatnonzero(block.counts)
            yield _hashed(block, 1, [here], block.counts[here])
            left, right, n = block.distinct_pairs(block.pair)
            yield _hashed(block, 2, [left, right], n)

    # Copies share a text but not an id, so a group of them is drawn from, not drawn as one.
    drawn = F.pmod(F.xxhash64("doc_id", "text"), F.lit(sample)) == 0
    return _summed(docs.where(drawn), work, least)


def full_pass(docs: DataFrame, proposed: Bits, counted: Bits | None, least: int, block_bytes: int) -> DataFrame:
    """(key, n) of the phrases with ``least`` occurrences that ``proposed`` reaches and ``counted`` did not.

    The first pass, without ``counted``, adds all words.
    """
    shared = docs.sparkSession.sparkContext.broadcast((proposed, counted))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        new, old = shared.value
        for lang, carried, data in _streams(batches, block_bytes):
            block = Block(lang, carried, data)
            if old is None:
                here = np.flatnonzero(block.counts)
                yield _hashed(block, 1, [here], block.counts[here])
            # Breaks are in no pair, whatever their bit says.
            inside = new.has(block.hashes, 1)
            reached = inside[block.left] & inside[block.right]
            if old is not None:
                before = old.has(block.hashes, 1)
                reached &= ~(before[block.left] & before[block.right])
            left, right, n = block.distinct_pairs(block.pair[reached[block.pair]])
            yield _hashed(block, 2, [left, right], n)
            codes, hashes = block.pairs_by_place()
            inside = new.has(hashes, 2)[codes]
            at = block.triple
            reached = inside[at] & inside[at + 1]
            if old is not None:
                before = old.has(hashes, 2)[codes]
                reached &= ~(before[at] & before[at + 1])
            *abc, n = block.distinct_triples(at[reached])
            yield _hashed(block, 3, abc, n)

    found = written(_summed(docs, work, least), "hashed")
    shared.destroy()
    return found


def exact_pass(docs: DataFrame, survivors: Bits, least: int, block_bytes: int) -> DataFrame:
    """(lang, size, phrase, n) of the phrases with ``least`` occurrences among ``survivors``; size 0 is all words of a language."""
    shared = docs.sparkSession.sparkContext.broadcast(survivors)

    def rows(lang: str, size: int, phrases: pa.Array, n: np.ndarray) -> pa.RecordBatch:
        phrases = phrases.cast(pa.binary()).cast(pa.string())
        columns = [pa.repeat(lang, len(n)), pa.repeat(pa.scalar(size, pa.int32()), len(n)), phrases, pa.array(n.astype(np.int64))]
        return pa.RecordBatch.from_arrays(columns, names=["lang", "size", "phrase", "n"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = shared.value
        for lang, carried, data in _streams(batches, block_bytes):
            block = Block(lang, carried, data)
            yield rows(lang, 0, pa.array([b""], pa.binary()), np.array([block.counts.sum()]))
            here = np.flatnonzero((block.counts > 0) & held.has(block.hashes, 1))
            yield rows(lang, 1, block.phrases(here), block.counts[here])
            codes, hashes = block.pairs_by_place()
            inside = held.has(hashes, 2)[codes]
            left, right, n = block.distinct_pairs(block.pair[inside[block.pair]])
            yield rows(lang, 2, block.phrases(left, right), n)
            # A frequent triple has two frequent pairs.
            at = block.triple
            *abc, n = block.distinct_triples(at[inside[at] & inside[at + 1]])
            kept = held.has(block.hashes_of(*abc), 3)
            yield rows(lang, 3, block.phrases(*[c[kept] for c in abc]), n[kept])

    sums = _given(docs).mapInArrow(work, _COUNTS).groupBy("lang", "size", "phrase").agg(F.sum("n").alias("n"))
    return sums.where((F.col("n") >= least) | (F.col("size") == 0))


def survivors(docs: DataFrame, least: int, sample: int, sample_least: int, filter_bits: int, block_bytes: int) -> Bits:
    """Bits of all phrases that may be frequent: passes until the border has no failures."""
    proposed = Bits.of(sampled_proposals(docs, sample, sample_least, block_bytes), filter_bits).parts()
    counted, found = None, None
    while True:
        new = Bits.of(full_pass(docs, proposed, counted, least, block_bytes), filter_bits)
        found = new if found is None else found.joined(new)
        if proposed.covers_parts(new):
            return found
        counted, proposed = proposed, proposed.joined(new.parts())


def frequent_phrases(
    docs: DataFrame, least: int = LEAST, sample: int = SAMPLE, sample_least: int = SAMPLE_LEAST, filter_bits: int = FILTER_BITS, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """(lang, size, phrase, n) of all phrases of up to three words with ``least`` occurrences; size 0 is all words of a language."""
    return exact_pass(docs, survivors(docs, least, sample, sample_least, filter_bits, block_bytes), least, block_bytes)


# ---- collocations ------------------------------------------------------------------------


def _with_part_counts(asked: DataFrame, counts: DataFrame, words: int) -> DataFrame:
    """``asked`` with the count ``f`` of (lang, part)."""
    parts = counts.select("lang", F.col("phrase").alias("part"), F.col("n").alias("f"))
    hot = F.col("f") >= max(1, -(-words // HOT_SHARE))
    by = ["lang", "part"]
    # A part this frequent makes up one in HOT_SHARE of all words: 3 * HOT_SHARE rows at most, one set for each size.
    marked = asked.join(F.broadcast(parts.where(hot).select(*by, "f")), by, "left")
    rare = marked.where("f is null").drop("f").join(parts.where(~hot), by)
    return marked.where("f is not null").unionByName(rare)


def _score(a: Column, left: Column, right: Column) -> Column:
    whole = lambda c: c.cast("decimal(19,0)")
    return F.call_function("div", F.lit(1_000_000).cast("decimal(7,0)") * (whole(a) * whole(a)).cast("decimal(31,0)"), whole(left) * whole(right))


def collocations(docs: DataFrame, top: int = TOP, least: int = LEAST, **passes: int) -> DataFrame:
    """The ``top`` phrases of each language: lang, rank, phrase, a, l, r, n, score; ``passes`` as for ``frequent_phrases``."""
    counts = written(frequent_phrases(docs, least, **passes), "frequent")
    totals = counts.where("size = 0").select("lang", F.col("n").alias("words"))
    all_words = totals.agg(F.coalesce(F.sum("words"), F.lit(0))).first()[0]
    w = F.split("phrase", " ")
    joined = lambda *at: F.concat_ws(" ", *[F.get(w, F.lit(i)) for i in at])
    part = lambda side, value: F.struct(F.lit(side).alias("side"), value.alias("part"))
    two = F.array(part("l1", joined(0)), part("r1", joined(1)))
    three = F.array(part("l1", joined(0)), part("r1", joined(1, 2)), part("l2", joined(0, 1)), part("r2", joined(2)))
    candidates = counts.where("size > 1")
    asked = candidates.select("lang", "phrase", F.col("n").alias("a"), F.explode(F.when(F.col("size") == 2, two).otherwise(three)).alias("p"))
    asked = _with_part_counts(asked.select("lang", "phrase", "a", "p.side", "p.part"), counts.where("size in (1, 2)"), all_words)
    of_parts = asked.select("lang", "phrase", "a", *[F.when(F.col("side") == s, F.col("f")).alias(s) for s in ("l1", "r1", "l2", "r2")], F.lit(None).cast("long").alias("longer"))
    none = F.lit(None).cast("long")
    # What the longest phrase around a pair has.
    around = counts.where("size = 3").select("lang", F.explode(F.array(joined(0, 1), joined(1, 2))).alias("phrase"), *[none.alias(c) for c in ("a", "l1", "r1", "l2", "r2")], F.col("n").alias("longer"))
    facts = of_parts.unionByName(around).groupBy("lang", "phrase").agg(*[F.max(c).alias(c) for c in ("a", "l1", "r1", "l2", "r2", "longer")])
    facts = facts.where(F.col("longer").isNull() | (100 * F.col("longer") < ABSORBED * F.col("a")))
    cut = lambda k: F.struct(_score(F.col("a"), F.col(f"l{k}"), F.col(f"r{k}")).alias("score"), F.lit(k).alias("k"), F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r"))
    scored = facts.select("lang", "phrase", "a", F.when(F.col("l2").isNull(), cut(1)).otherwise(F.least(cut(1), cut(2))).alias("cut"))
    scored = scored.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # The best of each part of a language first, so that no task ranks a whole language.
    piece = F.pmod(F.xxhash64("phrase"), F.lit(RANK_PARTS))
    best = scored.withColumn("rank", F.row_number().over(Window.partitionBy("lang", piece).orderBy(*order))).where(F.col("rank") <= top)
    ranked = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    # One row per language.
    return ranked.join(F.broadcast(totals), "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", F.col("words").alias("n"), "score"
    )


def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


OP11_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
    unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), split AS (
  SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda w: w <> '') AS w FROM pieces
), places AS (
  SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM split
), counts AS (
  SELECT lang, size, phrase, count(*) AS f FROM (
    SELECT lang, 1 AS size, w[i] AS phrase FROM places
    UNION ALL SELECT lang, 2, w[i] || ' ' || w[i + 1] FROM places WHERE i + 1 <= len(w)
    UNION ALL SELECT lang, 3, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] FROM places WHERE i + 2 <= len(w)
  ) GROUP BY ALL
), totals AS (
  SELECT lang, sum(f)::BIGINT AS n FROM counts WHERE size = 1 GROUP BY lang
), cand AS (
  SELECT lang, size, phrase, f AS a, string_split(phrase, ' ') AS w FROM counts WHERE size > 1 AND f >= 10
), cuts AS (
  SELECT lang, phrase, a, 1 AS k, w[1] AS lp, array_to_string(w[2:], ' ') AS rp FROM cand
  UNION ALL SELECT lang, phrase, a, 2, w[1] || ' ' || w[2], w[3] FROM cand WHERE size = 3
), scored AS (
  SELECT c.lang, c.phrase, c.a, c.k, x.f AS l, y.f AS r,
    ((1000000::HUGEINT * c.a * c.a) // (x.f::HUGEINT * y.f))::BIGINT AS score
  FROM cuts c JOIN counts x ON x.lang = c.lang AND x.phrase = c.lp JOIN counts y ON y.lang = c.lang AND y.phrase = c.rp
), best AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), longer AS (
  SELECT lang, part, max(a) AS top FROM (
    SELECT lang, w[1] || ' ' || w[2] AS part, a FROM cand WHERE size = 3
    UNION ALL SELECT lang, w[2] || ' ' || w[3], a FROM cand WHERE size = 3
  ) GROUP BY lang, part
), kept AS (
  SELECT b.* FROM best b LEFT JOIN longer o ON o.lang = b.lang AND o.part = b.phrase WHERE o.top IS NULL OR 100 * o.top < 50 * b.a
)
SELECT k.lang, row_number() OVER (PARTITION BY k.lang ORDER BY k.score DESC, k.a DESC, encode(k.phrase)) AS rank, k.phrase, k.a, k.l, k.r, t.n, k.score
FROM kept k JOIN totals t ON t.lang = k.lang
QUALIFY rank <= 2000
"""
