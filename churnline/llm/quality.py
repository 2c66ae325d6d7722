"""Operator 9, quality rules: tokeniser fertility with rejection bands per language or script.

A public vocabulary measures each text: characters per token, share of byte-fallback tokens
and entropy of the tokens. Per language (the ``lang`` column, else the script most letters
belong to) the middle of each measure over all documents gives a band; a text outside any
band is rejected. Documents below MIN_WORDS words or with most words in repeated 3-word
windows are rejected by the base rules.

A band reaches some median absolute deviations from the median, by measure and side: junk of
sf0.1 that passes the base rules lies 3 to 13 below the middle of its characters per token.
Equal texts count once, so thousands of copies cannot narrow a band to themselves; FLOOR of
the median is the least deviation, below that of every language there. Byte fallback is so
rare that it has no spread; its band is a fixed width. Medians are read from counts per group
and bin, a group never meets in one task; a row of bins per text is shuffled for the copies.
A language with fewer than MIN_GROUP texts is judged by the band of its script, a script with
fewer by that of all texts; every text with words enough is judged, in a table of any size.

Null and empty texts have no words and fail the base rules. Repeated rows are judged alike.
Texts are read whole. All columns of the input pass through ``with_quality``.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from churnline.llm.common import free_name, table, written

VOCABULARY = public_tokenizers.path("piece_bpe_32k.model")
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MIN_GROUP = 30
FLOOR = 0.01
#: (measure, bin width, deviations below the median, above it, least half band as a number)
MEASURES = (("chars_per_token", 0.01, 5.0, 8.0, 0.0), ("byte_share", 0.001, 8.0, 8.0, 0.08), ("token_entropy", 0.02, 5.0, 8.0, 0.0))
CACHE = 500_000

_SYMBOLS = re.compile(r"[#*$%&|<>]")
_CHUNK = re.compile(r" *[^ \n]*\n?")
_LETTER = re.compile(r"[^\W\d_]")
_TYPES = [
    ("n_words", pa.int64()),
    ("word_chars", pa.int64()),
    ("n_symbols", pa.int64()),
    ("n_dup_lines", pa.int64()),
    ("n_repeat_words", pa.int64()),
    ("n_tokens", pa.int64()),
    ("chars_per_token", pa.float64()),
    ("byte_share", pa.float64()),
    ("token_entropy", pa.float64()),
    ("script", pa.string()),
]
_SCHEMA = ",".join(f"{n}:{'long' if t == pa.int64() else 'double' if t == pa.float64() else 'string'}" for n, t in _TYPES)


class Tokens:
    """Token ids of a text, put together from remembered chunks.

    No piece has a space after another character, and none holds a line feed, so a text's
    tokens are those of its chunks: spaces with the characters up to the next space or
    line feed. Only the text's first chunk gets the model's dummy space.
    """

    def __init__(self, path: str):
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.known: dict[str, bytes] = {}
        self.prefix = len(self.model.encode("\n"))  # of the dummy space before a line feed
        self.feed = np.array(self.model.encode("\n"), dtype=np.int32)[-1]
        self.is_byte = np.array([self.model.is_byte(i) for i in range(self.model.get_piece_size())])

    def _chunk(self, chunk: str) -> bytes:
        """Ids of ``chunk`` where it stands after a line feed or a word."""
        ids = self.known.get(chunk)
        if ids is None:
            if len(self.known) >= CACHE:
                self.known.clear()
            # After a line feed nothing merges across, so its own ids can be cut off.
            ids = self.known[chunk] = np.array(self.model.encode("\n" + chunk), dtype=np.int32)[self.prefix :].tobytes()
        return ids

    def of(self, text: str) -> np.ndarray:
        chunks = _CHUNK.findall(" " + text) if text else []
        return np.frombuffer(b"".join(map(self._chunk, chunks)), dtype=np.int32)


def script_of(text: str) -> str:
    """The script that most letters of the text belong to, NONE without letters."""
    if max(text, default="") < "ɐ":
        return "LATIN" if _LETTER.search(text) else "NONE"
    found: Counter[str] = Counter()
    for c, n in Counter(text).items():
        if c.isalpha():
            found["LATIN" if c < "ɐ" else unicodedata.name(c, "OTHER").split(" ")[0]] += n
    return min(found, key=lambda s: (-found[s], s)) if found else "NONE"


def repeated_words(words: list[bytes]) -> int:
    """Words in 3-word windows that occur twice or more, the first included."""
    if len(words) < 4:
        return 0
    windows = list(zip(words, words[1:], words[2:]))
    counts = Counter(windows)
    if len(counts) == len(windows):
        return 0
    many = np.fromiter((counts[w] > 1 for w in windows), dtype=bool, count=len(windows))
    covered = np.zeros(len(words), dtype=bool)
    for shift in range(3):
        covered[shift : shift + len(many)] |= many
    return int(covered.sum())


def base_measures(text: str) -> tuple[int, int, int, int, int]:
    raw = text.encode()
    words = raw.split()
    lines = [line for line in raw.split(b"\n") if line.strip()]
    # Code points are the bytes that do not continue one.
    joined = np.frombuffer(b"".join(words), dtype=np.uint8)
    chars = int(((joined & 0xC0) != 0x80).sum())
    return len(words), chars, len(_SYMBOLS.findall(text)), len(lines) - len(set(lines)), repeated_words(words)


def fertility(ids: np.ndarray, chars: int, is_byte: np.ndarray, feeds: int) -> tuple[int, float, float, float]:
    """(tokens, characters per token, share of byte tokens without line feeds, entropy in bits)."""
    if not len(ids):
        return 0, 0.0, 0.0, 0.0
    counts = np.unique(ids, return_counts=True)[1] / len(ids)
    return len(ids), chars / len(ids), (int(is_byte[ids].sum()) - feeds) / len(ids), float(-(counts * np.log2(counts)).sum())


def measures(vocabulary: str = VOCABULARY):
    """Column function: all measures of a text as one struct."""

    @F.arrow_udf(f"struct<{_SCHEMA}>")
    def measured(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tokens = Tokens(vocabulary)
        for texts in batches:
            rows = []
            for t in texts:
                text = t.as_py() or ""
                ids = tokens.of(text)
                feeds = int((ids == tokens.feed).sum())
                rows.append((*base_measures(text), *fertility(ids, len(text), tokens.is_byte, feeds), script_of(text)))
            columns = list(zip(*rows)) or [()] * len(_TYPES)
            yield pa.StructArray.from_arrays([pa.array(c, k) for c, (_, k) in zip(columns, _TYPES)], fields=[pa.field(*x) for x in _TYPES])

    return measured


def bands(measured: DataFrame, groups: list[str], same: str) -> DataFrame:
    """(group, texts, low and high of each measure) per value of the columns ``groups``.

    All texts of MIN_WORDS words count, once for each combination of groups they stand in
    (copies are told apart by ``same``). The first column must hold the narrowest groups and
    no value may stand in two columns for different groups.
    """
    long = measured.where(F.col("n_words") >= MIN_WORDS)
    texts = long.select(*groups, same, *[F.round(F.col(m) / w).cast("long").alias(m) for m, w, *_ in MEASURES]).distinct()
    bins = F.array(*[F.struct(F.lit(m).alias("measure"), F.col(m).alias("bin")) for m, *_ in MEASURES])
    counts = texts.select(*groups, F.explode(bins).alias("b")).groupBy(*groups, "b.measure", "b.bin").agg(F.count("*").alias("n"))
    # Wider groups are added up from the counts of the narrower ones.
    group = "group"
    counts = counts.select(F.explode(F.array_distinct(F.array(*groups))).alias(group), "measure", "bin", "n")
    counts = counts.groupBy(group, "measure", "bin").agg(F.sum("n").alias("n"))

    def middle(rows: DataFrame, value: str, out: str) -> DataFrame:
        by = [group, "measure"]
        running = F.sum("n").over(Window.partitionBy(*by).orderBy(value).rowsBetween(Window.unboundedPreceding, 0))
        total = F.sum("n").over(Window.partitionBy(*by))
        ranked = rows.withColumn("upto", running).withColumn("total", total)
        return ranked.where(F.col("upto") * 2 >= F.col("total")).groupBy(*by).agg(F.min(value).alias(out), F.max("total").alias(f"n_{out}"))

    # Bins are as many as the measures have values at their resolution, whatever the corpus.
    counts = written(counts, "bins")
    centre = middle(counts, "bin", "median")
    away = counts.join(centre, [group, "measure"]).select(group, "measure", F.abs(F.col("bin") - F.col("median")).alias("away"), "n")
    spread = middle(away.groupBy(group, "measure", "away").agg(F.sum("n").alias("n")), "away", "mad")
    both = centre.join(spread, [group, "measure"])
    sides = []
    for m, w, below, above, least in MEASURES:
        own, middle_ = F.col("measure") == m, F.col("median") * w
        # Half a bin more: values were rounded to bins.
        low, high = (F.greatest(n * F.greatest(F.col("mad") * w, FLOOR * middle_), F.lit(least)) + w / 2 for n in (below, above))
        sides += [F.max(F.when(own, middle_ - low)).alias(f"low_{m}"), F.max(F.when(own, middle_ + high)).alias(f"high_{m}")]
    return both.groupBy(group).agg(F.max("n_median").alias("texts"), *sides)


def base_failed(row: Column) -> Column:
    return (row["n_words"] < MIN_WORDS) | (100 * row["n_repeat_words"] > MAX_REPEAT_PERCENT * row["n_words"])


def with_quality(docs: DataFrame, column: str = "quality", keep: list[str] | None = None, vocabulary: str = VOCABULARY) -> DataFrame:
    """The columns ``keep`` of ``docs`` (all) and a struct ``column``: measures, base_failed, kept."""
    keep = docs.columns if keep is None else keep
    same = free_name(docs.select(*keep), "same_text")
    measured = written(docs.select(*keep, F.xxhash64("text").alias(same), measures(vocabulary)("text").alias(column)), "quality")
    script = F.concat(F.lit("script:"), F.col(f"{column}.script"))
    group = F.coalesce(F.concat(F.lit("lang:"), F.col("lang").cast("string")), script) if "lang" in keep else script
    rows = measured
    keys = []
    for name, value in (("band_group", group), ("band_script", script), ("band_all", F.lit("all"))):
        keys.append(free_name(rows, name))
        rows = rows.withColumn(keys[-1], value)
    limits = written(bands(rows.select(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)], F.col(same).alias("same"), f"{column}.*"), ["k0", "k1", "k2"], "same"), "bands")
    values = F.struct(*[c for c in limits.columns if c not in ("group", "texts")])
    band = free_name(rows, "band")
    found = []
    for i, key in enumerate(keys[:-1]):
        own = free_name(rows, f"{band}_{i}")
        # One short row per language or script with texts enough.
        enough = limits.where(F.col("texts") >= MIN_GROUP).select(F.col("group").alias(key), values.alias(own))
        rows = rows.join(F.broadcast(enough), key, "left")
        found.append(F.col(own))
    # The band of all texts, one row, stands in whatever their number.
    found = F.coalesce(*found, limits.where(F.col("group") == "all").select(values).scalar())
    rows = rows.withColumn(band, found)
    inside = F.lit(True)
    for m, *_ in MEASURES:
        inside = inside & F.col(f"{column}.{m}").between(F.col(f"{band}.low_{m}"), F.col(f"{band}.high_{m}"))
    failed = base_failed(F.col(column))
    kept = ~failed & F.coalesce(inside, F.lit(True))
    return rows.withColumn(column, F.col(column).withField("base_failed", failed).withField("kept", kept)).select(*keep, column)


def of_quality(docs: DataFrame) -> DataFrame:
    """The documents that are kept, all columns as they were."""
    column = free_name(docs, "quality")
    return with_quality(docs, column).where(f"{column}.kept").drop(column)


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = with_quality(table(spark, sf_dir, "documents"), keep=["doc_id", "lang"])
    return judged.select("doc_id", *[f"quality.{n}" for n, _ in _TYPES if n != "script"], "quality.base_failed", "quality.kept")
