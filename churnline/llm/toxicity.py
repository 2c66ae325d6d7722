"""Operator 3, toxicity: multiple-instance learning from document labels.

A sentence s has the evidence u(s), the weights of its distinct words, and p(s), by how much
sigmoid(bias + u(s)) exceeds sigmoid(bias), as a share of what is left: 0 without evidence.
The document has 1 - (1 - sigmoid(bias)) * product(1 - p(s)), the noisy-or of its sentences and
of one leak, so a text's length alone never convicts it. A word's weight is the sum over its
features: the word itself and its beginnings of 3 to 6 characters, so that inflected or
lengthened forms of an insult share what is learned. Weights are learned from document
labels alone, by gradient steps over all partitions of the training rows; afterwards p(s)
tells which sentences are to blame (``offending``).

Words are runs of letters, digits and non-ASCII characters, A-Z lower-cased. Training takes
TRAIN_ROWS labelled documents at most in expectation (a hash of the id picks them evenly),
each distinct text once, with the mean of its labels. Only features of MIN_DOCS documents
or more that stand with label 1 beyond chance (MIN_Z deviations) get a weight. Null ids or
labels are not learned from; several labels of one document count as toxic if any is.

Null and empty texts, and all without evidence however long, score sigmoid(bias). Without
training rows of both labels every text scores 0. An empty table gives no rows. Whole texts are scored, rows are never dropped or merged.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnline.llm.common import fold, free_name, table, written

TRAIN_ROWS = 20_000
MIN_DOCS = 5
MIN_Z = 4.0
BEGINNINGS = (3, 4, 5, 6)
STEPS = 40
RATE = 0.4
RIDGE = 1e-5
START_BIAS = -6.0
FOLDS = 5
CACHE = 500_000

_SENTENCE = re.compile(rb"[.!?\n]+")
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


def split_words(text: str | None) -> list[list[bytes]]:
    """The distinct words of each sentence that has any."""
    found = (_WORD.findall(s) for s in _SENTENCE.split((text or "").encode().lower()))
    return [list(dict.fromkeys(words)) for words in found if words]


def word_features(word: bytes) -> list[int]:
    """32-bit hashes of the word and of its beginnings."""
    chars = word.decode(errors="ignore")
    return [zlib.crc32(word), *(zlib.crc32(b"^" + chars[:k].encode()) for k in BEGINNINGS if len(chars) >= k)]


class Remembered(dict):
    """Values by word, made when first asked for; emptied at CACHE words."""

    def __init__(self, make):
        super().__init__()
        self.make = make

    def __missing__(self, word: bytes):
        if len(self) >= CACHE:
            self.clear()
        value = self[word] = self.make(word)
        return value


def training_rows(docs: DataFrame, labels: DataFrame, limit: int = TRAIN_ROWS) -> DataFrame:
    """(text, y) of the distinct labelled texts outside the held-out fold."""
    known = (
        labels.where("doc_id is not null and toxic is not null")
        .where(fold("doc_id", FOLDS) != 0)
        .groupBy("doc_id")
        .agg(F.max("toxic").cast("double").alias("y"))
    )
    n = known.count()
    if n > limit:
        known = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(1e6 * limit / n))
    # At most about ``limit`` ids and labels, as documented.
    texts = docs.select("doc_id", "text").where("text is not null").join(F.broadcast(known), "doc_id")
    one = texts.groupBy(F.xxhash64("text").alias("same")).agg(F.avg("y").alias("y"), F.first("text").alias("text"))
    return written(one.select("text", "y"), "toxicity")


def chosen_features(rows: DataFrame) -> list[int]:
    """Features that stand with label 1 more often than chance explains, in order."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Remembered(word_features)
        counts: dict[int, list[float]] = {}
        for batch in batches:
            for text, y in zip(batch.column("text").to_pylist(), batch.column("y").to_pylist()):
                words = {w for s in split_words(text) for w in s}
                for f in {f for w in words for f in features[w]}:
                    got = counts.setdefault(f, [0, 0.0])
                    got[0] += 1
                    got[1] += y
        if counts:
            columns = [pa.array(counts, pa.int64()), *(pa.array([v[i] for v in counts.values()], pa.float64()) for i in (0, 1))]
            yield pa.RecordBatch.from_arrays(columns, names=["f", "n", "pos"])

    total = rows.agg(F.count("*").alias("n"), F.sum("y").alias("pos")).first()
    if not total.n or not 0 < total.pos < total.n:
        return []
    rate = total.pos / total.n
    sums = rows.mapInArrow(counted, "f long, n double, pos double").groupBy("f").agg(F.sum("n").alias("n"), F.sum("pos").alias("pos"))
    z = (F.col("pos") - F.col("n") * rate) / F.sqrt(F.col("n") * (rate * (1 - rate)))
    # Bounded, as the training rows are.
    return sorted(r.f for r in sums.where((F.col("n") >= MIN_DOCS) & (z >= MIN_Z)).select("f").collect())


def compact(rows: DataFrame, features: list[int]) -> DataFrame:
    """(y, sentences, sentence, feature): per text, its sentences and where the features stand."""
    place = {f: i for i, f in enumerate(features)}

    def reduced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places = Remembered(lambda w: [place[f] for f in word_features(w) if f in place])
        for batch in batches:
            sizes, sentences, found = [], [], []
            for text in batch.column("text").to_pylist():
                split = split_words(text)
                hits = [(i, f) for i, words in enumerate(split) for w in words for f in places[w]]
                sizes.append(len(split))
                sentences.append([i for i, _ in hits])
                found.append([f for _, f in hits])
            kinds = pa.list_(pa.int32())
            columns = [batch.column("y"), pa.array(sizes, pa.int32()), pa.array(sentences, kinds), pa.array(found, kinds)]
            yield pa.RecordBatch.from_arrays(columns, names=["y", "sentences", "sentence", "feature"])

    return written(rows.mapInArrow(reduced, "y double, sentences int, sentence array<int>, feature array<int>"), "toxicity")


def _sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _gradient(compacted: DataFrame, weights: np.ndarray) -> np.ndarray:
    """Sum over all rows of the slope of the log loss, by weight; the bias last."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(weights))
        for b in batches:
            y = b.column("y").to_numpy(zero_copy_only=False)
            sizes = b.column("sentences").to_numpy(zero_copy_only=False).astype(np.int64)
            hits = np.diff(b.column("sentence").offsets.to_numpy())
            first = np.cumsum(sizes) - sizes
            at = b.column("sentence").flatten().to_numpy() + np.repeat(first, hits)
            feature = b.column("feature").flatten().to_numpy()
            # Sentences without evidence add nothing, so only those that hold a feature are looked at.
            met, at = np.unique(at, return_inverse=True)
            doc = np.searchsorted(np.cumsum(sizes), met, side="right")
            u = np.bincount(at, weights[feature], len(met))
            p, leak = _sigmoid(weights[-1] + u), _sigmoid(weights[-1])
            counts = u >= 0  # at 0 too, where all weights start
            clean = np.bincount(doc, np.where(counts, np.log1p(-p) - np.log1p(-leak), 0.0), len(y)) + np.log1p(-leak)
            whole = np.maximum(-np.expm1(clean), 1e-12)
            slope = (1 - y) - y * (1 - whole) / whole
            total[:-1] += np.bincount(feature, np.where(counts, p * slope[doc], 0.0)[at], len(weights) - 1)
            total[-1] += (np.where(counts, p - leak, 0.0) * slope[doc]).sum() + leak * slope.sum()
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()])], names=["part"])

    # One vector per partition of the bounded training rows.
    return sum(np.frombuffer(r.part, np.float64) for r in compacted.mapInArrow(work, "part binary").collect())


def train(rows: DataFrame) -> dict[int, float] | None:
    """Weight by feature, the bias under -1; None without both labels."""
    n, pos = rows.agg(F.count("*"), F.sum("y")).first()
    if not n or not 0 < pos < n:
        return None
    features = chosen_features(rows)
    compacted = compact(rows, features)
    weights = np.append(np.zeros(len(features)), START_BIAS)
    mean, square = np.zeros_like(weights), np.zeros_like(weights)
    for step in range(1, STEPS + 1):
        slope = _gradient(compacted, weights) / n + RIDGE * np.append(weights[:-1], 0.0)
        mean = 0.8 * mean + 0.2 * slope
        square = 0.95 * square + 0.05 * slope * slope
        move = (mean / (1 - 0.8**step)) / (np.sqrt(square / (1 - 0.95**step)) + 1e-8)
        weights = weights - RATE * min(1.0, 2 * (1 - step / (STEPS + 1))) * move
    return dict(zip(features, weights[:-1].tolist())) | {-1: float(weights[-1])}


def log_clean(weights: dict[int, float], by_word: Remembered, sentences: list[list[bytes]]) -> list[float]:
    """ln(1 - p(s)) of each sentence."""
    get, bias = by_word.__getitem__, weights[-1]
    softplus = lambda z: math.log1p(math.exp(max(-30.0, min(30.0, z))))
    neutral = softplus(bias)
    return [neutral - softplus(bias + u) if (u := sum(map(get, words))) > 0 else 0.0 for words in sentences]


def _by_word(weights: dict[int, float]) -> Remembered:
    return Remembered(lambda word: sum(weights.get(f, 0.0) for f in word_features(word)))


def scorer(weights: dict[int, float] | None):
    """Column function: score of a text, from 0 to 1. The weights' number is bounded by the training rows."""

    @F.arrow_udf("double")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        by_word = _by_word(weights or {})
        for texts in batches:
            out = []
            for t in texts:
                clean = 0.0
                if weights is not None:
                    clean = math.log1p(-_sigmoid(weights[-1])) + sum(log_clean(weights, by_word, split_words(t.as_py())))
                out.append(max(0.0, -math.expm1(clean)))
            yield pa.array(out, pa.float64())

    return score


def offending(docs: DataFrame, weights: dict[int, float] | None, least: float = 0.5) -> DataFrame:
    """(doc_id, sentence number, sentence, score) of the sentences that score ``least`` or more."""
    kind = pa.list_(pa.struct([("number", pa.int32()), ("sentence", pa.string()), ("score", pa.float64())]))

    @F.arrow_udf("array<struct<number:int,sentence:string,score:double>>")
    def located(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        by_word = _by_word(weights or {})
        for texts in batches:
            rows = []
            for t in texts:
                found = []
                for number, s in enumerate(_SENTENCE.split((t.as_py() or "").encode()) if weights is not None else []):
                    if split := split_words(s.decode(errors="replace")):
                        p = -math.expm1(log_clean(weights, by_word, split)[0])
                        if p >= least:
                            found.append({"number": number, "sentence": s.decode(errors="replace"), "score": p})
                rows.append(found)
            yield pa.array(rows, kind)

    return docs.select("doc_id", F.explode(located("text")).alias("s")).select("doc_id", "s.*")


def fitted(docs: DataFrame, labels: DataFrame) -> dict[int, float] | None:
    return train(training_rows(docs, labels))


def without_toxic(docs: DataFrame, labels: DataFrame, limit: float = 0.5) -> DataFrame:
    """The documents that score below ``limit``, all columns kept."""
    name = free_name(docs, "score")
    return docs.withColumn(name, scorer(fitted(docs, labels))("text")).where(F.col(name) < limit).drop(name)


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels")
    scored = docs.select("doc_id", (fold("doc_id", FOLDS) == 0).alias("held_out"), scorer(fitted(docs, labels))("text").alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
