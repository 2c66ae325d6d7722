"""Operator 8, packing: windows filled by lexical retrieval.

Documents become token ids with an end id. Whole windows inside a long document stand alone;
what is left of each document enters the pool of its shard. Documents are dealt to shards by
content: the corpus is sorted by the commonest tokens of each that tell documents apart (a
hash of the ids breaks ties, so copies can be dealt to several tasks), and a shard is a run of
SHARD_DOCS documents of that order, with an inverted index of their tokens, weighted by BM25
with document frequencies of the whole corpus. Neighbours in other shards are not found; the
README says how many those are. A seed's unused neighbours, best first, fill its window;
the last one is cut where the window ends and its rest stays in the pool. What a shard cannot
fill is handed to the partition's next shard, and at the end of a partition split into
sequences of powers of two, which need no padding.

Null and empty texts are the end id alone. Repeated rows are packed once each. Every id lies
in exactly one piece; texts are never shortened. Only doc_id and text are read. Sequence ids
hold the number of the partition above bit 33 and are unique.
"""

from __future__ import annotations

import re
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from churnline.llm.common import table, written

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
WINDOW = 2048
END_ID = 1
SHARD_DOCS = 512
#: Tokens in the key that documents are sorted by.
KEY_TOKENS = 32
K1, B = 1.2, 0.75
#: Bytes that a worker keeps of remembered words and chunks, and the longest that it keeps.
CACHE_BYTES = 192_000_000
CACHE_CHARS = 48
#: Bytes of texts that are turned into ids together; a longer text goes alone.
SLICE_BYTES = 4_000_000

_PIECES = [("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())]
PIECES = ", ".join(f"{name} long" for name, _ in _PIECES)


#: Characters below U+0250 that have small letters beyond it.
_BEYOND = "".join(c for c in map(chr, range(0x250)) if max(c.lower()) > "\u024f")
#: What only the tokenizer itself knows: other characters and special tokens.
_FOREIGN = re.compile(f"[^\x00-\u024f]|[{_BEYOND}]|<\\|")
#: Stands in a row of ids where a chunk ends.
_CHUNK_END = 0xFFFFFFFF


def _word_pattern() -> re.Pattern:
    """Line feeds, and the tokenizer's words (short forms, letters, single digits, other marks) for characters below U+0250."""
    of = lambda kind: re.escape("".join(c for c in map(chr, range(0x250)) if unicodedata.category(c)[0] == kind))
    letter, number, space = of("L"), of("N"), "\t\n\x0b\x0c\r \x85\xa0"
    return re.compile(f"\n|[{letter}]+|[{number}]|'(?:s|t|re|ve|m|ll|d)|[^{space}{letter}{number}]+")


class Tokens:
    """Ids of the ``word_bpe`` file, put together from remembered words.

    That tokenizer drops white space and merges within words of its pattern only. So texts are
    cut into chunks at spaces and line feeds, and each distinct chunk of a slice of texts is
    looked at once: one below U+0250, also in lower case, is cut into words here, any other one
    goes through the tokenizer whole.
    """

    def __init__(self, path: str):
        self.whole = Tokenizer.from_file(path)
        self.model = self.whole.model
        self.pattern = _word_pattern()
        # Byte-level letters: printable bytes stand for themselves, the others follow from U+0100.
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        letter = {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in plain)}
        self.letters = {c: "".join(letter[b] for b in chr(c).encode()) for c in range(0x250)}
        self.words, self.chunks = Remembered(self._word, CACHE_BYTES * 3 // 4), Remembered(self._chunk, CACHE_BYTES // 4)

    def _word(self, word: str) -> bytes:
        if word == "\n":
            return _CHUNK_END.to_bytes(4, "little")
        # ASCII letters and digits stand for themselves.
        spelled = word if word.isascii() and word.isalnum() else word.translate(self.letters)
        found = self.model.tokenize(spelled)
        return b"".join([t.id.to_bytes(4, "little") for t in found])

    def _chunk(self, chunk: str) -> bytes:
        return np.array(self.whole.encode(chunk, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def of(self, text: str | None) -> np.ndarray:
        """Ids of the text, the end id last."""
        return np.frombuffer(self.of_all(pa.array([text], pa.string()), "<u4")[0].as_py(), dtype="<u4")

    def of_all(self, texts: pa.Array, kind: str) -> pa.Array:
        """Ids of each text, the end id last, as bytes of numbers of ``kind``."""
        parts, first = [], 0
        ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
        while first < len(texts):
            before = ends[first - 1] if first else 0
            last = max(first + 1, int(np.searchsorted(ends, before + SLICE_BYTES, side="right")))
            parts.append(self._slice(texts.slice(first, last - first), kind))
            first = last
        return pa.concat_arrays(parts) if parts else pa.array([], pa.binary())

    def _slice(self, texts: pa.Array, kind: str) -> pa.Array:
        texts = pc.fill_null(texts, "")
        # In other texts capitals may combine with what follows, or belong to a special token.
        plain = pc.and_not(pc.string_is_ascii(texts), pc.match_substring(texts, "<|"))
        texts = pc.if_else(plain, pc.ascii_lower(texts), texts)
        chunks = pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
        coded = chunks.flatten().dictionary_encode()
        stored, first, length = self._ids_of(coded.dictionary)
        # The end id is one more chunk of every text.
        stored, first, length = np.append(stored, END_ID).astype(kind), np.append(first, len(stored)), np.append(length, 1)
        text_ends = np.cumsum(pc.list_value_length(chunks).to_numpy(), dtype=np.int64)
        places = np.insert(coded.indices.to_numpy(), text_ends, len(first) - 1)
        counts = length[places]
        ends = np.cumsum(counts)
        ids = stored[np.arange(ends[-1]) + np.repeat(first[places] - (ends - counts), counts)]
        offsets = np.append(0, ends[text_ends + np.arange(len(text_ends))]) * ids.itemsize
        found = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(texts), [None, pa.py_buffer(offsets), pa.py_buffer(ids)])
        return found.cast(pa.binary())

    def _ids_of(self, chunks: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """A row of ids, and where in it those of each chunk start and how many they are."""

        def joined(of: pa.Array) -> str:
            return pc.binary_join(pa.ListArray.from_arrays([0, len(of)], of.cast(pa.string())), "\n")[0].as_py() + "\n"

        text, foreign = joined(chunks), {}
        if "<|" in text or not text.isascii() and _FOREIGN.search(text):
            foreign = {i: c for i, c in enumerate(text[:-1].split("\n")) if _FOREIGN.search(c)}
            mask = np.zeros(len(chunks), dtype=bool)
            mask[list(foreign)] = True
            text = joined(pc.if_else(pa.array(mask), "", chunks))
        words = self.pattern.findall(text.lower())
        stored = np.frombuffer(b"".join(map(self.words.__getitem__, words)), dtype="<u4")
        last = np.flatnonzero(stored == _CHUNK_END)
        first = np.append(0, last[:-1] + 1)
        length = last - first
        if foreign:
            own = [self.chunks[c] for c in foreign.values()]
            at, sizes = list(foreign), np.array([len(o) // 4 for o in own])
            first[at], length[at] = len(stored) + np.cumsum(sizes) - sizes, sizes
            stored = np.append(stored, np.frombuffer(b"".join(own), dtype="<u4"))
        return stored, first, length


class Remembered(dict):
    """Ids by word, made when first asked for; long ones are made anew each time.

    Two halves of ``bound`` bytes: a full one becomes the old one, from which words that are
    still in use come back.
    """

    def __init__(self, make, bound: int):
        super().__init__()
        self.make, self.half, self.held, self.old = make, bound // 2, 0, {}

    def __missing__(self, word: str) -> bytes:
        value = self.old.get(word)
        if value is None:
            value = self.make(word)
        if len(word) <= CACHE_CHARS:
            if self.held > self.half:
                self.old, self.held = dict(self), 0
                self.clear()
            self[word] = value
            # Two objects and their place in the table come to about 200 bytes.
            self.held += 200 + len(word) + len(value)
        return value


_KEPT: dict[str, Tokens] = {}


def tokens_of(path: str) -> Tokens:
    """The tokenizer of this worker, with what it remembers: a worker runs many tasks."""
    if path not in _KEPT:
        _KEPT[path] = Tokens(path)
    return _KEPT[path]


def tokenised(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """(doc_id, ids): ids as little-endian 16-bit numbers, 32-bit if the vocabulary needs it."""

    @F.arrow_udf("binary")
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tokens = tokens_of(vocabulary)
        kind = _kind(tokens.whole.get_vocab_size())
        for texts in batches:
            yield tokens.of_all(texts, kind)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), encode("text").alias("ids"))


def _kind(size: int) -> str:
    return "<u2" if size <= 1 << 16 else "<u4"


class Weights:
    """BM25 weights from corpus counts: one number per vocabulary entry."""

    def __init__(self, stored: DataFrame, size: int):
        kind = _kind(size)

        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            seen, docs, tokens = np.zeros(size, dtype=np.int64), 0, 0
            for batch in batches:
                for row in batch.column("ids"):
                    ids = np.frombuffer(row.as_py(), dtype=kind)
                    seen[np.unique(ids)] += 1
                    docs, tokens = docs + 1, tokens + len(ids)
            at = np.flatnonzero(seen)
            yield pa.RecordBatch.from_arrays([pa.array([-2, -1, *at.tolist()], pa.int64()), pa.array([docs, tokens, *seen[at].tolist()], pa.int64())], names=["token", "n"])

        # As many rows as the vocabulary has entries.
        totals = dict(stored.select("ids").mapInArrow(count, "token long, n long").groupBy("token").agg(F.sum("n").alias("n")).collect())
        docs = totals.get(-2, 0)
        df = np.zeros(size)
        for token, n in totals.items():
            if token >= 0:
                df[token] = n
        # Tokens of more than half of all documents say nothing.
        self.idf = np.maximum(0.0, np.log((docs - df + 0.5) / (df + 0.5))).astype(np.float32)
        # Place of each token from the commonest to the rarest.
        self.place = np.empty(size, dtype=np.uint32)
        self.place[np.argsort(-df, kind="stable")] = np.arange(size)
        self.mean_length = max(1.0, totals.get(-1, 0) / max(1, docs))


def by_content(stored: DataFrame, weights: Weights, kind: str) -> DataFrame:
    """``stored`` sorted over all partitions by what is left of each document beyond whole windows."""
    place, telling = weights.place, weights.idf > 0

    @F.arrow_udf("binary")
    def key(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for rows in batches:
            out = []
            for row in rows:
                ids = np.frombuffer(row.as_py(), dtype=kind)
                tail = np.unique(ids[len(ids) - len(ids) % WINDOW :])
                told = place[tail[telling[tail]]]
                if len(told) > KEY_TOKENS:
                    told = np.partition(told, KEY_TOKENS)[:KEY_TOKENS]
                out.append(np.sort(told).astype(">u4").tobytes())
            yield pa.array(out, pa.binary())

    order = ["content", "salt", "doc_id"]
    keyed = stored.withColumn("content", key("ids")).withColumn("salt", F.xxhash64("doc_id", "ids"))
    return keyed.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "ids")


class Index:
    """Inverted index of some token lists."""

    def __init__(self, lists: list[np.ndarray], weights: Weights):
        self.n, self.idf = len(lists), weights.idf
        found = [np.unique(ids, return_counts=True) for ids in lists]
        terms = np.concatenate([t for t, _ in found])
        tf = np.concatenate([c for _, c in found]).astype(np.float32)
        doc = np.repeat(np.arange(self.n), [len(t) for t, _ in found])
        length = np.array([len(ids) for ids in lists], dtype=np.float32)[doc]
        value = self.idf[terms] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * length / weights.mean_length))
        used = value > 0
        order = np.argsort(terms[used], kind="stable")
        self.doc, self.value = doc[used][order], value[used][order]
        self.terms, self.first = np.unique(terms[used][order], return_index=True)
        self.last = np.append(self.first[1:], len(order))
        self.queries = [t[self.idf[t] > 0] for t, _ in found]

    def scores(self, i: int) -> np.ndarray:
        """BM25 of all lists for the distinct tokens of list ``i``."""
        at = np.searchsorted(self.terms, self.queries[i])
        counts = self.last[at] - self.first[at]
        ends = np.cumsum(counts)
        if not len(ends) or not ends[-1]:
            return np.zeros(self.n)
        where = np.arange(ends[-1]) + np.repeat(self.first[at] - (ends - counts), counts)
        return np.bincount(self.doc[where], self.value[where], self.n)


def fill_windows(pool: list[list], weights: Weights, last: bool) -> tuple[list[list[tuple]], list[list]]:
    """Full windows of pieces (document, start, length) and what is left over.

    ``pool`` has [document, ids, start, end] of unpacked ends of documents, each shorter than
    a window. Unless it is the partition's last shard the seed that cannot be filled is left.
    """
    windows: list[list[tuple]] = []
    if not pool:
        return windows, []
    index = Index([ids[start:end] for _, ids, start, end in pool], weights)
    unused = np.ones(len(pool), dtype=bool)
    for seed in range(len(pool)):
        if not unused[seed]:
            continue
        room, pieces, taken = WINDOW, [], []
        scores = np.where(unused, index.scores(seed), -1.0)
        scores[seed] = np.inf
        while room and (best := int(np.argmax(scores))) >= 0 and scores[best] >= 0:
            entry = pool[best]
            take = min(room, entry[3] - entry[2])
            pieces.append((entry, entry[2], take))
            taken.append(best)
            scores[best] = -1.0
            room -= take
        if room and not last:
            break
        for entry, start, take in pieces:
            entry[2] = start + take
        unused[[i for i in taken if pool[i][2] == pool[i][3]]] = False
        windows.append(pieces)
    return windows, [pool[i] for i in np.flatnonzero(unused)]


def powers_of_two(pieces: list[tuple]) -> list[list[tuple]]:
    """A part-filled window as sequences whose lengths are powers of two, longest first."""
    rest = sum(p[2] for p in pieces)
    out, queue = [], list(pieces)
    while rest:
        room = 1 << (rest.bit_length() - 1)
        rest -= room
        sequence = []
        while room:
            entry, start, length = queue.pop(0)
            take = min(room, length)
            sequence.append((entry, start, take))
            if take < length:
                queue.insert(0, (entry, start + take, length - take))
            room -= take
        out.append(sequence)
    return out


def pack(docs: DataFrame, vocabulary: str = VOCABULARY, shard_docs: int = SHARD_DOCS) -> DataFrame:
    """One row per piece: where it lies in its document and in its sequence, with a checksum and its ids."""
    size = Tokenizer.from_file(vocabulary).get_vocab_size()
    kind = _kind(size)
    stored = written(tokenised(docs, vocabulary), "tokens")
    weights = Weights(stored, size)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 33
        pool: list[list] = []

        def rows(sequences: list[list[tuple]]) -> pa.RecordBatch:
            nonlocal number
            out, cut = [], []
            for pieces in sequences:
                offset = 0
                for (doc, ids, *_), start, length in pieces:
                    raw = ids[start : start + length].astype("<u4").tobytes()
                    out.append((doc, start, length, zlib.crc32(raw), len(ids), number, offset))
                    cut.append(raw)
                    offset += length
                number += 1
            columns = list(zip(*out)) or [()] * len(_PIECES)
            arrays = [pa.array(c, t) for c, (_, t) in zip(columns, _PIECES)]
            return pa.RecordBatch.from_arrays([*arrays, pa.array(cut, pa.binary())], names=[*(n for n, _ in _PIECES), "ids"])

        for batch in batches:
            alone: list[list[tuple]] = []
            for doc, raw in zip(batch.column("doc_id").to_pylist(), batch.column("ids")):
                ids = np.frombuffer(raw.as_py(), dtype=kind)
                entry = [doc, ids, len(ids) - len(ids) % WINDOW, len(ids)]
                alone += [[(entry, s, WINDOW)] for s in range(0, entry[2], WINDOW)]
                if entry[2] < entry[3]:
                    pool.append(entry)
                if len(pool) >= shard_docs:
                    windows, pool = fill_windows(pool, weights, last=False)
                    yield rows(alone + windows)
                    alone = []
            yield rows(alone)
        windows, _ = fill_windows(pool, weights, last=True)
        full = [w for w in windows if sum(p[2] for p in w) == WINDOW]
        tail = [s for w in windows if sum(p[2] for p in w) < WINDOW for s in powers_of_two(w)]
        yield rows(full + tail)

    return by_content(stored, weights, kind).mapInArrow(run, PIECES + ", ids binary")


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents")).drop("ids")
