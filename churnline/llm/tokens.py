"""Operator 4, token counts: count-only Viterbi over a unigram vocabulary.

An Aho-Corasick automaton lists the vocabulary's matches in a word; dynamic programming
over their ends carries the best score with its number of pieces, and no path. The rules
are those of the ``tokenizers`` unigram model: candidates for a place come by rising start,
a later one must be better to replace the first; a character without a piece of its own
also stands as an unknown at ten below the least score; neighbouring unknowns are one token.

Texts are cut as that library's Metaspace does it: spaces become U+2581, one is put before
the text if it has none, each starts a word. Counts are of whole texts; equal words are
counted once per task and remembered. Null and empty texts have no tokens and score 0.
Repeated rows count alike; other columns of the input are not touched.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import ahocorasick
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnline.llm.common import table

VOCABULARY = public_tokenizers.path("piece_bpe_32k.model")
UNKNOWN_PENALTY = 10.0
CACHE = 500_000
MARK = "▁"


def unigram_vocabulary(path: str = VOCABULARY) -> list[tuple[str, float]]:
    """(piece, log probability): the public pieces by rank r, with weight 1 / (r + 2.7).

    The file ranks its pieces but has no probabilities; the rank law stands in for them.
    The first entry is the unknown piece.
    """
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    plain = [i for i in range(model.get_piece_size()) if not (model.is_unknown(i) or model.is_control(i) or model.is_byte(i))]
    total = math.log(sum(1 / (r + 2.7) for r in range(len(plain))))
    pieces = {model.id_to_piece(i): -math.log(r + 2.7) - total for r, i in enumerate(plain)}
    return [("<unk>", 0.0), *pieces.items()]


class Counter:
    """Best score, number of tokens and of unknown tokens under a unigram vocabulary."""

    def __init__(self, vocabulary: list[tuple[str, float]], unknown: int = 0):
        self.automaton = ahocorasick.Automaton()
        for piece, score in vocabulary:
            if piece:
                self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.unknown = min(s for _, s in vocabulary) - UNKNOWN_PENALTY
        self.known: dict[str, tuple[float, int, int]] = {}

    def word(self, word: str) -> tuple[float, int, int]:
        got = self.known.get(word)
        if got is None:
            if len(self.known) >= CACHE:
                self.known.clear()
            got = self.known[word] = self._viterbi(word)
        return got

    def _viterbi(self, word: str) -> tuple[float, int, int]:
        n = len(word)
        # Longer matches of an end come first, so starts rise.
        ending: list[list[tuple[int, float]]] = [[] for _ in range(n)]
        for end, match in self.automaton.iter(word):
            ending[end].append(match)
        scores, tokens, unknowns, open_ = [0.0], [0], [0], [False]
        for end in range(n):
            best, start, is_unknown = None, 0, False
            single = False
            for length, score in ending[end]:
                candidate = score + scores[end + 1 - length]
                if best is None or candidate > best:
                    best, start = candidate, end + 1 - length
                single = single or length == 1
            if not single:
                candidate = self.unknown + scores[end]
                if best is None or candidate > best:
                    best, start, is_unknown = candidate, end, True
            grown = not (is_unknown and open_[start])
            scores.append(best)
            tokens.append(tokens[start] + grown)
            unknowns.append(unknowns[start] + (is_unknown and grown))
            open_.append(is_unknown)
        return scores[n], tokens[n], unknowns[n]

    def text(self, text: str | None) -> tuple[float, int, int]:
        if not text:
            return 0.0, 0, 0
        marked = text.replace(" ", MARK)
        marked = marked if marked.startswith(MARK) else MARK + marked
        score, tokens, unknowns = 0.0, 0, 0
        for part in marked.split(MARK)[1:]:
            s, t, u = self.word(MARK + part)
            score, tokens, unknowns = score + s, tokens + t, unknowns + u
        return score, tokens, unknowns


def token_counts(vocabulary: str = VOCABULARY):
    """Column function: struct (score, n_tokens, n_unknown) of a text."""
    kind = pa.struct([("score", pa.float64()), ("n_tokens", pa.int64()), ("n_unknown", pa.int64())])

    @F.arrow_udf("struct<score:double,n_tokens:long,n_unknown:long>")
    def counted(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        counter = Counter(unigram_vocabulary(vocabulary))
        for texts in batches:
            columns = list(zip(*(counter.text(t.as_py()) for t in texts))) or [(), (), ()]
            yield pa.StructArray.from_arrays([pa.array(c, f.type) for c, f in zip(columns, kind)], fields=list(kind))

    return counted


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", token_counts()("text").alias("c")).select("doc_id", "c.*")
