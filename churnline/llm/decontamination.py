"""Operator 10, benchmark decontamination: pigeonhole edit matching.

An item of n characters may occur with up to e = floor(n * EDIT_SHARE) edits. Cut into
e + 1 pieces, at least one piece of such an occurrence is untouched, so exact piece hits
(one automaton over all pieces) find every candidate place; Myers' bit-parallel distance
then decides. Texts and items are lower-cased, white space runs become one space.

Null and empty texts have no leaks; null and blank items match nothing. Items below
MIN_CHARS characters are matched without edits, as whole words. Equal items under several
ids are all reported, a null item_id as null. Texts are read whole. Benchmarks larger than BLOCK_CHARS are taken
in blocks, each searched in all documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnline.llm.common import table

EDIT_SHARE = 0.05
MIN_CHARS = 40
BLOCK_CHARS = 16_000_000
LEAKS = "array<struct<item_id:long,start:long,end:long,distance:int>>"
_LEAKS = pa.list_(pa.struct([("item_id", pa.int64()), ("start", pa.int64()), ("end", pa.int64()), ("distance", pa.int32())]))


def normalised(text: str | None) -> str:
    return " ".join((text or "").lower().split())


def budget(length: int) -> int:
    return int(length * EDIT_SHARE) if length >= MIN_CHARS else 0


def pieces(item: str) -> list[tuple[int, str]]:
    """(offset, piece): one piece more than the item's error budget, of even lengths."""
    n = budget(len(item)) + 1
    cuts = [len(item) * i // n for i in range(n + 1)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:])]


class Pattern:
    """An item ready for Myers' search for its best place in a text."""

    def __init__(self, item: str):
        self.length, self.errors = len(item), budget(len(item))
        self.masks: dict[str, int] = {}
        for i, c in enumerate(item):
            self.masks[c] = self.masks.get(c, 0) | 1 << i

    def best(self, text: str) -> tuple[int, int]:
        """(distance, end) of the place in ``text`` nearest to the item, the first of equals."""
        full, top = (1 << self.length) - 1, 1 << (self.length - 1)
        up, down, score = full, 0, self.length
        found = (score, 0)
        get = self.masks.get
        for j, c in enumerate(text):
            eq = get(c, 0)
            diagonal = (((eq & up) + up) ^ up) | eq | down
            rise = down | (full & ~(diagonal | up))
            fall = up & diagonal
            if rise & top:
                score += 1
            elif fall & top:
                score -= 1
                if score < found[0]:
                    found = (score, j + 1)
            rise, fall = rise << 1 & full, fall << 1 & full
            up = fall | (full & ~(diagonal | rise))
            down = rise & diagonal
        return found


class Matcher:
    """All places of some items in texts, within each item's error budget."""

    def __init__(self, items: list[tuple[int | None, str]]):
        by_text: dict[str, list[int | None]] = {}
        for item_id, text in items:
            if text:
                by_text.setdefault(text, []).append(item_id)
        self.texts, self.ids = list(by_text), list(by_text.values())
        self.patterns = [Pattern(t) for t in self.texts]
        owners: dict[str, list[tuple[int, int]]] = {}
        for k, text in enumerate(self.texts):
            for offset, piece in pieces(text):
                owners.setdefault(piece, []).append((k, offset))
        self.automaton = ahocorasick.Automaton()
        for piece, places in owners.items():
            self.automaton.add_word(piece, (len(piece), places))
        if owners:
            self.automaton.make_automaton()

    def places(self, text: str) -> list[tuple[int | None, int, int, int]]:
        """(item id, start, end, distance) in a normalised text, sorted, null ids last."""
        if not self.texts:
            return []
        starts: dict[int, list[int]] = {}
        for end, (length, owners) in self.automaton.iter(text):
            for k, offset in owners:
                starts.setdefault(k, []).append(end + 1 - length - offset)
        found = []
        for k, at in starts.items():
            pattern, at = self.patterns[k], sorted(set(at))
            if not pattern.errors:
                ends = [(s, s + pattern.length, 0) for s in at if pattern.length >= MIN_CHARS or _whole_words(text, s, s + pattern.length)]
            else:
                ends = self._verified(pattern, text, at)
            found += [(i, *place) for place in ends for i in self.ids[k]]
        return sorted(found, key=lambda p: (p[0] is None, p[0] or 0, *p[1:]))

    @staticmethod
    def _verified(pattern: Pattern, text: str, at: list[int]) -> list[tuple[int, int, int]]:
        spans: list[list[int]] = []
        for s in at:
            # Hits of one occurrence start within the error budget of each other.
            if spans and s - spans[-1][1] <= 2 * pattern.errors:
                spans[-1][1] = s
            else:
                spans.append([s, s])
        out = []
        for first, last in spans:
            low = max(0, first - pattern.errors)
            distance, end = pattern.best(text[low : last + pattern.length + pattern.errors])
            if distance <= pattern.errors:
                out.append((max(low, low + end - pattern.length), low + end, distance))
        return out


def _whole_words(text: str, start: int, end: int) -> bool:
    return not (start and text[start - 1].isalnum() and text[start].isalnum()) and not (end < len(text) and text[end].isalnum() and text[end - 1].isalnum())


def blocks(benchmark: DataFrame) -> Iterator[list[tuple[int | None, str]]]:
    """Normalised items in blocks of about BLOCK_CHARS characters, each fit for a broadcast."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).where("text is not null")
    chars = items.agg(F.sum(F.length("text"))).first()[0] or 0
    n = -(-chars // BLOCK_CHARS) or 1
    for b in range(n):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == b).collect()
        yield [(r.item_id, normalised(r.text)) for r in rows]


def leaks_in(items: list[tuple[int | None, str]]):
    """Column function: the places of ``items`` in a text column."""

    @F.arrow_udf(LEAKS)
    def leaks(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        matcher = Matcher(items)
        for texts in batches:
            rows = [[dict(zip(("item_id", "start", "end", "distance"), p)) for p in matcher.places(normalised(t.as_py()))] for t in texts]
            yield pa.array(rows, _LEAKS)

    return leaks


def find_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, start, end, distance): one row per place, positions in the normalised text."""
    found = None
    for items in blocks(benchmark):
        part = docs.select("doc_id", F.explode(leaks_in(items)("text")).alias("leak")).select("doc_id", "leak.*")
        found = part if found is None else found.unionByName(part)
    return found


def without_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents in which no item occurs, all columns kept."""
    for items in blocks(benchmark):
        docs = docs.where(F.size(leaks_in(items)("text")) == 0)
    return docs


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    places = find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return places.groupBy("doc_id", "item_id").agg(F.count("*").alias("n_places"), F.min("distance").alias("distance"))
