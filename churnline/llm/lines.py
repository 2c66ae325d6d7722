"""Operator 13, line dedup: lines that many documents share stay in one of them only.

Texts are exploded into lines, each long line's normalised form is hashed (128 bits), the
distinct documents of a hash are counted, and where they are DOCUMENTS or more the line goes
from all but the document with the largest id. The rest is put together by position: the
kept runs between dropped places. Only hashes, ids and places are shuffled for the counts; a
text meets the list of its own dropped places at the end.

Counts are per (hash, document) before they are per hash, so a line that a third of all
documents hold is no group of its own. Hashes that make up one in HOT_SHARE of all long lines
or more (HOT_SHARE at most) are sent along; the others are joined, none of them frequent.

A document is its id: rows that share an id count once, and lines are kept in all of them or
in none. Rows without an id count as one document, smaller than any other. Null and empty
texts are one empty line, which is never long enough to drop. Repeated lines of one document
count once and go or stay together. Repeated rows are treated alike. Texts are whole, however
long; other columns pass untouched. An empty table gives no rows.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from churnline.llm.common import free_name, table, written

LEAST_CHARS = 40
DOCUMENTS = 5
HOT_SHARE = 1 << 16
_BLANKS = " \t\n\x0b\x0c\r"


def lines_of(text: str | Column = "text") -> Column:
    return F.split(F.coalesce(text if isinstance(text, Column) else F.col(text), F.lit("")), "\n")


def line_key(line: Column) -> Column:
    """The line without blanks at both ends, A-Z lower-cased."""
    bare = F.btrim(line, F.lit(_BLANKS))
    # Spark's lower() is the quicker one and says the same where all characters are ASCII.
    plain = F.octet_length(bare) == F.char_length(bare)
    return F.when(plain, F.lower(bare)).otherwise(F.translate(bare, string.ascii_uppercase, string.ascii_lowercase))


def _hashes(value: Column, name: str) -> list[Column]:
    return [F.xxhash64(value).alias(f"{name}1"), F.xxhash64(F.lit(name), value).alias(f"{name}2")]


def long_lines(docs: DataFrame, least_chars: int = LEAST_CHARS) -> DataFrame:
    """(doc_id, text1, text2, at, line1, line2): hashes of the long lines and of their texts."""
    text = F.coalesce("text", F.lit(""))
    # A text shorter than a long line has none.
    able = docs.where(F.octet_length("text") >= least_chars)
    exploded = able.select("doc_id", *_hashes(text, "text"), F.posexplode(lines_of()).alias("at", "line"))
    # Trimming only shortens, so short lines need no key.
    keyed = exploded.where(F.char_length("line") >= least_chars).withColumn("key", line_key(F.col("line")))
    return keyed.where(F.char_length("key") >= least_chars).select("doc_id", "text1", "text2", "at", *_hashes(F.col("key"), "line"))


def shared_lines(found: DataFrame, documents: int = DOCUMENTS) -> DataFrame:
    """(line1, line2, keeper, n): hashes that ``documents`` documents or more hold."""
    one = found.groupBy("line1", "line2", "doc_id").agg(F.count("*").alias("times"))
    counted = one.groupBy("line1", "line2").agg(F.count("*").alias("documents"), F.max("doc_id").alias("keeper"), F.sum("times").alias("n"))
    return counted.where(F.col("documents") >= documents).drop("documents")


def dropped_places(docs: DataFrame, least_chars: int = LEAST_CHARS, documents: int = DOCUMENTS) -> DataFrame:
    """(doc_id, text1, text2, places): what goes from each text, places counted from 0."""
    found = written(long_lines(docs, least_chars), "lines")
    shared = written(shared_lines(found, documents), "shared_lines")
    frequent = -(-(shared.agg(F.sum("n")).first()[0] or 0) // HOT_SHARE)
    hot = F.col("n") >= max(1, frequent)
    line = ["line1", "line2"]
    # HOT_SHARE hashes at most, since each makes up that share of all shared lines.
    marked = found.join(F.broadcast(shared.where(hot).select(*line, F.struct("keeper").alias("hot"))), line, "left")
    by_hot = marked.where("hot is not null").withColumn("keeper", F.col("hot.keeper")).drop("hot")
    by_join = marked.where("hot is null").drop("hot").join(shared.where(~hot).select(*line, "keeper"), line)
    gone = by_hot.unionByName(by_join).where(~F.col("doc_id").eqNullSafe(F.col("keeper")))
    return gone.groupBy("doc_id", "text1", "text2").agg(F.sort_array(F.collect_set("at")).alias("places"))


def with_unique_lines(docs: DataFrame, least_chars: int = LEAST_CHARS, documents: int = DOCUMENTS, column: str = "lines") -> DataFrame:
    """``docs`` with a struct (n_lines, n_dropped, kept): the text without shared lines."""
    places = dropped_places(docs, least_chars, documents)
    names = {c: free_name(docs, f"gone_{c}") for c in places.columns}
    places = places.select(*[F.col(c).alias(n) for c, n in names.items()])
    text1, text2 = _hashes(F.coalesce("text", F.lit("")), "text")
    same = F.col("doc_id").eqNullSafe(F.col(names["doc_id"])) & (text1 == F.col(names["text1"])) & (text2 == F.col(names["text2"]))
    joined = docs.join(places, same, "left")
    every, gone = lines_of(), F.col(names["places"])
    # Runs of kept lines lie between dropped places, with one before the text and one after.
    stops = F.concat(F.array(F.lit(-1)), gone, F.array(F.size(every)))
    run = lambda k: F.slice(every, F.get(stops, k) + 2, F.get(stops, k + 1) - F.get(stops, k) - 1)
    kept = F.array_join(F.flatten(F.transform(F.sequence(F.lit(0), F.size(gone)), run)), "\n")
    counted = F.struct(
        F.size(every).cast("long").alias("n_lines"),
        F.coalesce(F.size(gone), F.lit(0)).cast("long").alias("n_dropped"),
        F.when(gone.isNull(), F.coalesce("text", F.lit(""))).otherwise(kept).alias("kept"),
    )
    return joined.select(*docs.columns, counted.alias(column))


def op13_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = with_unique_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return done.select("doc_id", "lines.n_lines", "lines.n_dropped", F.sha2(F.col("lines.kept").cast("binary"), 256).alias("kept_sha256"))


OP13_SQL = r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS place
  FROM documents
), keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines
), shared AS (
  SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5
), marked AS (
  SELECT k.*, coalesce(k.doc_id <> s.keeper, false) AS gone FROM keyed k LEFT JOIN shared s ON k.key = s.key
)
SELECT doc_id, count(*) AS n_lines, count_if(gone)::BIGINT AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
