"""What the corpus operators share: reading, writing between steps, words, components."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from churnline.session import fresh_path

SPACE = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.parquet(path)
    return spark.read.parquet(path)


def ascii_lower(text: Column | str) -> Column:
    """A-Z lower-cased, everything else left."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def words(text: Column, separators: str = SPACE) -> Column:
    """Array of the words of ``text`` (null: none), in order."""
    split = F.split(F.coalesce(text, F.lit("")), separators)
    return F.filter(split, lambda w: w != "")


def fold(doc_id: Column | str, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id falls in fold 0."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string") if isinstance(doc_id, str) else doc_id.cast("string")) % folds, F.lit(0))


def free_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, lengthened until no column of ``df`` has that name."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def components(links: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable over undirected links (a, b).

    Each round joins every node's smallest neighbour to all its larger ones, then the
    smaller ones to the smallest; the rounds needed grow with the logarithm of the
    longest path. Every round is written to the shared folder.
    """
    edges = written(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        # Large star: larger neighbours point to the smallest one.
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        # Small star: the smaller neighbours and the node itself point to the smallest.
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
        after = written(small.where("u <> v").distinct(), "links")
        same = after.join(edges, ["u", "v"], "left_anti").isEmpty() and edges.join(after, ["u", "v"], "left_anti").isEmpty()
        edges = after
        if same:
            break
    # A fixed point is a set of stars: every node points to its component's smallest.
    star = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return star.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
