"""Cleaning a corpus for training: five stages over ``documents``, each on all its predecessor kept.

Toxic documents go, then those that fail the quality rules, then all but one document of each
near-duplicate group, then those that hold a benchmark item; the rest is packed into windows.
Every stage but the last returns the columns of ``documents``. Each is written as Parquet to
the shared folder and read again.

Nulls, empty texts, repeated rows and empty tables are handled as each operator states. The
stages read ``labels`` and ``benchmark`` from the folder of the tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from churnline.llm.common import table, written
from churnline.llm.decontamination import without_leaks
from churnline.llm.packing import pack
from churnline.llm.quality import of_quality
from churnline.llm.simhash import one_of_each
from churnline.llm.toxicity import without_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_toxic(docs, table(spark, sf_dir, "labels"))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return of_quality(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_leaks(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack(docs).drop("ids")


STAGES = [
    ("toxicity", toxicity),
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("packing", packing),
]

# Learned weights, fingerprints, edit distances and retrieval have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
