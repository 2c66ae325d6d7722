"""Where shared intermediate tables and models live.

A run keeps its feature table, scores and models in the folder that the cluster
names in ``spark.checkpoint.dir``. Stages read each other's tables from there, so
a lost executor costs only the tasks it was running.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

_local_folders: dict[str, str] = {}
_stages: dict[tuple, object] = {}


def shared_folder(spark: SparkSession) -> str:
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if named:
        return named
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    app = context.applicationId
    if app not in _local_folders:
        _local_folders[app] = tempfile.mkdtemp(prefix="churnline-")
    return _local_folders[app]


def fresh_path(spark: SparkSession, name: str) -> str:
    app = spark.sparkContext.applicationId
    return f"{shared_folder(spark).rstrip('/')}/churnline/{app}/{name}-{uuid.uuid4().hex}"


def once(spark: SparkSession, key: tuple, build: Callable[[], object]):
    """Value of ``build()``, made once per application and key."""
    full_key = (spark.sparkContext.applicationId, *key)
    if full_key not in _stages:
        _stages[full_key] = build()
    return _stages[full_key]


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: what is numbered once stays numbered so."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def observed_write(df: DataFrame, path: str, facts: dict[str, Column] | None = None, partition_by: tuple[str, ...] = ()) -> dict:
    """Write ``df`` and return its row count, and ``facts`` (aggregates by name), gathered by the write itself."""
    seen = Observation()
    named = {"n_rows": F.count(F.lit(1)), **(facts or {})}
    df.observe(seen, *[c.alias(n) for n, c in named.items()]).write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    return seen.get


def staged(
    spark: SparkSession,
    name: str,
    key: tuple,
    build: Callable[[], DataFrame],
    partition_by: tuple[str, ...] = (),
    facts: dict[str, Column] | None = None,
) -> DataFrame:
    """Read the table ``name``, writing it first if this application has not done so yet."""

    def write() -> tuple[str, dict]:
        path = fresh_path(spark, name)
        return path, observed_write(build(), path, facts, partition_by)

    path, _ = once(spark, (name, *key), write)
    return spark.read.parquet(path)


def staged_facts(spark: SparkSession, name: str, key: tuple) -> dict:
    """What the write of a staged table observed."""
    return _stages[(spark.sparkContext.applicationId, name, *key)][1]
