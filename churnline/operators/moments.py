"""One table of moments behind the correlations, ranges and scaling.

A row per pair of columns holds counts and sums, so partial tables add up: each partition
folds its rows to one such table by matrix products, and a single aggregate adds the tables.
What is shuffled grows with columns and partitions only. Sums are taken about one row's
values, which keeps the digits of columns whose spread is small beside their mean.

Statistics of a pair use the rows where neither value is missing (null or NaN).
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Executors need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SUMS = ("n", "sum_a", "sum_b", "sum_aa", "sum_bb", "sum_ab")
_PARTIAL = "a int, b int, " + ", ".join(f"{s} double" for s in SUMS) + ", lo double, hi double"


def folded(batches: Iterator[pa.RecordBatch], shift: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sums (of SUMS, by column pair), minima and maxima of some batches of double columns."""
    k = len(shift)
    sums, low, high = np.zeros((len(SUMS), k, k)), np.full(k, np.inf), np.full(k, -np.inf)
    for batch in batches:
        if not batch.num_rows:
            continue
        values = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns]).astype(float)
        there = ~np.isnan(values)
        low = np.minimum(low, np.where(there, values, np.inf).min(axis=0))
        high = np.maximum(high, np.where(there, values, -np.inf).max(axis=0))
        x, m = np.where(there, values - shift, 0.0), there.astype(float)
        once, twice = x.T @ m, (x * x).T @ m
        sums += np.stack([m.T @ m, once, once.T, twice, twice.T, x.T @ x])
    return sums, low, high


def moment_table(features: DataFrame, columns: list[str]) -> DataFrame:
    """(feature_a, feature_b, n, mean_a, var_a, var_b, cov, lo, hi) per ordered pair of ``columns``.

    Variances and covariances are those of the population; ``lo`` and ``hi`` belong to feature_a
    and stand in the rows of a column with itself. No rows: n is 0, the rest null.
    """
    spark = features.sparkSession
    numbers = features.select(*[F.col(c).cast("double").alias(c) for c in columns])
    # Any row will do; its values only move the origin.
    row = numbers.head() or [None] * len(columns)
    shift = np.nan_to_num(np.array([0.0 if v is None else v for v in row]), posinf=0.0, neginf=0.0)

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, low, high = folded(batches, shift)
        a, b = np.triu_indices(len(shift))
        own = a == b
        ends = [np.where(own & np.isfinite(side[a]), side[a], np.nan) for side in (low, high)]
        arrays = [pa.array(a, pa.int32()), pa.array(b, pa.int32()), *[pa.array(s[a, b]) for s in sums]]
        arrays += [pa.array(e, from_pandas=True) for e in ends]
        yield pa.RecordBatch.from_arrays(arrays, names=["a", "b", *SUMS, "lo", "hi"])

    partial = numbers.mapInArrow(fold, _PARTIAL)
    total = partial.groupBy("a", "b").agg(*[F.sum(s).alias(s) for s in SUMS], F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    mirrored = total.where("a <> b").select(
        F.col("b").alias("a"), F.col("a").alias("b"), "n", F.col("sum_b").alias("sum_a"), F.col("sum_a").alias("sum_b"),
        F.col("sum_bb").alias("sum_aa"), F.col("sum_aa").alias("sum_bb"), "sum_ab", "lo", "hi",
    )
    names = spark.createDataFrame([(i, c, float(shift[i])) for i, c in enumerate(columns)], "at int, name string, shift double")
    # One row per column each.
    left = F.broadcast(names.select(F.col("at").alias("a"), F.col("name").alias("feature_a"), "shift"))
    right = F.broadcast(names.select(F.col("at").alias("b"), F.col("name").alias("feature_b")))
    n = F.nullif(F.col("n"), F.lit(0.0))
    mean_a, mean_b = F.col("sum_a") / n, F.col("sum_b") / n
    var = lambda squares, mean: F.greatest(F.col(squares) / n - mean * mean, F.lit(0.0) * mean)
    return (
        total.unionByName(mirrored)
        .join(left, "a")
        .join(right, "b")
        .select(
            "feature_a", "feature_b", F.col("n").cast("long").alias("n"), (F.col("shift") + mean_a).alias("mean_a"),
            var("sum_aa", mean_a).alias("var_a"), var("sum_bb", mean_b).alias("var_b"),
            (F.col("sum_ab") / n - mean_a * mean_b).alias("cov"), "lo", "hi",
        )
    )


def pearson() -> Column:
    """Correlation of a pair of the moment table, null where a column is constant."""
    return F.col("cov") / F.nullif(F.sqrt(F.col("var_a") * F.col("var_b")), F.lit(0.0))


def single(moments: DataFrame, columns: list[str]) -> DataFrame:
    """The rows of the given columns with themselves, as ``feature``."""
    own = (F.col("feature_a") == F.col("feature_b")) & F.col("feature_a").isin(columns)
    return moments.where(own).withColumnRenamed("feature_a", "feature")
