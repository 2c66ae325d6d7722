"""Pearson correlations of the numeric feature table, read from its table of moments.

Each function takes the moments if they are already there and folds them in one scan if not.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from churnline.operators.moments import moment_table, pearson
from churnline.schema import LABEL

DIGITS = 6


def correlation_matrix(features: DataFrame, columns: list[str], moments: DataFrame | None = None) -> DataFrame:
    """Long matrix; null where a column is constant."""
    table = moment_table(features, columns) if moments is None else moments
    wanted = F.col("feature_a").isin(columns) & F.col("feature_b").isin(columns)
    # A column goes with itself, constant or not.
    corr = F.when(F.col("feature_a") == F.col("feature_b"), 1.0).otherwise(pearson())
    return table.where(wanted).select("feature_a", "feature_b", F.round(corr, DIGITS).alias("corr"))


def target_correlation(features: DataFrame, columns: list[str], moments: DataFrame | None = None) -> DataFrame:
    """Correlation of every feature with the label, strongest first."""
    table = moment_table(features, [*columns, LABEL]) if moments is None else moments
    ranking = Window.orderBy(F.desc_nulls_last(F.abs("corr")), "feature")  # one row per feature
    pairs = table.where((F.col("feature_b") == LABEL) & F.col("feature_a").isin(columns))
    corr = pairs.select(F.col("feature_a").alias("feature"), F.round(pearson(), DIGITS).alias("corr"))
    return corr.withColumn("rank", F.row_number().over(ranking))


def correlation_top(features: DataFrame, columns: list[str], top: int = 15, moments: DataFrame | None = None) -> DataFrame:
    """Matrix of the strongest features and the label."""
    table = moment_table(features, [*columns, LABEL]) if moments is None else moments
    names = target_correlation(features, columns, table).where(F.col("rank") <= top).select("feature")
    strongest = [row["feature"] for row in names.collect()]
    return correlation_matrix(features, [*strongest, LABEL], table)


def correlation_drivers(features: DataFrame, columns: list[str], top: int = 5, moments: DataFrame | None = None) -> DataFrame:
    """Strongest features of each sign."""
    signed = (
        target_correlation(features, columns, moments)
        .where(F.col("corr") != 0)
        .withColumn("direction", F.when(F.col("corr") > 0, "positive").otherwise("negative"))
    )
    place = F.row_number().over(Window.partitionBy("direction").orderBy("rank"))
    return signed.select("direction", place.alias("place"), "feature", "corr").where(F.col("place") <= top)
