"""Saving and loading fitted models and result tables."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from churnline.operators.features import FeatureEncoder


def save_model(model: PipelineModel, path: str) -> str:
    model.write().overwrite().save(path)
    return path


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def save_table(table: DataFrame, path: str) -> str:
    table.write.mode("overwrite").parquet(path)
    return path


def load_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def encoder_table(spark: SparkSession, encoder: FeatureEncoder) -> DataFrame:
    """The fitted vocabularies: (name, position, level)."""
    rows = [(name, i, level) for name, levels in sorted(encoder.levels.items()) for i, level in enumerate(levels)]
    return spark.createDataFrame(rows, "name string, position int, level string")


def load_encoder(spark: SparkSession, path: str) -> FeatureEncoder:
    """The encoder whose table was written to ``path``; it makes the columns that its model knows."""
    levels: dict[str, list[str]] = {}
    # One row per encoded level, which fitting limits.
    for row in spark.read.parquet(path).orderBy("name", "position").collect():
        levels.setdefault(row["name"], []).append(row["level"])
    return FeatureEncoder(levels)
