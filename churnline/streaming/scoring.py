"""Scoring customer files as they arrive, with an encoder and a model fitted before."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from churnline.operators.features import FeatureEncoder
from churnline.operators.products import with_risk_tier
from churnline.operators.training import predicted, score_rows
from churnline.schema import KEY, RAW_SCHEMA


def arriving_customers(spark: SparkSession, folder: str) -> DataFrame:
    return spark.readStream.schema(RAW_SCHEMA).csv(folder, header=True)


def scored_stream(raw: DataFrame, encoder: FeatureEncoder, model: PipelineModel, threshold: float) -> DataFrame:
    """Scores, labels and tiers. Every step is row by row, so the stream keeps no state."""
    scores = score_rows(model, encoder.transform(raw), [KEY, "tenure", "MonthlyCharges"])
    return with_risk_tier(predicted(scores, threshold)).withColumn("scored_at", F.current_timestamp())


def start_scoring(scored: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Score all files not seen yet and stop; run again on schedule."""
    writer = scored.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()
