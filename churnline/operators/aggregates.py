"""Churn aggregates behind the exploratory charts and the overview page."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnline.functions import encodings as enc
from churnline.operators.moments import moment_table, single
from churnline.schema import LABEL, TENURE_BUCKETS

BUCKET_FLAGS = {enc.flag_name("tb", label): label for label in TENURE_BUCKETS}
SEGMENTS = ["Contract", "PaymentMethod", "InternetService", "is_high_value"]


def _position(label: Column, order: list[str]) -> Column:
    return F.array_position(F.array(*[F.lit(x) for x in order]), label)


def _rate_and_size() -> list[Column]:
    return [F.round(F.avg(LABEL), 6).alias("churn_rate"), F.count(LABEL).alias("n")]


def cohort_churn(rows: DataFrame) -> DataFrame:
    """Rate and size per tenure bucket, buckets that occur only, in bucket order."""
    return (
        rows.where(F.col("tenure_bucket").isNotNull())
        .groupBy("tenure_bucket")
        .agg(*_rate_and_size(), F.round(100 * F.avg(LABEL), 1).alias("churn_rate_pct"))
        .orderBy(_position(F.col("tenure_bucket"), list(TENURE_BUCKETS)))
    )


def cohort_churn_onehot(features: DataFrame) -> DataFrame:
    """The same from the indicator columns, which are folded back into a label per row."""
    label = F.lit(None).cast("string")
    for flag, bucket in BUCKET_FLAGS.items():
        label = F.when(F.col(flag) == 1, F.lit(bucket)).otherwise(label)
    return cohort_churn(features.select(label.alias("tenure_bucket"), LABEL))


def segment_churn(rows: DataFrame, column: str) -> DataFrame:
    return (
        rows.groupBy(F.col(column).cast("string").alias("level"))
        .agg(*_rate_and_size())
        .where(F.col("level").isNotNull())
        .orderBy(F.desc("churn_rate"), "level")
    )


def segment_churn_all(rows: DataFrame, columns: list[str] = SEGMENTS) -> DataFrame:
    """Every segment column in one scan, by grouping sets."""
    sets = [[F.col(c)] for c in columns]
    name = F.lit(None).cast("string")
    level = F.lit(None).cast("string")
    for column in columns:
        this_one = F.grouping(column) == 0
        name = F.when(this_one, F.lit(column)).otherwise(name)
        level = F.when(this_one, F.col(column).cast("string")).otherwise(level)
    grouped = rows.groupingSets(sets, *[F.col(c) for c in columns]).agg(
        name.alias("segment"), level.alias("level"), *_rate_and_size()
    )
    return grouped.select("segment", "level", "churn_rate", "n").where(F.col("level").isNotNull())


def class_balance(rows: DataFrame) -> DataFrame:
    counts = rows.groupBy(F.col(LABEL).alias("label")).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    return counts.select("label", "n", F.round(100 * F.col("n") / total, 4).alias("pct")).orderBy("label")


def level_rates(rows: DataFrame, wanted: list[tuple[str, str]]) -> DataFrame:
    """Rate of each wanted (segment, level); null where the level does not occur."""
    spark = rows.sparkSession
    asked = spark.createDataFrame(wanted, "segment string, level string")
    return asked.join(segment_churn_all(rows), ["segment", "level"], "left").select("segment", "level", "churn_rate", "n")


def money(column: Column) -> Column:
    """Exact sums: charges are whole cents."""
    return F.sum(column.cast("decimal(18,2)")).cast("double")


def kpi_overview(scored: DataFrame, threshold: Column | float) -> DataFrame:
    """Totals of the overview page, from rows with charges, label, score and risk tier."""
    flagged = F.col("score") >= threshold
    monthly = F.col("MonthlyCharges")
    return scored.agg(
        F.count(F.lit(1)).alias("customers"),
        F.sum(LABEL).cast("bigint").alias("churned"),
        F.round(F.avg(LABEL), 6).alias("churn_rate"),
        F.round(money(monthly) / F.count(monthly), 6).alias("avg_monthly"),
        money(monthly).alias("mrr"),
        F.coalesce(money(F.when(flagged, monthly)), F.lit(0.0)).alias("mrr_at_risk"),
        F.count_if(F.col("risk_tier").isin("High", "Critical")).alias("high_risk"),
    )


def feature_ranges(features: DataFrame, columns: list[str], moments: DataFrame | None = None) -> DataFrame:
    """Minimum, maximum and slider step per feature."""
    ranges = single(moment_table(features, columns) if moments is None else moments, columns)
    step = F.greatest(F.lit(0.01), F.round((F.col("hi") - F.col("lo")) / 100, 4))
    return ranges.select(
        "feature", F.round("lo", 6).alias("min_value"), F.round("hi", 6).alias("max_value"), step.alias("step")
    )
