"""Split points of features and the segments where acting pays."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from churnline.functions.ordering import running_totals
from churnline.functions.reshape import feature_rows
from churnline.schema import LABEL

MIN_SIDE = 50
MIN_GAP = 0.05
SEGMENTS = 3
ACCURACY = 10_000


def _overview(features: DataFrame, columns: list[str]) -> DataFrame:
    """Counts, extremes and mean of each feature, and of 0/1 values their labels.

    Runs at once and holds one row per feature. It settles everything about 0/1 columns,
    so only the others are looked at again.
    """
    value, one = F.col("value"), F.col("value") == 1
    facts = (
        feature_rows(features, columns, [LABEL])
        .groupBy("feature")
        .agg(
            F.count("value").alias("n"),
            F.min("value").alias("lo"),
            F.max("value").alias("hi"),
            F.avg("value").alias("mean"),
            F.count_if(value == 0).alias("zeros"),
            F.count_if(one).alias("ones"),
            F.sum(F.when(value == 0, F.col(LABEL)).otherwise(0)).alias("churn_zeros"),
            F.sum(F.when(one, F.col(LABEL)).otherwise(0)).alias("churn_ones"),
        )
        .where(F.col("lo") < F.col("hi"))
        .withColumn("flag", F.col("zeros") + F.col("ones") == F.col("n"))
    )
    return features.sparkSession.createDataFrame(facts.collect(), facts.schema)


def _not_flags(facts: DataFrame) -> list[str]:
    return [r["feature"] for r in facts.where("not flag").select("feature").collect()]


def _middle_ranks() -> tuple[Column, Column]:
    return F.floor((F.col("n") + 1) / 2), F.floor((F.col("n") + 2) / 2)


def _exact_medians(features: DataFrame, facts: DataFrame, columns: list[str], accuracy: int) -> DataFrame:
    """Features with their exact medians, from the rows between two approximate quantiles around the middle.

    Rows under the bracket are only counted, equal values are counted together, so the
    ranking per feature sees a few ten-thousandths of the rows at most, in buckets.
    """
    margin = 2 / accuracy
    around = F.array(F.lit(0.5 - margin), F.lit(0.5 + margin))
    quantiles = feature_rows(features, columns).groupBy("feature").agg(F.percentile_approx("value", around, accuracy).alias("q"))
    bracket = quantiles.select("feature", F.get("q", F.lit(0)).alias("lower"), F.get("q", F.lit(1)).alias("upper"))
    # The bracket has one row per feature.
    inside = feature_rows(features, columns).join(F.broadcast(bracket), "feature").where(F.col("value") <= F.col("upper"))
    point = F.when(F.col("value") >= F.col("lower"), F.col("value"))
    counted = inside.groupBy("feature", point.alias("point")).agg(F.count(F.lit(1)).alias("here"))
    placed = running_totals(counted, "point", ["here"], by=["feature"]).withColumn("cum", F.col("here_before") + F.col("here"))

    def at(rank: Column) -> Column:
        return F.min(F.when(F.col("cum") >= rank, F.col("point")))

    lower_middle, upper_middle = _middle_ranks()
    sizes = F.broadcast(facts.select("feature", "n"))
    return placed.join(sizes, "feature").groupBy("feature").agg(((at(lower_middle) + at(upper_middle)) / 2).alias("median"))


def _split_points(features: DataFrame, facts: DataFrame, accuracy: int = ACCURACY) -> DataFrame:
    """``facts`` with median, split value and kind of split."""
    lower_middle, upper_middle = _middle_ranks()
    ones = [F.when(rank > F.col("zeros"), 1.0).otherwise(0.0) for rank in (lower_middle, upper_middle)]
    medians = facts.where("flag").select("feature", ((ones[0] + ones[1]) / 2).alias("median"))
    if others := _not_flags(facts):
        medians = medians.unionByName(_exact_medians(features, facts, others, accuracy))
    extreme = (F.col("median") == F.col("lo")) | (F.col("median") == F.col("hi"))
    return facts.join(F.broadcast(medians), "feature").withColumns(
        {
            "split_value": F.when(extreme, F.col("mean")).otherwise(F.col("median")),
            "split_kind": F.when(extreme, "mean").otherwise("median"),
        }
    )


def feature_split_points(features: DataFrame, columns: list[str], accuracy: int = ACCURACY) -> DataFrame:
    """Where each feature is split: at its median, or its mean if the median is an extreme.

    Features with one value are left out. Starts jobs before an action (``_overview``).
    """
    facts = _overview(features.select(*columns, F.lit(0).alias(LABEL)), columns)
    return _split_points(features, facts, accuracy).select(
        "feature", F.col("lo").alias("min_value"), F.col("hi").alias("max_value"), "median", "split_value", "split_kind"
    )


def segment_halves(features: DataFrame, columns: list[str], importance: DataFrame) -> DataFrame:
    """Both halves of every feature's split, with their sizes and churn rates."""
    facts = _overview(features, columns)
    sides = ["feature", "split_value", "split_kind", "n_high", "n_low", "churn_high", "churn_low"]
    # A 0/1 column is split between its values.
    counts = {"n_high": "ones", "n_low": "zeros", "churn_high": "churn_ones", "churn_low": "churn_zeros"}
    flags = _split_points(features, facts.where("flag"))
    halves = flags.select(*sides[:3], *[F.col(c).alias(name) for name, c in counts.items()])
    if others := _not_flags(facts):
        splits = _split_points(features, facts.where("not flag")).select(*sides[:3])
        high = F.col("value") > F.col("split_value")
        # One row per feature on the small side of the join.
        wide = (
            feature_rows(features, others, [LABEL])
            .join(F.broadcast(splits), "feature")
            .groupBy(*sides[:3])
            .agg(
                F.count_if(high).alias("n_high"),
                F.count_if(~high).alias("n_low"),
                F.sum(F.when(high, F.col(LABEL)).otherwise(0)).alias("churn_high"),
                F.sum(F.when(high, 0).otherwise(F.col(LABEL))).alias("churn_low"),
            )
        )
        halves = halves.unionByName(wide)
    high_rate = F.col("churn_high") / F.nullif(F.col("n_high"), F.lit(0))
    low_rate = F.col("churn_low") / F.nullif(F.col("n_low"), F.lit(0))
    return halves.join(F.broadcast(importance.select("feature", "mean_abs")), "feature").select(
        "feature",
        "split_value",
        "split_kind",
        high_rate.alias("high_rate"),
        low_rate.alias("low_rate"),
        (high_rate / F.nullif(low_rate, F.lit(0.0))).alias("ratio"),
        "mean_abs",
        "n_high",
        "n_low",
        ((F.col("churn_high") + F.col("churn_low")) / (F.col("n_high") + F.col("n_low"))).alias("baseline_rate"),
    )


def segment_candidates(halves: DataFrame, min_side: int = MIN_SIDE, min_gap: float = MIN_GAP) -> DataFrame:
    """Add whether a split qualifies: both sides large enough, rates above 0 and apart."""
    qualifies = (
        (F.col("n_high") >= min_side)
        & (F.col("n_low") >= min_side)
        & (F.col("low_rate") > 0)
        & (F.abs(F.col("high_rate") - F.col("low_rate")) >= min_gap)
    )
    return halves.withColumn("qualifies", F.coalesce(qualifies.cast("int"), F.lit(0)))


def actionable_segments(candidates: DataFrame, segments: int = SEGMENTS) -> DataFrame:
    """The first qualifying splits in order of importance."""
    chosen = candidates.where(F.col("qualifies") == 1).orderBy(F.desc("mean_abs"), "feature").limit(segments)
    ranking = Window.orderBy(F.desc("mean_abs"), "feature")  # at most `segments` rows
    return chosen.select(F.row_number().over(ranking).alias("rank"), *[c for c in candidates.columns if c != "qualifies"])


def rounded(table: DataFrame) -> DataFrame:
    return table.select(*[F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in table.dtypes])


def segment_report(segments: DataFrame) -> DataFrame:
    """Segments as they are quoted: which side is risky, by how much, and its size."""
    above = F.col("high_rate") > F.col("low_rate")
    return segments.select(
        "rank",
        "feature",
        F.when(above, "above").otherwise("below").alias("direction"),
        "split_value",
        "split_kind",
        F.greatest("high_rate", "low_rate").alias("risky_rate"),
        F.least("high_rate", "low_rate").alias("other_half_rate"),
        F.when(above, F.col("ratio")).otherwise(F.try_divide("low_rate", "high_rate")).alias("ratio"),
        F.when(above, F.col("n_high")).otherwise(F.col("n_low")).alias("affected"),
        "mean_abs",
        "baseline_rate",
    )
