"""How much each feature adds to each score, and importances derived from that.

Attributions are kept one row per customer, as arrays in feature order. Per-customer
rankings then need no shuffle, and per-feature averages combine before they shuffle.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml import PipelineModel
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from churnline.functions.ordering import tie_break
from churnline.functions.scalars import with_row
from churnline.operators import ensembles
from churnline.operators.boosting import tree_nodes  # noqa: F401
from churnline.operators.training import ScoreCard, churn_probability
from churnline.schema import KEY, LABEL

# Executors need not have this package installed: its functions travel with the tasks.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def linear_attributions(features: DataFrame, card: ScoreCard, columns: list[str], key: str = KEY) -> DataFrame:
    """weight x (value - mean), exact for a logistic model."""
    used = [c for c in columns if card.weights.get(c)]
    means = features.agg(*[F.avg(c).alias(c) for c in used])
    parts = [
        F.lit(card.weights[c]) * (F.col(c) - F.col(f"mean.{c}")) if c in used else F.lit(0.0) for c in columns
    ]
    return with_row(features, "mean", means).select(
        key, F.array(*[F.col(c).cast("double") for c in columns]).alias("values"), F.array(*parts).alias("contributions")
    )


def linear_base_value(features: DataFrame, card: ScoreCard) -> DataFrame:
    """Mean log-odds: the part of a score that is the same for everyone."""
    return features.agg(F.round(F.avg(card.logit()), 6).alias("base_value"))


# ---- trees ---------------------------------------------------------------------------


def tree_attributions(features: DataFrame, nodes: DataFrame, columns: list[str], key: str = KEY) -> DataFrame:
    """Attributions of boosted trees in log-odds.

    The node table has at most trees x 2^(depth + 1) rows, whatever the data's size; rows
    stay in the partitions of the input.
    """
    trees = features.sparkSession.sparkContext.broadcast(ensembles.tabled(ensembles.trees_of(nodes.toPandas())))
    values_of = ensembles.shapley_values

    def attribute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = batch.column("values").flatten().to_numpy()
            found = values_of(flat.reshape(batch.num_rows, -1).T.copy(), trees.value)
            ends = pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * found.shape[0])
            shares = pa.ListArray.from_arrays(ends, pa.array(found.T.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column(key), batch.column("values"), shares], names=[key, "values", "contributions"])

    rows = features.select(F.col(key).cast("string").alias(key), F.array(*[F.col(c).cast("double") for c in columns]).alias("values"))
    return rows.mapInArrow(attribute, f"{key} string, values array<double>, contributions array<double>")


def tree_base_value(nodes: DataFrame) -> float:
    return ensembles.expected_value(ensembles.trees_of(nodes.toPandas()))


# ---- views on attributions -----------------------------------------------------------


def _names(columns: list[str]) -> Column:
    return F.array(*[F.lit(c) for c in columns])


def long_attributions(attributions: DataFrame, columns: list[str], key: str = KEY) -> DataFrame:
    zipped = F.arrays_zip(_names(columns).alias("feature"), F.col("values"), F.col("contributions"))
    return attributions.select(key, F.explode(zipped).alias("a")).select(
        key,
        F.col("a.feature").alias("feature"),
        F.col("a.values").alias("value"),
        F.col("a.contributions").alias("contribution"),
    )


def global_importance(attributions: DataFrame, columns: list[str]) -> DataFrame:
    """Mean absolute attribution per feature, ranked."""
    means = (
        attributions.select(F.posexplode("contributions"))
        .groupBy("pos")
        .agg(F.round(F.avg(F.abs("col")), 6).alias("mean_abs"))
        .select(F.get(_names(columns), F.col("pos")).alias("feature"), "mean_abs")
    )
    ranking = Window.orderBy(F.desc("mean_abs"), "feature")  # one row per feature
    return means.withColumn("rank", F.row_number().over(ranking).cast("bigint"))


def beeswarm_points(attributions: DataFrame, columns: list[str], top: int = 20, key: str = KEY) -> DataFrame:
    """Values and attributions of the most important features."""
    strongest = global_importance(attributions, columns).where(F.col("rank") <= top).select("feature")
    return long_attributions(attributions, columns, key).join(F.broadcast(strongest), "feature", "left_semi")


def _ranked(columns: list[str]) -> Column:
    """The row's attributions, largest first, ties by feature name."""
    named = F.zip_with(
        _names(columns), "contributions", lambda f, c: F.struct((-F.abs(c)).alias("size"), f.alias("feature"), c.alias("c"))
    )
    return F.sort_array(named)  # array_sort would compare through a lambda


def top_drivers(attributions: DataFrame, columns: list[str], top: int = 3, key: str = KEY) -> DataFrame:
    """The strongest attributions of every customer as text."""
    texts = F.transform(
        F.slice(_ranked(columns), 1, top), lambda d: F.format_string("%s(%+.2f)", d["feature"], d["c"])
    )
    return attributions.select(key, F.array_join(texts, ", ").alias("drivers"))


def customer_breakdown(attributions: DataFrame, columns: list[str], customer: str, top: int = 15, key: str = KEY) -> DataFrame:
    one = long_attributions(attributions.where(F.col(key) == customer), columns, key)
    return one.orderBy(F.desc(F.abs("contribution")), "feature").limit(top)


# ---- importances ---------------------------------------------------------------------


def _share_of_max(table: DataFrame, value: str, name: str) -> DataFrame:
    top = F.max(value).over(Window.partitionBy())  # one row per feature
    return table.withColumn(name, F.when(top > 0, F.col(value) / top).otherwise(F.col(value)))


def gain_importance(nodes: DataFrame, columns: list[str]) -> DataFrame:
    """Mean gain per split of each feature, weighted by node cover, as a share of the largest; 0 if unused.

    Spark's gain is per unit of weight, so it is multiplied by the weight that reaches the node.
    """
    spark = nodes.sparkSession
    named = spark.createDataFrame(list(enumerate(columns)), "position int, feature string")
    used = nodes.where(F.col("left") >= 0).groupBy(F.col("feature").alias("position")).agg(F.avg(F.col("gain") * F.col("cover")).alias("g"))
    gains = named.join(used, "position", "left").select("feature", F.coalesce("g", F.lit(0.0)).alias("gain"))
    return _share_of_max(gains, "gain", "gain_norm")


def permutation_importance(
    model: PipelineModel, sample: DataFrame, columns: list[str], repeats: int = 3, key: str = KEY
) -> DataFrame:
    """Mean loss of average precision when one feature's values are shuffled within the sample.

    All (feature, repeat) scenarios are scored in one pass. A shuffle pairs the rows in key
    order with the rows in the order of a hash seeded by the scenario. The sample is small
    (its size is set when it is drawn), so it is broadcast.
    """
    x = F.array(*[F.col(c).cast("double") for c in columns])
    by_key = Window.orderBy(tie_break(key), key)  # the sample has a fixed size
    rows = sample.select(key, LABEL, x.alias("x"), F.row_number().over(by_key).alias("place"))
    scenario = ["position", "repeat"]
    shuffles = [(p, r) for p in range(len(columns)) for r in range(repeats)]

    def scenarios(pairs: list[tuple[int, int]]) -> Column:
        return F.explode(F.array(*[F.struct(F.lit(p).alias("position"), F.lit(r).alias("repeat")) for p, r in pairs]))

    # Only single values are shuffled: the value of each row that takes another's place.
    seeded = F.md5(F.concat_ws("|", F.col(key), F.col("position"), F.col("repeat")))
    other = F.row_number().over(Window.partitionBy(scenario).orderBy(seeded, key))
    donors = rows.select(key, "x", scenarios(shuffles).alias("s")).select(
        key, "s.*", F.get("x", F.col("s.position")).alias("new_value")
    )
    donors = donors.select(*scenario, "new_value", other.alias("place"))
    swapped = donors.join(F.broadcast(rows), "place").withColumn(
        "x", F.transform("x", lambda v, i: F.when(i == F.col("position"), F.col("new_value")).otherwise(v))
    )
    as_is = rows.select(scenarios([(-1, 0)]).alias("s"), LABEL, "x").select("s.*", LABEL, "x")
    mixed = swapped.select(*scenario, LABEL, "x").unionByName(as_is)

    # The rows are vectors already, so the model's assembler is left out.
    assembler, *fitted = model.stages
    vectors = mixed.select(*scenario, LABEL, array_to_vector("x").alias(assembler.getOutputCol()))
    scored = PipelineModel(fitted).transform(vectors).select(*scenario, LABEL, churn_probability().alias("score"))

    points = scored.groupBy(*scenario, "score").agg(F.count(F.lit(1)).alias("n"), F.sum(LABEL).alias("pos"))
    down = Window.partitionBy(scenario).orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, 0)
    curve = points.select("*", F.sum("n").over(down).alias("cum_n"), F.sum("pos").over(down).alias("cum_pos"))
    step = F.sum(F.col("pos") * F.col("cum_pos") / F.col("cum_n"))
    ap = curve.groupBy(*scenario).agg((step / F.nullif(F.sum("pos"), F.lit(0))).alias("ap"))

    base = F.max(F.when(F.col("position") == -1, F.col("ap"))).over(Window.partitionBy())  # one row per scenario
    loss = (
        ap.select("position", "ap", base.alias("base"))
        .where(F.col("position") >= 0)
        .groupBy("position")
        .agg(F.avg(F.coalesce(F.col("base") - F.col("ap"), F.lit(0.0))).alias("loss"))
        .select(F.get(_names(columns), F.col("position")).alias("feature"), "loss")
    )
    return _share_of_max(loss, "loss", "perm_norm")


def importance_comparison(gain: DataFrame, permutation: DataFrame, top: int = 15) -> DataFrame:
    return (
        gain.join(permutation, "feature")
        .select("feature", F.round("gain_norm", 6).alias("gain_norm"), F.round("perm_norm", 6).alias("perm_norm"))
        .orderBy(F.desc("gain_norm"), "feature")
        .limit(top)
    )
