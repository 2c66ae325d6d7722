"""Training and scoring: logistic baseline, boosted trees and their tuning."""

from __future__ import annotations

import random
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel, Transformer
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier, LogisticRegression
from pyspark.ml.evaluation import Evaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from churnline.functions.scalars import with_row
from churnline.operators import boosting, metrics
from churnline.operators.moments import moment_table, single
from churnline.schema import KEY, LABEL
from churnline.session import fresh_path

SEED = 42
TRIALS = 50

# The tuning ranges (low, high).
SEARCH_SPACE = {
    "maxIter": (200, 800),  # in steps of 50
    "maxDepth": (3, 8),
    "stepSize": (0.01, 0.2),  # drawn on a log scale
    "subsamplingRate": (0.6, 1.0),
    "featureShare": (0.6, 1.0),
    "minInstancesPerNode": (1, 10),
}


def standardized(features: DataFrame, columns: list[str], train: Column | None = None) -> DataFrame:
    """Columns as (x - mean) / population deviation of the training rows; constants become 0."""
    used = features if train is None else features.where(train)
    spread = F.coalesce(F.nullif(F.sqrt("var_a"), F.lit(0.0)), F.lit(1.0))
    stats = single(moment_table(used, columns), columns).select("feature", F.col("mean_a").alias("mean"), spread.alias("sd"))
    fitted = stats.agg(F.sort_array(F.collect_list(F.struct("feature", "mean", "sd"))).alias("by_name"))
    place = {c: F.get("fit.by_name", F.lit(i)) for i, c in enumerate(sorted(columns))}
    others = [c for c in features.columns if c not in columns]
    scaled = [((F.col(c) - place[c]["mean"]) / place[c]["sd"]).alias(c) for c in columns]
    return with_row(features, "fit", fitted).select(*others, *scaled)


@dataclass(frozen=True)
class ScoreCard:
    """A logistic model with given weights, applied as a column expression."""

    intercept: float
    weights: dict[str, float]

    def logit(self, value_of=F.col) -> Column:
        total = F.lit(self.intercept)
        for name, weight in self.weights.items():
            total = total + F.lit(weight) * value_of(name)
        return total

    def score(self, value_of=F.col) -> Column:
        return 1 / (1 + F.exp(-self.logit(value_of)))


def churn_probability(column: str = "probability") -> Column:
    return vector_to_array(column)[1]


def score_rows(model: Transformer, rows: DataFrame, keep: list[str]) -> DataFrame:
    if isinstance(model, PipelineModel) and isinstance(model.stages[-1], GBTClassificationModel) and len(model.stages) == 2:
        return boosting.scored(model.stages[-1], rows, model.stages[0].getInputCols(), keep)
    return model.transform(rows).select(*keep, churn_probability().alias("score"))


def predicted(scored: DataFrame, threshold: Column | float) -> DataFrame:
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def _weighted(train: DataFrame, positive: float, negative: float) -> DataFrame:
    weight = F.when(F.col(LABEL) == 1, F.lit(positive)).otherwise(F.lit(negative))
    return train.withColumn("weight", weight).withColumn("label", F.col(LABEL).cast("double"))


def label_counts(train: DataFrame) -> tuple[int, int]:
    row = train.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(LABEL), F.lit(0)).alias("pos")).first()
    return row["n"], row["pos"]


def train_baseline(train: DataFrame, columns: list[str]) -> PipelineModel:
    """L2 logistic regression on standardised columns, classes weighted evenly.

    The objective is half the squared weights plus the weighted log losses (C = 1). The
    scaler divides by the sample deviation, hence the (n - 1) / n in the penalty.
    """
    n, pos = label_counts(train)
    rows = _weighted(train, n / (2 * max(1, pos)), n / (2 * max(1, n - pos)))
    stages = [
        VectorAssembler(inputCols=columns, outputCol="raw_features", handleInvalid="error"),
        StandardScaler(inputCol="raw_features", outputCol="features", withMean=True, withStd=True),
        LogisticRegression(
            weightCol="weight",
            regParam=(n - 1) / n / n,
            elasticNetParam=0.0,
            standardization=False,
            maxIter=1000,
            tol=1e-9,
        ),
    ]
    # A fitted logistic model keeps its training summary and with it the session; a saved one does not.
    path = fresh_path(train.sparkSession, "baseline_fit")
    Pipeline(stages=stages).fit(rows).write().save(path)
    return PipelineModel.load(path)


class AveragePrecision(Evaluator):
    """Average precision as a tuning objective."""

    def _evaluate(self, dataset: DataFrame) -> float:
        scored = dataset.select(F.col("label").cast("int").alias(LABEL), churn_probability().alias("score"))
        return metrics.ranking_facts(scored).first()["pr_auc"]

    def isLargerBetter(self) -> bool:
        return True


def draw_trials(gbt: GBTClassifier, trials: int, seed: int = SEED, space: dict | None = None) -> list[dict]:
    """A seeded list of parameter maps from the search space."""
    ranges = {**SEARCH_SPACE, **(space or {})}
    source = random.Random(seed)
    drawn = []
    for _ in range(trials):
        low, high = ranges["maxIter"]
        step = min(50, max(1, high - low))
        rate_low, rate_high = ranges["stepSize"]
        drawn.append(
            {
                gbt.maxIter: low + step * source.randint(0, (high - low) // step),
                gbt.maxDepth: source.randint(*ranges["maxDepth"]),
                gbt.stepSize: rate_low * (rate_high / rate_low) ** source.random(),
                gbt.subsamplingRate: source.uniform(*ranges["subsamplingRate"]),
                gbt.featureSubsetStrategy: f"{source.uniform(*ranges['featureShare']):.4f}",
                gbt.minInstancesPerNode: source.randint(*ranges["minInstancesPerNode"]),
            }
        )
    return drawn


def tree_rows(train: DataFrame, columns: list[str], keep: list[str]) -> DataFrame:
    n, pos = label_counts(train)
    assembled = VectorAssembler(inputCols=columns, outputCol="features", handleInvalid="error").transform(train)
    return _weighted(assembled, (n - pos) / max(1, pos), 1.0).select("features", "label", "weight", *keep)


def boosted(seed: int = SEED, **params) -> GBTClassifier:
    return GBTClassifier(lossType="logistic", weightCol="weight", seed=seed, **params)


def fit_trees(train: DataFrame, columns: list[str], params: dict, seed: int = SEED) -> PipelineModel:
    """Boosted trees with given parameters (by name), positives weighted up."""
    x = F.array(*[F.col(c).cast("double") for c in columns])
    rows = train.select(x.alias("x"), F.col(LABEL).cast("double").alias("label"))
    return as_pipeline(boosting.fit(rows, len(columns), boosted(seed, **params)), columns)


def best_params(tuned: CrossValidatorModel) -> dict:
    best = max(range(len(tuned.avgMetrics)), key=lambda i: tuned.avgMetrics[i])
    return {p.name: v for p, v in tuned.getEstimatorParamMaps()[best].items()}


def tune_trees(
    train: DataFrame,
    columns: list[str],
    trials: int = TRIALS,
    folds: int = 3,
    fold_column: str = "fold",
    seed: int = SEED,
    space: dict | None = None,
    parallelism: int = 4,
) -> CrossValidatorModel:
    """Boosted trees with positives weighted up, tuned for average precision over given folds.

    The best parameters are refitted on all training rows. Assembling happens once,
    ahead of the search.
    """
    rows = tree_rows(train, columns, [fold_column])
    gbt = boosted(seed)
    search = CrossValidator(
        estimator=gbt,
        estimatorParamMaps=draw_trials(gbt, trials, seed, space),
        evaluator=AveragePrecision(),
        numFolds=folds,
        foldCol=fold_column,
        parallelism=parallelism,
        seed=seed,
    )
    cached = rows.persist()
    try:
        return search.fit(cached)
    finally:
        cached.unpersist()


def tuning_results(tuned: CrossValidatorModel) -> DataFrame:
    """One row per trial, best first."""
    rows = [
        {"trial": number, **{p.name: v for p, v in params.items()}, "average_precision": float(score)}
        for number, (params, score) in enumerate(zip(tuned.getEstimatorParamMaps(), tuned.avgMetrics), start=1)
    ]
    schema = (
        "trial int, maxIter int, maxDepth int, stepSize double, subsamplingRate double, "
        "featureSubsetStrategy string, minInstancesPerNode int, average_precision double"
    )
    table = SparkSession.active().createDataFrame(rows, schema)
    return table.orderBy(F.desc("average_precision"), "trial")


def as_pipeline(model, columns: list[str]) -> PipelineModel:
    """The fitted trees behind their assembler, ready to save and to score feature rows."""
    assembler = VectorAssembler(inputCols=columns, outputCol="features", handleInvalid="error")
    return PipelineModel(stages=[assembler, model])


def in_parallel(work, items: list) -> list:
    """``work`` of every item, each in a thread of its own: Spark runs their jobs side by side."""
    if len(items) < 2:
        return [work(i) for i in items]
    with ThreadPoolExecutor(len(items)) as pool:
        return list(pool.map(inheritable_thread_target(SparkSession.active())(work), items))


def out_of_fold_scores(train: DataFrame, fit, fold_column: str = "fold", folds: int = 3) -> DataFrame:
    """Score every training row by a model that has not seen its fold; the folds are fitted side by side."""
    models = in_parallel(lambda fold: fit(train.where(F.col(fold_column) != fold)), list(range(folds)))
    parts = None
    for fold, model in enumerate(models):
        scored = score_rows(model, train.where(F.col(fold_column) == fold), [KEY, LABEL])
        parts = scored if parts is None else parts.unionByName(scored)
    return parts
