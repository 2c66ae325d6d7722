"""Tuning of boosted trees: prefix-scored ensembles and successive halving over the folds.

The first n trees of an ensemble are the ensemble of n trees, so one fit of the most trees
scores every smaller number as well. Parameter sets are drawn from the search ranges and
fitted for the first fold; only the best share of them goes on to the next fold, and so on.
The best set and number of trees among those that went through all folds are refitted.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnline.operators import ensembles, metrics
from churnline.operators.attribution import tree_nodes
from churnline.operators.training import SEARCH_SPACE, SEED, boosted, draw_trials, in_parallel, tree_rows

SETS = 12
KEEP = 1 / 3
STEP = 50
AT_ONCE = 4


def tree_counts(space: dict | None = None) -> list[int]:
    """The numbers of trees in the search range, in steps of 50 (of 1 in a narrower range)."""
    low, high = {**SEARCH_SPACE, **(space or {})}["maxIter"]
    step = min(STEP, max(1, high - low))
    return list(range(low, high + 1, step))


def prefix_scored(nodes: DataFrame, rows: DataFrame, counts: list[int], keep: list[str]) -> DataFrame:
    """(keep..., trees, score): every row's score after the first ``counts`` trees.

    Rows have ``features``. The node table, whose size depends on the model only, goes to
    every task; rows stay in their partitions.
    """
    trees = rows.sparkSession.sparkContext.broadcast(ensembles.trees_of(nodes.toPandas()))
    score_all, wanted = ensembles.prefix_scores, list(counts)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = batch.column("x").flatten().to_numpy().reshape(batch.num_rows, -1).T.copy()
            for n, score in zip(wanted, score_all(x, trees.value, wanted)):
                columns = [*[batch.column(c) for c in keep], pa.repeat(pa.scalar(n, pa.int32()), batch.num_rows), pa.array(score)]
                yield pa.RecordBatch.from_arrays(columns, names=[*keep, "trees", "score"])

    given = rows.select(*keep, vector_to_array("features").alias("x"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*keep).schema)
    return given.mapInArrow(work, f"{kinds}, trees int, score double")


def average_precisions(scored: DataFrame, label: str) -> dict[int, float]:
    """Average precision by number of trees: one row per number reaches the driver."""
    rows = metrics.average_precision_by(scored, "trees", label).collect()
    return {r["trees"]: r["average_precision"] for r in rows}


def search_trees(
    train: DataFrame,
    columns: list[str],
    sets: int = SETS,
    folds: int = 3,
    fold_column: str = "fold",
    seed: int = SEED,
    space: dict | None = None,
    keep: float = KEEP,
) -> list[dict]:
    """All trials, best first: parameters, the folds seen and the mean average precision over them.

    A trial is a parameter set with a number of trees. Trials that went through more folds come
    first, so the first row is the choice.
    """
    counts = tree_counts(space)
    rows = tree_rows(train, columns, [fold_column]).persist()
    gbt = GBTClassifier()
    drawn = [{p.name: v for p, v in t.items() if p.name != "maxIter"} for t in draw_trials(gbt, sets, seed, space)]
    scores: list[list[dict[int, float]]] = [[] for _ in drawn]
    alive = list(range(sets))

    def best(number: int) -> float:
        return max(float(np.mean([s[n] for s in scores[number]])) for n in counts)

    def try_one(number: int, fold: int) -> dict[int, float]:
        model = boosted(seed, maxIter=counts[-1], **drawn[number]).fit(rows.where(F.col(fold_column) != fold))
        unseen = rows.where(F.col(fold_column) == fold)
        return average_precisions(prefix_scored(tree_nodes(model), unseen, counts, ["label"]), "label")

    try:
        for fold in range(folds):
            for first in range(0, len(alive), AT_ONCE):
                together = alive[first : first + AT_ONCE]
                for number, found in zip(together, in_parallel(lambda n: try_one(n, fold), together)):
                    scores[number].append(found)
            if fold < folds - 1:
                alive = sorted(alive, key=lambda n: (-best(n), n))[: max(1, math.ceil(keep * len(alive)))]
    finally:
        rows.unpersist()
    trials = [
        {"set": number + 1, "maxIter": n, **params, "folds": len(seen), "average_precision": float(np.mean([s[n] for s in seen]))}
        for number, (params, seen) in enumerate(zip(drawn, scores))
        for n in counts
    ]
    return sorted(trials, key=lambda t: (-t["folds"], -t["average_precision"], t["set"], t["maxIter"]))


def best_params(trials: list[dict]) -> dict:
    return {k: v for k, v in trials[0].items() if k not in ("set", "folds", "average_precision")}


def tuning_results(spark: SparkSession, trials: list[dict]) -> DataFrame:
    """One row per trial, ranked: more folds first, then by average precision."""
    schema = (
        "rank int, set int, maxIter int, maxDepth int, stepSize double, subsamplingRate double, "
        "featureSubsetStrategy string, minInstancesPerNode int, folds int, average_precision double"
    )
    return spark.createDataFrame([{"rank": i, **t} for i, t in enumerate(trials, start=1)], schema)
