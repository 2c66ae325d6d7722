"""The tables and models that queries share, each made once per application.

The order is that of the analysis: raw customers, feature table, split with folds,
fitted models, attributions. Everything is written to the shared folder and read back,
so queries scan columns they need and never repeat the work before them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnline.operators import attribution, metrics, quality, search, segments, training
from churnline.operators.features import FeatureEncoder, feature_columns
from churnline.operators.moments import moment_table
from churnline.operators.splits import FOLDS, fixed_sample, ordered_holdout, stratified_folds
from churnline.operators.training import ScoreCard
from churnline.schema import KEY, LABEL
from churnline.session import fresh_path, once, shared_folder, staged, staged_facts
from churnline.sources.artifacts import load_model, save_model
from churnline.sources.panel import customer_snapshots

# A given logistic model: lets everything that follows a score be checked without training.
CARD = ScoreCard(
    intercept=0.2,
    weights={
        "tenure": -0.03,
        "Contract_ord": -0.6,
        "charges_per_service": 0.04,
        "is_high_value": 0.4,
        "IS_Fiber_optic": 0.7,
        "PaperlessBilling": 0.5,
        "TechSupport_No": 0.3,
        "tb_0_12": 0.6,
    },
)
CARD_THRESHOLD = 0.5

# Given parameters inside the search ranges, for queries that need a model but no search.
TREES = {
    "maxIter": 200,
    "maxDepth": 3,
    "stepSize": 0.1,
    "subsamplingRate": 0.8,
    "featureSubsetStrategy": "0.8",
    "minInstancesPerNode": 5,
}


class Stages:
    """``source`` names the raw customers and ``load`` reads them.

    With ``trees`` those parameters are fitted; without, ``trials`` parameter sets are searched,
    each with every number of trees.
    """

    def __init__(
        self,
        spark: SparkSession,
        source: str,
        load: Callable[[SparkSession, str], DataFrame] = customer_snapshots,
        trials: int = search.SETS,
        space: dict | None = None,
        trees: dict | None = None,
    ):
        self.spark = spark
        self.folder = source.rstrip("/")
        self.load = load
        self.trials = trials
        self.space = space
        self.given = trees
        context = spark.sparkContext
        # Boosting cuts its lineage there.
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(shared_folder(spark))

    def raw(self) -> DataFrame:
        return staged(self.spark, "raw", (self.folder,), lambda: self.load(self.spark, self.folder))

    def encoder(self) -> FeatureEncoder:
        return once(self.spark, ("encoder", self.folder), lambda: FeatureEncoder.fit(self.raw()))

    def features(self) -> DataFrame:
        build = lambda: self.encoder().transform(self.raw())
        return staged(self.spark, "features", (self.folder,), build, facts=quality.gate_facts())

    def kept(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        """An output table, written once."""
        return staged(self.spark, name, (self.folder,), build)

    def facts(self, name: str) -> dict:
        """What the write of a table observed: ``n_rows``, and more where it was asked for."""
        return staged_facts(self.spark, name, (self.folder,))

    def moments(self) -> DataFrame:
        """Moments of all features and the label: one scan for correlations and ranges."""
        build = lambda: moment_table(self.features(), [*self.columns(), LABEL])
        return staged(self.spark, "moments", (self.folder,), build)

    def columns(self) -> list[str]:
        return feature_columns(self.features())

    def modelling(self) -> DataFrame:
        """Features with ``split`` and ``fold``; folds are even within each split."""

        def build() -> DataFrame:
            return stratified_folds(ordered_holdout(self.features()), within=("split",))

        return staged(self.spark, "modelling", (self.folder,), build, partition_by=("split",))

    def train(self) -> DataFrame:
        return self.modelling().where(F.col("split") == "train")

    def sample(self) -> DataFrame:
        """The fixed sample that permutation importance works on."""
        return staged(self.spark, "sample", (self.folder,), lambda: fixed_sample(self.features()))

    # ---- the given model -----------------------------------------------------------

    def scored(self) -> DataFrame:
        """Scores of the given card, to six digits: other engines' last bits differ."""
        score = F.round(CARD.score(), 6).alias("score")
        return self.modelling().select(KEY, LABEL, "split", "tenure", "MonthlyCharges", score)

    def scored_test(self) -> DataFrame:
        return self.scored().where(F.col("split") == "test")

    def attributions(self) -> DataFrame:
        return attribution.linear_attributions(self.features(), CARD, self.columns())

    def importance(self) -> DataFrame:
        build = lambda: attribution.global_importance(self.attributions(), self.columns())
        return staged(self.spark, "importance", (self.folder,), build)

    def halves(self) -> DataFrame:
        build = lambda: segments.segment_halves(self.features(), self.columns(), self.importance())
        return staged(self.spark, "halves", (self.folder,), build)

    def metrics(self) -> DataFrame:
        build = lambda: metrics.evaluation_metrics(self.scored_test(), "card")
        return staged(self.spark, "metrics", (self.folder,), build)

    # ---- trained models --------------------------------------------------------------

    def _model(self, name: str, fit) -> PipelineModel:
        def train() -> PipelineModel:
            return load_model(save_model(fit(), fresh_path(self.spark, name)))

        return once(self.spark, (name, self.folder), train)

    def baseline(self) -> PipelineModel:
        return self._model("baseline", lambda: training.train_baseline(self.train(), self.columns()))

    def tree_params(self) -> dict:
        return self.given or search.best_params(self.tuned())

    def tuned(self) -> list[dict]:
        return once(
            self.spark,
            ("tuned", self.folder),
            lambda: search.search_trees(self.train(), self.columns(), self.trials, FOLDS, space=self.space),
        )

    def trees(self) -> PipelineModel:
        def fit() -> PipelineModel:
            return training.fit_trees(self.train(), self.columns(), self.tree_params())

        return self._model("trees", fit)

    def model_scores(self, model: PipelineModel) -> DataFrame:
        keep = [KEY, LABEL, "split", "tenure", "MonthlyCharges"]
        return training.score_rows(model, self.modelling(), keep)

    def baseline_scores(self) -> DataFrame:
        return staged(self.spark, "baseline_scores", (self.folder,), lambda: self.model_scores(self.baseline()))

    def tree_scores(self) -> DataFrame:
        return staged(self.spark, "tree_scores", (self.folder,), lambda: self.model_scores(self.trees()))

    def _threshold(self, name: str, fit) -> float:
        """Best-F1 threshold of a model on training rows, each scored out of its fold."""

        def choose() -> float:
            build = lambda: training.out_of_fold_scores(self.train(), fit, folds=FOLDS)
            scored = staged(self.spark, f"{name}_out_of_fold", (self.folder,), build)
            return metrics.best_f1_threshold(scored).first()["threshold"]

        return once(self.spark, (f"{name}_threshold", self.folder), choose)

    def baseline_threshold(self) -> float:
        return self._threshold("baseline", lambda rows: training.train_baseline(rows, self.columns()))

    def tree_threshold(self) -> float:
        params = self.tree_params()
        return self._threshold("trees", lambda rows: training.fit_trees(rows, self.columns(), params))

    def comparison(self, on_test: bool = False) -> DataFrame:
        """Metrics of both models on the test rows, one threshold protocol for both.

        Thresholds come from training rows out of fold, or, ``on_test``, from the test rows.
        """
        test = F.col("split") == "test"
        base = None if on_test else self.baseline_threshold()
        trees = None if on_test else self.tree_threshold()
        return metrics.evaluation_metrics(self.baseline_scores().where(test), "baseline", base).unionByName(
            metrics.evaluation_metrics(self.tree_scores().where(test), "trees", trees)
        )

    def nodes(self) -> DataFrame:
        model = self.trees().stages[-1]
        return staged(self.spark, "nodes", (self.folder,), lambda: attribution.tree_nodes(model))

    def tree_attributions(self) -> DataFrame:
        return staged(
            self.spark,
            "tree_attributions",
            (self.folder,),
            lambda: attribution.tree_attributions(self.features(), self.nodes(), self.columns()),
        )
