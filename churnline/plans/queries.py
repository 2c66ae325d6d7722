"""The registered queries: name -> function of (spark, table folder)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from churnline.functions import encodings as enc
from churnline.operators import aggregates, attribution, correlation, metrics, products, quality, segments, splits, training
from churnline.operators.features import clean, engineered, segment_columns, unseen_categories
from churnline.plans.stages import CARD, CARD_THRESHOLD, TREES, Stages
from churnline.schema import INTERNET_ADD_ONS, KEY, LABEL, PAYMENT_METHODS, YES_NO_COLUMNS
from churnline.sources.customers import replace_table

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}

GATE_MIN_ROWS = 1000  # the smallest given tables have fewer customers than the default asks for
CATALOG_TABLE = "churnline_features"
SMALL_GAP = 0.005  # labels of the given tables are almost independent of the features
SCENARIOS = [
    ("two_year_contract", "Contract_ord", 2.0),
    ("paper_bills", "PaperlessBilling", 0.0),
    ("supported_bundle", "TechSupport_No", 0.0),
    ("supported_bundle", "charges_per_service", 5.0),
]
# The levels whose rates the narrative quotes.
WANTED_LEVELS = [
    ("Contract", "Month-to-month"),
    ("Contract", "One year"),
    ("Contract", "Two year"),
    ("InternetService", "Fiber optic"),
    ("InternetService", "DSL"),
    ("InternetService", "No"),
    ("PaymentMethod", "Electronic check"),
    ("is_high_value", "1"),
    ("is_high_value", "0"),
]


def query(build: Callable[[Stages], DataFrame]) -> Callable[[Stages], DataFrame]:
    _QUERIES[build.__name__] = lambda spark, folder: build(Stages(spark, folder, trees=TREES))
    return build


def registered() -> dict[str, Query]:
    return dict(_QUERIES)


def _six(**columns: Column) -> list[Column]:
    return [F.round(c, 6).alias(name) for name, c in columns.items()]


def _named(columns: dict[str, Column]) -> list[Column]:
    return [c.alias(name) for name, c in columns.items()]


# ---- sources and outputs -------------------------------------------------------------


@query
def raw_customers(s: Stages) -> DataFrame:
    raw = s.raw()
    return raw.withColumn("obs_date", F.col("obs_date").cast("string"))


@query
def features_table_count(s: Stages) -> DataFrame:
    s.features().createOrReplaceTempView("features")
    return s.spark.sql("SELECT count(*) AS n_rows FROM features")


@query
def features_catalog_count(s: Stages) -> DataFrame:
    """The feature table as a table of the catalog, replaced on every run, counted by SQL."""
    replace_table(s.features(), CATALOG_TABLE)
    return s.spark.sql("SELECT count(*) AS n_rows FROM IDENTIFIER(:name)", {"name": CATALOG_TABLE})


@query
def output_manifest(s: Stages) -> DataFrame:
    """Row counts of the outputs, as observed when each was written."""
    raw, test = engineered(clean(s.raw())), s.scored_test()
    s.features(), s.importance(), s.metrics()
    outputs = {
        "raw_customers": "raw", "features": "features", "evaluation_metrics": "metrics", "global_importance": "importance"
    }
    more = {
        "cohort_churn": lambda: aggregates.cohort_churn(raw),
        "segment_churn": lambda: aggregates.segment_churn_all(raw),
        "class_balance": lambda: aggregates.class_balance(raw),
        "target_correlation": lambda: correlation.target_correlation(s.features(), s.columns(), s.moments()),
        "scores": s.scored,
        "gains_curve": lambda: metrics.gains_curve(test),
        "attributions": s.attributions,
        "risk_tiers": lambda: products.risk_tier_distribution(s.scored()),
    }
    for name, build in more.items():
        s.kept(f"out_{name}", build)
        outputs[name] = f"out_{name}"
    return products.observed_manifest(s.spark, {name: s.facts(stage)["n_rows"] for name, stage in outputs.items()})


# ---- preparation ---------------------------------------------------------------------


@query
def clean_charges(s: Stages) -> DataFrame:
    return clean(s.raw()).select(KEY, "TotalCharges", LABEL)


@query
def engineered_features(s: Stages) -> DataFrame:
    rows = engineered(clean(s.raw()))
    return rows.select(
        KEY,
        *_six(avg_monthly_charges=F.col("avg_monthly_charges"), charges_per_service=F.col("charges_per_service")),
        "active_services",
        "is_high_value",
    )


@query
def tenure_bucket(s: Stages) -> DataFrame:
    return s.raw().select(KEY, "tenure", enc.tenure_bucket().alias("tenure_bucket"))


@query
def contract_ordinal(s: Stages) -> DataFrame:
    return s.raw().select(KEY, "Contract", enc.contract_ordinal().alias("Contract_ord"))


@query
def unseen_contracts(s: Stages) -> DataFrame:
    return unseen_categories(s.raw())


@query
def unseen_payments(s: Stages) -> DataFrame:
    """Market segments stand in for payment methods in the given tables, so levels are found here."""
    return unseen_categories(s.raw(), "PaymentMethod", PAYMENT_METHODS)


@query
def onehot_internet_payment(s: Stages) -> DataFrame:
    return s.raw().select(KEY, *_named(s.encoder().one_hot(["InternetService", "PaymentMethod"])))


@query
def binary_encodings(s: Stages) -> DataFrame:
    flags = s.encoder().binary()
    return s.raw().select(KEY, *[flags[c].alias(c) for c in ["gender", *YES_NO_COLUMNS]])


@query
def onehot_services(s: Stages) -> DataFrame:
    return s.raw().select(KEY, *_named(s.encoder().one_hot(["MultipleLines", *INTERNET_ADD_ONS])))


@query
def onehot_tenure(s: Stages) -> DataFrame:
    rows = s.raw().withColumn("tenure_bucket", enc.tenure_bucket())
    return rows.select(KEY, *_named(s.encoder().bucket_flags()))


@query
def feature_table(s: Stages) -> DataFrame:
    return segments.rounded(s.features())


@query
def segment_column_levels(s: Stages) -> DataFrame:
    names = segment_columns(s.columns())
    levels = s.features().agg(*[F.count_distinct(c).alias(c) for c in names]).unpivot([], names, "column_name", "levels")
    position = F.array_position(F.array(*[F.lit(c) for c in names]), F.col("column_name"))
    return levels.select(position.alias("position"), "column_name", "levels")


@query
def quality_nulls(s: Stages) -> DataFrame:
    return quality.null_counts(s.features())


@query
def observed_quality_gate(s: Stages) -> DataFrame:
    """The gate from what the feature table's write observed."""
    s.features()
    return quality.observed_gate(s.spark, s.facts("features"), min_rows=GATE_MIN_ROWS)


@query
def quality_gate(s: Stages) -> DataFrame:
    return quality.quality_gate(s.features(), min_rows=GATE_MIN_ROWS)


# ---- aggregates ----------------------------------------------------------------------


def _prepared(s: Stages) -> DataFrame:
    return engineered(clean(s.raw()))


@query
def cohort_churn(s: Stages) -> DataFrame:
    return aggregates.cohort_churn(_prepared(s))


@query
def cohort_churn_onehot(s: Stages) -> DataFrame:
    return aggregates.cohort_churn_onehot(s.features())


@query
def segment_contract(s: Stages) -> DataFrame:
    return aggregates.segment_churn(_prepared(s), "Contract")


@query
def segment_payment(s: Stages) -> DataFrame:
    return aggregates.segment_churn(_prepared(s), "PaymentMethod")


@query
def segment_internet(s: Stages) -> DataFrame:
    return aggregates.segment_churn(_prepared(s), "InternetService")


@query
def segment_high_value(s: Stages) -> DataFrame:
    return aggregates.segment_churn(_prepared(s), "is_high_value")


@query
def segment_all(s: Stages) -> DataFrame:
    return aggregates.segment_churn_all(_prepared(s))


@query
def segment_by_column(s: Stages) -> DataFrame:
    rates = aggregates.segment_churn_all(s.features(), segment_columns(s.columns()))
    return rates.withColumn("churn_rate_pct", F.round(100 * F.col("churn_rate"), 1))


@query
def class_balance(s: Stages) -> DataFrame:
    return aggregates.class_balance(s.features())


@query
def correlation_matrix(s: Stages) -> DataFrame:
    return correlation.correlation_matrix(s.features(), [*s.columns(), LABEL], s.moments())


@query
def target_correlation(s: Stages) -> DataFrame:
    return correlation.target_correlation(s.features(), s.columns(), s.moments())


@query
def correlation_top15(s: Stages) -> DataFrame:
    return correlation.correlation_top(s.features(), s.columns(), 15, s.moments())


@query
def correlation_drivers(s: Stages) -> DataFrame:
    return correlation.correlation_drivers(s.features(), s.columns(), moments=s.moments())


@query
def eda_facts(s: Stages) -> DataFrame:
    rows = _prepared(s)
    return products.eda_facts(
        aggregates.cohort_churn(rows),
        aggregates.level_rates(rows, WANTED_LEVELS),
        aggregates.class_balance(rows),
        correlation.correlation_drivers(s.features(), s.columns(), moments=s.moments()),
    )


@query
def kpi_overview(s: Stages) -> DataFrame:
    return aggregates.kpi_overview(products.with_risk_tier(s.scored()), CARD_THRESHOLD)


@query
def feature_ranges(s: Stages) -> DataFrame:
    return aggregates.feature_ranges(s.features(), s.columns(), s.moments())


@query
def feature_split_points(s: Stages) -> DataFrame:
    return segments.rounded(segments.feature_split_points(s.features(), s.columns()))


# ---- splits and weights --------------------------------------------------------------


@query
def ordered_holdout(s: Stages) -> DataFrame:
    return splits.ordered_holdout(s.features().select(KEY, "tenure", LABEL)).select(KEY, "tenure", "split")


@query
def calendar_holdout(s: Stages) -> DataFrame:
    rows = splits.calendar_holdout(s.raw().select(KEY, "obs_date"))
    return rows.select(KEY, F.col("obs_date").cast("string").alias("obs_date"), "split")


@query
def rolling_folds(s: Stages) -> DataFrame:
    return splits.rolling_folds(s.raw().select(KEY, "c_custkey", "obs_date"), "c_custkey")


@query
def split_summary(s: Stages) -> DataFrame:
    return splits.split_summary(s.modelling())


@query
def stratified_folds(s: Stages) -> DataFrame:
    return splits.stratified_folds(s.features().select(KEY, LABEL)).select(KEY, LABEL, "fold")


@query
def class_weights(s: Stages) -> DataFrame:
    return splits.class_weights(s.train())


@query
def fixed_sample(s: Stages) -> DataFrame:
    return splits.fixed_sample(s.features().select(KEY, LABEL))


@query
def standardized_features(s: Stages) -> DataFrame:
    rows = training.standardized(s.modelling().drop("fold"), s.columns(), F.col("split") == "train")
    return segments.rounded(rows.drop(LABEL))


# ---- models --------------------------------------------------------------------------


@query
def baseline_scores(s: Stages) -> DataFrame:
    return s.baseline_scores()


@query
def gbt_scores(s: Stages) -> DataFrame:
    return s.tree_scores()


@query
def predicted_labels(s: Stages) -> DataFrame:
    return training.predicted(s.scored(), CARD_THRESHOLD).select(KEY, "score", "predicted")


@query
def model_comparison(s: Stages) -> DataFrame:
    return metrics.model_comparison(s.comparison(), ["baseline", "trees"])


# ---- evaluation ----------------------------------------------------------------------


@query
def pr_curve(s: Stages) -> DataFrame:
    return metrics.pr_curve(s.scored_test())


@query
def average_precision(s: Stages) -> DataFrame:
    return metrics.average_precision(s.scored_test())


@query
def roc_auc(s: Stages) -> DataFrame:
    return metrics.roc_auc(s.scored_test())


@query
def recall_at_k(s: Stages) -> DataFrame:
    return metrics.recall_at_k(s.scored_test())


@query
def lift_at_k(s: Stages) -> DataFrame:
    return metrics.lift_at_k(s.scored_test())


@query
def best_f1_threshold(s: Stages) -> DataFrame:
    return metrics.best_f1_threshold(s.scored_test())


@query
def confusion_at_threshold(s: Stages) -> DataFrame:
    return metrics.confusion_at_threshold(s.scored_test(), CARD_THRESHOLD)


@query
def classification_report(s: Stages) -> DataFrame:
    return metrics.classification_report(s.scored_test(), CARD_THRESHOLD)


@query
def gains_curve(s: Stages) -> DataFrame:
    return metrics.gains_curve(s.scored_test())


@query
def gains_curve_full(s: Stages) -> DataFrame:
    return metrics.gains_curve_full(s.scored_test())


@query
def evaluation_metrics(s: Stages) -> DataFrame:
    return s.metrics()


# ---- interpretation ------------------------------------------------------------------


@query
def linear_contributions(s: Stages) -> DataFrame:
    return segments.rounded(attribution.long_attributions(s.attributions(), s.columns()))


@query
def linear_base_value(s: Stages) -> DataFrame:
    return attribution.linear_base_value(s.features(), CARD)


@query
def tree_contributions(s: Stages) -> DataFrame:
    return attribution.long_attributions(s.tree_attributions(), s.columns())


@query
def tree_additivity(s: Stages) -> DataFrame:
    """Rows, and those where base value and contributions do not add up to the score."""
    base = attribution.tree_base_value(s.nodes())
    margin = F.lit(base) + F.aggregate("contributions", F.lit(0.0), lambda a, c: a + c)
    sums = s.tree_attributions().select(KEY, (1 / (1 + F.exp(-margin))).alias("rebuilt"))
    both = sums.join(s.tree_scores(), KEY)
    return both.agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(F.abs(F.col("rebuilt") - F.col("score")) > 1e-6).alias("n_off")
    )


@query
def attribution_base_value(s: Stages) -> DataFrame:
    rows = s.nodes().agg(F.count_distinct("tree").alias("trees"))
    return rows.select("trees", F.round(F.lit(attribution.tree_base_value(s.nodes())), 6).alias("base_value"))


@query
def global_importance(s: Stages) -> DataFrame:
    return s.importance()


@query
def tree_importance(s: Stages) -> DataFrame:
    return attribution.global_importance(s.tree_attributions(), s.columns())


@query
def beeswarm_points(s: Stages) -> DataFrame:
    return segments.rounded(attribution.beeswarm_points(s.attributions(), s.columns()))


@query
def top_drivers(s: Stages) -> DataFrame:
    return attribution.top_drivers(s.attributions(), s.columns())


@query
def customer_breakdown(s: Stages) -> DataFrame:
    one = s.features().agg(F.min(KEY)).scalar()
    table = attribution.customer_breakdown(s.attributions(), s.columns(), one)
    return segments.rounded(table)


@query
def gain_importance(s: Stages) -> DataFrame:
    return attribution.gain_importance(s.nodes(), s.columns())


def _permutation(s: Stages) -> DataFrame:
    return attribution.permutation_importance(s.trees(), s.sample(), s.columns())


@query
def permutation_importance(s: Stages) -> DataFrame:
    return _permutation(s)


@query
def importance_comparison(s: Stages) -> DataFrame:
    return attribution.importance_comparison(attribution.gain_importance(s.nodes(), s.columns()), _permutation(s))


# ---- segments ------------------------------------------------------------------------


@query
def segment_candidates(s: Stages) -> DataFrame:
    return segments.rounded(segments.segment_candidates(s.halves()))


@query
def actionable_segments(s: Stages) -> DataFrame:
    return segments.rounded(segments.actionable_segments(segments.segment_candidates(s.halves())))


def _segments(s: Stages) -> DataFrame:
    return segments.actionable_segments(segments.segment_candidates(s.halves(), min_gap=SMALL_GAP))


@query
def actionable_segments_small_gap(s: Stages) -> DataFrame:
    return segments.rounded(_segments(s))


@query
def segment_report(s: Stages) -> DataFrame:
    return segments.rounded(segments.segment_report(_segments(s)))


# ---- products ------------------------------------------------------------------------


@query
def risk_tiers(s: Stages) -> DataFrame:
    return products.with_risk_tier(s.scored()).select(KEY, "score", "risk_tier")


@query
def risk_tier_distribution(s: Stages) -> DataFrame:
    return products.risk_tier_distribution(s.scored())


@query
def score_histogram(s: Stages) -> DataFrame:
    return products.score_histogram(s.scored())


@query
def risk_list(s: Stages) -> DataFrame:
    return products.risk_list(s.scored(), s.attributions(), s.columns())


@query
def whatif_scores(s: Stages) -> DataFrame:
    scenarios = s.spark.createDataFrame(SCENARIOS, "scenario string, feature string, new_value double")
    score = lambda value_of: F.round(CARD.score(value_of), 6)
    return products.whatif_card(s.features(), scenarios, list(CARD.weights), score)


@query
def whatif_changes(s: Stages) -> DataFrame:
    scenarios = s.spark.createDataFrame(SCENARIOS, "scenario string, feature string, new_value double")
    return segments.rounded(products.whatif_changes(s.features(), scenarios, s.columns()))


@query
def whatif_model_scores(s: Stages) -> DataFrame:
    scenarios = s.spark.createDataFrame(SCENARIOS, "scenario string, feature string, new_value double")
    return products.whatif_model(s.features(), scenarios, s.columns(), s.trees())


@query
def revenue_impact(s: Stages) -> DataFrame:
    return products.revenue_impact(s.features(), s.scored_test())


@query
def memo_facts(s: Stages) -> DataFrame:
    test = s.scored_test()
    comparison = metrics.model_comparison(s.metrics(), ["card"])
    report = segments.segment_report(_segments(s))
    return products.memo_facts(products.revenue_impact(s.features(), test), comparison, segments.rounded(report))
