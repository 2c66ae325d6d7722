"""The whole analysis from a raw customer file to tables and models on disk.

    python -m churnline.plans.pipeline customers.csv out
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnline.operators import aggregates, attribution, correlation, metrics, products, quality, search, segments, splits, training
from churnline.operators.features import clean, engineered
from churnline.plans.queries import WANTED_LEVELS
from churnline.plans.stages import Stages
from churnline.session import observed_write
from churnline.sources.artifacts import encoder_table, load_table, save_model, save_table
from churnline.sources.customers import read_customers_csv, register_features


def exploration(s: Stages) -> dict[str, DataFrame]:
    rows = engineered(clean(s.raw()))
    features, columns, moments = s.features(), s.columns(), s.moments()
    cohorts, balance = aggregates.cohort_churn(rows), aggregates.class_balance(rows)
    drivers = correlation.correlation_drivers(features, columns, moments=moments)
    return {
        "cohort_churn": cohorts,
        "segment_churn": aggregates.segment_churn_all(rows),
        "class_balance": balance,
        "target_correlation": correlation.target_correlation(features, columns, moments),
        "correlation_top15": correlation.correlation_top(features, columns, moments=moments),
        "eda_facts": products.eda_facts(cohorts, aggregates.level_rates(rows, WANTED_LEVELS), balance, drivers),
        "feature_ranges": aggregates.feature_ranges(features, columns, moments),
    }


def evaluation(s: Stages, threshold: float) -> dict[str, DataFrame]:
    trees = s.tree_scores().where(F.col("split") == "test")
    both = s.comparison()
    return {
        "split_summary": splits.split_summary(s.modelling()),
        "class_weights": splits.class_weights(s.train()),
        "tuning_results": search.tuning_results(s.spark, s.tuned()),
        "metrics": both,
        "model_comparison": metrics.model_comparison(both, ["baseline", "trees"]),
        "classification_report": metrics.classification_report(trees, threshold),
        "gains_curve": metrics.gains_curve(trees),
        "gains_curve_full": metrics.gains_curve_full(trees),
    }


def interpretation(s: Stages) -> dict[str, DataFrame]:
    contributions, columns = s.tree_attributions(), s.columns()
    permutation = attribution.permutation_importance(s.trees(), s.sample(), columns)
    base = attribution.tree_base_value(s.nodes())
    return {
        "attributions": contributions,
        "attribution_base_value": s.spark.createDataFrame([(base,)], "base_value double"),
        "global_importance": attribution.global_importance(contributions, columns),
        "importance_comparison": attribution.importance_comparison(
            attribution.gain_importance(s.nodes(), columns), permutation
        ),
        "beeswarm_points": attribution.beeswarm_points(contributions, columns),
        "top_drivers": attribution.top_drivers(contributions, columns),
    }


def decisions(s: Stages, threshold: float, done: dict[str, DataFrame]) -> dict[str, DataFrame]:
    scores = products.with_risk_tier(training.predicted(s.tree_scores(), threshold))
    columns = s.columns()
    halves = segments.segment_halves(s.features(), columns, done["global_importance"])
    found = segments.actionable_segments(segments.segment_candidates(halves))
    report = segments.segment_report(found)
    revenue = products.revenue_impact(s.features(), s.tree_scores().where(F.col("split") == "test"))
    return {
        "scores": scores,
        "segments": found,
        "segment_report": report,
        "kpi_overview": aggregates.kpi_overview(scores, threshold),
        "risk_tiers": products.risk_tier_distribution(scores),
        "score_histogram": products.score_histogram(scores),
        "risk_list": products.risk_list(scores, done["attributions"], columns),
        "revenue_impact": revenue,
        "memo_facts": products.memo_facts(revenue, done["model_comparison"], report),
    }


MAY_BE_EMPTY = {"segments", "segment_report", "risk_list"}


def run(s: Stages, out: str, **gate) -> DataFrame:
    """Write every table and model under ``out`` and return the checked manifest."""
    done: dict[str, DataFrame] = {}
    n_rows: dict[str, int] = {}

    def keep(tables: dict[str, DataFrame]) -> None:
        for name, table in tables.items():
            n_rows[name] = observed_write(table, f"{out}/{name}")["n_rows"]
            done[name] = load_table(s.spark, f"{out}/{name}")

    keep({"features": s.features(), "encoder": encoder_table(s.spark, s.encoder())})
    register_features(s.spark, f"{out}/features")
    # Judged by what the write of the feature table observed.
    quality.require_passed(quality.observed_gate(s.spark, s.facts("features"), **gate))
    keep(exploration(s))
    threshold = s.tree_threshold()
    keep({"threshold": s.spark.createDataFrame([(threshold,)], "threshold double")})
    keep(evaluation(s, threshold))
    keep(interpretation(s))
    keep(decisions(s, threshold, done))
    save_model(s.baseline(), f"{out}/models/baseline")
    save_model(s.trees(), f"{out}/models/trees")

    save_table(products.observed_manifest(s.spark, n_rows), f"{out}/manifest")
    manifest = load_table(s.spark, f"{out}/manifest")
    empty = {r["table_name"] for r in manifest.where(F.col("ok") == 0).collect()} - MAY_BE_EMPTY
    if empty:
        raise RuntimeError(f"empty output tables: {sorted(empty)}")
    return manifest


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("customers")
    parser.add_argument("out")
    parser.add_argument("--trials", type=int, default=search.SETS)
    parser.add_argument("--min-rows", type=int, default=quality.MIN_ROWS)
    given = parser.parse_args()
    spark = SparkSession.builder.appName("churnline").getOrCreate()
    stages = Stages(spark, given.customers, read_customers_csv, given.trials)
    run(stages, given.out.rstrip("/"), min_rows=given.min_rows).orderBy("table_name").show(100, truncate=False)


if __name__ == "__main__":
    main()
