"""Ranking metrics of scored rows (key, label, score).

Scores keep their full precision. Rows are counted per distinct score first; all curves and
areas come from that table, and only top-k cuts look at rows again, at those tied with the cut.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnline.functions.ordering import order_cuts, running_totals
from churnline.functions.scalars import with_row
from churnline.schema import KEY, LABEL

TOP_SHARE = 0.1
GAINS_POINTS = 100


def score_points(scored: DataFrame, label: str = LABEL) -> DataFrame:
    """One row per distinct score: its size and positives, and the totals at or above it."""
    points = scored.groupBy("score").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col(label).cast("bigint")).alias("pos")
    )
    placed = running_totals(points, "score", ["n", "pos"], descending=True)
    return placed.select(
        "score",
        "n",
        "pos",
        (F.col("n_before") + F.col("n")).alias("cum_n"),
        (F.col("pos_before") + F.col("pos")).alias("cum_pos"),
    )


def _ratio(top: Column, bottom: Column, empty: float | None = 0.0) -> Column:
    return F.coalesce(top / F.nullif(bottom, F.lit(0)), F.lit(empty).cast("double"))


def _label_totals(scored: DataFrame) -> DataFrame:
    return scored.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.col(LABEL).cast("bigint")), F.lit(0)).alias("pos"))


def _precision() -> Column:
    return F.col("cum_pos") / F.col("cum_n")


def _recall() -> Column:
    return _ratio(F.col("cum_pos"), F.col("all.pos"), 1.0)


def pr_curve(scored: DataFrame) -> DataFrame:
    curve = with_row(score_points(scored), "all", _label_totals(scored)).select(
        F.col("score").alias("threshold"),
        F.round(_precision(), 6).alias("precision"),
        F.round(_recall(), 6).alias("recall"),
    )
    end = scored.sparkSession.range(1).select(
        F.lit(None).cast("double").alias("threshold"), F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall")
    )
    return curve.unionByName(end)


def ranking_facts(scored: DataFrame) -> DataFrame:
    """Average precision, ROC area and best-F1 threshold in one aggregate over the points."""
    points = with_row(score_points(scored), "all", _label_totals(scored))
    step = F.col("pos") * _precision()
    neg = F.col("n") - F.col("pos")
    all_pos, all_neg = F.sum("pos").cast("double"), F.sum(neg).cast("double")
    neg_from_here = F.col("cum_n") - F.col("cum_pos")
    # Pairs won: positives here x (all negatives - those at or above here + half of those tied).
    pairs = F.sum(F.col("pos") * (neg / 2 - neg_from_here)) + all_pos * all_neg
    f1 = 2 * _precision() * _recall() / F.greatest(_precision() + _recall(), F.lit(1e-9))
    best = F.max(F.struct(f1.alias("f1"), (-F.col("score")).alias("neg_threshold")))
    return points.agg(
        _ratio(F.sum(step), F.sum("pos")).alias("pr_auc"),
        _ratio(pairs, all_pos * all_neg, None).alias("roc_auc"),
        F.coalesce(-best["neg_threshold"], F.lit(0.5)).alias("threshold"),
        F.coalesce(best["f1"], F.lit(0.0)).alias("best_f1"),
        F.sum("n").alias("n"),
        F.sum("pos").alias("pos"),
    )


def average_precision(scored: DataFrame) -> DataFrame:
    """Step sum of precision over recall gains. The trapezoid of the ML evaluator differs."""
    return ranking_facts(scored).select(F.round("pr_auc", 6).alias("average_precision"))


def average_precision_by(scored: DataFrame, group: str, label: str = LABEL) -> DataFrame:
    """Average precision of each group; 0 in a group without positives."""
    points = scored.groupBy(group, "score").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col(label).cast("bigint")).alias("pos")
    )
    placed = running_totals(points, "score", ["n", "pos"], descending=True, by=[group])
    step = F.col("pos") * (F.col("pos_before") + F.col("pos")) / (F.col("n_before") + F.col("n"))
    return placed.groupBy(group).agg(_ratio(F.sum(step), F.sum("pos")).alias("average_precision"))


def roc_auc(scored: DataFrame) -> DataFrame:
    """Share of (positive, negative) pairs ranked rightly, ties half; null with one class."""
    return ranking_facts(scored).select(F.round("roc_auc", 6).alias("roc_auc"))


def best_f1_threshold(scored: DataFrame) -> DataFrame:
    """Lowest threshold with the highest F1; 0.5 without rows."""
    return ranking_facts(scored).select("threshold", F.round("best_f1", 6).alias("f1"))


def top_size(n: Column, share: float) -> Column:
    return F.greatest(F.lit(1), F.ceil(n * share)).cast("bigint")


def captured_at(scored: DataFrame, positions, key: str = KEY) -> DataFrame:
    """Positives among the first k rows by score, for each asked k."""
    rows = scored.select(key, "score", F.col(LABEL).cast("bigint").alias("label"))
    return order_cuts(rows, "score", key, "label", positions, descending=True).select("k", "captured")


def top_share(scored: DataFrame, share: float = TOP_SHARE, key: str = KEY) -> DataFrame:
    """One row: k, positives captured in the top k, recall and lift there."""
    cut = captured_at(scored, lambda n: F.array(top_size(n, share)), key)
    base = F.nullif(F.col("all.pos") / F.col("all.n"), F.lit(0.0))
    lift = F.when(F.col("all.pos") == 0, F.lit(float("inf"))).otherwise(F.col("captured") / F.col("k") / base)
    return with_row(cut, "all", _label_totals(scored)).select(
        "k",
        "captured",
        F.round(F.col("captured") / F.greatest(F.col("all.pos"), F.lit(1)), 6).alias("recall"),
        F.round(lift, 6).alias("lift"),
    )


def recall_at_k(scored: DataFrame, share: float = TOP_SHARE, key: str = KEY) -> DataFrame:
    return top_share(scored, share, key).select("k", "captured", "recall")


def lift_at_k(scored: DataFrame, share: float = TOP_SHARE, key: str = KEY) -> DataFrame:
    return top_share(scored, share, key).select("k", "lift")


def gains_curve_full(scored: DataFrame) -> DataFrame:
    """Cumulative gains after each distinct score, with those of a random order beside them."""
    targeted = F.col("cum_n") * 100 / F.col("all.n")
    return with_row(score_points(scored), "all", _label_totals(scored)).select(
        "score",
        "cum_n",
        "cum_pos",
        F.round(targeted, 6).alias("pct_targeted"),
        F.round(F.col("cum_pos") * 100 / F.greatest(F.col("all.pos"), F.lit(1)), 6).alias("pct_captured"),
        F.round(targeted, 6).alias("pct_random"),
    )


def gains_curve(scored: DataFrame, key: str = KEY, points: int = GAINS_POINTS) -> DataFrame:
    """Cumulative gains at ``points`` even steps through the ranked rows, ties cut by key."""
    steps = F.sequence(F.lit(1), F.lit(points))
    cuts = captured_at(
        scored, lambda n: F.array_distinct(F.transform(steps, lambda p: F.ceil(n * p / points).cast("bigint"))), key
    )
    return with_row(cuts, "all", _label_totals(scored)).select(
        "k",
        "captured",
        F.round(F.col("k") * 100 / F.col("all.n"), 6).alias("pct_targeted"),
        F.round(F.col("captured") * 100 / F.greatest(F.col("all.pos"), F.lit(1)), 6).alias("pct_captured"),
    )


def confusion(scored: DataFrame, threshold: Column | float, label: str = LABEL) -> DataFrame:
    """True and false positives and negatives at a threshold (inclusive)."""
    flagged, churned = F.col("score") >= threshold, F.col(label) == 1
    return scored.agg(
        F.count_if(flagged & churned).alias("tp"),
        F.count_if(flagged & ~churned).alias("fp"),
        F.count_if(~flagged & churned).alias("fn"),
        F.count_if(~flagged & ~churned).alias("tn"),
    )


def confusion_at_threshold(scored: DataFrame, threshold: Column | float) -> DataFrame:
    counts = confusion(scored, threshold)
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return counts.select("tp", "fp", "fn", "tn", F.round(_ratio(2 * tp, 2 * tp + fp + fn), 6).alias("f1"))


def classification_report(scored: DataFrame, threshold: Column | float) -> DataFrame:
    """Precision, recall, F1 and support per class, accuracy, and macro and weighted means."""
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))

    def scores(hit: Column, wrong: Column, missed: Column) -> Column:
        return F.struct(
            _ratio(hit, hit + wrong).alias("precision"),
            _ratio(hit, hit + missed).alias("recall"),
            _ratio(2 * hit, 2 * hit + wrong + missed).alias("f1"),
            (hit + missed).alias("support"),
        )

    wide = confusion(scored, threshold).select(
        scores(tn, fn, fp).alias("a"), scores(tp, fp, fn).alias("b"), (tp + fp + fn + tn).alias("n"), (tp + tn).alias("right")
    )
    names = ("precision", "recall", "f1")

    def line(name: str, *values: Column) -> Column:
        fields = ("precision", "recall", "f1", "support")
        return F.struct(F.lit(name).alias("class"), *[v.alias(f) for f, v in zip(fields, values)])

    accuracy = _ratio(F.col("right"), F.col("n"))
    none = F.lit(None).cast("double")
    macro = [(F.col(f"a.{c}") + F.col(f"b.{c}")) / 2 for c in names]
    weighted = [
        _ratio(F.col(f"a.{c}") * F.col("a.support") + F.col(f"b.{c}") * F.col("b.support"), F.col("n")) for c in names
    ]
    lines = F.array(
        line("0", *[F.col(f"a.{c}") for c in names], F.col("a.support")),
        line("1", *[F.col(f"b.{c}") for c in names], F.col("b.support")),
        line("accuracy", none, none, accuracy, F.col("n")),
        line("macro avg", *macro, F.col("n")),
        line("weighted avg", *weighted, F.col("n")),
    )
    rows = wide.select(F.explode(lines).alias("r"))
    return rows.select("r.class", *[F.round(f"r.{c}", 6).alias(c) for c in names], "r.support")


def evaluation_metrics(
    scored: DataFrame, model: str, threshold: Column | float | None = None, key: str = KEY
) -> DataFrame:
    """All ranking metrics of one model as (model, metric, value)."""
    facts = with_row(ranking_facts(scored), "top", top_share(scored, key=key))
    values = {
        "pr_auc": F.col("pr_auc"),
        "roc_auc": F.col("roc_auc"),
        "recall_top10": F.col("top.recall"),
        "lift_top10": F.col("top.lift"),
        "threshold": F.col("threshold"),
        "f1": F.col("best_f1"),
    }
    if threshold is not None:
        facts = with_row(facts, "at", confusion_at_threshold(scored, threshold))
        values |= {"threshold": F.lit(threshold), "f1": F.col("at.f1")}
    # A threshold is applied to scores again, so it stays as it is.
    whole = lambda name, v: v if name == "threshold" else F.round(v, 6)
    wide = facts.select(*[whole(name, v.cast("double")).alias(name) for name, v in values.items()])
    return wide.unpivot([], list(values), "metric", "value").select(F.lit(model).alias("model"), "metric", "value")


def model_comparison(metrics: DataFrame, models: list[str]) -> DataFrame:
    """Metrics side by side, one column per model."""
    return metrics.groupBy("metric").pivot("model", models).agg(F.first("value"))
