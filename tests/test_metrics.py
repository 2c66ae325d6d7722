import math
import random

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from churnline.functions.ordering import order_cuts, running_totals, sequence_numbers
from churnline.operators import metrics
from churnline.schema import KEY, LABEL

SCHEMA = f"{KEY} string, {LABEL} int, score double"
PROPERTY = settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def frame(spark, rows):
    return spark.createDataFrame([(f"k{i}", label, score) for i, (label, score) in enumerate(rows)], SCHEMA)


@pytest.fixture(scope="module")
def scored(spark):
    return frame(spark, [(1, 0.9), (0, 0.8), (1, 0.7), (0, 0.3), (1, 0.3), (0, 0.1)])


def brute(rows):
    """The metrics by their definitions, one threshold and one pair at a time."""
    labels, scores = np.array([r[0] for r in rows]), np.array([r[1] for r in rows])
    area, last, best = 0.0, 0.0, (-1.0, None)
    for t in sorted(set(scores), reverse=True):
        p, r = labels[scores >= t].mean(), labels[scores >= t].sum() / labels.sum()
        area += (r - last) * p
        last = r
        f1 = 2 * p * r / max(p + r, 1e-9)
        if f1 >= best[0] - 1e-12:
            best = (f1, t)
    pairs = [(a > b) + (a == b) / 2 for a in scores[labels == 1] for b in scores[labels == 0]]
    return area, float(np.mean(pairs)), best


def test_known_case(scored):
    assert metrics.average_precision(scored).first()[0] == 0.755556
    assert metrics.roc_auc(scored).first()[0] == 0.722222
    curve = metrics.pr_curve(scored).orderBy(F.asc_nulls_last("threshold")).collect()
    assert [r["threshold"] for r in curve] == [0.1, 0.3, 0.7, 0.8, 0.9, None]
    assert (curve[-1]["precision"], curve[-1]["recall"]) == (1.0, 0.0)
    assert (curve[1]["precision"], curve[1]["recall"]) == (0.6, 1.0)


@PROPERTY
@given(st.lists(st.tuples(st.integers(0, 1), st.integers(0, 30)), min_size=2, max_size=60))
def test_areas_against_definitions(spark, drawn):
    rows = [(label, step / 30) for label, step in drawn] + [(1, 0.5), (0, 0.5)]
    rows = [(label, round(score, 6)) for label, score in rows]
    data = frame(spark, rows)
    area, auc, (f1, threshold) = brute(rows)
    assert metrics.average_precision(data).first()[0] == pytest.approx(area, abs=1e-6)
    got_auc = metrics.roc_auc(data).first()[0]
    assert got_auc == pytest.approx(auc, abs=1e-6)
    flipped = data.withColumn("score", F.round(1 - F.col("score"), 6))
    assert metrics.roc_auc(flipped).first()[0] == pytest.approx(1 - got_auc, abs=2e-6)
    best = metrics.best_f1_threshold(data).first()
    assert best["f1"] == pytest.approx(f1, abs=1e-6)
    at = metrics.confusion_at_threshold(data, best["threshold"]).first()
    assert at["f1"] == pytest.approx(f1, abs=1e-6)


def test_best_threshold_is_the_lowest_of_equals(spark):
    # F1 is 2/3 at 0.9 (P 1, R 1/2) and at 0.2 (P 1/2, R 1).
    data = frame(spark, [(1, 0.9), (0, 0.5), (0, 0.4), (1, 0.2)])
    assert metrics.best_f1_threshold(data).first()["threshold"] == 0.2
    assert metrics.best_f1_threshold(data.limit(0)).first()["threshold"] == 0.5


def test_no_positives(spark):
    data = frame(spark, [(0, s / 10) for s in range(5)])
    top = metrics.top_share(data).first()
    assert (top["k"], top["captured"], top["recall"], top["lift"]) == (1, 0, 0.0, math.inf)
    assert metrics.average_precision(data).first()[0] == 0.0
    assert metrics.roc_auc(data).first()[0] is None
    assert metrics.confusion_at_threshold(data, 0.9).first()["f1"] == 0.0


def _in_order(rows):
    import hashlib

    return sorted(rows, key=lambda r: (-r[2], hashlib.md5(r[0].encode()).hexdigest(), r[0]))


@pytest.mark.parametrize("tied", [0.0, 0.34, 1.0])
def test_top_k_and_gains_with_ties(spark, tied):
    source = np.random.default_rng(3)
    n = 1013
    scores = np.where(source.random(n) < tied, 0.5, source.integers(0, 1000, n) / 1000).round(6)
    labels = source.integers(0, 2, n)
    rows = [(f"k{i}", int(a), float(b)) for i, (a, b) in enumerate(zip(labels, scores))]
    data = spark.createDataFrame(rows, SCHEMA)
    ordered = [r[1] for r in _in_order(rows)]
    k = math.ceil(n * 0.1)
    top = metrics.top_share(data).first()
    assert (top["k"], top["captured"]) == (k, sum(ordered[:k]))
    assert top["recall"] == pytest.approx(sum(ordered[:k]) / sum(ordered), abs=1e-6)
    assert top["lift"] == pytest.approx(sum(ordered[:k]) / k / np.mean(ordered), abs=1e-6)
    curve = metrics.gains_curve(data).orderBy("k").collect()
    assert [r["k"] for r in curve] == sorted({math.ceil(n * p / 100) for p in range(1, 101)})
    assert [r["captured"] for r in curve] == [sum(ordered[: r["k"]]) for r in curve]
    assert curve[-1]["pct_captured"] == 100.0 and curve[-1]["pct_targeted"] == 100.0


def test_gains_with_fewer_rows_than_percents(scored):
    curve = metrics.gains_curve(scored).orderBy("k").collect()
    assert [r["k"] for r in curve] == [1, 2, 3, 4, 5, 6]


def test_classification_report(scored):
    rows = {r["class"]: r for r in metrics.classification_report(scored, 0.7).collect()}
    # At 0.7: tp 2, fp 1, fn 1, tn 2.
    assert rows["1"]["precision"] == rows["1"]["recall"] == 0.666667 and rows["1"]["support"] == 3
    assert rows["accuracy"]["f1"] == 0.666667 and rows["accuracy"]["precision"] is None
    assert rows["macro avg"]["f1"] == rows["weighted avg"]["f1"] == 0.666667


def test_evaluation_with_given_threshold(scored):
    got = {r["metric"]: r["value"] for r in metrics.evaluation_metrics(scored, "m", threshold=0.85).collect()}
    assert got["threshold"] == 0.85 and got["f1"] == 0.5 and got["recall_top10"] == 0.333333
    both = metrics.evaluation_metrics(scored, "a").unionByName(metrics.evaluation_metrics(scored, "b"))
    table = metrics.model_comparison(both, ["a", "b"]).collect()
    assert len(table) == 6 and all(r["a"] == r["b"] for r in table)


def test_order_cuts_inside_one_huge_tie(spark):
    import hashlib

    data = spark.range(5000).select(F.col("id").cast("string").alias("id"), F.lit(1).alias("v"), (F.col("id") % 2).alias("y"))
    cut = order_cuts(data, "v", "id", "y", lambda n: F.array(F.lit(1).cast("bigint"), n)).orderBy("k").collect()
    ordered = sorted((hashlib.md5(str(i).encode()).hexdigest(), str(i), i % 2) for i in range(5000))
    assert [(r["k"], r["key"], r["captured"]) for r in cut] == [(1, ordered[0][1], ordered[0][2]), (5000, ordered[-1][1], 2500)]


def test_sequence_numbers_fill_each_group(spark):
    data = spark.range(3000).select(F.col("id").cast("string").alias("id"), F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("g"))
    got = sequence_numbers(data, ["g"], "id")
    for group, size in (("a", 1000), ("b", 2000)):
        assert sorted(r["position"] for r in got.where(F.col("g") == group).collect()) == list(range(1, size + 1))


def test_scores_keep_their_precision(spark):
    from churnline.operators.products import with_risk_tier

    data = frame(spark, [(1, 3e-7), (0, 0.50000004), (1, 0.50000005)])
    assert [r["risk_tier"] for r in with_risk_tier(data).orderBy("score").collect()] == ["Low", "High", "High"]
    assert metrics.captured_at(data, lambda n: F.array(F.lit(1).cast("bigint"))).first()["captured"] == 1
    full = metrics.gains_curve_full(data).orderBy("cum_n").collect()
    assert [(r["cum_n"], r["cum_pos"]) for r in full] == [(1, 1), (2, 1), (3, 2)]


def test_one_row_per_asked_position_whatever_the_ties(spark):
    data = spark.range(4000).select(
        F.col("id").cast("string").alias(KEY), (F.col("id") % 2).cast("int").alias(LABEL), F.lit(0.25).alias("score")
    )
    curve = metrics.gains_curve(data, points=400).orderBy("k").collect()
    assert [r["k"] for r in curve] == list(range(10, 4001, 10)) and curve[-1]["captured"] == 2000


def test_running_totals_per_group(spark):
    source = random.Random(8)
    rows = [(g, v, source.randint(1, 9)) for g in "ab" for v in {round(source.lognormvariate(0, 3), 3) for _ in range(700)}]
    rows += [("a", None, 4), ("c", 1.0, 2)]
    data = spark.createDataFrame(rows, "g string, v double, n long")
    for descending in (False, True):
        got = running_totals(data, "v", ["n"], descending, by=["g"]).collect()
        assert len(got) == len(rows)
        for r in got:
            rank = lambda v: float("-inf") if v is None else v
            ahead = lambda v: rank(v) > rank(r["v"]) if descending else rank(v) < rank(r["v"])
            assert r["n_before"] == sum(n for g, v, n in rows if g == r["g"] and ahead(v))
