import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from churnline.operators import aggregates, correlation, moments, products, segments
from churnline.operators.training import ScoreCard
from churnline.schema import KEY, LABEL

PROPERTY = settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


# ---- statistics --------------------------------------------------------------------------


def test_constant_columns_have_no_correlation(spark):
    data = spark.createDataFrame([(float(i), 1.0, i % 2) for i in range(10)], f"x double, c double, {LABEL} int")
    matrix = {(r["feature_a"], r["feature_b"]): r["corr"] for r in correlation.correlation_matrix(data, ["x", "c", LABEL]).collect()}
    assert matrix[("x", "c")] is None and matrix[("x", "x")] == 1.0
    assert matrix[("x", LABEL)] == pytest.approx(np.corrcoef(range(10), [i % 2 for i in range(10)])[0, 1], abs=1e-6)
    ranked = {r["feature"]: (r["rank"], r["corr"]) for r in correlation.target_correlation(data, ["x", "c"]).collect()}
    assert ranked == {"x": (1, matrix[("x", LABEL)]), "c": (2, None)}


def test_moment_table_equals_numpy(spark):
    source = np.random.default_rng(4)
    x = source.normal(size=500)
    # Far from zero with a small spread, a flag, a constant, and values missing here and there.
    values = np.column_stack([x, 1e6 + 1e-2 * x + 1e-3 * source.normal(size=500), x > 0.3, np.full(500, 7.0), source.normal(size=500)])
    gaps = source.random(500) < 0.2
    rows = [tuple(None if j == 4 and g else float(v) for j, v in enumerate(line)) for line, g in zip(values, gaps)]
    names = ["x", "far", "flag", "same", "gaps"]
    data = spark.createDataFrame(rows, ", ".join(f"{n} double" for n in names)).repartition(5)
    got = {(r.feature_a, r.feature_b): r for r in moments.moment_table(data, names).withColumn("corr", moments.pearson()).collect()}
    assert len(got) == 25
    for i, a in enumerate(names):
        for j, b in enumerate(names):
            used = ~gaps if "gaps" in (a, b) else np.ones(500, dtype=bool)
            u, v, r = values[used, i], values[used, j], got[a, b]
            assert (r.n, r.mean_a) == (used.sum(), pytest.approx(u.mean(), rel=1e-12, abs=1e-12))
            assert r.var_a == pytest.approx(u.var(), rel=1e-6, abs=1e-12) and r.cov == pytest.approx(np.cov(u, v, bias=True)[0, 1], rel=1e-6, abs=1e-12)
            assert r["corr"] is None if "same" in (a, b) else r["corr"] == pytest.approx(np.corrcoef(u, v)[0, 1], abs=1e-8)
            assert (r.lo, r.hi) == ((u.min(), u.max()) if a == b else (None, None))


def test_moment_table_of_no_rows(spark):
    none = spark.createDataFrame([], "x double, y double")
    assert {(r.n, r.mean_a, r.cov, r.lo) for r in moments.moment_table(none, ["x", "y"]).collect()} <= {(0, None, None, None)}
    assert {r["corr"] for r in correlation.correlation_matrix(none.withColumn(LABEL, none.x), ["x", LABEL]).collect()} <= {None, 1.0}


def test_segments_and_cohorts_by_hand(spark):
    data = spark.createDataFrame(
        [("0-12", "A", 1), ("0-12", "B", 0), ("49+", "A", 1), (None, "B", 0)], f"tenure_bucket string, plan string, {LABEL} int"
    )
    assert [tuple(r) for r in aggregates.cohort_churn(data).collect()] == [("0-12", 0.5, 2, 50.0), ("49+", 1.0, 1, 100.0)]
    assert [tuple(r) for r in aggregates.segment_churn(data, "plan").collect()] == [("A", 1.0, 2), ("B", 0.0, 2)]
    both = aggregates.segment_churn_all(data, ["plan", "tenure_bucket"]).collect()
    assert {(r["segment"], r["level"], r["n"]) for r in both} == {
        ("plan", "A", 2), ("plan", "B", 2), ("tenure_bucket", "0-12", 2), ("tenure_bucket", "49+", 1),
    }
    balance = {r["label"]: (r["n"], r["pct"]) for r in aggregates.class_balance(data).collect()}
    assert balance == {0: (2, 50.0), 1: (2, 50.0)}


# ---- medians and segments ------------------------------------------------------------------


@PROPERTY
@given(
    st.lists(st.integers(-20, 20), min_size=1, max_size=80),
    st.lists(st.floats(-1e3, 1e3, allow_nan=False).map(lambda v: v + 0.0), min_size=80, max_size=80),
)
def test_medians_are_exact(spark, ints, floats):
    n = len(ints)
    data = spark.createDataFrame(list(zip(map(float, ints), floats[:n])), "a double, b double")
    got = {r["feature"]: r for r in segments.feature_split_points(data, ["a", "b"], accuracy=100).collect()}
    for name, values in (("a", np.array(ints, float)), ("b", np.array(floats[:n]))):
        if len(set(values)) < 2:
            assert name not in got
            continue
        median = np.median(values)
        assert got[name]["median"] == pytest.approx(median, abs=1e-12)
        degenerate = median in (values.min(), values.max())
        assert got[name]["split_kind"] == ("mean" if degenerate else "median")
        assert got[name]["split_value"] == pytest.approx(values.mean() if degenerate else median, abs=1e-9)


def test_medians_of_many_rows_with_a_hot_value(spark):
    source = np.random.default_rng(5)
    values = np.where(source.random(40_001) < 0.34, 3.25, source.normal(3, 2, 40_001))
    data = spark.createDataFrame(pd.DataFrame({"v": values})).repartition(13)
    got = segments.feature_split_points(data, ["v"], accuracy=1000).first()
    assert got["median"] == np.median(values)


def planted(spark, rows):
    return spark.createDataFrame(rows, f"flag double, noise double, rare double, {LABEL} int")


def test_segments_follow_the_rules(spark):
    rows = []
    for i in range(400):
        flag = float(i % 4 == 0)  # median 0 is the minimum: split at the mean
        rows.append((flag, float(i % 97), float(i < 30), int(flag == 1 and i % 8 != 0 or i % 10 == 0)))
    data = planted(spark, rows)
    importance = spark.createDataFrame([("flag", 0.2), ("noise", 0.3), ("rare", 0.9)], "feature string, mean_abs double")
    columns = ["flag", "noise", "rare"]
    candidates = segments.segment_candidates(segments.segment_halves(data, columns, importance))
    table = {r["feature"]: r for r in candidates.collect()}
    assert table["rare"]["qualifies"] == 0 and table["rare"]["n_high"] == 30
    frame = data.toPandas()
    high = frame["flag"] > frame["flag"].mean()
    assert table["flag"]["split_kind"] == "mean" and table["flag"]["n_high"] == high.sum()
    assert table["flag"]["high_rate"] == pytest.approx(frame.loc[high, LABEL].mean())
    assert table["flag"]["low_rate"] == pytest.approx(frame.loc[~high, LABEL].mean())
    found = segments.actionable_segments(candidates).collect()
    assert [r["feature"] for r in found][-1] == "flag" and found[0]["rank"] == 1
    report = segments.segment_report(segments.actionable_segments(candidates)).where(F.col("feature") == "flag").first()
    assert report["direction"] == "above" and report["affected"] == high.sum()
    assert report["risky_rate"] >= report["other_half_rate"]


def test_below_segments_invert_the_ratio(spark):
    found = spark.createDataFrame(
        [(1, "tenure", 29.0, "median", 0.132, 0.395, 0.132 / 0.395, 0.4, 3474, 3569, 0.2654),
         (2, "z", 1.0, "median", 0.0, 0.2, 0.0, 0.1, 60, 60, 0.1)],
        "rank int, feature string, split_value double, split_kind string, high_rate double, low_rate double, "
        "ratio double, mean_abs double, n_high long, n_low long, baseline_rate double",
    )
    first, second = segments.segment_report(found).orderBy("rank").collect()
    assert (first["direction"], first["affected"]) == ("below", 3569)
    assert first["ratio"] == pytest.approx(0.395 / 0.132)
    assert second["ratio"] is None


# ---- tiers, histogram, what-if, revenue -------------------------------------------------------


def test_tier_edges(spark):
    scores = [0.0, 0.000001, 0.3, 0.300001, 0.5, 0.500001, 0.7, 0.700001, 1.0]
    data = spark.createDataFrame(list(enumerate(scores)), "id long, score double")
    got = [r["risk_tier"] for r in products.with_risk_tier(data).orderBy("id").collect()]
    assert got == [None, "Low", "Low", "Medium", "Medium", "High", "High", "Critical", "Critical"]
    counts = {r["risk_tier"]: r["n"] for r in products.risk_tier_distribution(data.where("score <= 0.3")).collect()}
    assert counts == {"Low": 2, "Medium": 0, "High": 0, "Critical": 0}


@PROPERTY
@given(st.lists(st.integers(0, 1000), min_size=2, max_size=60, unique=True))
def test_histogram_counts_equal_pandas_cut(spark, steps):
    scores = [s / 1000 for s in steps]
    data = spark.createDataFrame([(s,) for s in scores], "score double")
    got = [r["n"] for r in products.score_histogram(data).orderBy("bin").collect()]
    lo, width = min(scores), (max(scores) - min(scores)) / 20
    on_an_edge = any(abs((s - lo) / width - round((s - lo) / width)) < 1e-9 for s in scores if s not in (lo, max(scores)))
    assert sum(got) == len(scores)
    if not on_an_edge:
        assert got == pd.cut(pd.Series(scores), bins=20).value_counts().sort_index().tolist()


def test_histogram_of_one_value(spark):
    data = spark.createDataFrame([(0.4,), (0.4,)], "score double")
    got = products.score_histogram(data).collect()
    assert len(got) == 20 and sum(r["n"] for r in got) == 2


def test_whatif(spark):
    card = ScoreCard(0.0, {"a": 1.0, "b": -1.0})
    people = spark.createDataFrame([("p", 1.0, 0), ("q", 0.0, 1)], f"{KEY} string, a double, b int")
    scenarios = spark.createDataFrame(
        [("more_b", "b", 1.0), ("both", "a", 0.0), ("both", "b", 3.0)], "scenario string, feature string, new_value double"
    )
    got = {(r[KEY], r["scenario"]): r for r in products.whatif_card(people, scenarios, ["a", "b"], card.score).collect()}
    assert len(got) == 4
    sigmoid = lambda z: pytest.approx(1 / (1 + np.exp(-z)), abs=1e-12)
    assert got[("p", "more_b")]["new_score"] == sigmoid(0) and got[("p", "more_b")]["direction"] == "reduced"
    assert got[("q", "more_b")]["direction"] == "unchanged" and got[("q", "more_b")]["changed"] == ""
    assert got[("p", "both")]["changed"] == "a, b" and got[("p", "both")]["new_score"] == sigmoid(-3)
    assert got[("q", "both")]["changed"] == "b"
    with pytest.raises(Exception, match="unknown feature in scenario: a"):
        products.whatif_card(people, scenarios, ["b"], ScoreCard(0.0, {"b": 1.0}).score).collect()
    moved = products.whatif_changes(people, scenarios, ["a", "b"]).collect()
    assert sorted(tuple(r) for r in moved) == [
        ("p", "both", "a", 1.0, 0.0, -1.0),
        ("p", "both", "b", 0.0, 3.0, 3.0),
        ("p", "more_b", "b", 0.0, 1.0, 1.0),
        ("q", "both", "b", 1.0, 3.0, 2.0),
    ]


def test_whatif_changes_spread_no_columns(spark):
    """Rows come from what a scenario sets: no per-column structs are laid out for every customer."""
    columns = [f"f{i}" for i in range(60)]
    kinds = ", ".join([f"{KEY} string", *[f"{c} double" for c in columns]])
    people = spark.createDataFrame([("p", *[float(i) for i in range(60)]), (None, *[None] * 60)], kinds)
    scenarios = spark.createDataFrame(
        [("s", "f59", 1.0), ("s", "f3", 3.0), ("s", "f7", 8.5), ("none", "f1", None)], "scenario string, feature string, new_value double"
    )
    moved = products.whatif_changes(people, scenarios, columns)
    assert sorted(tuple(r) for r in moved.collect()) == [("p", "s", "f59", 59.0, 1.0, -58.0), ("p", "s", "f7", 7.0, 8.5, 1.5)]
    assert moved._jdf.queryExecution().optimizedPlan().toJSON().count("expressions.CaseWhen") < 10


def test_revenue_arithmetic(spark):
    """141 of 1,409 contacted, 39 of 93 churners among them, 74.44 a month."""
    test = [(f"t{i}", 1 if i < 39 or 141 <= i < 195 else 0, round(1 - i / 2000, 6)) for i in range(1409)]
    scored = spark.createDataFrame(test, f"{KEY} string, {LABEL} int, score double")
    people = spark.createDataFrame([("a", 1, 74.0), ("b", 1, 74.88), ("c", 0, 20.0)], f"{KEY} string, {LABEL} int, MonthlyCharges double")
    got = products.revenue_impact(people, scored).first()
    assert (got["contacts"], got["contacts_rounded"], got["captured"], got["test_size"]) == (141, 141, 39, 1409)
    assert got["churner_monthly"] == 74.44
    assert got["revenue_kept"] == pytest.approx(39 * 0.3 * 74.44 * 12, abs=0.01) and round(got["revenue_kept"]) == 10451


def test_overview(spark):
    data = spark.createDataFrame([("a", 1, 10.1, 0.8), ("b", 0, 20.2, 0.4), ("c", 0, 30.3, 0.6)],
                                 f"{KEY} string, {LABEL} int, MonthlyCharges double, score double")
    got = aggregates.kpi_overview(products.with_risk_tier(data), 0.5).first()
    assert (got["customers"], got["churned"], got["mrr"], got["mrr_at_risk"], got["high_risk"]) == (3, 1, 60.6, 40.4, 2)


def test_risk_list_is_ordered_and_limited(spark):
    people = [(f"p{i:02d}", 0, 10, 50.0, 0.4 + i / 50) for i in range(30)]
    scored = spark.createDataFrame(people, f"{KEY} string, {LABEL} int, tenure int, MonthlyCharges double, score double")
    drivers = spark.createDataFrame([(p[0], [1.0], [p[4]]) for p in people], f"{KEY} string, values array<double>, contributions array<double>")
    got = products.risk_list(scored, drivers, ["a"], top=5).collect()
    assert [r["customer"] for r in got] == ["p29", "p28", "p27", "p26", "p25"]
    assert got[0]["risk_tier"] == "Critical" and got[0]["top_drivers"] == "a(+0.98)"
