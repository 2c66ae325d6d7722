import itertools
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from churnline.operators import attribution, boosting, ensembles, metrics, search, splits, training
from churnline.operators.features import FeatureEncoder, feature_columns
from churnline.schema import KEY, LABEL
from churnline.sources.artifacts import load_model, save_model


@pytest.fixture(scope="module")
def features(customers):
    return FeatureEncoder.fit(customers).transform(customers).cache()


@pytest.fixture(scope="module")
def split(features):
    return splits.stratified_folds(splits.ordered_holdout(features), within=("split",)).cache()


@pytest.fixture(scope="module")
def train(split):
    return split.where(F.col("split") == "train").cache()


@pytest.fixture(scope="module")
def columns(features):
    return feature_columns(features)


@pytest.fixture(scope="module")
def small_trees(train):
    used = ["tenure", "Contract_ord", "MonthlyCharges", "charges_per_service"]
    rows = VectorAssembler(inputCols=used, outputCol="features").transform(train).withColumn("label", F.col(LABEL).cast("double"))
    model = GBTClassifier(maxIter=4, maxDepth=3, stepSize=0.3, seed=1).fit(rows)
    return used, rows, model


def test_holdout_is_disjoint_ordered_and_exact(split, features):
    sizes = {r["split"]: r["n"] for r in splits.split_summary(split).collect()}
    assert sizes == {"train": 2400, "test": 600}
    edge = split.groupBy("split").agg(F.min("tenure").alias("lo"), F.max("tenure").alias("hi")).collect()
    edge = {r["split"]: r for r in edge}
    assert edge["train"]["hi"] <= edge["test"]["lo"]
    assert split.select(KEY).distinct().count() == 3000


def test_folds_hold_every_class_evenly(train):
    for label in (0, 1):
        sizes = [r["count"] for r in train.where(F.col(LABEL) == label).groupBy("fold").count().collect()]
        assert len(sizes) == 3 and max(sizes) - min(sizes) <= 1


def test_class_weights(train):
    rows = {r["label"]: r for r in splits.class_weights(train).collect()}
    n, pos = 2400, rows[1]["n"]
    assert rows[1]["balanced_weight"] == pytest.approx(n / (2 * pos), abs=1e-6)
    assert rows[0]["balanced_weight"] == pytest.approx(n / (2 * (n - pos)), abs=1e-6)
    assert rows[1]["positive_weight"] == pytest.approx((n - pos) / pos, abs=1e-6)
    assert rows[0]["positive_weight"] == 1.0


def test_fixed_sample_repeats(features):
    one = {r[KEY] for r in splits.fixed_sample(features, size=100).collect()}
    two = {r[KEY] for r in splits.fixed_sample(features.repartition(7), size=100).collect()}
    assert one == two and len(one) == 100
    assert splits.fixed_sample(features, size=5000).count() == 3000


def test_standardized(split, columns, train):
    used = ["tenure", "MonthlyCharges"]
    data = split.withColumn("MonthlyCharges", F.lit(5.0))
    got = training.standardized(data, used, F.col("split") == "train").toPandas()
    known = train.select("tenure").toPandas()["tenure"]
    merged = got.merge(split.select(KEY, F.col("tenure").alias("raw")).toPandas(), on=KEY)
    assert np.allclose(merged["tenure"], (merged["raw"] - known.mean()) / known.std(ddof=0))
    assert (got["MonthlyCharges"] == 0).all()


def test_baseline_solves_the_penalised_problem(train, columns):
    """The gradient of 1/2 |w|^2 + sum of balanced log losses vanishes at the solution."""
    model = training.train_baseline(train, columns).stages[-1]
    table = train.select(*columns, LABEL).toPandas()
    y = table.pop(LABEL).to_numpy()
    x = table.to_numpy(float)
    deviation = x.std(axis=0)
    z = (x - x.mean(axis=0)) / np.where(deviation == 0, 1, deviation)
    n = len(y)
    w = model.coefficients.toArray() * math.sqrt((n - 1) / n)
    p = 1 / (1 + np.exp(-(z @ w + model.intercept)))
    weight = np.where(y == 1, n / (2 * y.sum()), n / (2 * (n - y.sum())))
    assert np.abs(z.T @ (weight * (p - y)) + w).max() < 0.1 * math.sqrt(n)
    assert np.abs(z.T @ (weight * (p - y)) + w).max() / n < 1e-5


def test_baseline_beats_the_base_rate(train, columns):
    model = training.train_baseline(train, columns)
    scored = training.score_rows(model, train, [KEY, LABEL])
    rate = train.agg(F.avg(LABEL)).first()[0]
    assert metrics.average_precision(scored).first()[0] > rate * 1.4
    assert metrics.roc_auc(scored).first()[0] > 0.75


def test_search_space(spark):
    gbt = GBTClassifier()
    trials = training.draw_trials(gbt, training.TRIALS)
    assert len(trials) == 50 and trials == training.draw_trials(gbt, 50)
    for t in trials:
        assert 200 <= t[gbt.maxIter] <= 800 and t[gbt.maxIter] % 50 == 0
        assert 3 <= t[gbt.maxDepth] <= 8 and 1 <= t[gbt.minInstancesPerNode] <= 10
        assert 0.01 <= t[gbt.stepSize] <= 0.2 and 0.6 <= t[gbt.subsamplingRate] <= 1
        assert 0.6 <= float(t[gbt.featureSubsetStrategy]) <= 1


def test_tuning_keeps_the_best_and_repeats(train, columns, tmp_path):
    used = columns[:15]
    space = {"maxIter": (2, 4), "maxDepth": (3, 3)}
    tuned = training.tune_trees(train, used, trials=2, space=space)
    table = training.tuning_results(tuned).collect()
    assert [r["average_precision"] for r in table] == sorted(tuned.avgMetrics, reverse=True)
    assert table[0]["maxDepth"] == 3 and 0.3 < table[0]["average_precision"] <= 1
    model = training.as_pipeline(tuned.bestModel, used)
    scores = training.score_rows(model, train, [KEY, LABEL])
    again = training.fit_trees(train, used, training.best_params(tuned))
    both = scores.join(training.score_rows(again, train, [KEY]).withColumnRenamed("score", "other"), KEY)
    assert both.where(F.abs(F.col("score") - F.col("other")) > 1e-5).count() == 0

    loaded = load_model(save_model(model, str(tmp_path / "trees")))
    assert training.score_rows(loaded, train, [KEY, LABEL]).exceptAll(scores).count() == 0


def test_prefix_scores_equal_separate_fits(train, columns):
    used = columns[:12]
    rows = training.tree_rows(train, used, [KEY])
    params = {"maxDepth": 3, "stepSize": 0.2, "subsamplingRate": 0.7, "featureSubsetStrategy": "0.8"}
    whole = training.boosted(42, maxIter=8, **params).fit(rows)
    got = search.prefix_scored(attribution.tree_nodes(whole), rows, [3, 8], [KEY])
    for n in (3, 8):
        alone = training.as_pipeline(training.boosted(42, maxIter=n, **params).fit(rows), used)
        both = got.where(F.col("trees") == n).join(training.score_rows(alone, train, [KEY]).withColumnRenamed("score", "other"), KEY)
        assert both.count() == 2400
        assert both.where(F.abs(F.col("score") - F.col("other")) > 1e-12).isEmpty()


def test_average_precision_of_groups(spark):
    data = spark.createDataFrame(
        [(g, i % 7 == 0 or i % (g + 2) == 0, (i * 37 % 50) / 50) for g in range(3) for i in range(60)] + [(3, False, 0.5)],
        "g int, hit boolean, score double",
    ).withColumn(LABEL, F.col("hit").cast("int"))
    got = {r["g"]: r["average_precision"] for r in metrics.average_precision_by(data, "g").collect()}
    for g in range(3):
        assert round(got[g], 6) == metrics.average_precision(data.where(F.col("g") == g)).first()[0]
    assert got[3] == 0


def test_search_halves_the_sets_and_scores_every_count(spark, train, columns):
    used = columns[:12]
    space = {"maxIter": (3, 5), "maxDepth": (2, 3)}
    trials = search.search_trees(train, used, sets=3, space=space, keep=0.5)
    assert search.tree_counts(space) == [3, 5] and search.tree_counts() == list(range(200, 801, 50))
    assert len(trials) == 6
    assert sorted(t["folds"] for t in trials) == [1, 1, 2, 2, 3, 3]
    # The trials that went on had the best score in the fold before, and the choice is the best of the last.
    assert trials[0]["folds"] == 3 and trials[0]["average_precision"] >= trials[1]["average_precision"]
    assert trials == search.search_trees(train, used, sets=3, space=space, keep=0.5)
    table = search.tuning_results(spark, trials).orderBy("rank").collect()
    assert [r["maxIter"] for r in table] == [t["maxIter"] for t in trials]
    best = search.best_params(trials)
    model = training.fit_trees(train, used, best)
    assert model.stages[-1].getNumTrees == best["maxIter"]


def test_shapley_values_of_deep_trees_add_up(train, columns):
    used = columns[:15]
    rows = training.tree_rows(train, used, [KEY])
    nodes = attribution.tree_nodes(training.boosted(1, maxIter=3, maxDepth=8).fit(rows)).toPandas()
    trees = ensembles.trees_of(nodes)
    x = np.array([r["x"] for r in rows.select(vector_to_array("features").alias("x")).limit(700).collect()]).T
    got = ensembles.shapley_values(x, trees)
    log_odds = sum(ensembles.tree_values(x, t) for t in trees)
    assert np.abs(got.sum(axis=0) + ensembles.expected_value(trees) - log_odds).max() < 1e-9
    # Few rows take the way without a table of patterns.
    assert np.abs(ensembles.shapley_values(x[:, :5], trees) - got[:, :5]).max() < 1e-12


# ---- trees from packed rows --------------------------------------------------------------


def numbers(spark, n: int, width: int = 7) -> tuple:
    """Rows whose columns part them all differently, so that no two splits have the same gain; some values are zero."""
    source = np.random.default_rng(3)
    x = source.normal(size=(n, width)).round(3)
    x[:, 1] = np.maximum(x[:, 1], 0.0)
    x[:, 2:4] = x[:, 2:4] > np.array([0.3, -0.4])
    hit = x[:, 0] + x[:, 2] - x[:, 1] * x[:, 4] + source.normal(size=n) > 0.8
    used = [f"c{i}" for i in range(width)]
    table = pd.DataFrame(x, columns=used).assign(**{LABEL: hit.astype(int), KEY: [str(i) for i in range(n)]})
    return spark.createDataFrame(table), used


def node_rows(model) -> pd.DataFrame:
    table = attribution.tree_nodes(model).toPandas().sort_values(["tree", "node"]).reset_index(drop=True)
    return table[["tree", "node", "left", "right", "feature", "threshold", "weight", "prediction", "cover", "gain"]]


@pytest.mark.parametrize(
    ("n", "params"),
    [
        (700, {"maxIter": 5, "maxDepth": 3, "stepSize": 0.3}),
        (23000, {"maxIter": 4, "maxDepth": 4, "subsamplingRate": 0.7, "featureSubsetStrategy": "0.6", "minInstancesPerNode": 20}),
        (30000, {"maxIter": 3, "maxDepth": 8, "subsamplingRate": 0.9, "featureSubsetStrategy": "sqrt", "minInstancesPerNode": 60}),
    ],
)
def test_trees_from_packed_rows_are_sparks(spark, n, params):
    """Same thresholds, draws, splits and leaves, with and without a sample for the thresholds."""
    rows, used = numbers(spark, n)
    want = node_rows(training.boosted(11, **params).fit(training.tree_rows(rows, used, [])))
    got = node_rows(training.fit_trees(rows, used, params, seed=11).stages[-1])
    exact = ["tree", "node", "left", "right", "feature", "threshold"]
    pd.testing.assert_frame_equal(got[exact], want[exact])
    pd.testing.assert_frame_equal(got.drop(columns=exact), want.drop(columns=exact), rtol=1e-7, atol=1e-11)


def test_fit_trees_passes_over_packed_rows(spark, monkeypatch):
    """Spark's own passes read every column of every row as a number: 1.6 microseconds a row and pass."""
    monkeypatch.setattr(GBTClassifier, "_fit", lambda *_: pytest.fail("not over packed rows"))
    rows, used = numbers(spark, 600)
    model = training.fit_trees(rows, used, {"maxIter": 2, "maxDepth": 2})
    assert model.stages[-1].getNumTrees == 2 and model.stages[-1].getMaxDepth() == 2


def test_blocks_are_dealt_evenly_and_hold_every_row(spark, monkeypatch):
    monkeypatch.setattr(boosting, "BLOCK", 64)
    table = pd.DataFrame({"x": [[float(i), float(i % 2)] for i in range(3000)], "label": [float(i % 3 == 0) for i in range(3000)]})
    rows = spark.createDataFrame(table).repartitionByRange(3, F.expr("x[0] * x[0]")).cache()
    thresholds = [np.arange(0.5, 30), np.array([0.5])]
    dealt = boosting.packed_rows(rows, [[(0, 31), (1, 2)]], thresholds)
    held = [sum(n for _, (n, _) in part) for part in dealt.glom().collect()]
    assert sum(held) == 3000 and max(held) - min(held) <= 64
    codes = np.concatenate([np.frombuffer(body, np.uint16, n) for _, (n, body) in dealt.collect()])
    assert sorted(codes) == sorted(min(i, 30) + 31 * (i % 2) for i in range(3000))
    dealt.unpersist()
    rows.unpersist()


def test_draws_are_those_of_sparks_generator(spark, monkeypatch):
    monkeypatch.setattr(boosting, "BLOCK", 1024)
    tables = boosting.jump_tables(12)
    theirs = spark._jvm.org.apache.spark.util.random.XORShiftRandom(77)
    want = [theirs.nextDouble() < 0.3 for _ in range(3500)]
    got = np.concatenate([boosting.drawn_rows(77, b, min(1024, 3500 - 1024 * b), 0.3, tables) for b in range(4)])
    assert got.tolist() == want
    longs, java = boosting.java_longs(-5), spark._jvm.java.util.Random(-5)
    assert [next(longs) for _ in range(50)] == [java.nextLong() for _ in range(50)]


def test_lost_state_of_a_block_is_made_again(tmp_path, monkeypatch):
    monkeypatch.setenv("SPARK_LOCAL_DIRS", str(tmp_path))
    passes = boosting.Passes("fit", [[(0, 4), (1, 3)]], 2, 0.7, 5, 0.1, boosting.jump_tables(14))
    codes = np.random.default_rng(1).integers(0, 12, (1, 500)).astype(np.uint16)
    label = (codes[0] % 5 > 2).astype(np.uint8)
    tree = np.array([[0, 4, 2, 1, 2, 0.1], [-1, 1, 0, -1, -1, -0.4], [0, 12, 8, 3, 4, 0.2], [-1, 1, 0, -1, -1, 0.3], [-1, 1, 0, -1, -1, 0.7]])
    for count in range(4):
        residual, drawn = (a.copy() for a in passes.state((2, 0), codes, label, [tree] * count))
        # Known already, then lost, then broken off while it was written.
        for harm in (lambda f: None, lambda f: f.unlink(), lambda f: f.write_bytes(f.read_bytes()[:100])):
            harm(tmp_path / "boosting-fit" / "2-0")
            again = passes.state((2, 0), codes, label, [tree] * count)
            assert np.allclose(again[0], residual, rtol=1e-12) and (again[1] == drawn).all()
    leaf = np.where(codes[0] % 4 < 2, -0.4, np.where(codes[0] < 8, 0.3, 0.7))
    sign = np.where(label, 1.0, -1.0)
    assert np.allclose(residual, 4 * sign / (1 + np.exp(2 * sign * 1.2 * leaf)))


def test_fit_trees_takes_odd_rows(spark):
    rows, used = numbers(spark, 300)
    params = {"maxIter": 2, "maxDepth": 2}
    with pytest.raises(Exception, match="null or NaN"):
        training.fit_trees(rows.withColumn("c1", F.when(F.col("c1") > 1, F.col("c1"))), used, params)
    with pytest.raises(ValueError, match="labels"):
        training.fit_trees(rows.withColumn(LABEL, F.when(F.col(KEY) > "1", F.col(LABEL))), used, params)
    with pytest.raises(ValueError, match="no rows"):
        training.fit_trees(rows.limit(0), used, params)
    for label in (0, 1):  # nothing to tell apart
        one = rows.where(F.col(LABEL) == label)
        got, want = training.fit_trees(one, used, params), training.boosted(42, **params).fit(training.tree_rows(one, used, []))
        assert len(node_rows(got.stages[-1])) == 2  # Spark may split on what rounding leaves
        scores = training.score_rows(got, one, [KEY]).select("score").distinct().collect()
        theirs = training.score_rows(training.as_pipeline(want, used), one, [KEY]).select("score").distinct().collect()
        assert [round(r[0], 9) for r in scores] == [round(r[0], 9) for r in theirs]
    flat = rows.select(KEY, LABEL, *[F.lit(1.0).alias(c) for c in used])
    assert len(node_rows(training.fit_trees(flat, used, params).stages[-1])) == 2


def test_tabled_trees_have_the_same_shapley_values():
    source = np.random.default_rng(2)
    trees = []
    for _ in range(6):
        cover = np.array([100.0, *[0.0] * 14])
        for node in range(7):
            cover[2 * node + 1 : 2 * node + 3] = cover[node] * np.array([0.3, 0.7])
        child = [np.array([2 * i + side if i < 7 else -1 for i in range(15)]) for side in (1, 2)]
        # Two columns only, so that paths ask for one twice.
        feature, threshold = source.integers(0, 2, 15), source.normal(size=15)
        trees.append({"feature": feature, "threshold": threshold, "left": child[0], "right": child[1], "cover": cover, "value": source.normal(size=15)})
    x = source.normal(size=(3, 400))
    tabled = ensembles.tabled(trees)
    assert all("table" in t for t in tabled)
    assert np.abs(ensembles.shapley_values(x, tabled) - ensembles.shapley_values(x, trees)).max() < 1e-12
    assert all((ensembles.tree_values(x, a) == ensembles.tree_values(x, b)).all() for a, b in zip(tabled, trees))


def test_scores_of_trees_are_the_models_own(spark):
    """Tabled trees and deeper ones; what is missing is an error as before."""
    rows, used = numbers(spark, 900)
    rows = rows.withColumn("day", F.lit("2020-01-31").cast("date"))
    for depth in (3, 5):
        model = training.fit_trees(rows, used, {"maxIter": 4, "maxDepth": depth})
        want = {r[KEY]: r["score"] for r in model.transform(rows).select(KEY, training.churn_probability().alias("score")).collect()}
        got = training.score_rows(model, rows, [KEY, "day"])
        assert got.dtypes == [(KEY, "string"), ("day", "date"), ("score", "double")]
        assert all(abs(want.pop(r[KEY]) - r["score"]) < 1e-12 for r in got.collect()) and not want
    with pytest.raises(Exception, match="null or NaN"):
        training.score_rows(model, rows.withColumn("c0", F.lit(None).cast("double")), [KEY]).collect()


# ---- calendar splits -------------------------------------------------------------------


def snapshots(spark):
    dates = [f"{y}-{m}-01" for y in range(2000, 2004) for m in ("01", "07")]
    rows = [(f"{c}-{d}", c, d) for c in range(40) for d in dates[c % 3 :]] + [("x", 99, None)]
    return spark.createDataFrame(rows, f"{KEY} string, customer long, obs string").withColumn("obs_date", F.col("obs").cast("date"))


def test_calendar_holdout_purges_what_looks_ahead(spark):
    rows = snapshots(spark)
    got = {(r["obs"], r["split"]) for r in splits.calendar_holdout(rows).collect()}
    assert {s for _, s in got} == {"train", "purged", "test"}
    first = min(d for d, s in got if s == "test")
    n, total = rows.where(F.col("obs") >= first).count(), rows.count() - 1
    after = rows.where(F.col("obs") > first).count()
    assert n >= 0.2 * total > after
    year_before = f"{int(first[:4]) - 1}{first[4:]}"
    assert all((s == "test") == (d >= first) and (s == "train") == (d <= year_before) for d, s in got if d)
    assert (None, "purged") in got
    assert splits.calendar_holdout(rows.limit(0)).count() == 0


def test_rolling_folds_keep_customers_and_time_apart(spark):
    rows = snapshots(spark)
    folds = splits.rolling_folds(rows, "customer").join(rows, KEY).collect()
    assert {f["fold"] for f in folds} == {0, 1, 2}
    for fold in range(3):
        side = {r: [f for f in folds if f["fold"] == fold and f["role"] == r] for r in ("train", "validate")}
        origin = {f["obs"] for f in side["validate"]}
        assert len(origin) == 1
        (origin,) = origin
        assert not {f["customer"] for f in side["train"]} & {f["customer"] for f in side["validate"]}
        assert max(f["obs"] for f in side["train"]) == f"{int(origin[:4]) - 1}{origin[4:]}"
    validated = [f["customer"] for f in folds if f["role"] == "validate"]
    assert len(validated) == len(set(validated)) == 40
    assert splits.rolling_folds(rows.limit(0), "customer").count() == 0


def test_fixed_sample_of_fewer_rows_than_asked(train):
    assert splits.fixed_sample(train, size=10**6).count() == 2400
    assert splits.fixed_sample(train.limit(0)).count() == 0
    got = [r[KEY] for r in splits.fixed_sample(train, size=50).collect()]
    assert got == [r[KEY] for r in train.orderBy(F.md5(KEY), KEY).limit(50).collect()]


def test_out_of_fold_scores_every_row_once(train, columns):
    used = columns[:6]
    scored = training.out_of_fold_scores(train, lambda rows: training.train_baseline(rows, used))
    assert scored.count() == 2400 and scored.select(KEY).distinct().count() == 2400


def test_predicted_label_includes_the_threshold(spark):
    data = spark.createDataFrame([(0, 0.5), (1, 0.499999)], "id long, score double")
    assert [r["predicted"] for r in training.predicted(data, 0.5).orderBy("id").collect()] == [1, 0]


# ---- attributions ----------------------------------------------------------------------


def tree_value(nodes: pd.DataFrame, x, known) -> float:
    """Log-odds with only ``known`` features given: unknown splits are averaged by cover."""
    total = 0.0
    for _, tree in nodes.groupby("tree"):
        table = tree.set_index("node").to_dict("index")

        def walk(number):
            node = table[number]
            if node["left"] < 0:
                return node["prediction"]
            if node["feature"] in known:
                return walk(node["left"] if x[node["feature"]] <= node["threshold"] else node["right"])
            sides = [table[node[s]]["cover"] / node["cover"] * walk(node[s]) for s in ("left", "right")]
            return sum(sides)

        total += 2 * table[0]["weight"] * walk(0)
    return total


def test_tree_attributions_are_shapley_values(small_trees):
    used, rows, model = small_trees
    nodes = attribution.tree_nodes(model)
    table = nodes.toPandas()
    got = attribution.tree_attributions(rows.limit(8), nodes, used).collect()
    everyone = range(len(used))
    base = attribution.tree_base_value(nodes)
    assert base == pytest.approx(tree_value(table, None, set()), abs=1e-12)
    for row in got:
        x = row["values"]
        for j in everyone:
            expected = 0.0
            others = [i for i in everyone if i != j]
            for size in range(len(used)):
                share = math.factorial(size) * math.factorial(len(used) - size - 1) / math.factorial(len(used))
                for known in itertools.combinations(others, size):
                    gain = tree_value(table, x, {*known, j}) - tree_value(table, x, set(known))
                    expected += share * gain
            assert row["contributions"][j] == pytest.approx(expected, abs=1e-12)


def test_tree_attributions_add_up_to_the_log_odds(small_trees):
    used, rows, model = small_trees
    nodes = attribution.tree_nodes(model)
    base = attribution.tree_base_value(nodes)
    sums = attribution.tree_attributions(rows, nodes, used).select(
        KEY, (F.lit(base) + F.aggregate("contributions", F.lit(0.0), lambda a, b: a + b)).alias("margin")
    )
    p = model.transform(rows).select(KEY, vector_to_array("probability").alias("p"))
    both = sums.join(p, KEY).select(F.abs(1 / (1 + F.exp(-F.col("margin"))) - F.get("p", F.lit(1))).alias("gap"))
    worst = both.agg(F.max("gap").alias("gap"), F.count(F.lit(1)).alias("n")).first()
    assert worst["n"] == 2400 and worst["gap"] < 1e-9


def test_gain_importance_is_the_mean_weighted_gain_of_used_features(small_trees):
    used, _, model = small_trees
    nodes = attribution.tree_nodes(model)
    table = nodes.toPandas()
    inner = table[table["left"] >= 0]
    means = {used[int(f)]: (g["gain"] * g["cover"]).mean() for f, g in inner.groupby("feature")}
    got = {r["feature"]: r for r in attribution.gain_importance(nodes, [*used, "never"]).collect()}
    assert got["never"]["gain_norm"] == 0.0
    for name, value in means.items():
        assert got[name]["gain"] == pytest.approx(value)
        assert got[name]["gain_norm"] == pytest.approx(value / max(means.values()))


def test_permutation_importance_finds_the_signal(train, small_trees):
    used, _, model = small_trees
    pipeline = training.as_pipeline(model, used)
    sample = splits.fixed_sample(train, size=400)
    got = {r["feature"]: r for r in attribution.permutation_importance(pipeline, sample, used).collect()}
    assert max(got, key=lambda f: got[f]["loss"]) in ("Contract_ord", "tenure")
    assert max(r["perm_norm"] for r in got.values()) == pytest.approx(1.0)
    gains = attribution.gain_importance(attribution.tree_nodes(model), used)
    both = attribution.importance_comparison(gains, attribution.permutation_importance(pipeline, sample, used), top=3).collect()
    assert len(both) == 3 and both[0]["gain_norm"] == 1.0


def test_views_on_attributions(spark):
    data = spark.createDataFrame(
        [("a", [1.0, 2.0, 3.0, 4.0], [0.1, -0.5, 0.0, 0.5]), ("b", [1.0, 2.0, 3.0, 4.0], [0.3, 0.1, 0.0, -0.005])],
        f"{KEY} string, values array<double>, contributions array<double>",
    )
    names = ["w", "x", "y", "z"]
    ranks = {r["feature"]: (r["rank"], r["mean_abs"]) for r in attribution.global_importance(data, names).collect()}
    assert ranks == {"x": (1, 0.3), "z": (2, 0.2525), "w": (3, 0.2), "y": (4, 0.0)}
    texts = {r[KEY]: r["drivers"] for r in attribution.top_drivers(data, names).collect()}
    assert texts["a"] == "x(-0.50), z(+0.50), w(+0.10)"
    assert attribution.beeswarm_points(data, names, top=2).count() == 4
    one = attribution.customer_breakdown(data, names, "b", top=2).collect()
    assert [(r["feature"], r["value"]) for r in one] == [("w", 1.0), ("x", 2.0)]


def test_linear_attributions_add_up(features, columns):
    card = training.ScoreCard(0.1, {"tenure": -0.03, "Contract_ord": -0.5})
    base = attribution.linear_base_value(features, card).first()[0]
    rows = attribution.linear_attributions(features, card, columns).join(
        features.select(KEY, card.logit().alias("logit")), KEY
    )
    total = F.lit(base) + F.aggregate("contributions", F.lit(0.0), lambda a, b: a + b)
    assert rows.where(F.abs(total - F.col("logit")) > 2e-6).count() == 0
