import duckdb
import pytest
from conftest import customer_rows, write_customers
from pyspark.sql import functions as F

from churnline import session
from churnline.operators import products
from churnline.plans import pipeline
from churnline.plans.oracle_panel import RAW
from churnline.plans.stages import Stages
from churnline.sources.artifacts import load_model, load_table
from churnline.sources.customers import read_customers_csv
from churnline.sources.panel import customer_snapshots
from churnline.streaming.scoring import arriving_customers, scored_stream, start_scoring

SPACE = {"maxIter": (4, 8), "maxDepth": (3, 3), "stepSize": (0.1, 0.3)}


@pytest.fixture(scope="module")
def stages(spark, customers_csv):
    return Stages(spark, customers_csv, read_customers_csv, trials=2, space=SPACE)


@pytest.fixture(scope="module")
def out(stages, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("out"))
    pipeline.run(stages, folder, min_rows=2000, rate_range=(0.1, 0.6))
    return folder


def test_every_table_is_written(spark, out):
    manifest = {r["table_name"]: r for r in load_table(spark, f"{out}/manifest").collect()}
    assert len(manifest) >= 25
    assert {n for n, r in manifest.items() if not r["ok"]} <= pipeline.MAY_BE_EMPTY
    assert manifest["features"]["n_rows"] == manifest["scores"]["n_rows"] == 3000
    assert spark.table("features").count() == 3000


def test_planted_signal_is_found(spark, out):
    strongest = load_table(spark, f"{out}/global_importance").orderBy("rank").first()["feature"]
    assert strongest == "Contract_ord"
    segments = load_table(spark, f"{out}/segment_report").orderBy("rank").collect()
    assert (segments[0]["feature"], segments[0]["direction"]) == ("Contract_ord", "below")
    rates = {r["level"]: r["churn_rate"] for r in load_table(spark, f"{out}/segment_churn").where("segment = 'Contract'").collect()}
    assert rates["Month-to-month"] > 2 * rates["Two year"]
    facts = {r["fact"] for r in load_table(spark, f"{out}/memo_facts").collect()}
    assert {"churner_monthly", "revenue_kept", "trees.pr_auc", "1.Contract_ord.below.ratio"} <= facts


def test_saved_models_give_the_saved_scores(spark, stages, out):
    model = load_model(f"{out}/models/trees")
    again = stages.model_scores(model).select("customerID", "score")
    saved = load_table(spark, f"{out}/scores").select("customerID", "score")
    assert again.exceptAll(saved).count() == 0


def test_empty_outputs_are_reported(spark):
    empty = spark.range(0)
    manifest = {r["table_name"]: (r["n_rows"], r["ok"]) for r in products.output_manifest({"a": spark.range(3), "b": empty}).collect()}
    assert manifest == {"a": (3, 1), "b": (0, 0)}


def test_stream_scores_like_the_batch(spark, stages, out, tmp_path):
    inbox = tmp_path / "inbox"
    inbox.mkdir()
    rows = customer_rows(40, seed=99)
    write_customers(inbox / "first.csv", rows[:25])
    encoder, model = stages.encoder(), load_model(f"{out}/models/trees")
    target, marks = str(tmp_path / "scored"), str(tmp_path / "marks")

    def score_new_files():
        query = start_scoring(scored_stream(arriving_customers(spark, str(inbox)), encoder, model, 0.5), target, marks)
        assert query.awaitTermination(120)

    score_new_files()
    assert spark.read.parquet(target).count() == 25
    write_customers(inbox / "second.csv", rows[25:])
    score_new_files()
    got = spark.read.parquet(target)
    assert got.count() == 40 and got.select("customerID").distinct().count() == 40

    batch = model.transform(encoder.transform(read_customers_csv(spark, str(inbox))))
    from churnline.operators.training import churn_probability

    both = got.join(batch.select("customerID", churn_probability().alias("batch")), "customerID")
    assert both.where(F.col("score") != F.col("batch")).count() == 0


# ---- where intermediate tables go -----------------------------------------------------------


class FakeSession:
    def __init__(self, master, setting=None):
        self.conf = {"spark.checkpoint.dir": setting}
        self.sparkContext = self
        self.master, self.applicationId = master, f"app-{master}-{setting}"

    def getConf(self):
        return self.conf


def test_the_clusters_folder_is_used():
    assert session.shared_folder(FakeSession("yarn", "hdfs:///shared")) == "hdfs:///shared"
    assert session.shared_folder(FakeSession("local[2]", "/named")) == "/named"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_folder(FakeSession("yarn"))


def test_a_stage_is_built_once(spark):
    calls = []

    def build():
        calls.append(1)
        return spark.range(5)

    assert session.staged(spark, "five", ("x",), build).count() == 5
    assert session.staged(spark, "five", ("x",), build).count() == 5
    assert len(calls) == 1


# ---- skewed input ------------------------------------------------------------------------------


def test_snapshots_with_one_customer_holding_a_third_of_the_orders(spark, tmp_path):
    """The panel equals its SQL form when orders and parts pile up on single keys."""
    tables = "region nation customer part orders lineitem events".split()
    engine = duckdb.connect()
    for name in tables:
        engine.sql(f"CREATE TABLE {name} AS SELECT * FROM '/root/testdata/sf0.001/{name}.parquet'")
    engine.sql("UPDATE orders SET o_custkey = 1 WHERE o_orderkey % 3 = 0")
    engine.sql("UPDATE lineitem SET l_partkey = 5 WHERE l_linenumber % 2 = 0")
    engine.sql("UPDATE orders SET o_orderdate = TIMESTAMP '1998-06-30' WHERE o_orderkey % 30 = 0")
    for name in tables:
        engine.sql(f"COPY {name} TO '{tmp_path}/{name}.parquet' (FORMAT parquet)")
    got = customer_snapshots(spark, str(tmp_path)).withColumn("obs_date", F.col("obs_date").cast("string"))
    expected = engine.sql(f"{RAW} SELECT {', '.join(got.columns)} FROM raw").fetchall()
    assert sorted(tuple(r) for r in got.collect()) == sorted(expected) and len(expected) > 1000
