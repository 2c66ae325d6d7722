import os

import duckdb
import pytest

import __spark_entry__ as driver
from churnline.plans.oracle import oracle_sql
from churnline.plans.queries import registered

FOLDER = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events".split()
TYPES = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string"}
TRAINED = {
    "baseline_scores", "gbt_scores", "model_comparison", "tree_contributions", "attribution_base_value",
    "tree_importance", "gain_importance", "permutation_importance", "importance_comparison", "whatif_model_scores",
}

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="needs the given tables")


@pytest.fixture(scope="module")
def engine():
    connection = duckdb.connect()
    for name in TABLES:
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


def as_set(rows, names):
    """Rows as sortable text, columns by name; floats in full precision."""
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(repr(float(r[i])) if isinstance(r[i], float) else repr(r[i]) for i in order) for r in rows)


def test_everything_untrained_has_a_check():
    assert set(registered()) - set(oracle_sql()) == TRAINED
    assert set(driver.oracle_sql()) <= set(driver.queries())


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_equal_to_sql(spark, engine, name):
    table = driver.queries()[name](spark, FOLDER)
    rows = [tuple(r) for r in table.collect()]
    result = engine.sql(driver.oracle_sql()[name])
    assert dict(table.dtypes) == {c: TYPES[str(t)] for c, t in zip(result.columns, result.types)}
    assert as_set(rows, table.columns) == as_set(result.fetchall(), result.columns)


def test_entry(spark):
    table = driver.entry(spark)
    assert table.columns[:3] == ["customer", "churn_prob", "risk_tier"] and table.count() > 0


@pytest.mark.parametrize("name", sorted(TRAINED))
def test_trained_queries_run(spark, name):
    assert driver.queries()[name](spark, FOLDER).count() > 0


# ---- plans ------------------------------------------------------------------------------


def plan(table) -> str:
    return table._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(driver.oracle_sql()) - {"tree_additivity"}))
def test_plans_stay_in_the_jvm_and_join_on_keys(spark, name):
    text = plan(driver.queries()[name](spark, FOLDER))
    for unwanted in ("PythonUDF", "ArrowEvalPython", "BatchEvalPython", "MapInPandas", "CartesianProduct", "NestedLoopJoin"):
        assert unwanted not in text, unwanted


def test_one_scan_for_all_segments(spark):
    assert plan(driver.queries()["segment_all"](spark, FOLDER)).count("FileScan") == 1


def test_only_needed_columns_are_read(spark):
    text = plan(driver.queries()["kpi_overview"](spark, FOLDER))
    assert "ReadSchema" in text and "StreamingTV_Yes" not in text


def test_order_filter_reaches_the_scan(spark):
    from churnline.sources.panel import customer_snapshots

    text = customer_snapshots(spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "LessThan(o_orderdate" in text and "l_extendedprice" not in text
