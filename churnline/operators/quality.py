"""Checks that a feature table must pass before anything is trained on it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from churnline.schema import LABEL, REQUIRED_COLUMNS

MIN_ROWS = 7000
RATE_RANGE = (0.1, 0.4)


def null_counts(features: DataFrame, columns: list[str] | None = None) -> DataFrame:
    columns = columns or REQUIRED_COLUMNS
    counts = features.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counts.unpivot([], columns, "column_name", "nulls")


def gate_facts() -> dict[str, Column]:
    """What the gate judges, as aggregates: a query can compute them, or a write observe them."""
    any_null = F.lit(0)
    for column in REQUIRED_COLUMNS:
        any_null = any_null + F.col(column).isNull().cast("int")
    return {
        "nulls": F.coalesce(F.sum(any_null), F.lit(0)).cast("double"),
        "rows": F.count(F.lit(1)).cast("double"),
        "rate": F.round(F.avg(LABEL), 6),
    }


def quality_gate(features: DataFrame, min_rows: int = MIN_ROWS, rate_range: tuple[float, float] = RATE_RANGE) -> DataFrame:
    """One row per check with its value and a 0/1 verdict, from a single pass."""
    return judged(features.agg(*[c.alias(n) for n, c in gate_facts().items()]), min_rows, rate_range)


def observed_gate(spark: SparkSession, facts: dict, min_rows: int = MIN_ROWS, rate_range: tuple[float, float] = RATE_RANGE) -> DataFrame:
    """The same gate from the facts that the table's write observed, without reading it again."""
    row = [facts[name] for name in ("nulls", "rows", "rate")]
    return judged(spark.createDataFrame([row], "nulls double, rows double, rate double"), min_rows, rate_range)


def judged(facts: DataFrame, min_rows: int, rate_range: tuple[float, float]) -> DataFrame:
    low, high = rate_range

    def check(name: str, value: Column, ok: Column) -> Column:
        return F.struct(F.lit(name).alias("check"), value.alias("value"), ok.alias("ok"))

    checks = F.array(
        check("key_nulls", F.col("nulls"), F.col("nulls") == 0),
        check("row_count", F.col("rows"), F.col("rows") > min_rows),
        check("churn_rate", F.col("rate"), (F.col("rate") > low) & (F.col("rate") < high)),
    )
    rows = facts.select(F.explode(checks).alias("c"))
    return rows.select("c.check", "c.value", F.coalesce(F.col("c.ok").cast("int"), F.lit(0)).alias("ok"))


def require_quality(features: DataFrame, **limits) -> None:
    require_passed(quality_gate(features, **limits))


def require_passed(gate: DataFrame) -> None:
    failed = [f"{r['check']}={r['value']}" for r in gate.collect() if not r["ok"]]
    if failed:
        raise ValueError(f"feature table fails {', '.join(failed)}")
