"""One-row results next to every row."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_row(rows: DataFrame, name: str, one_row: DataFrame) -> DataFrame:
    """Add a one-row table as a struct column, by a scalar subquery that runs once."""
    return rows.withColumn(name, one_row.select(F.struct("*")).scalar())
