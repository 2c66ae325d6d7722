"""Reading raw customers and keeping the feature table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from churnline.schema import RAW_SCHEMA
from churnline.session import fresh_path, observed_write


def read_customers_csv(spark: SparkSession, path: str) -> DataFrame:
    """Customer file with a header row. Padding is kept: blank charges are handled by ``clean``."""
    return spark.read.schema(RAW_SCHEMA).csv(path, header=True, enforceSchema=False, mode="FAILFAST")


def write_table(table: DataFrame, path: str) -> None:
    table.write.mode("overwrite").parquet(path)


def replace_table(table: DataFrame, name: str) -> int:
    """Replace the catalog's table ``name`` by ``table`` and return its row count.

    The new rows are written to a place of their own before the old entry goes, so readers of
    the old table keep their files and a failed write leaves the catalog as it was.
    """
    spark = table.sparkSession
    path = fresh_path(spark, name)
    n_rows = observed_write(table, path)["n_rows"]
    spark.sql("DROP TABLE IF EXISTS IDENTIFIER(:name)", {"name": name})
    spark.catalog.createTable(name, path, "parquet")
    return n_rows


def register_features(spark: SparkSession, path: str, name: str = "features") -> int:
    """Replace the SQL view of the feature table and return its row count."""
    spark.read.parquet(path).createOrReplaceTempView(name)
    return spark.table(name).count()
