"""Wide numeric columns as rows.

Statistics over dozens of columns are taken from (feature, value) rows: the rows are
folded into one partial result per feature before anything is shuffled, and the
generated code stays small, which a single aggregate over all columns does not.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def feature_rows(features: DataFrame, columns: list[str], keep: list[str] | None = None) -> DataFrame:
    keep = keep or []
    numbers = features.select(*keep, *[F.col(c).cast("double").alias(c) for c in columns])
    return numbers.unpivot(keep, columns, "feature", "value")
