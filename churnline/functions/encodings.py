"""Column expressions of the feature preparation."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from churnline.schema import CONTRACT_ORDER, COUNTED_SERVICES, HIGH_VALUE_OVER, TENURE_BUCKETS

_WHITESPACE = " \t\n\r\f\v"


def normal(column: str | Column) -> Column:
    """Text without surrounding white space, in lower case."""
    return F.lower(F.btrim(F.col(column) if isinstance(column, str) else column, F.lit(_WHITESPACE)))


def equals_flag(column: str | Column, word: str) -> Column:
    """1 where the text is ``word``, ignoring case and padding; 0 elsewhere, nulls included."""
    return F.coalesce((normal(column) == word).cast("int"), F.lit(0))


def number_or_zero(column: str) -> Column:
    """Text as a double, blanks as 0. A plain cast of a blank raises under ANSI."""
    text = F.col(column).cast("string")
    return F.when(text.rlike(r"^\s*$"), F.lit(0.0)).otherwise(text.cast("double"))


def average_monthly() -> Column:
    return F.col("TotalCharges") / (F.col("tenure") + 1)


def active_services() -> Column:
    total = F.lit(0)
    for name in COUNTED_SERVICES:
        total = total + equals_flag(name, "yes")
    return total


def charge_per_service() -> Column:
    return F.col("MonthlyCharges") / (active_services() + 1)


def high_value() -> Column:
    return (F.col("MonthlyCharges") > HIGH_VALUE_OVER).cast("int")


def right_closed(column: str | Column, bounds: dict[str, float | None], above: float) -> Column:
    """Label of the first bound that is not below the value; null at or under ``above``."""
    value = F.col(column) if isinstance(column, str) else column
    labelled = F.when(value.isNull() | (value <= above), F.lit(None).cast("string"))
    for label, bound in bounds.items():
        labelled = labelled.otherwise(F.lit(label)) if bound is None else labelled.when(value <= bound, F.lit(label))
    return labelled


def tenure_bucket(column: str = "tenure") -> Column:
    return right_closed(column, TENURE_BUCKETS, above=-0.1)


def contract_ordinal(column: str = "Contract") -> Column:
    ordinal = F.when(F.lit(False), F.lit(None).cast("int"))
    for level, position in CONTRACT_ORDER.items():
        ordinal = ordinal.when(F.col(column) == level, F.lit(position))
    unseen = F.concat(F.lit("unexpected Contract level: "), F.coalesce(F.col(column), F.lit("null")))
    return ordinal.otherwise(F.raise_error(unseen).cast("int"))


def level_flag(column: str, level: str) -> Column:
    return F.coalesce((F.col(column) == level).cast("int"), F.lit(0))


def flag_name(prefix: str, level: str) -> str:
    return re.sub(r"[^A-Za-z0-9_]", "_", f"{prefix}_{level}")
