"""Raw customers to the numeric feature table."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnline.functions import encodings as enc
from churnline.schema import CONTRACT_ORDER, KEY, LABEL, ONE_HOT_PREFIX, TENURE_BUCKETS, YES_NO_COLUMNS

MAX_LEVELS = 1000


def clean(raw: DataFrame) -> DataFrame:
    """Charges as numbers and the label as 0/1. The customer id stays as the row key."""
    return raw.withColumns({"TotalCharges": enc.number_or_zero("TotalCharges"), LABEL: enc.equals_flag(LABEL, "yes")})


def engineered(cleaned: DataFrame) -> DataFrame:
    """Cleaned customers with the derived columns, text columns still in place."""
    return cleaned.withColumns(
        {
            "avg_monthly_charges": enc.average_monthly(),
            "active_services": enc.active_services(),
            "charges_per_service": enc.charge_per_service(),
            "is_high_value": enc.high_value(),
            "tenure_bucket": enc.tenure_bucket(),
        }
    )


def unseen_categories(raw: DataFrame, column: str = "Contract", known: Iterable[str] = tuple(CONTRACT_ORDER)) -> DataFrame:
    """Levels of a column outside its known ones, with their row counts."""
    levels = raw.groupBy(F.col(column).alias("level")).agg(F.count(F.lit(1)).alias("n"))
    return levels.where(F.col("level").isNull() | ~F.col("level").isin(*known))


@dataclass(frozen=True)
class FeatureEncoder:
    """One-hot vocabularies fixed by ``fit``; ``transform`` then needs no shuffle."""

    levels: dict[str, list[str]]

    @classmethod
    def fit(cls, raw: DataFrame, max_levels: int = MAX_LEVELS) -> FeatureEncoder:
        columns = list(ONE_HOT_PREFIX)
        pairs = (
            raw.select(F.explode(F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).alias("level")) for c in columns])))
            .select("col.name", "col.level")
            .where(F.col("level").isNotNull())
            .distinct()
        )
        # The vocabulary must be small to become columns, so its size is checked before it is used.
        limit = max_levels * len(columns)
        found = pairs.limit(limit + 1).collect()
        levels = {c: sorted(row["level"] for row in found if row["name"] == c) for c in columns}
        too_wide = [c for c in columns if len(levels[c]) > max_levels]
        if too_wide or len(found) > limit:
            raise ValueError(f"more than {max_levels} levels to encode in {too_wide or columns}")
        return cls(levels)

    def one_hot(self, columns: list[str]) -> dict[str, Column]:
        flags: dict[str, Column] = {}
        for column in columns:
            for level in self.levels[column]:
                name = enc.flag_name(ONE_HOT_PREFIX[column], level)
                if name in flags:
                    raise ValueError(f"two levels of {column} share the column name {name}")
                flags[name] = enc.level_flag(column, level)
        return flags

    @staticmethod
    def bucket_flags() -> dict[str, Column]:
        return {enc.flag_name("tb", label): enc.level_flag("tenure_bucket", label) for label in TENURE_BUCKETS}

    @staticmethod
    def binary() -> dict[str, Column]:
        return {
            "gender": enc.equals_flag("gender", "male"),
            **{c: enc.equals_flag(c, "yes") for c in YES_NO_COLUMNS},
        }

    def expressions(self) -> dict[str, Column]:
        """Feature columns in their fixed order, for use on ``engineered`` rows."""
        binary = self.binary()
        kept = [
            "gender", "SeniorCitizen", "Partner", "Dependents", "tenure", "PhoneService",
            "PaperlessBilling", "MonthlyCharges", "TotalCharges",
        ]
        derived = ["avg_monthly_charges", "active_services", "charges_per_service", "is_high_value"]
        return {
            **{c: binary.get(c, F.col(c)) for c in kept},
            **{c: F.col(c) for c in derived},
            "Contract_ord": enc.contract_ordinal(),
            **self.one_hot(list(ONE_HOT_PREFIX)),
            **self.bucket_flags(),
        }

    @property
    def feature_names(self) -> list[str]:
        return list(self.expressions())

    def transform(self, raw: DataFrame, key: str = KEY) -> DataFrame:
        rows = engineered(clean(raw))
        return rows.select(key, *[e.alias(c) for c, e in self.expressions().items()], LABEL)


def feature_columns(features: DataFrame, key: str = KEY) -> list[str]:
    return [c for c in features.columns if c not in (key, LABEL)]


def segment_columns(columns: list[str]) -> list[str]:
    """Columns offered for segment views: contract and value flag first, the rest by name."""
    first = ["Contract_ord", "is_high_value"]
    offered = {c for c in columns if c.startswith(("Contract", "IS_", "PM_")) or c == "is_high_value"}
    return [c for c in first if c in offered] + sorted(offered.difference(first))
