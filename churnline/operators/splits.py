"""Hold-out, folds, class weights and the fixed sample."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from churnline.functions.ordering import HASH_DIGITS, order_cuts, sequence_numbers, tie_break
from churnline.functions.scalars import with_row
from churnline.schema import KEY, LABEL

TRAIN_SHARE = 0.8
FOLDS = 3
HORIZON_MONTHS = 12  # how far a label looks ahead


def ordered_holdout(features: DataFrame, key: str = KEY, share: float = TRAIN_SHARE) -> DataFrame:
    """Add ``split``: the first ``share`` of the rows by tenure train, the rest test.

    The last training row is found first; every row then decides for itself.
    """
    last = order_cuts(
        features,
        "tenure",
        key,
        LABEL,
        positions=lambda n: F.array(F.floor(n * share).cast("bigint")),
    ).select(F.struct("tenure", "hash", "key"))
    here = F.struct(F.col("tenure"), tie_break(key).alias("hash"), F.col(key).alias("key"))
    return features.withColumn("split", F.when(here <= last.scalar(), "train").otherwise("test"))


def calendar_holdout(
    snapshots: DataFrame, date: str = "obs_date", share: float = 1 - TRAIN_SHARE, horizon_months: int = HORIZON_MONTHS
) -> DataFrame:
    """Add ``split`` by the calendar: the latest dates that hold ``share`` of the rows test.

    Rows whose label window ends by the first test date train; those in between are ``purged``,
    since their labels look into the test period. A null date is purged. Rows are counted per
    date first, so only dates are ordered.
    """
    dates = snapshots.where(F.col(date).isNotNull()).groupBy(date).agg(F.count(F.lit(1)).alias("n"))
    # One row per calendar date.
    later = F.sum("n").over(Window.orderBy(F.desc(date)))
    cumulated = dates.select(date, later.alias("later"), F.sum("n").over(Window.partitionBy()).alias("total"))
    cutoff = cumulated.where(F.col("later") >= F.lit(share) * F.col("total")).agg(F.max(date)).scalar()
    split = F.when(F.col(date) >= cutoff, "test").when(F.add_months(date, horizon_months) <= cutoff, "train")
    return snapshots.withColumn("split", split.otherwise("purged"))


def customer_group(customer: str, groups: int) -> Column:
    """A customer's group 0..groups-1, by hash: all its snapshots share it."""
    return F.conv(F.left(tie_break(customer), F.lit(HASH_DIGITS)), 16, 10).cast("int") % groups


def rolling_folds(
    snapshots: DataFrame,
    customer: str,
    date: str = "obs_date",
    folds: int = FOLDS,
    horizon_months: int = HORIZON_MONTHS,
    key: str = KEY,
) -> DataFrame:
    """(fold, key, role): rolling-origin folds, grouped by customer and purged of the label's horizon.

    The last ``folds`` dates are the origins. Fold i validates the snapshots of its origin whose
    customers are in group i, and trains on those of all other customers whose label window
    ends by the origin. So no customer is on both sides and no label looks past the origin.
    """
    origins = snapshots.where(F.col(date).isNotNull()).select(date).distinct().orderBy(F.desc(date)).limit(folds)
    # One row per fold.
    numbered = origins.select(
        F.col(date).alias("origin"), (F.row_number().over(Window.orderBy(date)) - 1).alias("fold")
    )
    rows = snapshots.select(key, date, customer_group(customer, folds).alias("group"))
    mine, trained = F.col("group") == F.col("fold"), F.add_months(date, horizon_months) <= F.col("origin")
    role = F.when(mine & (F.col(date) == F.col("origin")), "validate").when(~mine & trained, "train")
    # An array of ``folds`` origins beside each row: rows are spread, never compared with each other.
    spread = with_row(rows, "of", numbered.agg(F.collect_list(F.struct("fold", "origin")).alias("folds")))
    spread = spread.select(key, date, "group", F.explode("of.folds").alias("f")).select(key, date, "group", "f.fold", "f.origin")
    return spread.select("fold", key, role.alias("role")).where(F.col("role").isNotNull())


def split_summary(split: DataFrame) -> DataFrame:
    return split.groupBy("split").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(LABEL).cast("bigint").alias("churners"),
        F.round(F.avg(LABEL), 6).alias("churn_rate"),
    )


def stratified_folds(rows: DataFrame, key: str = KEY, folds: int = FOLDS, within: tuple[str, ...] = ()) -> DataFrame:
    """Add ``fold`` 0..folds-1, each class (within each group) spread evenly over the folds."""
    numbered = sequence_numbers(rows, [*within, LABEL], key)
    return numbered.withColumn("fold", ((F.col("position") - 1) % folds).cast("int")).drop("position")


def class_weights(rows: DataFrame) -> DataFrame:
    """Per label: size, the balanced weight and the weight that evens out the classes by positives alone."""
    counts = rows.groupBy(F.col(LABEL).alias("label")).agg(F.count(F.lit(1)).alias("n"))
    totals = counts.agg(
        F.sum("n").alias("n"),
        F.count(F.lit(1)).alias("classes"),
        F.coalesce(F.sum(F.when(F.col("label") == 1, F.col("n"))), F.lit(0)).alias("pos"),
    )
    boosted = (F.col("all.n") - F.col("all.pos")) / F.greatest(F.col("all.pos"), F.lit(1))
    return with_row(counts, "all", totals).select(
        "label",
        "n",
        F.round(F.col("all.n") / (F.col("all.classes") * F.col("n")), 6).alias("balanced_weight"),
        F.round(F.when(F.col("label") == 1, boosted).otherwise(1.0), 6).alias("positive_weight"),
    )


def fixed_sample(rows: DataFrame, key: str = KEY, size: int = 1000) -> DataFrame:
    """A repeatable sample without replacement: the rows with the smallest key hashes.

    Rows are counted per hash cell; only those of the first cells that hold ``size`` rows are sorted.
    """
    cell = F.left(tie_break(key), F.lit(HASH_DIGITS))
    # 65,536 cells at most.
    before = F.coalesce(F.sum("n").over(Window.orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    cells = rows.groupBy(cell.alias("cell")).agg(F.count(F.lit(1)).alias("n")).select("cell", before.alias("before"))
    first = rows.where(cell <= cells.where(F.col("before") < size).agg(F.max("cell")).scalar())
    return first.orderBy(tie_break(key), key).limit(size)
