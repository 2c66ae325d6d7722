"""Customer snapshots with the raw churn schema, derived from order history.

One row per customer and observation date. Orders are first reduced to one row per
customer and half-year, which bounds every later per-customer group by the number of
half-years however many orders a customer has. A window over those few rows then sees
the half-year before and after, so no dense customer-by-date grid is ever built.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from churnline.schema import INTERNET_ADD_ONS, RAW_SCHEMA

FIRST_DATE = "1996-01-01"
DATES = 10
STEP_MONTHS = 6
YEAR = 12 // STEP_MONTHS  # half-years in the look-back and in the label window
END_OF_LABELS = "2001-07-01"

# Part type that stands for each internet add-on, in column order.
ADD_ON_PART_TYPE = dict(zip(INTERNET_ADD_ONS, ["ECONOMY", "MEDIUM", "STANDARD", "LARGE", "SMALL", "PROMO"]))


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _months(date):
    return F.year(date) * 12 + F.month(date)


def _add_on_bits(lines: DataFrame, parts: DataFrame) -> DataFrame:
    """Per order, one bit for each add-on bought."""
    bit = F.lit(None).cast("int")
    for position, part_type in enumerate(ADD_ON_PART_TYPE.values()):
        bit = F.when(F.col("p_type") == part_type, F.lit(1 << position)).otherwise(bit)
    kinds = parts.where(F.col("p_type").isin(*ADD_ON_PART_TYPE.values())).select("p_partkey", bit.alias("bit"))
    return (
        lines.select("l_orderkey", "l_partkey")
        .join(kinds, F.col("l_partkey") == F.col("p_partkey"))
        .groupBy(F.col("l_orderkey").alias("o_orderkey"))
        .agg(F.bit_or("bit").alias("bits"))
    )


def _half_years(orders: DataFrame, bits: DataFrame) -> DataFrame:
    """Orders reduced to one row per customer and half-year."""
    date = F.col("o_orderdate")
    first = F.lit(FIRST_DATE).cast("date")
    return (
        orders.where(date < F.lit(END_OF_LABELS).cast("timestamp_ntz"))
        .join(bits, "o_orderkey", "left")
        .groupBy(
            F.col("o_custkey").alias("c_custkey"),
            F.floor((_months(date) - _months(first)) / STEP_MONTHS).cast("int").alias("period"),
        )
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(F.round(F.col("o_totalprice") * 100).cast("bigint")).alias("cents"),
            F.bit_or("bits").alias("bits"),
            F.min(_months(date)).alias("month"),
            F.max(F.struct("o_orderdate", "o_orderkey", "o_orderstatus", "o_orderpriority")).alias("latest"),
        )
    )


def _customers(spark: SparkSession, folder: str) -> DataFrame:
    buyers = (
        read_table(spark, folder, "events")
        .where(F.col("event_type") == "purchase")
        .select(F.col("user_id").alias("c_custkey"))
        .distinct()
        .withColumn("paperless", F.lit(True))
    )
    places = read_table(spark, folder, "nation").join(
        read_table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    return (
        read_table(spark, folder, "customer")
        .join(places, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(buyers, "c_custkey", "left")
        .select("c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment", "r_name", "paperless")
    )


def customer_snapshots(spark: SparkSession, folder: str) -> DataFrame:
    """The raw customer table, with ``c_custkey`` and ``obs_date`` kept as extra keys."""
    bits = _add_on_bits(read_table(spark, folder, "lineitem"), read_table(spark, folder, "part"))
    halves = _half_years(read_table(spark, folder, "orders"), bits)

    by_time = Window.partitionBy("c_custkey").orderBy("period")
    so_far = by_time.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    history = halves.select(
        "c_custkey",
        "period",
        "n",
        "cents",
        "bits",
        "latest",
        F.lag("period").over(by_time).alias("prev_period"),
        F.lag("n").over(by_time).alias("prev_n"),
        F.lag("cents").over(by_time).alias("prev_cents"),
        F.lag("bits").over(by_time).alias("prev_bits"),
        F.lead("period").over(by_time).alias("next_period"),
        F.sum("cents").over(so_far).alias("past_cents"),
        F.min("month").over(so_far).alias("first_month"),
    )

    # A half-year is the latest one with orders for every date up to the next such half-year.
    first_obs = F.greatest(F.col("period") + 1, F.lit(0))
    last_obs = F.least(F.coalesce("next_period", F.lit(DATES - 1)), F.lit(DATES - 1))
    dated = (
        history.join(_customers(spark, folder), "c_custkey")
        .where(first_obs <= last_obs)
        .withColumn("obs", F.explode(F.sequence(first_obs, last_obs)))
    )

    in_year = F.col("period") >= F.col("obs") - YEAR
    prev_in_year = F.coalesce(F.col("prev_period") >= F.col("obs") - YEAR, F.lit(False))

    def year_value(name: str):
        now = F.when(in_year, F.col(name)).otherwise(0)
        return now + F.when(prev_in_year, F.col(f"prev_{name}")).otherwise(0)

    start = F.lit(FIRST_DATE).cast("date")
    obs_date = F.add_months(start, F.col("obs") * STEP_MONTHS)
    year_bits = F.when(in_year, F.coalesce("bits", F.lit(0))).otherwise(0).bitwiseOR(
        F.when(prev_in_year, F.coalesce("prev_bits", F.lit(0))).otherwise(0)
    )
    facts = dated.select(
        "*",
        obs_date.alias("obs_date"),
        year_value("n").alias("year_n"),
        year_value("cents").alias("year_cents"),
        year_bits.alias("year_bits"),
        (_months(start) + F.col("obs") * STEP_MONTHS - F.col("first_month")).alias("tenure"),
        F.coalesce(F.col("next_period") <= F.col("obs") + YEAR - 1, F.lit(False)).alias("orders_again"),
        F.col("latest.o_orderstatus").alias("status"),
        F.left(F.col("latest.o_orderpriority"), F.lit(1)).alias("priority"),
    )

    def yes_no(condition):
        return F.when(condition, "Yes").otherwise("No")

    columns = {
        "customerID": F.concat_ws("-", "c_custkey", F.col("obs_date").cast("string")),
        "gender": F.when(F.col("c_custkey") % 2 == 0, "Male").otherwise("Female"),
        "SeniorCitizen": (F.col("c_acctbal") < 0).cast("int"),
        "Partner": yes_no(F.col("c_nationkey") % 2 == 1),
        "Dependents": yes_no(F.col("r_name").isin("AFRICA", "AMERICA")),
        "tenure": F.col("tenure").cast("int"),
        "PhoneService": yes_no(F.col("year_n") > 0),
        "MultipleLines": F.when(F.col("year_n") == 0, "No phone service").otherwise(yes_no(F.col("year_n") >= 2)),
        "InternetService": F.when(F.col("status") == "F", "Fiber optic")
        .when(F.col("status") == "O", "DSL")
        .otherwise("No"),
        "Contract": F.when(F.col("priority").isin("1", "2"), "Month-to-month")
        .when(F.col("priority") == "3", "One year")
        .otherwise("Two year"),
        "PaperlessBilling": yes_no(F.col("paperless")),
        "PaymentMethod": F.col("c_mktsegment"),
        "MonthlyCharges": F.expr("year_cents div 5040") / F.lit(100.0),
        "TotalCharges": F.when(F.col("tenure") <= 1, " ").otherwise(F.expr("past_cents div 42000").cast("string")),
        "Churn": yes_no(~F.col("orders_again")),
    }
    for position, name in enumerate(INTERNET_ADD_ONS):
        bought = F.col("year_bits").bitwiseAND(1 << position) != 0
        columns[name] = F.when(F.col("status") == "P", "No internet service").otherwise(yes_no(bought))
    return facts.select("c_custkey", "obs_date", *[columns[f.name].alias(f.name) for f in RAW_SCHEMA])
