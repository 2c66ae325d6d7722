import pytest
from pyspark.sql import functions as F

from churnline.functions import encodings as enc
from churnline.operators import quality
from churnline.operators.features import FeatureEncoder, clean, engineered, feature_columns, segment_columns, unseen_categories
from churnline.schema import KEY, LABEL, ONE_HOT_PREFIX
from churnline.session import observed_write
from churnline.sources.customers import read_customers_csv, register_features, replace_table, write_table


def values(frame, column):
    return [r[column] for r in frame.orderBy("id").collect()]


def test_blank_charges_are_zero_under_ansi(spark):
    frame = spark.createDataFrame(list(enumerate([" ", "", "\t ", "  29.85", "0", None])), "id long, TotalCharges string")
    assert values(frame.withColumn("v", enc.number_or_zero("TotalCharges")), "v") == [0.0, 0.0, 0.0, 29.85, 0.0, None]


def test_label_ignores_case_and_padding(spark):
    frame = spark.createDataFrame(list(enumerate(["Yes", " yes ", "NO", None, "yess"])), "id long, Churn string")
    assert values(frame.withColumn("v", enc.equals_flag("Churn", "yes")), "v") == [1, 1, 0, 0, 0]


def test_tenure_bins_are_right_closed(spark):
    months = [0, 1, 12, 13, 24, 25, 48, 49, 72, -1, None]
    frame = spark.createDataFrame(list(enumerate(months)), "id long, tenure int")
    got = values(frame.withColumn("v", enc.tenure_bucket()), "v")
    assert got == ["0-12", "0-12", "0-12", "13-24", "13-24", "25-48", "25-48", "49+", "49+", None, None]


def test_high_value_is_strictly_over_the_limit(spark):
    frame = spark.createDataFrame([(0, 70.0), (1, 70.01)], "id long, MonthlyCharges double")
    assert values(frame.withColumn("v", enc.high_value()), "v") == [0, 1]


def test_unknown_contract_fails_and_is_reported(spark):
    frame = spark.createDataFrame([(0, "One year"), (1, "Weekly"), (2, None)], "id long, Contract string")
    assert {(r["level"], r["n"]) for r in unseen_categories(frame).collect()} == {("Weekly", 1), (None, 1)}
    with pytest.raises(Exception, match="unexpected Contract level: Weekly"):
        frame.where("id < 2").select(enc.contract_ordinal()).collect()


def test_feature_table_has_the_46_features_in_order(customers):
    encoder = FeatureEncoder.fit(customers)
    table = encoder.transform(customers)
    names = feature_columns(table)
    assert len(names) == 46 and table.columns == [KEY, *names, LABEL]
    assert names[:9] == [
        "gender", "SeniorCitizen", "Partner", "Dependents", "tenure", "PhoneService",
        "PaperlessBilling", "MonthlyCharges", "TotalCharges",
    ]
    assert names[14:17] == ["IS_DSL", "IS_Fiber_optic", "IS_No"]
    assert names[17:21] == ["PM_Bank_transfer__automatic_", "PM_Credit_card__automatic_", "PM_Electronic_check", "PM_Mailed_check"]
    assert names[-4:] == ["tb_0_12", "tb_13_24", "tb_25_48", "tb_49_"]
    assert table.count() == customers.count()
    assert table.select([F.count_if(F.col(c).isNull()).alias(c) for c in table.columns]).first().asDict() == {
        c: 0 for c in table.columns
    }


def test_one_hot_rows_sum_to_one(customers):
    encoder = FeatureEncoder.fit(customers)
    table = encoder.transform(customers)
    for column, prefix in [*ONE_HOT_PREFIX.items(), ("tenure_bucket", "tb")]:
        flags = [c for c in table.columns if c.startswith(f"{prefix}_")]
        total = sum((F.col(c) for c in flags[1:]), F.col(flags[0]))
        assert table.where(total != 1).count() == 0, column


def test_unseen_level_has_no_flag(spark, customers):
    encoder = FeatureEncoder.fit(customers)
    odd = customers.limit(1).withColumn("InternetService", F.lit("Satellite"))
    row = encoder.transform(odd).first()
    assert row["IS_DSL"] == row["IS_Fiber_optic"] == row["IS_No"] == 0


def test_vocabulary_size_and_name_clashes_are_checked(customers):
    with pytest.raises(ValueError, match="more than 2 levels"):
        FeatureEncoder.fit(customers, max_levels=2)
    clash = FeatureEncoder({**FeatureEncoder.fit(customers).levels, "InternetService": ["A+", "A-"]})
    with pytest.raises(ValueError, match="share the column name"):
        clash.expressions()


def test_derived_columns_by_hand(customers):
    for r in engineered(clean(customers)).limit(50).collect():
        services = ["PhoneService", "MultipleLines", "OnlineSecurity", "OnlineBackup", "DeviceProtection",
                    "TechSupport", "StreamingTV", "StreamingMovies"]
        active = sum(r[c] == "Yes" for c in services)
        assert r["active_services"] == active
        assert r["charges_per_service"] == pytest.approx(r["MonthlyCharges"] / (active + 1))
        assert r["avg_monthly_charges"] == pytest.approx(r["TotalCharges"] / (r["tenure"] + 1))


def test_segment_columns():
    names = ["tenure", "PM_b", "IS_x", "is_high_value", "Contract_ord", "PM_a", "tb_0_12"]
    assert segment_columns(names) == ["Contract_ord", "is_high_value", "IS_x", "PM_a", "PM_b"]


def test_quality_gate(customers):
    table = FeatureEncoder.fit(customers).transform(customers)
    quality.require_quality(table, min_rows=2000, rate_range=(0.1, 0.6))
    with pytest.raises(ValueError, match="row_count"):
        quality.require_quality(table, min_rows=3000, rate_range=(0.1, 0.6))
    with pytest.raises(ValueError, match="churn_rate"):
        quality.require_quality(table, min_rows=2000, rate_range=(0.1, 0.11))
    with pytest.raises(ValueError, match="key_nulls"):
        broken = table.withColumn("tenure", F.when(F.col("tenure") > 1, F.col("tenure")))
        quality.require_quality(broken, min_rows=2000, rate_range=(0.1, 0.6))
    assert {r["column_name"]: r["nulls"] for r in quality.null_counts(table).collect()}["tenure"] == 0


def test_missing_input_fails_at_once(spark):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        read_customers_csv(spark, "/tmp/no/such/customers.csv")


def test_feature_table_round_trip(spark, customers, tmp_path):
    table = FeatureEncoder.fit(customers).transform(customers)
    path = str(tmp_path / "features")
    write_table(table, path)
    assert register_features(spark, path) == 3000
    assert spark.table("features").columns == table.columns
    assert spark.table("features").exceptAll(table).count() == 0


def test_catalog_table_is_replaced(spark, customers):
    table = FeatureEncoder.fit(customers).transform(customers)
    assert replace_table(table, "kept_features") == 3000
    assert replace_table(table.limit(10).select("tenure"), "kept_features") == 10
    assert spark.table("kept_features").columns == ["tenure"]
    assert spark.sql("SELECT count(*) FROM kept_features").first()[0] == 10
    spark.sql("DROP TABLE kept_features")


def test_gate_from_what_the_write_observed(spark, customers, tmp_path):
    table = FeatureEncoder.fit(customers).transform(customers).withColumn("tenure", F.when(F.col("tenure") > 5, F.col("tenure")))
    facts = observed_write(table, str(tmp_path / "observed"), quality.gate_facts())
    assert facts["n_rows"] == 3000
    limits = {"min_rows": 2000, "rate_range": (0.1, 0.6)}
    seen = quality.observed_gate(spark, facts, **limits)
    assert seen.collect() == quality.quality_gate(table, **limits).collect()
    with pytest.raises(ValueError, match="key_nulls"):
        quality.require_passed(seen)


def test_saved_encoder_makes_the_same_columns(spark, tmp_path):
    from churnline.operators.features import FeatureEncoder
    from churnline.sources.artifacts import encoder_table, load_encoder, save_table

    encoder = FeatureEncoder({"InternetService": ["DSL", "Fiber optic", "No"], "PaymentMethod": ["b", "a"]})
    save_table(encoder_table(spark, encoder), f"{tmp_path}/encoder")
    assert load_encoder(spark, f"{tmp_path}/encoder") == encoder
