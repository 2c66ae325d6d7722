import csv
import os
import random
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("churnline-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "6g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def customer_rows(n: int, seed: int = 7) -> list[dict]:
    """Customers whose churn depends on contract, tenure and internet service."""
    source = random.Random(seed)
    rows = []
    for i in range(n):
        contract = source.choice(["Month-to-month", "Month-to-month", "One year", "Two year"])
        tenure = source.randint(0, 72)
        internet = source.choice(["Fiber optic", "DSL", "No"])
        phone = source.choice(["Yes", "Yes", "No"])
        monthly = round(source.uniform(20, 110), 2)
        risk = 0.05 + 0.4 * (contract == "Month-to-month") + 0.3 * (tenure < 13) + 0.1 * (internet == "Fiber optic")
        add_on = lambda: "No internet service" if internet == "No" else source.choice(["Yes", "No"])
        rows.append(
            {
                "customerID": f"C{i:05d}",
                "gender": source.choice(["Male", "Female"]),
                "SeniorCitizen": source.choice([0, 0, 1]),
                "Partner": source.choice(["Yes", "No"]),
                "Dependents": source.choice(["Yes", "No"]),
                "tenure": tenure,
                "PhoneService": phone,
                "MultipleLines": "No phone service" if phone == "No" else source.choice(["Yes", "No"]),
                "InternetService": internet,
                "OnlineSecurity": add_on(),
                "OnlineBackup": add_on(),
                "DeviceProtection": add_on(),
                "TechSupport": add_on(),
                "StreamingTV": add_on(),
                "StreamingMovies": add_on(),
                "Contract": contract,
                "PaperlessBilling": source.choice(["Yes", "No"]),
                "PaymentMethod": source.choice(
                    ["Electronic check", "Mailed check", "Bank transfer (automatic)", "Credit card (automatic)"]
                ),
                "MonthlyCharges": monthly,
                "TotalCharges": " " if tenure == 0 else f"{monthly * tenure:.2f}",
                "Churn": "Yes" if source.random() < risk else "No",
            }
        )
    return rows


def write_customers(path, rows: list[dict]) -> str:
    with open(path, "w", newline="") as file:
        writer = csv.DictWriter(file, list(rows[0]))
        writer.writeheader()
        writer.writerows(rows)
    return str(path)


@pytest.fixture(scope="session")
def customers_csv(tmp_path_factory):
    return write_customers(tmp_path_factory.mktemp("raw") / "customers.csv", customer_rows(3000))


@pytest.fixture(scope="session")
def customers(spark, customers_csv):
    from churnline.sources.customers import read_customers_csv

    return read_customers_csv(spark, customers_csv).cache()
