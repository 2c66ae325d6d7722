"""Column names, domains and the raw customer schema."""

from pyspark.sql import types as T

# The raw customer file's columns, in file order.
RAW_SCHEMA = T.StructType(
    [
        T.StructField("customerID", T.StringType()),
        T.StructField("gender", T.StringType()),
        T.StructField("SeniorCitizen", T.IntegerType()),
        T.StructField("Partner", T.StringType()),
        T.StructField("Dependents", T.StringType()),
        T.StructField("tenure", T.IntegerType()),
        T.StructField("PhoneService", T.StringType()),
        T.StructField("MultipleLines", T.StringType()),
        T.StructField("InternetService", T.StringType()),
        T.StructField("OnlineSecurity", T.StringType()),
        T.StructField("OnlineBackup", T.StringType()),
        T.StructField("DeviceProtection", T.StringType()),
        T.StructField("TechSupport", T.StringType()),
        T.StructField("StreamingTV", T.StringType()),
        T.StructField("StreamingMovies", T.StringType()),
        T.StructField("Contract", T.StringType()),
        T.StructField("PaperlessBilling", T.StringType()),
        T.StructField("PaymentMethod", T.StringType()),
        T.StructField("MonthlyCharges", T.DoubleType()),
        # Text in the file: new customers have a blank here.
        T.StructField("TotalCharges", T.StringType()),
        T.StructField("Churn", T.StringType()),
    ]
)

KEY = "customerID"
LABEL = "Churn"

# Domains and limits of the feature preparation.
CONTRACT_ORDER = {"Month-to-month": 0, "One year": 1, "Two year": 2}
PAYMENT_METHODS = ["Electronic check", "Mailed check", "Bank transfer (automatic)", "Credit card (automatic)"]
TENURE_BUCKETS = {"0-12": 12, "13-24": 24, "25-48": 48, "49+": None}
HIGH_VALUE_OVER = 70
YES_NO_COLUMNS = ["Partner", "Dependents", "PhoneService", "PaperlessBilling"]
INTERNET_ADD_ONS = [
    "OnlineSecurity",
    "OnlineBackup",
    "DeviceProtection",
    "TechSupport",
    "StreamingTV",
    "StreamingMovies",
]
COUNTED_SERVICES = ["PhoneService", "MultipleLines", *INTERNET_ADD_ONS]
ONE_HOT_PREFIX = {
    "InternetService": "IS",
    "PaymentMethod": "PM",
    "MultipleLines": "MultipleLines",
    **{c: c for c in INTERNET_ADD_ONS},
}
REQUIRED_COLUMNS = ["tenure", "MonthlyCharges", "TotalCharges", LABEL]

# Risk tiers (upper bounds, inclusive).
RISK_TIERS = {"Low": 0.3, "Medium": 0.5, "High": 0.7, "Critical": 1.0}
