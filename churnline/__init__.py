"""Customer-churn analytics as Spark DataFrame operators."""
