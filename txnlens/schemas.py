"""Column names and types of every layer."""

from __future__ import annotations

from pyspark.sql import types as T

# The 16 raw columns as (column here, header / message key, Spark type).
RAW_COLUMNS = [
    ("transaction_id", "Transaction ID", T.StringType()),
    ("customer_id", "Customer ID", T.StringType()),
    ("transaction_amount", "Transaction Amount", T.FloatType()),
    ("transaction_date", "Transaction Date", T.StringType()),
    ("payment_method", "Payment Method", T.StringType()),
    ("product_category", "Product Category", T.StringType()),
    ("quantity", "Quantity", T.IntegerType()),
    ("customer_age", "Customer Age", T.IntegerType()),
    ("customer_location", "Customer Location", T.StringType()),
    ("device_used", "Device Used", T.StringType()),
    ("ip_address", "IP Address", T.StringType()),
    ("shipping_address", "Shipping Address", T.StringType()),
    ("billing_address", "Billing Address", T.StringType()),
    ("is_fraudulent", "Is Fraudulent", T.IntegerType()),
    ("account_age_days", "Account Age Days", T.IntegerType()),
    ("transaction_hour", "Transaction Hour", T.IntegerType()),
]

RAW_NAMES = [name for name, _, _ in RAW_COLUMNS]
MESSAGE_KEYS = {name: key for name, key, _ in RAW_COLUMNS}

RAW = T.StructType([T.StructField(name, kind) for name, _, kind in RAW_COLUMNS])
RAW_MESSAGE = T.StructType([T.StructField(key, kind) for _, key, kind in RAW_COLUMNS])

# Scoring input carries no label.
SCORING_NAMES = [name for name in RAW_NAMES if name != "is_fraudulent"]

# The fields of a result message.
FRAUD_RESULT_MESSAGE = T.StructType(
    [
        T.StructField("transaction_id", T.StringType()),
        T.StructField("is_fraud", T.BooleanType()),
        T.StructField("timestamp", T.StringType()),
        T.StructField("amount", T.FloatType()),
        T.StructField("payment_method", T.StringType()),
        T.StructField("product_category", T.StringType()),
        T.StructField("error", T.StringType()),
    ]
)

# The stored tables of both topics: what the messages hold, with times as such.
STORED_TRANSACTIONS = ", ".join(
    f"{name} {'timestamp' if name == 'transaction_date' else kind.simpleString()}" for name, _, kind in RAW_COLUMNS
)
STORED_RESULTS = ", ".join(
    f"{f.name} {'timestamp' if f.name == 'timestamp' else f.dataType.simpleString()}" for f in FRAUD_RESULT_MESSAGE
)

# The typed star schema as read by the reports.
STAR_DDL = {
    "dim_customers": (
        "customer_id STRING, customer_age INT, customer_location STRING, "
        "account_age_days INT, age_group STRING"
    ),
    "dim_payment_methods": "payment_method STRING, payment_method_id INT",
    "dim_product_categories": "product_category STRING, product_category_id INT",
    "dim_devices": "device_type STRING, device_id INT",
    "dim_time": (
        "time_id TIMESTAMP, transaction_hour INT, transaction_dayofweek STRING, "
        "transaction_month STRING, transaction_year INT"
    ),
    "fact_transactions": (
        "transaction_id STRING, customer_id STRING, transaction_amount DECIMAL(10,2), "
        "quantity INT, is_fraudulent BOOLEAN, transaction_timestamp TIMESTAMP, "
        "payment_method_id INT, product_category_id INT, device_id INT"
    ),
}

# The categorical and the numeric features; their order is that of the vector.
CATEGORICAL = ["payment_method", "product_category", "customer_location", "device_used"]

NUMERIC = [
    "transaction_amount",
    "quantity",
    "customer_age",
    "account_age_days",
    "transaction_hour",
    "day_of_month",
    "day_of_week",
    "month",
    "address_mismatch",
    "amount_per_quantity",
    "is_weekend",
    "is_night_time",
]

MOMENT = "yyyy-MM-dd HH:mm:ss"
