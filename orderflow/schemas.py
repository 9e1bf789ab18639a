"""Fixed schemas of the input tables and of the month-over-month outputs."""

from pyspark.sql.types import (
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructType,
    TimestampType,
)

ACCOUNTS = (
    StructType()
    .add("account_id", StringType(), False)
    .add("customer_name", StringType(), False)
    .add("order_limit", IntegerType(), False)
    .add("created_date", DateType())
    .add("status", StringType())
)

ORDERS = (
    StructType()
    .add("order_id", StringType(), False)
    .add("account_id", StringType(), False)
    .add("order_date", DateType(), False)
    .add("total_amount", DoubleType(), False)
    .add("product_count", IntegerType(), False)
    .add("status", StringType())
)

TRANSACTIONS = (
    StructType()
    .add("transaction_id", StringType(), False)
    .add("order_id", StringType(), False)
    .add("amount", DoubleType(), False)
    .add("transaction_date", TimestampType(), False)
    .add("status", StringType(), False)
)

RAG_RESULT = (
    StructType()
    .add("account_id", StringType(), False)
    .add("customer_name", StringType(), False)
    .add("current_month_total", DoubleType(), False)
    .add("previous_month_total", DoubleType(), False)
    .add("percentage_change", DoubleType())
    .add("order_count", IntegerType(), False)
    .add("order_limit", IntegerType(), False)
    .add("rag_status", StringType(), False)
    .add("limit_exceeded", StringType(), False)
)

# Held rows may lack any of the measured values, so only the key, the reason
# and the time are declared as always present.
RAG_HOLDING = (
    StructType()
    .add("account_id", StringType(), False)
    .add("customer_name", StringType())
    .add("current_month_total", DoubleType())
    .add("previous_month_total", DoubleType())
    .add("percentage_change", DoubleType())
    .add("order_count", IntegerType())
    .add("order_limit", IntegerType())
    .add("rag_status", StringType())
    .add("limit_exceeded", StringType())
    .add("hold_reason", StringType(), False)
    .add("hold_timestamp", TimestampType(), False)
)

# Files of the routed sink, with the declared types of the keys.
ROUTED = (
    StructType()
    .add("account_id", StringType())
    .add("customer_name", StringType())
    .add("order_month", TimestampType())
    .add("monthly_total", DoubleType())
    .add("order_count", LongType())
    .add("total_products", LongType())
    .add("order_limit", IntegerType())
    .add("hold_reason", StringType())
    .add("hold_timestamp", TimestampType())
    .add("route", StringType())
)

# Column order of the validated tables.
RESULT_COLUMNS = [
    "account_id",
    "customer_name",
    "order_month",
    "monthly_total",
    "order_count",
    "total_products",
    "order_limit",
]
HOLDING_COLUMNS = RESULT_COLUMNS + ["hold_reason", "hold_timestamp"]
