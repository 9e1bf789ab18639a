"""Status filters. A NULL or differently spelled status is dropped."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values of the input tables.
VALID_ORDER_STATUSES = ["COMPLETED", "PENDING"]
SUCCESSFUL_TRANSACTION_STATUS = "SUCCESS"


def valid_orders(orders: DataFrame) -> DataFrame:
    return orders.where(F.col("status").isin(VALID_ORDER_STATUSES))


def successful_transactions(transactions: DataFrame) -> DataFrame:
    return transactions.where(F.col("status") == SUCCESSFUL_TRANSACTION_STATUS)
