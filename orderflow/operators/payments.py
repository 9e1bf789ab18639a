"""Payments per order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def payment_summary(transactions: DataFrame) -> DataFrame:
    """Sum and number of the payments of each order.

    Partial sums are formed before the shuffle, so an order with very many
    transactions costs no more than others.
    """
    return transactions.groupBy("order_id").agg(
        F.sum("amount").alias("total_paid"),
        F.count("transaction_id").alias("transaction_count"),
    )


def join_orders_with_transactions(orders: DataFrame, transactions: DataFrame) -> DataFrame:
    """Add ``total_paid`` and ``transaction_count`` to every order, zero without payments.

    Payments are summed per order first, so there is one output row per order
    row, and the optimizer drops the join where both columns go unused.

    A NULL or repeated order id may fill a large part of the orders, so the join
    has a second column, a hash. For rows without an id, which match nothing, it
    is taken from account and day and deals them out over all partitions. For the
    others it is taken from the id; that equality adds nothing, but the sums must
    be shuffled once more for it, and only where both sides come straight from a
    shuffle does adaptive execution split the oversized partition of a repeated
    id. The sums are the narrow side, two numbers per order.
    """
    lane = F.expr(
        "CASE WHEN order_id IS NULL THEN xxhash64(account_id, order_date)"
        " ELSE xxhash64(order_id) END"
    )
    paid = payment_summary(transactions).withColumn("_lane", F.xxhash64("order_id"))
    joined = orders.withColumn("_lane", lane).join(paid, ["order_id", "_lane"], "left")
    return joined.withColumns(
        {
            "total_paid": F.expr("coalesce(total_paid, 0)"),
            "transaction_count": F.expr("coalesce(transaction_count, 0)"),
        }
    ).drop("_lane")


def payment_reconciliation(orders_with_payments: DataFrame) -> DataFrame:
    """Add ``payment_status``: how the payments of an order compare with its amount.

    NULL where there are payments but the amount is unknown. Exact for DECIMAL money.
    """
    return orders_with_payments.withColumn(
        "payment_status",
        F.expr(
            "CASE WHEN transaction_count = 0 THEN 'NO_PAYMENT'"
            " WHEN total_paid < total_amount THEN 'UNDERPAID'"
            " WHEN total_paid = total_amount THEN 'EXACT'"
            " WHEN total_paid > total_amount THEN 'OVERPAID' END"
        ),
    )
