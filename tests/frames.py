"""Small input frames with explicit schemas, so that a column may be all NULL."""

from datetime import date

ACCOUNTS = "account_id string, customer_name string, order_limit int"
ORDERS = (
    "order_id string, account_id string, order_date date, total_amount double,"
    " product_count int, status string"
)
TRANSACTIONS = "transaction_id string, order_id string, amount double, status string"
MONTHLY = (
    "account_id string, order_month timestamp, monthly_total double, order_count bigint,"
    " total_products bigint"
)
ENRICHED = MONTHLY + ", customer_name string, order_limit int"


def accounts(spark, *rows):
    return spark.createDataFrame(list(rows), ACCOUNTS)


def order(id, account, day, amount=100.0, products=1, status="COMPLETED"):
    return (id, account, None if day is None else date.fromisoformat(day), amount, products, status)


def orders(spark, *rows):
    return spark.createDataFrame([order(*row) for row in rows], ORDERS)


def transactions(spark, *rows):
    return spark.createDataFrame(list(rows), TRANSACTIONS)


def enriched(spark, **changes):
    """One valid enriched account-month with some values replaced."""
    row = {
        "account_id": "A1",
        "order_month": None,
        "monthly_total": 100.0,
        "order_count": 1,
        "total_products": 1,
        "customer_name": "Ann",
        "order_limit": 5,
    }
    row.update(changes)
    return spark.createDataFrame([tuple(row.values())], ENRICHED)


def rows(frame, *columns):
    """Rows as a sorted list of tuples, NULLs first."""
    picked = frame.select(*columns) if columns else frame
    return sorted(
        (tuple(row) for row in picked.collect()),
        key=lambda row: [(value is not None, str(value)) for value in row],
    )
