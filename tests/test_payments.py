import orderflow as of
from tests.frames import orders, rows, transactions


def _joined(spark, order_rows, transaction_rows):
    return of.join_orders_with_transactions(
        orders(spark, *order_rows), transactions(spark, *transaction_rows)
    )


def test_payments_are_summed_per_order(spark):
    joined = _joined(
        spark,
        [("O1", "A1", "2024-12-01"), ("O2", "A1", "2024-12-02")],
        [("T1", "O1", 60.0, "SUCCESS"), (None, "O1", 40.0, "SUCCESS"), ("T3", "O9", 1.0, "SUCCESS")],
    )
    assert rows(joined, "order_id", "total_paid", "transaction_count") == [
        ("O1", 100.0, 1),
        ("O2", 0.0, 0),
    ]
    assert joined.columns == [
        "order_id",
        "account_id",
        "order_date",
        "total_amount",
        "product_count",
        "status",
        "total_paid",
        "transaction_count",
    ]
    assert dict(joined.dtypes)["total_paid"] == "double"


def test_null_and_repeated_order_ids_keep_their_rows(spark):
    same = [("O1", "A1", "2024-12-01")] * 3
    missing = [(None, "A1", "2024-12-01")] * 4
    joined = _joined(
        spark, same + missing, [("T1", "O1", 5.0, "SUCCESS"), ("T2", None, 9.0, "SUCCESS")]
    )
    assert rows(joined, "order_id", "total_paid", "transaction_count") == [
        (None, 0.0, 0)
    ] * 4 + [("O1", 5.0, 1)] * 3


def test_null_amounts_count_but_add_nothing(spark):
    joined = _joined(spark, [("O1", "A1", "2024-12-01")], [("T1", "O1", None, "SUCCESS")])
    assert rows(joined, "total_paid", "transaction_count") == [(0.0, 1)]


def test_only_successful_transactions(spark):
    kept = of.successful_transactions(
        transactions(
            spark, *((s, "O1", 1.0, s) for s in ("SUCCESS", "FAILED", "PENDING", "success", None))
        )
    )
    assert rows(kept, "status") == [("SUCCESS",)]


def test_reconciliation(spark):
    joined = _joined(
        spark,
        [(id, "A1", "2024-12-01", amount) for id, amount in
         [("O1", 10.0), ("O2", 10.0), ("O3", 10.0), ("O4", 10.0), ("O5", None)]],
        [(id, id, paid, "SUCCESS") for id, paid in
         [("O1", 9.99), ("O2", 10.0), ("O3", 10.01), ("O5", 1.0)]],
    )
    assert rows(of.payment_reconciliation(joined), "order_id", "payment_status") == [
        ("O1", "UNDERPAID"),
        ("O2", "EXACT"),
        ("O3", "OVERPAID"),
        ("O4", "NO_PAYMENT"),
        ("O5", None),
    ]
