from decimal import Decimal

import orderflow as of
from tests.frames import accounts, orders, rows


def _output(spark, *order_rows):
    known = accounts(spark, ("A1", "Ann", 9), ("A2", None, 9), ("A3", None, 9), ("A4", "D", None))
    return of.validate_orders(orders(spark, *order_rows), known, "2024-12")


DECEMBER = [(f"O{i}", f"A{i}", "2024-12-05", 10.0 * i) for i in range(1, 5)]


def test_result_summary(spark):
    output = _output(spark, *DECEMBER, ("O9", "A1", "2024-12-06", 5.0))
    assert of.get_result_summary(output.result_table) == {
        "total_records": 1,
        "total_amount": 15.0,
        "total_orders": 2,
    }


def test_empty_and_null_summaries_are_zero(spark):
    empty = _output(spark)
    assert of.get_result_summary(empty.result_table) == {
        "total_records": 0,
        "total_amount": 0.0,
        "total_orders": 0,
    }
    assert of.get_holding_summary(empty.holding_table) == {"total_held": 0, "by_reason": {}}
    unknown = _output(spark, ("O1", "A1", "2024-12-05", None))
    assert of.result_summary(unknown.result_table).first()["total_amount"] == 0.0
    exact = spark.createDataFrame([(Decimal("1.10"), 1)], "monthly_total decimal(18,2), order_count bigint")
    assert of.result_summary(exact).first()["total_amount"] == Decimal("1.10")


def test_total_of_nothing_held_is_zero(spark):
    held = _output(spark, ("O1", "A1", "2024-12-05", 1.0)).holding_table
    assert rows(of.holding_summary_total(held)) == [(None, 0)]
    assert rows(of.holding_summary_total(_output(spark).holding_table)) == [(None, 0)]


def test_holding_summary(spark):
    held = _output(spark, *DECEMBER).holding_table
    assert of.get_holding_summary(held) == {
        "total_held": 3,
        "by_reason": {"MISSING_CUSTOMER_NAME": 2, "MISSING_ORDER_LIMIT": 1},
    }
    assert rows(of.holding_summary_total(held)) == [
        (None, 3),
        ("MISSING_CUSTOMER_NAME", 2),
        ("MISSING_ORDER_LIMIT", 1),
    ]


def test_presentation_order(spark):
    output = _output(spark, *DECEMBER, ("O9", None, "2024-12-06", 5.0))
    held = [tuple(row)[0] for row in of.ordered_holding(output.holding_table).collect()]
    assert held == [None, "A2", "A3", "A4"]
    counts = [tuple(row) for row in of.ordered_holding_summary(output.holding_table).collect()]
    assert counts == [
        ("MISSING_CUSTOMER_NAME", 2),
        ("MISSING_ACCOUNT_ID", 1),
        ("MISSING_ORDER_LIMIT", 1),
    ]
    assert of.ordered_result(output.result_table).first()["account_id"] == "A1"
