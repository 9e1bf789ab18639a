from datetime import datetime
from decimal import Decimal

import pytest

import orderflow as of
from orderflow.schemas import RAG_HOLDING, RAG_RESULT
from tests.frames import MONTHLY, accounts, enriched, orders, rows

ANN = ("A1", "Ann", 1)


def _monthly(spark, *totals):
    return spark.createDataFrame(
        [(account, datetime.fromisoformat(month), total, 1, 1) for account, month, total in totals],
        MONTHLY,
    )


def _judged(spark, previous, current, kind="decimal(18,2)", **options):
    frame = spark.createDataFrame(
        [(previous, current)], f"previous_month_total {kind}, monthly_total {kind}"
    )
    return of.add_rag_status(of.month_over_month(frame), **options).first()


def test_previous_month_is_the_calendar_month(spark):
    compared = of.previous_month_totals(
        _monthly(
            spark,
            ("A1", "2023-12-01", 5.0),
            ("A1", "2024-01-01", 7.0),
            ("A1", "2024-03-01", 9.0),
            ("A2", "2024-02-01", 1.0),
            (None, "2024-01-01", 3.0),
            (None, "2024-02-01", 4.0),
        )
    )
    assert rows(compared, "account_id", "monthly_total", "previous_month_total") == [
        (None, 3.0, 0.0),
        (None, 4.0, 0.0),
        ("A1", 5.0, 0.0),
        ("A1", 7.0, 5.0),
        ("A1", 9.0, 0.0),
        ("A2", 1.0, 0.0),
    ]


@pytest.mark.parametrize(
    "previous, current, change, status",
    [
        ("100", "150", 50.0, "RED"),
        ("100", "149.99", 49.99, "AMBER"),
        ("100", "149", 49.0, "AMBER"),
        ("100", "130", 30.0, "AMBER"),
        ("100", "129.99", 29.99, "GREEN"),
        ("100", "100", 0.0, "GREEN"),
        ("100", "10", -90.0, "GREEN"),
        ("110.30", "143.39", 30.0, "AMBER"),
        ("0.10", "0.13", 30.0, "AMBER"),
        ("0.10", "0.15", 50.0, "RED"),
        ("1.10", "1.65", 50.0, "RED"),
        ("1.10", "1.64", 49.09090909, "AMBER"),
        ("0", "50", None, "GREEN"),
        ("-5", "50", None, "GREEN"),
        ("100", None, None, "GREEN"),
    ],
)
@pytest.mark.parametrize("kind, money", [("decimal(18,2)", Decimal), ("double", float)])
def test_change_and_status(spark, previous, current, change, status, kind, money):
    row = _judged(spark, money(previous), current and money(current), kind)
    assert row["percentage_change"] == (None if change is None else pytest.approx(change))
    assert row["rag_status"] == status


def test_status_without_baseline_can_be_named(spark):
    assert _judged(spark, 0.0, 1.0, "double", no_baseline="NONE")["rag_status"] == "NONE"
    assert _judged(spark, 10.0, 15.0, "double", no_baseline="NONE")["rag_status"] == "RED"
    assert _judged(spark, 0.0, 1.0, "double", no_baseline="NO 'BASE'")["rag_status"] == "NO 'BASE'"


@pytest.mark.parametrize("previous, current, status", [(1e30, 1e31, "RED"), (1e30, 1e30, "GREEN")])
def test_totals_beyond_cents_are_judged_as_they_are(spark, previous, current, status):
    assert _judged(spark, previous, current, "double")["rag_status"] == status


@pytest.mark.parametrize("count, limit, flag", [(6, 5, "YES"), (5, 5, "NO"), (6, None, "NO")])
def test_limit_flag(spark, count, limit, flag):
    row = of.add_limit_exceeded(enriched(spark, order_count=count, order_limit=limit)).first()
    assert row["limit_exceeded"] == flag


def _shop(spark):
    sold = orders(
        spark,
        ("O1", "A1", "2024-11-05", 100.0),
        ("O2", "A1", "2024-12-05", 90.0),
        ("O3", "A1", "2024-12-06", 70.0),
        ("O4", "A2", "2024-11-05", 10.0),
        ("O5", "A3", "2024-12-05", 10.0),
        ("O6", "A4", "2024-10-05", 10.0),
        ("O7", "A4", "2024-12-05", 10.0),
        ("O8", None, "2024-11-05", 10.0),
        ("O9", None, "2024-12-05", 10.0),
        ("O10", "A1", None, 10.0),
        (None, "A4", "2024-12-07", None),
    )
    known = accounts(spark, ANN, ("A2", "Bob", 5), ("A3", None, 5), ("A4", "Dan", 5))
    return sold, known


def test_rag_tables_of_one_month(spark):
    output = of.rag_tables(*_shop(spark), "2024-12", as_of=datetime(2025, 1, 1))
    assert rows(output.result_table) == [
        ("A1", "Ann", 160.0, 100.0, pytest.approx(60.0), 2, 1, "RED", "YES"),
        ("A4", "Dan", 10.0, 0.0, None, 1, 5, "GREEN", "NO"),
    ]
    assert rows(output.holding_table, "account_id", "hold_reason", "previous_month_total") == [
        (None, "MISSING_ACCOUNT_ID", 0.0),
        ("A3", "MISSING_CUSTOMER_NAME", 0.0),
    ]
    for table, schema in ((output.result_table, RAG_RESULT), (output.holding_table, RAG_HOLDING)):
        assert [(f.name, f.dataType) for f in table.schema] == [
            (f.name, f.dataType) for f in schema
        ]


@pytest.mark.parametrize("month", ["2024-10", "2024-11", "2024-12", "2025-01", None])
def test_one_month_equals_that_month_of_all(spark, month):
    sold, known = _shop(spark)
    columns = [
        "account_id",
        "order_month",
        "monthly_total",
        "order_count",
        "total_products",
        "last_order_date",
        "previous_month_total",
        "rag_status",
        "limit_exceeded",
        "hold_reason",
    ]
    one = of.classify_rag(sold, known, month).select(*columns)
    every = of.classify_rag(sold, known, "ALL").select(*columns)
    chosen = month or "2024-12"
    assert rows(one) == rows(every.where(f"date_format(order_month, 'yyyy-MM') = '{chosen}'"))


def test_latest_month_without_any_date(spark):
    output = of.rag_tables(orders(spark, ("O1", "A1", None, 5.0)), accounts(spark, ANN))
    assert rows(output.result_table, "current_month_total", "previous_month_total") == [(5.0, 0.0)]


def test_all_months_carry_the_month(spark):
    output = of.rag_tables(*_shop(spark), of.ALL_MONTHS)
    assert rows(output.result_table, "order_month", "account_id", "previous_month_total") == [
        (None, "A1", 0.0),
        (datetime(2024, 10, 1), "A4", 0.0),
        (datetime(2024, 11, 1), "A1", 0.0),
        (datetime(2024, 11, 1), "A2", 0.0),
        (datetime(2024, 12, 1), "A1", 100.0),
        (datetime(2024, 12, 1), "A4", 0.0),
    ]


def test_repeated_account_fails_unless_allowed(spark):
    sold = orders(spark, ("O1", "A1", "2024-12-05"))
    twice = accounts(spark, ANN, ANN)
    with pytest.raises(Exception, match="account listed more than once"):
        of.rag_tables(sold, twice).result_table.collect()
    assert of.rag_tables(sold, twice, unique_accounts=False).result_table.count() == 2


@pytest.mark.parametrize("zone", ["Asia/Tokyo", "America/Los_Angeles"])
def test_months_do_not_depend_on_the_time_zone(spark, zone):
    expected = of.rag_tables(*_shop(spark), "ALL").result_table
    expected = rows(expected.withColumn("order_month", expected.order_month.cast("string")))
    saved = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        actual = of.rag_tables(*_shop(spark), "ALL").result_table
        assert rows(actual.withColumn("order_month", actual.order_month.cast("string"))) == expected
    finally:
        spark.conf.set("spark.sql.session.timeZone", saved)
