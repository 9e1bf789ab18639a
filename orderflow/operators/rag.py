"""Month-over-month comparison of account totals and their RAG status."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from orderflow.functions import change
from orderflow.functions.months import (
    ALL_MONTHS,
    from_month_on,
    in_month_range,
    month_of,
    parse_month,
    previous_month,
)
from orderflow.operators.monthly import calculate_monthly_totals, latest_month
from orderflow.operators.validation import hold_timestamp
from orderflow.schemas import RAG_HOLDING, RAG_RESULT


def _baseline(total: str) -> Column:
    """Previous total of a known account, zero where there is none."""
    return F.expr(f"CASE WHEN account_id IS NOT NULL THEN coalesce({total}, 0) ELSE 0 END")


def previous_month_totals(monthly_totals: DataFrame) -> DataFrame:
    """Add ``previous_month_total``: the account's total of the calendar month before.

    Zero if the account has no row for that month, also when an earlier month
    exists. Runs on monthly totals, where an account has one row per month, so the
    window of even the busiest account is as short as the calendar.
    """
    by_month = Window.partitionBy("account_id").orderBy("order_month")
    lagged = monthly_totals.withColumns(
        {
            "_month_before": F.lag("order_month").over(by_month),
            "_total_before": F.lag("monthly_total").over(by_month),
        }
    )
    adjacent = "CAST(_month_before AS DATE) = add_months(CAST(order_month AS DATE), -1)"
    return lagged.withColumn(
        "previous_month_total", _baseline(f"CASE WHEN {adjacent} THEN _total_before END")
    ).drop("_month_before", "_total_before")


def compare_with_previous_month(
    orders: DataFrame, target_month: str | date | None = None
) -> DataFrame:
    """Monthly totals with ``previous_month_total`` for one month, the latest or all.

    For a single month both totals come from one aggregation per account over the
    orders of two months, with one shuffle, which also serves the join with the
    accounts. All months take the window of ``previous_month_totals``.
    """
    if target_month == ALL_MONTHS:
        return previous_month_totals(calculate_monthly_totals(orders, with_last_order_date=True))
    if target_month:
        first = parse_month(target_month)
        month = F.lit(first)
        pair = orders.where(in_month_range("order_date", previous_month(first), first))
        is_current = F.expr(f"order_date >= DATE '{first}'")
    else:
        day = F.col("order_date")
        before = latest_month(orders).select(F.add_months("order_month", -1)).scalar()
        month = F.add_months(before, 1)
        pair = orders.where(from_month_on(day, before))
        is_current = month_of(day).eqNullSafe(month)

    def current(column: str) -> str:
        return f"CASE WHEN _current THEN {column} END"

    totals = (
        pair.withColumn("_current", is_current)
        .groupBy("account_id")
        .agg(
            F.expr(f"sum({current('total_amount')}) AS monthly_total"),
            F.expr(f"count({current('order_id')}) AS order_count"),
            F.expr(f"sum({current('product_count')}) AS total_products"),
            F.expr(f"max({current('order_date')}) AS last_order_date"),
            F.expr("sum(CASE WHEN NOT _current THEN total_amount END) AS _total_before"),
            F.expr("max(_current) AS _has_current"),
        )
        .where("_has_current")
    )
    return totals.select(
        "account_id",
        month.cast("timestamp").alias("order_month"),
        "monthly_total",
        "order_count",
        "total_products",
        "last_order_date",
        _baseline("_total_before").alias("previous_month_total"),
    )


def month_over_month(compared: DataFrame) -> DataFrame:
    """Add ``percentage_change`` against the previous month."""
    return compared.withColumn(
        "percentage_change",
        change.percentage_change("monthly_total", "previous_month_total"),
    )


def add_rag_status(compared: DataFrame, no_baseline: str = "GREEN") -> DataFrame:
    """Add ``rag_status``."""
    return compared.withColumn(
        "rag_status",
        change.rag_status("monthly_total", "previous_month_total", no_baseline),
    )


def add_limit_exceeded(enriched: DataFrame) -> DataFrame:
    """Add ``limit_exceeded``, whatever the RAG status."""
    return enriched.withColumn(
        "limit_exceeded", change.limit_exceeded("order_count", "order_limit")
    )


def _rag_columns(schema: StructType, with_month: bool) -> list[str]:
    """The declared columns in their declared types, except for the key.

    A key keeps the type it has in the data.
    """
    source = {"current_month_total": "monthly_total"}
    columns = ["order_month"] if with_month else []
    for field in schema:
        column = source.get(field.name, field.name)
        if field.name != "account_id":
            column = f"CAST({column} AS {field.dataType.simpleString()})"
        columns.append(f"{column} AS {field.name}")
    return columns


def rag_result(classified: DataFrame, with_month: bool = False) -> DataFrame:
    """Valid rows in the declared result columns, with the month first if asked for."""
    return classified.where("NOT validation_failed").selectExpr(
        *_rag_columns(RAG_RESULT, with_month)
    )


def rag_holding(
    classified: DataFrame, as_of: datetime | None = None, with_month: bool = False
) -> DataFrame:
    """Held rows in the declared holding columns, with the month first if asked for."""
    held = classified.where("validation_failed")
    held = held.withColumn("hold_timestamp", hold_timestamp(as_of))
    return held.selectExpr(*_rag_columns(RAG_HOLDING, with_month))
