"""Monthly totals per account, and the choice of months."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderflow.functions.months import (
    ALL_MONTHS,
    from_month_on,
    in_month_range,
    month_of,
    parse_month,
)


def latest_month(orders: DataFrame) -> DataFrame:
    """One row, ``order_month``: the month of the last order, NULL if no order has a date.

    Give it orders already filtered by status; the last month of all orders may
    hold only cancelled ones.
    """
    return orders.agg(month_of(F.max("order_date")).alias("order_month"))


def orders_of_month(orders: DataFrame, target_month: str | date | None = None) -> DataFrame:
    """Orders of one month, of the latest month (no target), or all of them ("ALL").

    The filter is a range on ``order_date`` below the aggregation, so that files
    and row groups of other months are skipped, also for the latest month, whose
    bound comes from a scalar subquery of the same query.
    """
    if target_month == ALL_MONTHS:
        return orders
    if target_month:
        month = parse_month(target_month)
        return orders.where(in_month_range("order_date", month, month))
    latest = latest_month(orders).scalar()
    return orders.where(from_month_on(F.col("order_date"), latest))


def monthly_measures(*extra: Column) -> list[Column]:
    return [
        F.sum("total_amount").alias("monthly_total"),
        F.count("order_id").alias("order_count"),
        F.sum("product_count").alias("total_products"),
        *extra,
    ]


def calculate_monthly_totals(orders: DataFrame, with_last_order_date: bool = False) -> DataFrame:
    """Total amount, order count and product count per account and month.

    Accounts and months that are NULL form groups of their own. The sums are
    combined before the shuffle, so an account with very many orders sends at
    most one row per month and task. ``with_last_order_date`` adds the day of the
    last order, which the stale-order rule needs.
    """
    extra = [F.max("order_date").alias("last_order_date")] if with_last_order_date else []
    totals = orders.groupBy("account_id", month_of(F.col("order_date")).alias("order_month")).agg(
        *monthly_measures(*extra)
    )
    return totals.withColumn("order_month", F.col("order_month").cast("timestamp"))


def totals_of_month(
    orders: DataFrame,
    target_month: str | date | None = None,
    with_last_order_date: bool = False,
) -> DataFrame:
    """``calculate_monthly_totals`` of the chosen months: one, the latest, or "ALL".

    Orders of a single month are grouped by account alone, and the month is a value.
    So the totals are already dealt by account when they are joined with the accounts.
    """
    chosen = orders_of_month(orders, target_month)
    if target_month == ALL_MONTHS:
        return calculate_monthly_totals(chosen, with_last_order_date)
    month = F.lit(parse_month(target_month)) if target_month else latest_month(orders).scalar()
    extra = [F.max("order_date").alias("last_order_date")] if with_last_order_date else []
    totals = chosen.groupBy("account_id").agg(*monthly_measures(*extra))
    names = [c for c in totals.columns if c != "account_id"]
    return totals.select("account_id", month.cast("timestamp").alias("order_month"), *names)
