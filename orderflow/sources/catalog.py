"""Catalog tables as inputs, and every stage as a named view."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from orderflow.functions.months import ALL_MONTHS
from orderflow.functions.rules import DEFAULT_RULES, Rule
from orderflow.operators.accounts import enrich_with_account_data, enrich_with_unique_accounts
from orderflow.operators.filters import successful_transactions, valid_orders
from orderflow.operators.monthly import calculate_monthly_totals, totals_of_month
from orderflow.operators.payments import join_orders_with_transactions
from orderflow.operators.validation import apply_validation_rules


def register_views(
    spark: SparkSession,
    accounts: str = "accounts",
    orders: str = "orders",
    transactions: str = "transactions",
    target_month: str | date | None = None,
    rules: Sequence[Rule] = DEFAULT_RULES,
    with_violations: bool = False,
    unique_accounts: bool = True,
) -> dict[str, DataFrame]:
    """Publish each stage over three catalog tables as a temporary view for SQL.

    The views of enriched and validated totals show the latest month unless
    ``target_month`` names another or "ALL". Rules, violations and the check for repeated
    accounts are those of ``classify_orders``.
    """
    kept_orders = valid_orders(spark.table(orders))
    payments = successful_transactions(spark.table(transactions))
    with_payments = join_orders_with_transactions(kept_orders, payments)
    known = spark.table(accounts)
    totals = totals_of_month(with_payments, target_month, with_last_order_date=True)
    if unique_accounts:
        enriched = enrich_with_unique_accounts(totals, known, target_month != ALL_MONTHS)
    else:
        enriched = enrich_with_account_data(totals, known, unique=False)
    validated = apply_validation_rules(enriched, rules, with_violations)
    # The names of the views.
    views = {
        "valid_orders": kept_orders,
        "successful_transactions": payments,
        "orders_with_payments": with_payments.drop("status"),
        "monthly_account_totals": calculate_monthly_totals(with_payments),
        "enriched_monthly_totals": enriched.drop("last_order_date"),
        "validated_orders": validated.drop("last_order_date"),
    }
    for name, view in views.items():
        view.createOrReplaceTempView(name)
    return views
