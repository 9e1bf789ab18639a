"""From orders and accounts to result and holding tables."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession

from orderflow.functions.months import ALL_MONTHS
from orderflow.functions.rules import DEFAULT_RULES, Rule
from orderflow.operators.accounts import enrich_with_account_data, enrich_with_unique_accounts
from orderflow.operators.monthly import totals_of_month
from orderflow.operators.payments import join_orders_with_transactions
from orderflow.operators.validation import (
    RoutedTables,
    apply_validation_rules,
    split_by_validation,
)
from orderflow.sources.files import load_accounts, load_orders, load_transactions


def classify_orders(
    orders: DataFrame,
    accounts: DataFrame,
    target_month: str | date | None = None,
    rules: Sequence[Rule] = DEFAULT_RULES,
    with_violations: bool = False,
    unique_accounts: bool = True,
) -> DataFrame:
    """Every account-month of the chosen months with its account data and hold reason.

    ``target_month`` is a month, None for the latest one, or "ALL". Orders are
    taken as they are: filter them by status first. An account listed twice would
    repeat its rows and count its money twice, so the plan fails when it runs; with
    ``unique_accounts=False`` the rows are repeated.
    """
    totals = totals_of_month(orders, target_month, with_last_order_date=True)
    if unique_accounts:
        enriched = enrich_with_unique_accounts(totals, accounts, target_month != ALL_MONTHS)
    else:
        enriched = enrich_with_account_data(totals, accounts, unique=False)
    return apply_validation_rules(enriched, rules, with_violations)


def validate_orders(
    orders: DataFrame,
    accounts: DataFrame,
    target_month: str | date | None = None,
    rules: Sequence[Rule] = DEFAULT_RULES,
    as_of: datetime | None = None,
    unique_accounts: bool = True,
) -> RoutedTables:
    """``classify_orders``, split into result and holding table."""
    classified = classify_orders(
        orders, accounts, target_month, rules, unique_accounts=unique_accounts
    )
    return split_by_validation(classified, as_of)


def run_pipeline(
    spark: SparkSession,
    accounts_path: str,
    orders_path: str,
    transactions_path: str,
    target_month: str | date | None = None,
    rules: Sequence[Rule] = DEFAULT_RULES,
    as_of: datetime | None = None,
    unique_accounts: bool = True,
    **options,
) -> RoutedTables:
    """Load the three tables and validate one month, the latest, or all.

    ``options`` are those of ``read_table``. The payments join is part of the
    pipeline, but no output column comes from it, so the optimizer removes it.
    """
    orders = join_orders_with_transactions(
        load_orders(spark, orders_path, **options),
        load_transactions(spark, transactions_path, **options),
    )
    accounts = load_accounts(spark, accounts_path, **options)
    return validate_orders(orders, accounts, target_month, rules, as_of, unique_accounts)
