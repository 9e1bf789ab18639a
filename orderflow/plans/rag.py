"""From orders and accounts to month-over-month RAG tables."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession

from orderflow.functions.months import ALL_MONTHS
from orderflow.functions.rules import DEFAULT_RULES, Rule
from orderflow.operators.accounts import enrich_with_account_data, enrich_with_unique_accounts
from orderflow.operators.payments import join_orders_with_transactions
from orderflow.operators.rag import (
    add_limit_exceeded,
    add_rag_status,
    compare_with_previous_month,
    month_over_month,
    rag_holding,
    rag_result,
)
from orderflow.operators.validation import RoutedTables, apply_validation_rules
from orderflow.sources.files import load_accounts, load_orders, load_transactions


def classify_rag(
    orders: DataFrame,
    accounts: DataFrame,
    target_month: str | date | None = None,
    rules: Sequence[Rule] = DEFAULT_RULES,
    no_baseline: str = "GREEN",
    unique_accounts: bool = True,
) -> DataFrame:
    """Account-months with change, RAG status, limit flag and hold reason.

    The months are chosen after the comparison with the previous month, whose
    orders a filter on the month alone would remove.
    """
    compared = add_rag_status(
        month_over_month(compare_with_previous_month(orders, target_month)), no_baseline
    )
    if unique_accounts:
        enriched = enrich_with_unique_accounts(compared, accounts, target_month != ALL_MONTHS)
    else:
        enriched = enrich_with_account_data(compared, accounts, unique=False)
    return apply_validation_rules(add_limit_exceeded(enriched), rules)


def rag_tables(
    orders: DataFrame,
    accounts: DataFrame,
    target_month: str | date | None = None,
    rules: Sequence[Rule] = DEFAULT_RULES,
    no_baseline: str = "GREEN",
    as_of: datetime | None = None,
    unique_accounts: bool = True,
) -> RoutedTables:
    """RAG result and RAG holding table; with a month column for "ALL" months."""
    classified = classify_rag(orders, accounts, target_month, rules, no_baseline, unique_accounts)
    with_month = target_month == ALL_MONTHS
    return RoutedTables(
        rag_result(classified, with_month), rag_holding(classified, as_of, with_month)
    )


def run_rag_tables(
    spark: SparkSession,
    accounts_path: str,
    orders_path: str,
    transactions_path: str,
    target_month: str | date | None = None,
    rules: Sequence[Rule] = DEFAULT_RULES,
    no_baseline: str = "GREEN",
    as_of: datetime | None = None,
    unique_accounts: bool = True,
    **options,
) -> RoutedTables:
    """Load the three tables and return RAG result and RAG holding table.

    ``options`` are those of ``read_table``. As in ``run_pipeline`` the optimizer
    removes the payments join.
    """
    orders = join_orders_with_transactions(
        load_orders(spark, orders_path, **options),
        load_transactions(spark, transactions_path, **options),
    )
    accounts = load_accounts(spark, accounts_path, **options)
    return rag_tables(orders, accounts, target_month, rules, no_baseline, as_of, unique_accounts)


def run_rag_analysis(spark: SparkSession, *paths: str, **options) -> DataFrame:
    """The result table of ``run_rag_tables``, which takes the same arguments."""
    return run_rag_tables(spark, *paths, **options).result_table
