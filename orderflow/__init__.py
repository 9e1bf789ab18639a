"""Order validation and month-over-month account status on Spark.

Every function takes and returns lazy DataFrames; only the sink and the two
``get_*_summary`` helpers run a job.
"""

from orderflow.functions.months import ALL_MONTHS
from orderflow.functions.rules import DEFAULT_RULES, Rule, stale_order_rule
from orderflow.operators.accounts import (
    duplicate_accounts,
    enrich_with_account_data,
    enrich_with_unique_accounts,
    require_unique_accounts,
)
from orderflow.operators.filters import successful_transactions, valid_orders
from orderflow.operators.monthly import (
    calculate_monthly_totals,
    latest_month,
    orders_of_month,
    totals_of_month,
)
from orderflow.operators.payments import (
    join_orders_with_transactions,
    payment_reconciliation,
    payment_summary,
)
from orderflow.operators.rag import (
    add_limit_exceeded,
    add_rag_status,
    compare_with_previous_month,
    month_over_month,
    previous_month_totals,
    rag_holding,
    rag_result,
)
from orderflow.operators.risk import calculate_customer_risk_score
from orderflow.operators.summaries import (
    get_holding_summary,
    get_result_summary,
    holding_summary,
    holding_summary_total,
    result_summary,
)
from orderflow.operators.validation import (
    RoutedTables,
    apply_validation_rules,
    split_by_validation,
)
from orderflow.plans.rag import classify_rag, rag_tables, run_rag_analysis, run_rag_tables
from orderflow.plans.reports import ordered_holding, ordered_holding_summary, ordered_result
from orderflow.plans.validation import classify_orders, run_pipeline, validate_orders
from orderflow.sources.catalog import register_views
from orderflow.sources.files import (
    load_accounts,
    load_orders,
    load_transactions,
    rejected_records,
    write_table,
)
from orderflow.sources.routed import read_routed, write_routed

__all__ = [
    "ALL_MONTHS",
    "DEFAULT_RULES",
    "RoutedTables",
    "Rule",
    "add_limit_exceeded",
    "add_rag_status",
    "apply_validation_rules",
    "calculate_customer_risk_score",
    "calculate_monthly_totals",
    "classify_orders",
    "classify_rag",
    "compare_with_previous_month",
    "duplicate_accounts",
    "enrich_with_account_data",
    "enrich_with_unique_accounts",
    "get_holding_summary",
    "get_result_summary",
    "holding_summary",
    "holding_summary_total",
    "join_orders_with_transactions",
    "latest_month",
    "load_accounts",
    "load_orders",
    "load_transactions",
    "month_over_month",
    "ordered_holding",
    "ordered_holding_summary",
    "ordered_result",
    "orders_of_month",
    "payment_reconciliation",
    "payment_summary",
    "previous_month_totals",
    "rag_holding",
    "rag_result",
    "rag_tables",
    "read_routed",
    "register_views",
    "rejected_records",
    "require_unique_accounts",
    "result_summary",
    "run_pipeline",
    "run_rag_analysis",
    "run_rag_tables",
    "split_by_validation",
    "stale_order_rule",
    "successful_transactions",
    "totals_of_month",
    "valid_orders",
    "validate_orders",
    "write_routed",
    "write_table",
]
