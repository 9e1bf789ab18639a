"""Registered queries and the SQL that checks them.

Every query reads the whole of the tables that it needs: orders, with accounts also
customer, with payments also lineitem. ``orderflow.sources.retail`` maps them to
orders, accounts and transactions row by row; ``MAPPING`` is the same mapping in SQL.
"""

from __future__ import annotations

import os
import sys
import tempfile
import uuid
from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from orderflow.functions.rules import DEFAULT_RULES, stale_order_rule  # noqa: E402
from orderflow.operators.accounts import (  # noqa: E402
    duplicate_accounts,
    enrich_with_account_data,
    require_unique_accounts,
)
from orderflow.operators.filters import successful_transactions, valid_orders  # noqa: E402
from orderflow.operators.monthly import calculate_monthly_totals, latest_month  # noqa: E402
from orderflow.operators.payments import (  # noqa: E402
    join_orders_with_transactions,
    payment_reconciliation,
    payment_summary,
)
from orderflow.operators.rag import (  # noqa: E402
    add_limit_exceeded,
    add_rag_status,
    month_over_month,
    previous_month_totals,
)
from orderflow.operators.risk import calculate_customer_risk_score  # noqa: E402
from orderflow.operators.summaries import (  # noqa: E402
    holding_summary,
    holding_summary_total,
    result_summary,
)
from orderflow.plans.rag import rag_tables, run_rag_analysis  # noqa: E402
from orderflow.plans.reports import (  # noqa: E402
    ordered_holding,
    ordered_holding_summary,
    ordered_result,
)
from orderflow.plans.validation import (  # noqa: E402
    classify_orders,
    run_pipeline,
    validate_orders,
)
from orderflow.schemas import ACCOUNTS, ORDERS, TRANSACTIONS  # noqa: E402
from orderflow.sources.catalog import register_views  # noqa: E402
from orderflow.sources.files import load_accounts, rejected_records, write_table  # noqa: E402
from orderflow.sources.retail import RetailTables  # noqa: E402
from orderflow.sources.routed import read_routed, write_routed  # noqa: E402

try:
    from orderflow.llm import queries as llm
except ModuleNotFoundError as missing:
    if not (missing.name or "").startswith("orderflow.llm"):
        raise
    llm = None

try:
    import corpus_pipeline
except ModuleNotFoundError as missing:
    if not (missing.name or "").startswith(("corpus_pipeline", "orderflow.llm")):
        raise
    corpus_pipeline = None

SMALL_TABLES = "/root/testdata/sf0.001"
TARGET_MONTH = "1998-05"
EMPTY_MONTH = "1950-01"
STALE_AS_OF = date(2000, 7, 1)
RAISED_TOTAL = 300000
KEPT_IN_MONTH = (
    "coalesce(order_id % 2, 0) = 0 OR order_date < DATE '1998-05-01'"
    " OR order_date >= DATE '1998-06-01'"
)

CLASSIFIED = [
    "account_id",
    "customer_name",
    "order_month",
    "monthly_total",
    "order_count",
    "total_products",
    "order_limit",
    "hold_reason",
]
COMPARED = ["account_id", "order_month", "monthly_total", "previous_month_total"]


def _comparable(table: DataFrame) -> DataFrame:
    """Money as DOUBLE and months as DATE, as in the checking SQL."""
    casts = {
        field.name: F.col(field.name).cast("double")
        for field in table.schema
        if field.dataType.typeName() == "decimal"
    }
    if "order_month" in table.columns:
        casts["order_month"] = F.col("order_month").cast("date")
    return table.withColumns(casts)


def entry(spark: SparkSession) -> DataFrame:
    """Valid account-months of one month at the smallest scale."""
    tables = RetailTables(spark, SMALL_TABLES)
    orders = join_orders_with_transactions(
        valid_orders(tables.orders), successful_transactions(tables.transactions)
    )
    return _comparable(validate_orders(orders, tables.accounts, TARGET_MONTH).result_table)


# Each function below takes the three inputs and gives the rows of one query.


def _orders(t: RetailTables) -> DataFrame:
    return valid_orders(t.orders)


def _with_payments(t: RetailTables) -> DataFrame:
    return join_orders_with_transactions(_orders(t), successful_transactions(t.transactions))


def _monthly(t: RetailTables) -> DataFrame:
    return calculate_monthly_totals(_orders(t))


def _classified(t: RetailTables, month: str | None = "ALL", **options) -> DataFrame:
    return classify_orders(_orders(t), t.accounts, month, **options)


def _validated(t: RetailTables, month: str | None = "ALL"):
    return validate_orders(_orders(t), t.accounts, month)


def _rag(t: RetailTables, month: str | None = "ALL"):
    return rag_tables(_orders(t), t.accounts, month)


def _compared(t: RetailTables) -> DataFrame:
    return previous_month_totals(_monthly(t))


def _with_repeats(t: RetailTables) -> DataFrame:
    """Accounts as if every tenth had been delivered twice."""
    return t.accounts.union(t.accounts.where(F.col("account_id") % 10 == 0))


def _rule_violations(t: RetailTables) -> DataFrame:
    classified = _classified(t, with_violations=True)
    joined = F.array_join("violations", ",").alias("violations")
    return classified.select("account_id", "order_month", "hold_reason", joined)


def _risk(t: RetailTables, with_violations: bool = False, **options) -> DataFrame:
    scored = calculate_customer_risk_score(
        _classified(t, with_violations=with_violations), **options
    )
    return scored.select("account_id", "order_month", "risk_score", "risk_category")


def _risk_all_rules(t: RetailTables) -> DataFrame:
    """Risk with 10 points for each failure; some orders a century on break every rule."""
    planted = t.orders.where("order_id % 10 = 0").selectExpr(
        "CAST(NULL AS BIGINT) AS order_id",
        "CAST(NULL AS BIGINT) AS account_id",
        "add_months(order_date, 1200) AS order_date",
        "-abs(total_amount) AS total_amount",
        "product_count",
        "'COMPLETED' AS status",
    )
    both = _orders(t).unionByName(planted)
    classified = classify_orders(both, t.accounts, "ALL", with_violations=True)
    scored = calculate_customer_risk_score(classified, per_failure=True)
    return scored.select("account_id", "order_month", "risk_score", "risk_category")


def _risk_stale(t: RetailTables) -> DataFrame:
    """Risk with 10 points for each failure, the stale-order rule among the rules."""
    rules = (*DEFAULT_RULES, stale_order_rule(STALE_AS_OF))
    scored = calculate_customer_risk_score(
        _classified(t, rules=rules, with_violations=True), per_failure=True
    )
    return scored.select("account_id", "order_month", "risk_score", "risk_category")


def _stale(t: RetailTables) -> DataFrame:
    rules = (*DEFAULT_RULES, stale_order_rule(STALE_AS_OF))
    return _classified(t, rules=rules).select(
        "account_id", "order_month", "last_order_date", "hold_reason"
    )


def _limit_exceeded(t: RetailTables) -> DataFrame:
    flagged = add_limit_exceeded(enrich_with_account_data(_monthly(t), t.accounts))
    return flagged.select(
        "account_id", "order_month", "order_count", "order_limit", "limit_exceeded"
    )


def _register(t: RetailTables, **options) -> None:
    inputs = {"accounts": t.accounts, "orders": t.orders, "transactions": t.transactions}
    for name, table in inputs.items():
        table.createOrReplaceTempView(f"retail_{name}")
    register_views(t.spark, **{name: f"retail_{name}" for name in inputs}, **options)


def _sql_views(t: RetailTables) -> DataFrame:
    _register(t)
    return t.spark.sql(f"SELECT {', '.join(CLASSIFIED)} FROM validated_orders ORDER BY account_id")


def _sql_view_holding(t: RetailTables) -> DataFrame:
    """Held rows of all months and how many share their reason, by SQL over the views."""
    _register(t, target_month="ALL", with_violations=True)
    return t.spark.sql(
        "SELECT v.account_id, v.order_month, v.hold_reason, array_join(v.violations, ',') AS"
        " violations, s.record_count FROM validated_orders v JOIN (SELECT hold_reason, count(*)"
        " AS record_count FROM validated_orders WHERE hold_reason IS NOT NULL GROUP BY"
        " hold_reason) s ON v.hold_reason = s.hold_reason"
    )


def _rag_status_double(t: RetailTables) -> DataFrame:
    """RAG status of money in DOUBLE, the type that files are read with."""
    money = _orders(t).withColumn("total_amount", F.col("total_amount").cast("double"))
    compared = add_rag_status(previous_month_totals(calculate_monthly_totals(money)))
    return compared.select("account_id", "order_month", "rag_status")


def _reconciled_exact(t: RetailTables) -> DataFrame:
    """As if every third order had been paid exactly."""
    paid = F.when(F.col("order_id") % 3 == 0, F.col("total_paid")).otherwise(F.col("total_amount"))
    rows = payment_reconciliation(_with_payments(t).withColumn("total_amount", paid))
    return rows.select("order_id", "total_amount", "total_paid", "payment_status")


def _folder(spark: SparkSession, name: str) -> str:
    """A new path in the cluster's shared folder; without one, locally in a temporary folder."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    master = spark.sparkContext.master
    if not folder and master.startswith("local") and "cluster" not in master:
        folder = tempfile.mkdtemp(prefix="orderflow-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return f"{folder or spark.conf.get('spark.sql.warehouse.dir')}/{name}-{uuid.uuid4().hex}"


def _as_files(t: RetailTables, format: str) -> list[str]:
    """Writes accounts, orders and transactions as files and returns their paths."""
    folder = _folder(t.spark, "tables")
    accounts = t.accounts.withColumn("status", F.lit("ACTIVE"))
    inputs = {"accounts": (accounts, ACCOUNTS), "orders": (t.orders, ORDERS)}
    inputs["transactions"] = (t.transactions, TRANSACTIONS)
    for name, (table, schema) in inputs.items():
        write_table(table, f"{folder}/{name}.{format}", schema)
    return [f"{folder}/{name}.{format}" for name in inputs]


def _number_key(table: DataFrame) -> DataFrame:
    return table.withColumn("account_id", F.col("account_id").cast("bigint"))


def _both_routes(output) -> DataFrame:
    """Result and holding rows as one table; a result row has no reason."""
    held = output.holding_table.drop("hold_timestamp")
    return output.result_table.unionByName(held, allowMissingColumns=True)


def _pipeline_of_files(t: RetailTables, format: str, month: str | None) -> DataFrame:
    paths = _as_files(t, format)
    output = run_pipeline(t.spark, *paths, target_month=month, money="decimal")
    return _number_key(_both_routes(output))


def _rag_of_json(t: RetailTables) -> DataFrame:
    paths = _as_files(t, "json")
    return _number_key(run_rag_analysis(t.spark, *paths, target_month="ALL", money="decimal"))


def _accounts_of_csv(t: RetailTables) -> DataFrame:
    accounts = _number_key(load_accounts(t.spark, _as_files(t, "csv")[0]))
    return accounts.select("account_id", "customer_name", "order_limit", "status")


def _rejected_of_csv(t: RetailTables) -> DataFrame:
    """Accounts in a file whose limit is a word for every seventh of them."""
    path = f"{_folder(t.spark, 'rejected')}/accounts.csv"
    limit = F.when(F.col("account_id") % 7 == 0, "many").otherwise(F.col("order_limit").cast("string"))
    columns = [F.lit(None).cast("date").alias("created_date"), F.lit("ACTIVE").alias("status")]
    faulty = t.accounts.select("account_id", "customer_name", limit.alias("order_limit"), *columns)
    faulty.write.option("header", True).csv(path)
    return _number_key(rejected_records(t.spark, path, ACCOUNTS)).select("account_id", "customer_name")


def _routed_months_replaced(t: RetailTables) -> DataFrame:
    """All months routed to a table; then one of them anew, without its orders of odd id."""
    path = _folder(t.spark, "routed")
    write_routed(_classified(t), path, by_month=True)
    corrected = classify_orders(_orders(t).where(KEPT_IN_MONTH), t.accounts, TARGET_MONTH)
    write_routed(corrected, path, by_month=True, mode="replace")
    return _both_routes(read_routed(t.spark, path))


def _routed_counts(t: RetailTables) -> DataFrame:
    """Rows of every reason as the sink reported and as the table holds them."""
    path = _folder(t.spark, "routed")
    said = write_routed(_classified(t), path)
    reported = [(None, said["result"]["total_records"]), *said["holding"]["by_reason"].items()]
    reported = t.spark.createDataFrame(reported, "reason string, reported bigint")
    stored = _both_routes(read_routed(t.spark, path)).groupBy("hold_reason")
    stored = stored.agg(F.count("*").alias("stored"), F.sum("order_count").alias("orders"))
    joined = stored.join(reported, F.expr("hold_reason <=> reason"), "full")
    return joined.select("hold_reason", "stored", "orders", "reported")


_QUERIES: dict[str, Callable[[RetailTables], DataFrame]] = {
    "valid_orders": _orders,
    "successful_transactions": lambda t: successful_transactions(t.transactions),
    "payment_summary": lambda t: payment_summary(successful_transactions(t.transactions)),
    "orders_with_payments": _with_payments,
    "payment_reconciliation": lambda t: payment_reconciliation(_with_payments(t)),
    "monthly_account_totals": _monthly,
    "latest_month": lambda t: latest_month(_orders(t)),
    "enriched_monthly_totals": lambda t: enrich_with_account_data(_monthly(t), t.accounts),
    "enriched_repeated_accounts": lambda t: enrich_with_account_data(
        _monthly(t), _with_repeats(t), unique=False
    ),
    "enriched_unique_accounts": lambda t: enrich_with_account_data(
        _monthly(t), require_unique_accounts(t.accounts)
    ),
    "validated_orders": lambda t: _classified(t).select(*CLASSIFIED, "validation_failed"),
    "validated_target_month": lambda t: _classified(t, TARGET_MONTH).select(*CLASSIFIED),
    "validated_latest_month": lambda t: _classified(t, None).select(*CLASSIFIED),
    "validated_all_months": lambda t: _classified(t).select(*CLASSIFIED),
    "result_table": lambda t: _validated(t).result_table,
    "holding_table": lambda t: _validated(t).holding_table.drop("hold_timestamp"),
    "result_latest_month": lambda t: _validated(t, None).result_table,
    "holding_latest_month": lambda t: _validated(t, None).holding_table.drop("hold_timestamp"),
    "sql_views": _sql_views,
    "ordered_result": lambda t: ordered_result(_validated(t).result_table),
    "ordered_holding": lambda t: ordered_holding(_validated(t).holding_table).drop(
        "hold_timestamp"
    ),
    "ordered_holding_summary": lambda t: ordered_holding_summary(_validated(t).holding_table),
    "result_summary": lambda t: result_summary(_validated(t).result_table),
    "holding_summary": lambda t: holding_summary(_validated(t).holding_table),
    "holding_summary_total": lambda t: holding_summary_total(_validated(t).holding_table),
    "holding_summary_no_orders": lambda t: holding_summary_total(
        _validated(t, EMPTY_MONTH).holding_table
    ),
    "rule_violations": _rule_violations,
    "sql_view_holding": _sql_view_holding,
    "rag_status_double": _rag_status_double,
    "payment_reconciliation_exact": _reconciled_exact,
    "customer_risk_score_low_bands": lambda t: _risk(t, high_from=30, medium_from=20),
    "previous_month_totals": lambda t: _compared(t).select(*COMPARED),
    "month_over_month": lambda t: month_over_month(_compared(t)).select(
        *COMPARED, "percentage_change"
    ),
    "rag_status": lambda t: add_rag_status(_compared(t)).select(*COMPARED, "rag_status"),
    "limit_exceeded": _limit_exceeded,
    "rag_result": lambda t: _rag(t).result_table,
    "rag_holding": lambda t: _rag(t).holding_table.drop("hold_timestamp"),
    "rag_result_target_month": lambda t: _rag(t, TARGET_MONTH).result_table,
    "rag_holding_target_month": lambda t: _rag(t, TARGET_MONTH).holding_table.drop(
        "hold_timestamp"
    ),
    "rag_result_latest_month": lambda t: _rag(t, None).result_table,
    "rag_holding_latest_month": lambda t: _rag(t, None).holding_table.drop("hold_timestamp"),
    "customer_risk_score": _risk,
    "customer_risk_score_raised_total": lambda t: _risk(t, large_total=RAISED_TOTAL),
    "customer_risk_score_per_failure": lambda t: _risk(t, with_violations=True, per_failure=True),
    "customer_risk_score_all_rules": _risk_all_rules,
    "customer_risk_score_stale": _risk_stale,
    "loaded_accounts_csv": _accounts_of_csv,
    "rejected_accounts_csv": _rejected_of_csv,
    "run_pipeline_csv": lambda t: _pipeline_of_files(t, "csv", "ALL"),
    "run_pipeline_json": lambda t: _pipeline_of_files(t, "json", TARGET_MONTH),
    "run_pipeline_parquet": lambda t: _pipeline_of_files(t, "parquet", None),
    "run_rag_analysis_json": _rag_of_json,
    "routed_months_replaced": _routed_months_replaced,
    "routed_counts": _routed_counts,
    "stale_orders": _stale,
    "duplicate_accounts": lambda t: duplicate_accounts(_with_repeats(t)),
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def over_tables(query):
        return lambda spark, sf_dir: _comparable(query(RetailTables(spark, sf_dir)))

    found = {name: over_tables(query) for name, query in _QUERIES.items()}
    if llm:
        found |= llm.QUERIES
    if corpus_pipeline:
        found["pipeline"] = corpus_pipeline.run
    return found


MAPPING = """
WITH acc AS (
  SELECT c_custkey AS account_id,
         CASE WHEN c_acctbal < 0 THEN NULL ELSE c_name END AS customer_name,
         CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN NULL
              ELSE CAST(1 + c_custkey % 3 AS INT) END AS order_limit
  FROM customer),
ord AS (
  SELECT CASE WHEN o_orderkey % 101 = 5 THEN NULL ELSE o_orderkey END AS order_id,
         CASE WHEN o_custkey % 97 = 3 THEN NULL WHEN o_custkey % 50 = 7 THEN -o_custkey
              ELSE o_custkey END AS account_id,
         CAST(o_orderdate AS DATE) AS order_date,
         CAST(CASE WHEN o_orderkey % 40 = 1 THEN -o_totalprice
                   ELSE o_totalprice END AS DECIMAL(18,2)) AS total_amount,
         CAST(1 + o_orderkey % 7 AS INT) AS product_count,
         CASE o_orderstatus WHEN 'F' THEN 'COMPLETED' WHEN 'O' THEN 'PENDING'
              ELSE 'CANCELLED' END AS status
  FROM orders),
txn AS (
  SELECT l_orderkey * 10 + l_linenumber AS transaction_id, l_orderkey AS order_id,
         CAST(l_extendedprice AS DECIMAL(18,2)) AS amount,
         l_shipdate AS transaction_date,
         CASE l_returnflag WHEN 'A' THEN 'SUCCESS' WHEN 'N' THEN 'PENDING'
              ELSE 'FAILED' END AS status
  FROM lineitem),
good AS (SELECT * FROM ord WHERE status IN ('COMPLETED', 'PENDING')),
success AS (SELECT * FROM txn WHERE status = 'SUCCESS'),
paid AS (
  SELECT order_id, SUM(amount) AS total_paid, COUNT(transaction_id) AS transaction_count
  FROM success GROUP BY order_id),
with_pay AS (
  SELECT g.*, COALESCE(p.total_paid, 0) AS total_paid,
         COALESCE(p.transaction_count, 0) AS transaction_count
  FROM good g LEFT JOIN paid p ON g.order_id = p.order_id),
monthly AS (
  SELECT account_id, CAST(DATE_TRUNC('month', order_date) AS DATE) AS order_month,
         SUM(total_amount) AS monthly_total, COUNT(order_id) AS order_count,
         CAST(SUM(product_count) AS BIGINT) AS total_products,
         MAX(order_date) AS last_order_date
  FROM good GROUP BY 1, 2),
previous AS (
  SELECT m.*, COALESCE(p.monthly_total, 0) AS previous_total
  FROM monthly m LEFT JOIN monthly p
    ON m.account_id = p.account_id AND m.order_month = p.order_month + INTERVAL 1 MONTH),
changed AS (
  SELECT *,
         CASE WHEN previous_total > 0
              THEN CAST(monthly_total - previous_total AS DOUBLE)
                   / CAST(previous_total AS DOUBLE) * 100 END AS percentage_change,
         CASE WHEN previous_total <= 0 THEN 'GREEN'
              WHEN 100 * (monthly_total - previous_total) >= 50 * previous_total THEN 'RED'
              WHEN 100 * (monthly_total - previous_total) >= 30 * previous_total THEN 'AMBER'
              ELSE 'GREEN' END AS rag_status
  FROM previous),
checked AS (
  SELECT c.*, a.customer_name, a.order_limit,
         CASE WHEN c.order_count > a.order_limit THEN 'YES' ELSE 'NO' END AS limit_exceeded,
         CASE WHEN c.account_id IS NULL THEN 'MISSING_ACCOUNT_ID'
              WHEN a.customer_name IS NULL THEN 'MISSING_CUSTOMER_NAME'
              WHEN c.monthly_total < 0 THEN 'NEGATIVE_AMOUNT'
              WHEN c.order_count <= 0 THEN 'INVALID_ORDER_COUNT'
              WHEN a.order_limit IS NULL THEN 'MISSING_ORDER_LIMIT' END AS hold_reason,
         CONCAT_WS(',',
              CASE WHEN c.account_id IS NULL THEN 'MISSING_ACCOUNT_ID' END,
              CASE WHEN a.customer_name IS NULL THEN 'MISSING_CUSTOMER_NAME' END,
              CASE WHEN c.monthly_total < 0 THEN 'NEGATIVE_AMOUNT' END,
              CASE WHEN c.order_count <= 0 THEN 'INVALID_ORDER_COUNT' END,
              CASE WHEN a.order_limit IS NULL THEN 'MISSING_ORDER_LIMIT' END) AS violations
  FROM changed c LEFT JOIN acc a ON c.account_id = a.account_id),
repeated AS (SELECT * FROM acc UNION ALL SELECT * FROM acc WHERE account_id % 10 = 0)
"""


def oracle_sql() -> dict[str, str]:
    total = "CAST(monthly_total AS DOUBLE) AS monthly_total"
    measures = f"order_month, {total}, order_count, total_products"
    enriched = f"account_id, customer_name, {measures}, order_limit"
    order_columns = (
        "order_id, account_id, order_date, CAST(total_amount AS DOUBLE) AS total_amount,"
        " product_count, status"
    )
    paid = "CAST(total_paid AS DOUBLE) AS total_paid, transaction_count"
    compared = (
        f"account_id, order_month, {total},"
        " CAST(previous_total AS DOUBLE) AS previous_month_total"
    )
    rag = (
        "account_id, customer_name, CAST(monthly_total AS DOUBLE) AS current_month_total,"
        " CAST(previous_total AS DOUBLE) AS previous_month_total, percentage_change,"
        " CAST(order_count AS INT) AS order_count, order_limit, rag_status, limit_exceeded"
    )
    valid, held = "hold_reason IS NULL", "hold_reason IS NOT NULL"
    target = f"order_month = DATE '{TARGET_MONTH}-01'"
    latest = "order_month = (SELECT MAX(order_month) FROM monthly)"

    def risk(large_total: int, failure_points: str, high: int = 50, medium: int = 25) -> str:
        return f"""SELECT account_id, order_month, risk_score,
              CASE WHEN risk_score >= {high} THEN 'HIGH_RISK' WHEN risk_score >= {medium}
                   THEN 'MEDIUM_RISK' ELSE 'LOW_RISK' END AS risk_category
            FROM (SELECT account_id, order_month, CAST(
                    CASE WHEN order_count > order_limit THEN 20 ELSE 0 END
                    + CASE WHEN monthly_total > {large_total} THEN 15 ELSE 0 END
                    + {failure_points} AS INT) AS risk_score
                  FROM checked)"""

    once = "CASE WHEN hold_reason IS NULL THEN 0 ELSE 10 END"
    each = (
        "10 * (CASE WHEN violations = '' THEN 0"
        " ELSE 1 + LENGTH(violations) - LENGTH(REPLACE(violations, ',', '')) END)"
    )

    def repeat_join(source: str) -> str:
        return f"""SELECT m.account_id, order_month, {total}, order_count, total_products,
            a.customer_name, a.order_limit
            FROM monthly m LEFT JOIN {source} a ON m.account_id = a.account_id"""

    held_summary = (
        f"SELECT hold_reason, COUNT(*) AS record_count FROM checked WHERE {held} GROUP BY 1"
    )
    stale_day = f"DATE '{STALE_AS_OF.isoformat()}' - INTERVAL 365 DAY"
    bodies = {
        "valid_orders": f"SELECT {order_columns} FROM good",
        "successful_transactions": """SELECT transaction_id, order_id,
            CAST(amount AS DOUBLE) AS amount, transaction_date, status FROM success""",
        "payment_summary": f"SELECT order_id, {paid} FROM paid",
        "orders_with_payments": f"SELECT {order_columns}, {paid} FROM with_pay",
        "payment_reconciliation": f"""SELECT {order_columns}, {paid},
            CASE WHEN transaction_count = 0 THEN 'NO_PAYMENT'
                 WHEN with_pay.total_paid < with_pay.total_amount THEN 'UNDERPAID'
                 WHEN with_pay.total_paid = with_pay.total_amount THEN 'EXACT'
                 WHEN with_pay.total_paid > with_pay.total_amount THEN 'OVERPAID'
            END AS payment_status FROM with_pay""",
        "monthly_account_totals": f"SELECT account_id, {measures} FROM monthly",
        "latest_month": "SELECT MAX(order_month) AS order_month FROM monthly",
        "enriched_monthly_totals": repeat_join("acc"),
        "enriched_repeated_accounts": repeat_join("repeated"),
        "enriched_unique_accounts": repeat_join("acc"),
        "validated_orders": f"""SELECT {enriched}, hold_reason,
            hold_reason IS NOT NULL AS validation_failed FROM checked""",
        "validated_target_month": f"SELECT {enriched}, hold_reason FROM checked WHERE {target}",
        "validated_latest_month": f"SELECT {enriched}, hold_reason FROM checked WHERE {latest}",
        "validated_all_months": f"SELECT {enriched}, hold_reason FROM checked",
        "result_table": f"SELECT {enriched} FROM checked WHERE {valid}",
        "holding_table": f"SELECT {enriched}, hold_reason FROM checked WHERE {held}",
        "result_latest_month": f"SELECT {enriched} FROM checked WHERE {valid} AND {latest}",
        "holding_latest_month": f"""SELECT {enriched}, hold_reason FROM checked
            WHERE {held} AND {latest}""",
        "sql_views": f"SELECT {enriched}, hold_reason FROM checked WHERE {latest}",
        "ordered_result": f"SELECT {enriched} FROM checked WHERE {valid} ORDER BY account_id",
        "ordered_holding": f"""SELECT {enriched}, hold_reason FROM checked WHERE {held}
            ORDER BY hold_reason, account_id""",
        "ordered_holding_summary": f"{held_summary} ORDER BY record_count DESC, hold_reason",
        "result_summary": f"""SELECT COUNT(*) AS total_records,
            CAST(COALESCE(SUM(monthly_total), 0) AS DOUBLE) AS total_amount,
            CAST(COALESCE(SUM(order_count), 0) AS BIGINT) AS total_orders
            FROM checked WHERE {valid}""",
        "holding_summary": held_summary,
        "holding_summary_total": f"""{held_summary}
            UNION ALL SELECT NULL, COUNT(*) FROM checked WHERE {held}""",
        "rule_violations": "SELECT account_id, order_month, hold_reason, violations FROM checked",
        "holding_summary_no_orders": """SELECT CAST(NULL AS VARCHAR) AS hold_reason,
            COUNT(*) AS record_count FROM checked WHERE order_month = DATE '1950-01-01'""",
        "sql_view_holding": f"""SELECT account_id, order_month, hold_reason, violations,
            COUNT(*) OVER (PARTITION BY hold_reason) AS record_count FROM checked WHERE {held}""",
        "rag_status_double": "SELECT account_id, order_month, rag_status FROM changed",
        "payment_reconciliation_exact": """SELECT order_id, CAST(amount AS DOUBLE) AS total_amount,
            CAST(paid_sum AS DOUBLE) AS total_paid,
            CASE WHEN transaction_count = 0 THEN 'NO_PAYMENT' WHEN paid_sum < amount THEN 'UNDERPAID'
                 WHEN paid_sum = amount THEN 'EXACT' WHEN paid_sum > amount THEN 'OVERPAID'
            END AS payment_status
            FROM (SELECT order_id, transaction_count, total_paid AS paid_sum,
                  CASE WHEN order_id % 3 = 0 THEN total_paid ELSE total_amount END AS amount
                  FROM with_pay)""",
        "customer_risk_score_low_bands": risk(10000, once, 30, 20),
        "previous_month_totals": f"SELECT {compared} FROM previous",
        "month_over_month": f"SELECT {compared}, percentage_change FROM changed",
        "rag_status": f"SELECT {compared}, rag_status FROM changed",
        "limit_exceeded": """SELECT account_id, order_month, order_count, order_limit,
            limit_exceeded FROM checked""",
        "rag_result": f"SELECT order_month, {rag} FROM checked WHERE {valid}",
        "rag_holding": f"SELECT order_month, {rag}, hold_reason FROM checked WHERE {held}",
        "rag_result_target_month": f"SELECT {rag} FROM checked WHERE {valid} AND {target}",
        "rag_holding_target_month": f"""SELECT {rag}, hold_reason FROM checked
            WHERE {held} AND {target}""",
        "rag_result_latest_month": f"SELECT {rag} FROM checked WHERE {valid} AND {latest}",
        "rag_holding_latest_month": f"""SELECT {rag}, hold_reason FROM checked
            WHERE {held} AND {latest}""",
        "customer_risk_score": risk(10000, once),
        "customer_risk_score_raised_total": risk(RAISED_TOTAL, once),
        "customer_risk_score_per_failure": risk(10000, each),
        "stale_orders": f"""SELECT account_id, order_month, last_order_date,
            COALESCE(hold_reason, CASE WHEN last_order_date < {stale_day}
                                       THEN 'STALE_ORDER_DATE' END) AS hold_reason
            FROM checked""",
        "customer_risk_score_stale": risk(
            10000, f"{each} + CASE WHEN last_order_date < {stale_day} THEN 10 ELSE 0 END"
        ),
        "loaded_accounts_csv": """SELECT account_id, customer_name, order_limit,
            'ACTIVE' AS status FROM acc""",
        "rejected_accounts_csv": """SELECT account_id, customer_name FROM acc
            WHERE account_id % 7 = 0""",
        "run_pipeline_csv": f"SELECT {enriched}, hold_reason FROM checked",
        "run_pipeline_json": f"SELECT {enriched}, hold_reason FROM checked WHERE {target}",
        "run_pipeline_parquet": f"SELECT {enriched}, hold_reason FROM checked WHERE {latest}",
        "run_rag_analysis_json": f"SELECT order_month, {rag} FROM checked WHERE {valid}",
        "routed_counts": """SELECT hold_reason, COUNT(*) AS stored,
            CAST(SUM(order_count) AS BIGINT) AS orders, COUNT(*) AS reported
            FROM checked GROUP BY 1""",
        "duplicate_accounts": """SELECT account_id, COUNT(*) AS account_rows FROM repeated
            GROUP BY account_id HAVING COUNT(*) > 1""",
    }
    kept = "good AS (SELECT * FROM ord WHERE status IN ('COMPLETED', 'PENDING'))"
    assert kept in MAPPING
    corrected = MAPPING.replace(kept, f"{kept[:-1]} AND ({KEPT_IN_MONTH}))")
    planted = f"""{kept[:-1]} UNION ALL
      SELECT NULL, NULL, CAST(order_date + INTERVAL 1200 MONTH AS DATE), -abs(total_amount),
             product_count, 'COMPLETED' FROM ord WHERE order_id % 10 = 0)"""
    found = {name: MAPPING + body for name, body in bodies.items()}
    found["routed_months_replaced"] = corrected + bodies["validated_all_months"]
    found["customer_risk_score_all_rules"] = MAPPING.replace(kept, planted) + risk(10000, each)
    if llm:
        found |= llm.ORACLES
    if corpus_pipeline and corpus_pipeline.ORACLE_SQL:
        found["pipeline"] = corpus_pipeline.ORACLE_SQL
    return found
