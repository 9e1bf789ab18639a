"""Accounts, orders and transactions derived from retail tables.

The tables customer, orders and lineitem hold no faulty rows. The mapping plants
each fault by a fixed rule on the keys, so that every validation rule finds
something to hold.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

# Columns the mapping reads. Declared, so that no job has to read file footers
# before the query itself.
CUSTOMER = "c_custkey BIGINT, c_name STRING, c_acctbal DOUBLE, c_mktsegment STRING"
ORDERS = (
    "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE,"
    " o_orderdate TIMESTAMP_NTZ"
)
LINEITEM = (
    "l_orderkey BIGINT, l_linenumber INT, l_extendedprice DOUBLE, l_returnflag STRING,"
    " l_shipdate TIMESTAMP_NTZ"
)


def accounts_of(customer: DataFrame) -> DataFrame:
    """Customers as accounts; some lack a name or a limit."""
    return customer.selectExpr(
        "c_custkey AS account_id",
        "CASE WHEN c_acctbal < 0 THEN NULL ELSE c_name END AS customer_name",
        "CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN NULL"
        " ELSE CAST(1 + c_custkey % 3 AS INT) END AS order_limit",
    )


def orders_of(orders: DataFrame) -> DataFrame:
    """Orders; some lack their id, lack or have an unknown account, or have a negative amount."""
    return orders.selectExpr(
        "CASE WHEN o_orderkey % 101 = 5 THEN NULL ELSE o_orderkey END AS order_id",
        "CASE WHEN o_custkey % 97 = 3 THEN NULL WHEN o_custkey % 50 = 7 THEN -o_custkey"
        " ELSE o_custkey END AS account_id",
        "CAST(o_orderdate AS DATE) AS order_date",
        "CAST(CASE WHEN o_orderkey % 40 = 1 THEN -o_totalprice"
        " ELSE o_totalprice END AS DECIMAL(18,2)) AS total_amount",
        "CAST(1 + o_orderkey % 7 AS INT) AS product_count",
        "CASE o_orderstatus WHEN 'F' THEN 'COMPLETED' WHEN 'O' THEN 'PENDING'"
        " ELSE 'CANCELLED' END AS status",
    )


def transactions_of(lineitem: DataFrame) -> DataFrame:
    """Line items as payments of their order."""
    return lineitem.selectExpr(
        "l_orderkey * 10 + l_linenumber AS transaction_id",
        "l_orderkey AS order_id",
        "CAST(l_extendedprice AS DECIMAL(18,2)) AS amount",
        "l_shipdate AS transaction_date",
        "CASE l_returnflag WHEN 'A' THEN 'SUCCESS' WHEN 'N' THEN 'PENDING'"
        " ELSE 'FAILED' END AS status",
    )


class RetailTables:
    """The three inputs from the Parquet files of a directory, opened on first use."""

    def __init__(self, spark: SparkSession, directory: str):
        self.spark = spark
        self.directory = directory

    def _read(self, name: str, schema: str) -> DataFrame:
        return self.spark.read.schema(schema).parquet(f"{self.directory}/{name}.parquet")

    @cached_property
    def accounts(self) -> DataFrame:
        return accounts_of(self._read("customer", CUSTOMER))

    @cached_property
    def orders(self) -> DataFrame:
        return orders_of(self._read("orders", ORDERS))

    @cached_property
    def transactions(self) -> DataFrame:
        return transactions_of(self._read("lineitem", LINEITEM))
