"""The presentation orders, row by row."""

from itertools import pairwise

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as registered
import orderflow as of
from tests.test_oracle import DIRECTORY, oracle  # noqa: F401

RESULT = "account_id string, customer_name string, monthly_total double"
HOLDING = f"{RESULT}, hold_reason string"


def _key(row, columns):
    """NULLs first, as Spark sorts."""
    return [(row[c] is not None, row[c]) for c in columns]


def test_result_by_account(spark):
    given = [("B", "x", 1.0), (None, "y", 2.0), ("A", "z", 3.0), ("B", "w", 4.0), ("a", "v", 5.0), (None, "u", 6.0)]
    table = spark.createDataFrame(given, RESULT).repartition(5)
    found = of.ordered_result(table).collect()
    assert [r.account_id for r in found] == [None, None, "A", "B", "B", "a"]
    assert sorted(map(str, found)) == sorted(map(str, table.collect()))


def test_holding_by_reason_and_account(spark):
    given = [
        ("B", "x", 1.0, "R2"), (None, "y", 2.0, "R2"), ("A", "z", 3.0, "R2"), ("C", "w", 4.0, "R1"),
        (None, "v", 5.0, "R1"), ("A", "u", 6.0, "R2"), ("Z", "t", 7.0, None),
    ]
    table = spark.createDataFrame(given, HOLDING).repartition(5)
    found = of.ordered_holding(table).collect()
    assert [(r.hold_reason, r.account_id) for r in found] == [
        (None, "Z"), ("R1", None), ("R1", "C"), ("R2", None), ("R2", "A"), ("R2", "A"), ("R2", "B"),
    ]
    assert {r.monthly_total for r in found} == {r[2] for r in given}


def test_summary_by_count_and_reason(spark):
    reasons = ["R3", "R1", "R2", "R2", "R3", None, "R4", "R4", "R4", None]
    table = spark.createDataFrame([("A", "x", 1.0, r) for r in reasons], HOLDING).repartition(5)
    found = [(r.hold_reason, r.record_count) for r in of.ordered_holding_summary(table).collect()]
    assert found == [("R4", 3), (None, 2), ("R2", 2), ("R3", 2), ("R1", 1)]


ORDERS = {
    "ordered_result": ["account_id"],
    "ordered_holding": ["hold_reason", "account_id"],
    "ordered_holding_summary": ["record_count", "hold_reason"],
}


@pytest.mark.parametrize("name", sorted(ORDERS))
def test_registered_orders_against_sql(spark, oracle, name):  # noqa: F811
    """Row numbers over the collected rows: the n-th row has the sort key of SQL's n-th row."""
    found = registered.queries()[name](spark, DIRECTORY).collect()
    columns = ORDERS[name]
    directions = ["DESC" if c == "record_count" else "ASC" for c in columns]
    clause = ", ".join(f"{c} {d} NULLS FIRST" for c, d in zip(columns, directions))
    body = registered.oracle_sql()[name]
    numbered = f"""SELECT row_number() OVER (ORDER BY {clause}) AS position, {", ".join(columns)}
        FROM ({body}) ORDER BY position"""
    expected = oracle.sql(numbered).fetchall()
    assert [(n + 1, *(r[c] for c in columns)) for n, r in enumerate(found)] == expected
    assert len({_key(r, columns).__str__() for r in found}) < len(found) or name == "ordered_holding_summary"
    if "record_count" not in columns:
        assert all(_key(a, columns) <= _key(b, columns) for a, b in pairwise(found))


def test_order_holds_over_many_partitions(spark):
    """A sort over more partitions than rows of a key: ties may stand on both sides of a cut."""
    table = spark.range(0, 20_000, 1, 8).select(
        F.when(F.col("id") % 11 > 0, F.concat(F.lit("A"), F.col("id") % 7)).alias("account_id"),
        F.col("id").cast("string").alias("customer_name"),
        F.col("id").cast("double").alias("monthly_total"),
    )
    found = [r.account_id or "" for r in of.ordered_result(table).collect()]
    assert found == sorted(found) and len(found) == 20_000
