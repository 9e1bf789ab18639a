"""Result and holding rows as one partitioned Parquet table."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from orderflow.functions.rules import DEFAULT_RULES, Rule
from orderflow.operators.validation import RoutedTables, hold_timestamp
from orderflow.schemas import RESULT_COLUMNS, ROUTED

RESULT, HOLDING = "result", "holding"


def write_routed(
    classified: DataFrame,
    path: str,
    as_of: datetime | None = None,
    columns: Sequence[str] = RESULT_COLUMNS,
    by_month: bool = False,
    mode: str = "errorifexists",
    rules: Sequence[Rule] = DEFAULT_RULES,
) -> dict:
    """Write a classified table in one pass and return the summaries of both outputs.

    Both outputs and both summaries come from a single computation of the table:
    ``result`` as of ``get_result_summary`` (its sums only for columns that the table
    has), ``holding`` as of ``get_holding_summary`` with the reasons of ``rules``.
    ``columns`` are those of the result; a RAG table names its own.

    Without ``by_month`` the table is partitioned by ``route``. With it, by month alone,
    and the route is a column: rows are gathered per month in partitions of even size and
    sorted by route, so that a month is neither scattered over thousands of files nor
    written by one task, and readers of one route skip the other's row groups.

    ``mode="replace"`` needs ``by_month`` and replaces the months that occur in the new
    rows, both routes of them, so a month that holds no row any more keeps none; other
    months stay. ``mode="overwrite"`` replaces the whole table.
    """
    if mode == "replace" and not by_month:
        raise ValueError('mode="replace" needs by_month=True')
    failed = F.col("validation_failed")
    codes = [rule.code for rule in rules]
    measures = {
        name: F.coalesce(F.sum(F.when(~failed, F.col(column))), F.lit(0))
        for name, column in (("total_amount", "monthly_total"), ("total_orders", "order_count"))
        if column in classified.columns
    }
    seen = Observation()
    observed = classified.observe(
        seen,
        F.count_if(~failed).alias("total_records"),
        F.count_if(failed).alias("total_held"),
        *(value.alias(name) for name, value in measures.items()),
        *(F.count_if(F.col("hold_reason") == c).alias(f"held_{n}") for n, c in enumerate(codes)),
    )
    month = F.col("order_month").cast("date").alias("month")
    routed = observed.select(
        *columns,
        "hold_reason",
        F.when(failed, hold_timestamp(as_of)).alias("hold_timestamp"),
        F.when(failed, HOLDING).otherwise(RESULT).alias("route"),
        *([month] if by_month else []),
    )
    if by_month:
        routed = routed.hint("rebalance", "month").sortWithinPartitions("month", "route")
    kind = "dynamic" if mode == "replace" else "static"
    writer = routed.write.mode("overwrite" if mode == "replace" else mode)
    writer = writer.option("partitionOverwriteMode", kind)
    writer.partitionBy("month" if by_month else "route").parquet(path)
    found = seen.get
    held = {c: found[f"held_{n}"] for n, c in enumerate(codes) if found[f"held_{n}"]}
    return {
        "result": {name: found[name] for name in ("total_records", *measures)},
        "holding": {"total_held": found["total_held"], "by_reason": held},
    }


def read_routed(
    spark: SparkSession, path: str, schema: StructType | str | None = None
) -> RoutedTables:
    """The two outputs of ``write_routed``; each skips the other's data.

    ``schema`` is that of the files: result columns, hold reason, hold timestamp, and route
    and month. With it no job reads file footers. Without it the files tell, and a table
    without any row has the declared columns.
    """
    if schema is not None:
        table = spark.read.schema(schema).parquet(path)
    else:
        try:
            table = spark.read.parquet(path)
        except AnalysisException as error:
            if error.getCondition() != "UNABLE_TO_INFER_SCHEMA":
                raise
            table = spark.read.schema(ROUTED).parquet(path)
    levels = {"route", "month"} & set(table.columns)
    held = table.where(F.col("route") == HOLDING).drop(*levels)
    valid = table.where(F.col("route") == RESULT)
    return RoutedTables(valid.drop(*levels, "hold_reason", "hold_timestamp"), held)
