"""Presentation order of the outputs.

A global sort is a shuffle of its own, so it is kept out of every other step.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderflow.operators.summaries import holding_summary


def ordered_result(result_table: DataFrame) -> DataFrame:
    return result_table.orderBy("account_id")


def ordered_holding(holding_table: DataFrame) -> DataFrame:
    return holding_table.orderBy("hold_reason", "account_id")


def ordered_holding_summary(holding_table: DataFrame) -> DataFrame:
    """Reasons by falling count; equal counts by reason."""
    return holding_summary(holding_table).orderBy(F.desc("record_count"), "hold_reason")
