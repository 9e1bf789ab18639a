"""Summaries of the result and holding tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _total(name: str) -> Column:
    return F.coalesce(F.sum(name), F.lit(0))


def result_summary(result_table: DataFrame) -> DataFrame:
    """One row: number of records, their amount and their orders; zeros if there are none."""
    return result_table.agg(
        F.count("*").alias("total_records"),
        _total("monthly_total").alias("total_amount"),
        _total("order_count").alias("total_orders"),
    )


def holding_summary(holding_table: DataFrame) -> DataFrame:
    """Number of held records per reason."""
    return holding_table.groupBy("hold_reason").agg(F.count("*").alias("record_count"))


def holding_summary_total(holding_table: DataFrame) -> DataFrame:
    """Number of held records per reason and, with a NULL reason, of all held records.

    Every held record has a reason, so the NULL row can only be the total; it is zero
    if nothing is held. Both parts come from one shuffle of the held records.
    """
    by_reason = holding_summary(holding_table)
    total = by_reason.agg(_total("record_count").alias("record_count"))
    none = F.lit(None).cast(by_reason.schema["hold_reason"].dataType)
    return by_reason.unionByName(total.withColumn("hold_reason", none))


def get_result_summary(result_table: DataFrame) -> dict:
    """``result_summary`` as a dict, in one job."""
    return result_summary(result_table).first().asDict()


def get_holding_summary(holding_table: DataFrame) -> dict:
    """Held records in total and by reason as a dict, in one job.

    What comes back is one row per rule.
    """
    by_reason = {
        row["hold_reason"]: row["record_count"] for row in holding_summary(holding_table).collect()
    }
    return {"total_held": sum(by_reason.values()), "by_reason": by_reason}
