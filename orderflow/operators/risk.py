"""Risk score of classified account-months."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed points and bands.
OVER_LIMIT_POINTS = 20
LARGE_TOTAL_POINTS = 15
FAILURE_POINTS = 10
LARGE_TOTAL = 10000
HIGH_RISK_FROM = 50
MEDIUM_RISK_FROM = 25


def calculate_customer_risk_score(
    classified: DataFrame,
    large_total: float = LARGE_TOTAL,
    per_failure: bool = False,
    high_from: int = HIGH_RISK_FROM,
    medium_from: int = MEDIUM_RISK_FROM,
) -> DataFrame:
    """Add ``risk_score`` and ``risk_category`` to a classified table.

    A failed row scores 10 points once; with ``per_failure`` it scores 10 for each
    broken rule, which needs the ``violations`` column of
    ``apply_validation_rules``. Only then can a row reach HIGH_RISK by the default
    rules, unless ``high_from`` is lower. An unknown limit or total gives no points.
    """
    failures = "size(violations)" if per_failure else "IF(validation_failed, 1, 0)"
    large = F.when(F.col("monthly_total") > F.lit(large_total), LARGE_TOTAL_POINTS).otherwise(0)
    scored = classified.withColumn(
        "risk_score",
        F.expr(f"IF(order_count > order_limit, {OVER_LIMIT_POINTS}, 0)")
        + large
        + F.expr(f"{FAILURE_POINTS} * {failures}"),
    )
    category = (
        F.when(F.col("risk_score") >= high_from, "HIGH_RISK")
        .when(F.col("risk_score") >= medium_from, "MEDIUM_RISK")
        .otherwise("LOW_RISK")
    )
    return scored.withColumn("risk_category", category)
