"""Month-over-month change as expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Increase in percent from which a status applies, and flag texts.
RED_FROM = 50
AMBER_FROM = 30
EXCEEDED, NOT_EXCEEDED = "YES", "NO"


def percentage_change(current: str, previous: str) -> Column:
    """Change in percent of the previous total, NULL without a positive one."""
    return F.expr(
        f"CASE WHEN {previous} > 0 THEN"
        f" CAST({current} - {previous} AS DOUBLE) / CAST({previous} AS DOUBLE) * 100 END"
    )


def rag_status(current: str, previous: str, no_baseline: str = "GREEN") -> Column:
    """RED, AMBER or GREEN by the increase; ``no_baseline`` where there is no change to judge.

    Totals are compared in cents as DECIMAL, whatever their type, and as products
    instead of a quotient. So a total exactly on a threshold is not moved across it by
    rounding, and DOUBLE sums give the same status in any order of addition. Totals that
    are no number of cents (infinite, 10**26 or more) are compared as they are.
    """

    def rises_by(percent: int) -> str:
        def at_least(new: str, old: str) -> str:
            return f"({new} - {old}) * 100 >= {old} * {percent}"

        cents = [f"try_cast({total} AS DECIMAL(28,2))" for total in (current, previous)]
        return f"coalesce({at_least(*cents)}, {at_least(current, previous)})"

    no_change = F.expr(f"coalesce({previous} <= 0, true) OR {current} IS NULL")
    judged = F.when(F.expr(rises_by(RED_FROM)), "RED").when(F.expr(rises_by(AMBER_FROM)), "AMBER")
    return F.when(no_change, F.lit(no_baseline)).otherwise(judged.otherwise("GREEN"))


def limit_exceeded(order_count: str, order_limit: str) -> Column:
    """Whether there are more orders than the limit allows; an unknown limit is not exceeded."""
    return F.expr(f"IF({order_count} > {order_limit}, '{EXCEEDED}', '{NOT_EXCEEDED}')")
