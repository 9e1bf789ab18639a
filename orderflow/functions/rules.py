"""Validation rules as data.

A rule is a code and a SQL predicate that is true for a row breaking it. The
order of the list is the precedence: the first broken rule names the row. The
same list yields the first reason, every reason, and the number of failures.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    code: str
    broken_when: str


# The codes and their order.
DEFAULT_RULES: tuple[Rule, ...] = (
    Rule("MISSING_ACCOUNT_ID", "account_id IS NULL"),
    Rule("MISSING_CUSTOMER_NAME", "customer_name IS NULL"),
    Rule("NEGATIVE_AMOUNT", "monthly_total < 0"),
    Rule("INVALID_ORDER_COUNT", "order_count <= 0"),
    Rule("MISSING_ORDER_LIMIT", "order_limit IS NULL"),
)


def stale_order_rule(as_of: date, days: int = 365) -> Rule:
    """Rule for account-months whose last order is more than ``days`` before ``as_of``.

    Needs the ``last_order_date`` column of ``calculate_monthly_totals``.
    Not among the defaults: on historical data it would hold every row.
    """
    return Rule(
        "STALE_ORDER_DATE",
        f"last_order_date < date_sub(DATE '{as_of.isoformat()}', {int(days)})",
    )


def first_broken_rule(rules: Sequence[Rule] = DEFAULT_RULES) -> Column:
    """Code of the first broken rule, NULL when every rule holds."""
    found = F.lit(None).cast("string")
    for rule in reversed(rules):
        found = F.when(F.expr(rule.broken_when), F.lit(rule.code)).otherwise(found)
    return found


def all_broken_rules(rules: Sequence[Rule] = DEFAULT_RULES) -> Column:
    """Codes of all broken rules in precedence order, an empty array for a valid row."""
    codes = [F.when(F.expr(rule.broken_when), F.lit(rule.code)) for rule in rules]
    return F.array_compact(F.array(*codes, F.lit(None).cast("string")))
