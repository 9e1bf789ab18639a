"""Validation of account-months and their routing to result and holding rows."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderflow.functions.rules import DEFAULT_RULES, Rule, all_broken_rules, first_broken_rule
from orderflow.schemas import RESULT_COLUMNS


@dataclass
class RoutedTables:
    """Valid rows and held rows, two lazy views of one classified table."""

    result_table: DataFrame
    holding_table: DataFrame


def apply_validation_rules(
    enriched: DataFrame,
    rules: Sequence[Rule] = DEFAULT_RULES,
    with_violations: bool = False,
) -> DataFrame:
    """Add ``hold_reason`` (the first broken rule) and ``validation_failed``.

    ``with_violations`` also adds the array ``violations`` of all broken rules.
    """
    reason = first_broken_rule(rules)
    columns = {"hold_reason": reason, "validation_failed": reason.isNotNull()}
    if with_violations:
        columns["violations"] = all_broken_rules(rules)
    return enriched.withColumns(columns)


def hold_timestamp(as_of: datetime | None = None) -> Column:
    """Time of holding: the time of the query, or ``as_of`` for reproducible output."""
    time = F.current_timestamp() if as_of is None else F.lit(as_of).cast("timestamp")
    return time.alias("hold_timestamp")


def result_rows(classified: DataFrame) -> DataFrame:
    return classified.where("NOT validation_failed").select(*RESULT_COLUMNS)


def holding_rows(classified: DataFrame, as_of: datetime | None = None) -> DataFrame:
    held = classified.where("validation_failed")
    return held.select(*RESULT_COLUMNS, "hold_reason", hold_timestamp(as_of))


def split_by_validation(classified: DataFrame, as_of: datetime | None = None) -> RoutedTables:
    """Split a classified table in two.

    Each of the two frames computes the classified table when it is used. To use
    both at scale, write the table once with ``write_routed`` and read it back.
    """
    return RoutedTables(result_rows(classified), holding_rows(classified, as_of))
