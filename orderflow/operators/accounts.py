"""Account attributes for monthly totals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ATTRIBUTES = ["customer_name", "order_limit"]
UNKNOWN_KEYS = 64
"""Join keys that totals of unknown accounts are dealt out to."""


def enrich_with_account_data(
    monthly_totals: DataFrame, accounts: DataFrame, unique: bool = True
) -> DataFrame:
    """Add customer name and order limit; NULL for an account that is not known.

    An account listed more than once multiplies its rows. ``unique=False`` gives
    the same rows by another plan, for accounts that may be repeated very often:
    adaptive execution can split the oversized side of an inner join, but not the
    inner side of a left join. So each total first learns whether its account is known,
    from the distinct ids, which are few for any number of repeats; an inner join then
    leads known totals to their account and all others to one of ``UNKNOWN_KEYS`` rows
    without attributes. The totals are computed once, whatever Spark broadcasts.
    """
    attributes = accounts.select("account_id", *ATTRIBUTES)
    if unique:
        return monthly_totals.join(attributes, "account_id", "left")
    listed = attributes.where("account_id IS NOT NULL")
    known = listed.select("account_id").distinct().withColumn("_known", F.lit(True))
    place = F.pmod(F.xxhash64("account_id", "order_month"), F.lit(UNKNOWN_KEYS)).cast("int")
    marked = monthly_totals.join(known, "account_id", "left").withColumn(
        "_place", F.when(F.col("_known"), -1).otherwise(place)
    )
    kind = attributes.schema["account_id"].dataType.simpleString()
    unknown = listed.sparkSession.range(UNKNOWN_KEYS).select(
        F.col("id").cast("int").alias("_place"), F.lit(None).cast(kind).alias("_id")
    )
    rows = listed.select(F.lit(-1).alias("_place"), F.col("account_id").alias("_id"), *ATTRIBUTES)
    rows = rows.unionByName(unknown, allowMissingColumns=True)
    own = F.when(F.col("_place") < 0, F.col("account_id"))
    joined = marked.withColumn("_own", own).join(
        rows.withColumnRenamed("_place", "_row"), F.expr("_place <=> _row AND _own <=> _id")
    )
    return joined.select(*monthly_totals.columns, *ATTRIBUTES)


def enrich_with_unique_accounts(
    monthly_totals: DataFrame, accounts: DataFrame, single_month: bool
) -> DataFrame:
    """``enrich_with_account_data`` in a plan that fails when it runs if an account is repeated.

    Totals of a single month have one row per account, so a row too many shows in the
    joined rows themselves: they are still dealt by account, and only accounts with a total
    are looked at. No exchange and no pass over the accounts is added, and small accounts
    are broadcast as they are. For several months ``require_unique_accounts`` checks the
    accounts before the join.
    """
    if not single_month:
        return enrich_with_account_data(monthly_totals, require_unique_accounts(accounts))
    enriched = enrich_with_account_data(monthly_totals, accounts.where("account_id IS NOT NULL"))
    matches = F.count("*").over(Window.partitionBy("account_id"))
    return _without_repeats(enriched.withColumn("_listed", matches)).drop("_listed")


def duplicate_accounts(accounts: DataFrame) -> DataFrame:
    """Account ids listed more than once, with their number of rows."""
    counted = accounts.groupBy("account_id").agg(F.count("*").alias("account_rows"))
    return counted.where("account_id IS NOT NULL AND account_rows > 1")


def require_unique_accounts(accounts: DataFrame) -> DataFrame:
    """The accounts with an id, in a plan that fails when it runs if one is listed twice.

    Rows are counted per account, and a single one is its own most frequent value. Counts
    and values are combined before the shuffle, so the copies of an account repeated very
    often make one row per task. The shuffle is that of a join by account, so the check
    adds no exchange, sort or scan to such a join. Accounts that no join reads are not
    checked.
    """
    others = [c for c in accounts.columns if c != "account_id"]
    counted = accounts.where("account_id IS NOT NULL").groupBy("account_id").agg(
        F.count("*").alias("_listed"), F.mode(F.struct(F.lit(True), *others)).alias("_row")
    )
    values = {name: F.col(f"_row.`{name}`") for name in others}
    rows = _without_repeats(counted)
    return rows.select(*(values.get(c, F.col(c)).alias(c) for c in accounts.columns))


def _without_repeats(counted: DataFrame) -> DataFrame:
    """The rows as they are, or a failure when they run if ``_listed`` exceeds one."""
    return counted.where(F.when(F.col("_listed") > 1, _failure()).otherwise(True))


def _failure() -> Column:
    message = F.concat(
        F.lit("account listed more than once: "), F.col("account_id").cast("string")
    )
    return F.raise_error(message).cast("boolean")
