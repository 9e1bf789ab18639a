"""Readers for the three input tables in CSV, JSON or Parquet."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from orderflow import schemas
from orderflow.operators.filters import successful_transactions, valid_orders

CORRUPT_RECORD = "_corrupt_record"


def _format_of(path: str) -> str:
    # Also finds the suffix in front of one for compression.
    suffixes = path.rstrip("/").rsplit("/", 1)[-1].split(".")[1:]
    return next((name for name in ("json", "parquet") if name in suffixes), "csv")


def read_table(
    spark: SparkSession,
    path: str,
    schema: StructType,
    format: str | None = None,
    money: str = "double",
    keep_corrupt: bool = False,
    reject_corrupt: bool = False,
    **options,
) -> DataFrame:
    """Read a table with a fixed schema.

    ``format`` defaults to the suffix of the path, CSV without one. A CSV header
    that does not match the schema is an error, while an unreadable value becomes
    NULL; ``keep_corrupt`` adds the raw text of such records in
    ``_corrupt_record``, and ``reject_corrupt`` leaves them out; ``rejected_records``
    returns them. ``money="decimal"`` turns the double columns into DECIMAL(18,2), whose
    sums do not depend on the order of addition; an amount of 10**16 or more stops the job,
    since as NULL it would pass unseen.
    """
    if money not in ("double", "decimal"):
        raise ValueError(f"money must be 'double' or 'decimal', not {money!r}")
    format = format or _format_of(path)
    reader = spark.read
    if format == "csv":
        reader = reader.option("header", True).option("enforceSchema", False)
    marked = (keep_corrupt or reject_corrupt) and format in ("csv", "json")
    if marked:
        # Else a record would count as unreadable by the columns that a query reads.
        reader = reader.option("columnPruning", False)
        schema = StructType([*schema.fields, StructField(CORRUPT_RECORD, StringType())])
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT_RECORD)
    table = reader.options(**options).schema(schema).format(format).load(path)
    if marked:
        # Always true, but reads all columns: Spark only parses values that a query reads.
        table = table.where(F.xxhash64(*schema.names) >= F.lit(-(2**63)))
    if reject_corrupt and marked:
        table = table.where(F.col(CORRUPT_RECORD).isNull())
        table = table if keep_corrupt else table.drop(CORRUPT_RECORD)
    if money == "decimal":
        table = table.withColumns(
            {
                field.name: F.col(field.name).cast("decimal(18,2)")
                for field in schema
                if field.name in table.columns and field.dataType.typeName() == "double"
            }
        )
    return table


def write_table(
    table: DataFrame, path: str, schema: StructType, format: str | None = None, **options
) -> None:
    """Write a table as files that ``read_table`` reads back as the same rows.

    Columns come in the schema's order and types; one that the table lacks is NULL.
    Values that a file's text can't tell from NULL are not told apart: an empty string in
    CSV. Money of type DECIMAL is written digit by digit, so ``money="decimal"`` reads the
    same amounts. A name that is taken is an error.
    """
    format = format or _format_of(path)
    columns = []
    for field in schema:
        column = F.col(field.name) if field.name in table.columns else F.lit(None)
        held = table.schema[field.name].dataType if field.name in table.columns else field.dataType
        exact = held.typeName() == "decimal" and format != "parquet"
        columns.append((column if exact else column.cast(field.dataType)).alias(field.name))
    writer = table.select(*columns).write.format(format).options(**options)
    (writer.option("header", True) if format == "csv" else writer).save(path)


def rejected_records(
    spark: SparkSession, path: str, schema: StructType, **options
) -> DataFrame:
    """The records that do not fit the schema, as far as they could be read, with their text.

    Options are those of ``read_table``. Parquet files have no such records.
    """
    table = read_table(spark, path, schema, **{**options, "keep_corrupt": True})
    if CORRUPT_RECORD not in table.columns:
        return table.withColumn(CORRUPT_RECORD, F.lit(None).cast("string")).where("false")
    return table.where(F.col(CORRUPT_RECORD).isNotNull())


def load_accounts(spark: SparkSession, path: str, **options) -> DataFrame:
    """All accounts. Options are those of ``read_table``."""
    return read_table(spark, path, schemas.ACCOUNTS, **options)


def load_orders(spark: SparkSession, path: str, **options) -> DataFrame:
    """Completed and pending orders. Options are those of ``read_table``."""
    return valid_orders(read_table(spark, path, schemas.ORDERS, **options))


def load_transactions(spark: SparkSession, path: str, **options) -> DataFrame:
    """Successful transactions. Options are those of ``read_table``."""
    return successful_transactions(read_table(spark, path, schemas.TRANSACTIONS, **options))
