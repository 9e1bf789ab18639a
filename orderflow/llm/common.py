"""What the operators share: reading tables, shared staging folders, label splits."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

WHITE = " \t\n\x0b\x0c\r"
"""The white space between words; ``bytes.split()`` splits at the same characters."""

FEW_ROWS = 1000
FEW_BYTES = 8 << 20
"""Rows and bytes of an Arrow batch; a batch of the longest texts has a few rows only."""


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Bounds the rows and the bytes that a Python worker holds at once."""
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > FEW_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(FEW_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(FEW_BYTES))


def shared_folder(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; without one, the warehouse, or locally a temporary folder."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if spark.sparkContext.master.startswith("local") and "cluster" not in spark.sparkContext.master:
        folder = tempfile.mkdtemp(prefix="orderflow-")
    else:
        folder = spark.conf.get("spark.sql.warehouse.dir")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def staged(table: DataFrame, name: str) -> DataFrame:
    """Writes the table to the shared folder and reads it back, which cuts its lineage.

    Executors may be lost at any time after; what was written stays.
    """
    path = f"{shared_folder(table.sparkSession)}/{name}-{uuid.uuid4().hex}"
    table.write.parquet(path)
    return table.sparkSession.read.schema(table.schema).parquet(path)


def remainder(doc_id: Column, parts: int = 5) -> Column:
    """crc32 of the id as text, modulo ``parts``: the fold of a document."""
    return F.crc32(doc_id.cast("string")) % parts


def slices(texts: DataFrame, key: Column, sample: int) -> DataFrame:
    """At most about ``sample`` rows, those with the smallest hashes of the key.

    The rows that are kept depend on keys alone, so a rerun keeps the same ones.
    """
    rows = texts.count()
    if rows <= sample:
        return texts
    parts = 2**31 - 1
    return texts.where(F.pmod(F.xxhash64(key.cast("string")), parts) < int(parts * sample / rows))


def with_columns(
    table: DataFrame,
    inputs: list[str],
    schema: str,
    start: Callable[[], Callable[..., list[list]]],
) -> DataFrame:
    """The table's rows with more columns, worked out in Arrow batches.

    ``start`` runs once in each task; what it gives takes the lists of the input columns
    and returns one list for each new column. A new column replaces one of its name.
    """
    small_batches(table.sparkSession)
    added = StructType.fromDDL(schema)
    names = [c for c in table.columns if c not in added.names]
    reads = [c for c in inputs if c not in names]
    rows = table.select(*names, *(F.col(c).alias(f"_read_{c}") for c in reads))
    at = [rows.columns.index(c if c in names else f"_read_{c}") for c in inputs]
    kinds = to_arrow_schema(added)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = start()
        for batch in batches:
            found = work(*(batch.column(i).to_pylist() for i in at))
            arrays = [pa.array(x, f.type, from_pandas=False) for x, f in zip(found, kinds)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(names)], *arrays], names=[*names, *added.names]
            )
        pa.default_memory_pool().release_unused()

    kept = rows.select(*names).schema.fields
    return rows.mapInArrow(run, StructType([*kept, *added.fields]))


def labelled(
    documents: DataFrame, labels: DataFrame, label: str, sample: int, fold: int | None = 0
) -> DataFrame:
    """``doc_id, text, label`` of at most about ``sample`` labelled documents outside the fold.

    A label given twice counts at its larger value; a document found twice gives one row.
    The sample is bounded, so its ids are broadcast.
    """
    known = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull())
    if fold is not None:
        known = known.where(remainder(F.col("doc_id")) != fold)
    known = known.groupBy("doc_id").agg(F.max(label).alias("label"))
    known = slices(known, F.col("doc_id"), sample)
    rows = documents.select("doc_id", "text").join(F.broadcast(known), "doc_id")
    return rows.groupBy("doc_id", "label").agg(F.min("text").alias("text"))
