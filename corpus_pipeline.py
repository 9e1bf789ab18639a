"""A training corpus from raw documents: five stages, each written and read again.

Each stage works on all that the one before kept. All but the last return the columns of
``documents``; the last returns token ids.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderflow.llm import bpe, decontamination, jaccard, quality, toxicity
from orderflow.llm.common import read, staged
from orderflow.llm.queries import tokenizer_file

MOST_TOXIC = 0.5


def kept_by(stage: Callable) -> Callable:
    """A stage that sees only id and text; other columns pass it by, whatever their names are."""

    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        others = [c for c in docs.columns if c not in ("doc_id", "text")]
        aside = [F.col(f"`{c}`").alias(f"_aside_{n}") for n, c in enumerate(others)]
        found = stage(spark, docs.select("doc_id", "text", *aside), sf_dir)
        back = {c: F.col(f"_aside_{n}").alias(c) for n, c in enumerate(others)}
        return found.select(*(back.get(c, F.col(c)) for c in map(str, docs.columns)))

    return run


@kept_by
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the string-kernel machine finds less toxic than ``MOST_TOXIC``."""
    machine = toxicity.fit(docs, read(spark, sf_dir, "labels"))
    return toxicity.scored(docs, machine).where(F.col("toxicity") < MOST_TOXIC).select(docs.columns)


@kept_by
def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither a base rule nor the trees reject."""
    trees = quality.fit(docs, read(spark, sf_dir, "labels"))
    return quality.scored(docs, trees).where("kept").select(docs.columns)


@kept_by
def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that links of 90 % common shingles join."""
    return jaccard.representatives(docs)


@kept_by
def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    found = decontamination.with_matches(docs, read(spark, sf_dir, "benchmark"))
    return found.where(F.size("matches") == 0).select(docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document that is left, and digests of ids and decoded text."""
    tokens = bpe.round_trip(docs, tokenizer_file())
    return tokens.select(
        "doc_id",
        "ids",
        F.expr("octet_length(ids) div 4").cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("toxicity", drop_toxic),
    ("quality", keep_quality),
    ("near_copies", drop_near_copies),
    ("decontamination", drop_benchmark),
    ("bpe", encode),
]

ORACLE_SQL = None
"""SQL can't express the trained stages; ``tests/llm/test_pipeline.py`` checks each one."""


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
