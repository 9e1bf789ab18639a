"""Connected components of a graph kept as a DataFrame of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderflow.llm.common import staged


def _mark(links: DataFrame) -> tuple[int, int]:
    row = links.agg(F.count("*"), F.sum(F.xxhash64("high", "low").cast("decimal(38,0)"))).first()
    return row[0], row[1]


def components(links: DataFrame) -> DataFrame:
    """``node, component`` of all nodes with a link: the smallest node that links lead to.

    ``links`` has ``a`` and ``b``. Links are replaced by links to the smallest neighbour, from
    both ends in turn, until nothing changes; then every node hangs on its smallest one. Each
    round is written to the shared folder. Minima are combined before they are shuffled, so
    a node with very many links is no hot spot there.
    """
    edges = links.where("a <> b").select(
        F.greatest("a", "b").alias("high"), F.least("a", "b").alias("low")
    )
    edges = staged(edges.distinct(), "links")
    mark = _mark(edges)
    while mark[0]:
        both = edges.select(F.col("high").alias("v"), F.col("low").alias("u")).union(
            edges.select(F.col("low").alias("v"), F.col("high").alias("u"))
        )
        least = both.groupBy("v").agg(F.min("u").alias("u"))
        least = least.select("v", F.least("v", "u").alias("m"))
        large = both.where("u > v").join(least, "v")
        large = large.select(F.col("u").alias("high"), F.col("m").alias("low")).distinct()
        least = large.groupBy("high").agg(F.min("low").alias("m"))
        small = large.join(least, "high").where("low <> m")
        small = small.select(F.col("low").alias("high"), F.col("m").alias("low"))
        edges = staged(
            small.union(least.select("high", F.col("m").alias("low"))).distinct(), "links"
        )
        before, mark = mark, _mark(edges)
        if mark == before:
            break
    roots = edges.select(F.col("low").alias("node"), F.col("low").alias("component")).distinct()
    return edges.select(F.col("high").alias("node"), F.col("low").alias("component")).union(roots)
