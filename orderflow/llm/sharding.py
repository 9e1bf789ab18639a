"""Shards of near-equal size by minimax contiguous partition.

Equal texts form one atomic group. Groups are ordered by the MD5 of their text, except
that a group as large as a fair share or larger comes first and has a shard to itself.
The smallest capacity for which a greedy pass fits the ordered groups into the shards is
found by binary search, and the order is cut where that pass cuts.

Group sizes stay distributed. The driver sees sums over ranges of hashes: the greedy pass
runs on them once as if ranges could be cut anywhere and once as if they could not. Only
ranges that hold a cut in between are split further, until both passes agree, so a few
thousand sums travel in each round whatever the number of groups, and the result is that
of the pass over all groups.

Null texts count as empty and form a group with them. Documents repeated in all columns
stay together and get slots in any order. An empty table gives an empty one. Only id and
text are read.
"""

from __future__ import annotations

from bisect import bisect_right
from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderflow.llm.common import staged

EXTRA = 16
FIRST_DIGITS = 3
SLOT_ROWS = 2000
"""Rows of a document bucket in which slots are numbered, about."""


@dataclass(frozen=True)
class Plan:
    """Groups with a shard of their own, the first digits at each cut, and the capacity."""

    alone: list[str]
    cuts: list[str]
    capacity: int

    def shard(self, key: Column) -> Column:
        first = len(self.alone)
        found = F.lit(first + len(self.cuts))
        for n in range(len(self.cuts) - 1, -1, -1):
            found = F.when(key < self.cuts[n], first + n).otherwise(found)
        for n, group in enumerate(self.alone):
            found = F.when(key == group, n).otherwise(found)
        return found.cast("int")


class Ranges:
    """Sums over ranges of hashes in order, some of them a single group."""

    def __init__(self, rows: list[tuple[str, int, int, int]]) -> None:
        self.rows = sorted(rows)
        self.ends = np.cumsum([r[1] for r in self.rows], dtype=np.int64)
        self.starts = np.concatenate(([0], self.ends[:-1])).astype(np.int64)
        self.single = np.array([r[2] == 1 for r in self.rows], bool)
        self.total = int(self.ends[-1]) if self.rows else 0
        self.largest = max((r[3] for r in self.rows), default=0)

    def passes(self, capacity: int, shards: int, whole: bool) -> list[int]:
        """Where each shard of a greedy pass ends; ``whole``: no range is cut."""
        position, found = 0, []
        for _ in range(shards):
            goal = position + capacity
            n = bisect_right(self.ends, goal)
            edge = int(self.ends[n - 1]) if n else 0
            position = max(position, edge)
            if not whole and n < len(self.rows) and not self.single[n]:
                position = goal
            found.append(position)
        return found

    def smallest(self, shards: int, whole: bool) -> int:
        """The smallest capacity with which a pass reaches the end."""
        low, high = max(self.largest, -(-self.total // shards)), max(self.total, 1)
        while low < high:
            middle = (low + high) // 2
            if self.passes(middle, shards, whole)[-1] >= self.total:
                high = middle
            else:
                low = middle + 1
        return low

    def cut_inside(self, shards: int) -> tuple[list[str], int]:
        """Ranges that may hold a cut, and the capacity, exact if there are none."""
        low, high = self.smallest(shards, False), self.smallest(shards, True)
        before, after = self.passes(low, shards, True), self.passes(high, shards, False)
        inside = np.zeros(len(self.rows), bool)
        for a, b in zip(before[:-1], after[:-1]):
            first = bisect_right(self.ends, a)
            last = int(np.searchsorted(self.starts, b, "left"))
            inside[first:last] = True
        return [self.rows[n][0] for n in np.flatnonzero(inside & ~self.single)], high


def _sums(groups: DataFrame, prefix: Column) -> DataFrame:
    return groups.groupBy(prefix.alias("prefix")).agg(
        F.sum("size").cast("long").alias("size"),
        F.count("*").alias("groups"),
        F.max("size").cast("long").alias("largest"),
    )


def plan(groups: DataFrame, shards: int) -> Plan:
    """The partition of ``key`` (unique hex digits) and ``size`` into shards."""
    total = int(groups.agg(F.sum("size")).first()[0] or 0)
    alone: list[str] = []
    left, room = total, shards
    largest = groups.orderBy(F.desc("size"), "key").limit(shards).select("key", "size").collect()
    for row in largest:
        if room > 1 and row["size"] * room >= left:
            alone.append(row["key"])
            left, room = left - int(row["size"]), room - 1
    rest = groups.where(~F.col("key").isin(alone)) if alone else groups
    found = _sums(rest, F.substring("key", 1, FIRST_DIGITS)).collect()
    ranges = Ranges([tuple(r) for r in found])
    digits = FIRST_DIGITS
    while True:
        split, capacity = ranges.cut_inside(room)
        if not split:
            break
        digits += 1
        wanted = groups.sparkSession.createDataFrame([(p,) for p in split], "wanted string")
        length = F.length("wanted")
        finer = rest.select("key", "size", F.substring("key", 1, digits).alias("prefix"))
        parts = [
            finer.join(F.broadcast(wanted.where(length == n)), F.substring("key", 1, n) == F.col("wanted"))
            for n in sorted({len(p) for p in split})
        ]
        rows = _sums(reduce(DataFrame.union, parts), F.col("prefix")).collect()
        kept = set(split)
        ranges = Ranges([r for r in ranges.rows if r[0] not in kept] + [tuple(r) for r in rows])
    ends = ranges.passes(capacity, room, True)[:-1]
    cuts = []
    for end in ends:
        n = bisect_right(ranges.ends, end)
        cuts.append(ranges.rows[n][0] if n < len(ranges.rows) else "g")
    return Plan(alone, cuts, capacity)


def sharded(
    documents: DataFrame, shards: int = 40, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``key, size, text_crc32, shard, slot`` of every document.

    Slots count from 0 without gaps in each shard. They are numbered in small buckets of
    documents, whose places follow from the counts of the buckets before, so a shard is
    never sorted in one task. Rows of one id and one text are counted and go in pieces of
    ``SLOT_ROWS``, so neither very many null ids nor repeated rows are one task.
    """
    content = F.coalesce(F.col(text), F.lit(""))
    digests = staged(
        documents.select(
            F.col(key).alias("id"),
            (F.octet_length(content) + EXTRA).cast("long").alias("size"),
            F.crc32(content).alias("text_crc32"),
            F.md5(content).alias("key"),
        ),
        "sharding-digests",
    )
    groups = digests.groupBy("key").agg(F.sum("size").alias("size"), F.count("*").alias("rows"))
    groups = staged(groups, "sharding-groups")
    cut = plan(groups, shards)
    rows = groups.agg(F.sum("rows")).first()[0] or 0
    buckets = max(64, int(rows) // SLOT_ROWS)
    pieces = F.sequence(F.lit(0), F.expr(f"int((rows - 1) div {SLOT_ROWS})"))
    equal = digests.groupBy("id", "size", "text_crc32", "key").agg(F.count("*").alias("rows"))
    equal = equal.withColumn("piece", F.explode(pieces))
    left = F.col("rows") - F.col("piece") * SLOT_ROWS
    placed = equal.select(
        "id",
        "size",
        "text_crc32",
        "key",
        "piece",
        F.least(left, F.lit(SLOT_ROWS)).alias("rows"),
        cut.shard(F.col("key")).alias("shard"),
        F.pmod(F.xxhash64(F.col("id").cast("string"), "key", "piece"), buckets).alias("bucket"),
    )
    counts = placed.groupBy("shard", "bucket").agg(F.sum("rows").alias("rows"))
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(
        "shard", "bucket", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("before")
    )
    inside = Window.partitionBy("shard", "bucket").orderBy("id", "key", "piece")
    inside = inside.rowsBetween(Window.unboundedPreceding, -1)
    numbered = placed.withColumn("place", F.coalesce(F.sum("rows").over(inside), F.lit(0)))
    numbered = numbered.join(counts, ["shard", "bucket"])
    row = F.explode(F.sequence(F.lit(0).cast("long"), F.col("rows") - 1)).alias("row")
    return numbered.select("*", row).select(
        F.col("id").alias(key),
        "size",
        "text_crc32",
        "shard",
        (F.col("before") + F.col("place") + F.col("row")).cast("long").alias("slot"),
    )
