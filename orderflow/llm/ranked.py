"""The best documents for each query text, ranked by weighted terms, exactly.

**Scores.** Terms are runs of letters, digits and other characters beyond ASCII, A to Z in
lower case. N documents have a term, L is the number of all their terms, n that of one
document, df the number of documents with a term, tf how often it stands in one. A term
weighs ``floor(1000 ln((2 N + 2) / (2 df + 1)))``; a document's score is the sum over the
query's different terms of ``weight * (10^9 tf div (1000 tf + 20 m))`` in whole numbers,
where ``m = 50 + 50 n N div L``.

**Index.** Documents are dealt to segments as they come; each segment keeps the posting
lists of its documents for the queries' terms. A list longer than ``BLOCK`` documents is
clustered: some of its documents, evenly spaced, stand for clusters, and every other joins
the one most similar by the cosine of random projections of their term values. A cluster is
a block. Its summary holds for each term the largest value of its documents, rounded up to
one of 255 steps, so the sum of a query's terms in the summary is never below the score of
a document in the block.

**Search.** A document with a score stands in a block of one of the query's terms. The blocks
of its lists are taken by falling bound; a block is skipped only if its bound is below the
least score that still counts, and the documents of the others are scored in full. That
least score starts from the best of a small part of the documents, which is searched first
(about the square root of ``depth`` times all documents, so that both the part and what it
lets through grow slowly), and rises as a task goes on. Equal scores go by ascending id, so
bounds equal to it are not skipped. Every document is indexed; none is sampled away.

No posting leaves its task: the shuffle carries numbers of documents by term and the best
``depth`` rows of each query and task. A hot term or a hot query is spread over all tasks;
the last ranking goes in two steps over salted groups. Queries are searched in blocks of at
most about ``PAIRS`` query terms, one block after the other, so what goes to every worker is
bounded for any number of queries.

Null and empty texts have no terms: such documents count nowhere and such queries have no
rows. Every row of documents counts, repeated ones too; a null id ranks behind equal scores.
Rows with one query id, null included, are one query with the terms of all of them. Texts
are never cut. Only ids and texts are read, so other columns may have any names; an empty
table on either side gives an empty one.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from heapq import nsmallest
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from orderflow.llm.common import small_batches, staged, with_columns

DEPTH = 50
BLOCK = 64
PAIRS = 8192
DENSE = 16 << 20
"""Bytes of a segment's table of steps, documents times terms."""
SKETCH = 16
SALTS = 32
MOST = 10**6
"""No term's value before weighting is larger."""
STEPS = 255
UPPER = np.arange(STEPS + 1) * MOST // STEPS

_LOWER = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 0x80 or chr(c).isalnum() else 32 for c in range(256)
)


def terms_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()


def query_terms(queries: DataFrame, key: str, text: str) -> DataFrame:
    """``item, term``: every different term of each query."""

    def start():
        return lambda texts: [[sorted({w.decode("utf-8", "replace") for w in terms_of(t)}) for t in texts]]

    rows = queries.select(F.col(key).alias("item"), F.col(text).alias("words"))
    split = with_columns(rows, ["words"], "terms array<string>", start)
    return split.select("item", F.explode("terms").alias("term")).distinct()


def forward(documents: DataFrame, key: str, text: str, vocabulary: list[str]) -> DataFrame:
    """``id, n, terms, counts``: each document's number of terms, and which of the vocabulary it
    has how often, as 32-bit numbers. Documents without any term are left out."""
    small_batches(documents.sparkSession)
    rows = documents.select(F.col(key).alias("id"), F.col(text).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    shared = documents.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = {term.encode("utf-8", "surrogatepass"): n for n, term in enumerate(shared.value)}
        width = max(1, len(number))
        for batch in batches:
            split = [terms_of(t) for t in batch.column(1).to_pylist()]
            lengths = np.array([len(s) for s in split], np.int64)
            found = np.concatenate([
                np.fromiter(map(number.get, s, repeat(-1)), np.int64, len(s)) for s in split
            ] or [np.zeros(0, np.int64)])
            at = np.repeat(np.arange(len(split)), lengths)[found >= 0]
            codes, counts = np.unique(at * width + found[found >= 0], return_counts=True)
            cuts = np.searchsorted(codes, np.arange(len(split) + 1) * width).tolist()
            terms, counts = (codes % width).astype("<i4"), counts.astype("<i4")
            parts = list(zip(cuts[:-1], cuts[1:]))
            keep = pa.array(lengths > 0)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(lengths),
                    pa.array([terms[a:b].tobytes() for a, b in parts], pa.binary()),
                    pa.array([counts[a:b].tobytes() for a, b in parts], pa.binary()),
                ],
                names=["id", "n", "terms", "counts"],
            ).filter(keep)

    return rows.mapInArrow(run, f"id {kind}, n long, terms binary, counts binary")


def statistics(rows: DataFrame, width: int) -> tuple[int, int, np.ndarray]:
    """Documents, all their terms, and how many documents have each term of the vocabulary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width + 2, np.int64)
        for batch in batches:
            terms = np.frombuffer(b"".join(batch.column(1).to_pylist()), "<i4")
            total[:width] += np.bincount(terms, minlength=width)
            total[width] += batch.num_rows
            total[width + 1] += int(batch.column(0).to_numpy().sum())
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["at", "times"])

    parts = rows.select("n", "terms").mapInArrow(run, "at long, times long")
    total = np.zeros(width + 2, np.int64)
    for at, times in parts.groupBy("at").agg(F.sum("times")).collect():
        total[at] = times
    return int(total[width]), int(total[width + 1]), total[:width]


def term_weights(documents: int, frequencies: np.ndarray) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * f + 1))) for f in frequencies.tolist()], np.int64)


class Segment:
    """Some documents with clustered posting lists and summaries of their blocks."""

    def __init__(self, lengths, starts, terms, counts, weights, documents: int, total: int) -> None:
        m = 50 + (50 * lengths * documents) // total
        room = np.diff(starts)
        doc = np.repeat(np.arange(len(lengths)), room)
        impact = (10**9 * counts) // (1000 * counts + 20 * m[doc])
        self.weights, self.starts, self.room, self.terms = weights, starts, room, terms
        self.values = impact * weights[terms]
        self.steps = np.zeros((len(lengths), len(weights)), np.uint8)
        self.steps[doc, terms] = -(-impact * STEPS // MOST)
        self._cluster(doc, self._directions(doc))

    def _directions(self, doc: np.ndarray) -> np.ndarray:
        """Each document's direction: its values on random axes, of length one."""
        axes = np.random.default_rng(17).normal(0, 1, (len(self.weights), SKETCH)).astype(np.float32)
        out = np.empty((len(self.room), SKETCH), np.float32)
        for k in range(SKETCH):
            out[:, k] = np.bincount(doc, self.values * axes[self.terms, k], len(self.room))
        return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-6)

    def _cluster(self, doc: np.ndarray, directions: np.ndarray) -> None:
        """Cuts the posting list of every term into blocks and sums these up."""
        by_term = doc[np.argsort(self.terms, kind="stable")]
        ends = np.cumsum(np.bincount(self.terms, minlength=len(self.weights))).tolist()
        self.blocks: list[np.ndarray] = []
        self.first = [0]
        begin = 0
        for end in ends:
            docs, begin = by_term[begin:end], end
            if len(docs) > BLOCK:
                stand = docs[:: BLOCK]
                own = (directions[docs] @ directions[stand].T).argmax(axis=1)
                order = np.argsort(own, kind="stable")
                cuts = np.flatnonzero(np.diff(own[order])) + 1
                self.blocks += np.split(docs[order], cuts)
            elif len(docs):
                self.blocks.append(docs)
            self.first.append(len(self.blocks))
        self.summaries = np.empty((len(self.blocks), len(self.weights)), np.uint8)
        for n, docs in enumerate(self.blocks):
            np.max(self.steps[docs], axis=0, out=self.summaries[n])

    def scores(self, docs: np.ndarray, asked: np.ndarray) -> np.ndarray:
        """The whole score of each document; ``asked`` is 1 for the query's terms, else 0."""
        room = self.room[docs]
        ends = np.cumsum(room)
        places = np.arange(ends[-1]) + np.repeat(self.starts[docs] - (ends - room), room)
        return np.add.reduceat(self.values[places] * asked[self.terms[places]], ends - room)

    def search(self, query: np.ndarray, least: int, take) -> None:
        """Gives documents and scores to ``take``, which returns the least score that counts."""
        lists = [np.arange(self.first[t], self.first[t + 1]) for t in query.tolist() if self.weights[t] > 0]
        near = np.concatenate([*lists, np.zeros(0, np.int64)])
        if not len(near):
            return
        bounds = UPPER[self.summaries[np.ix_(near, query)]] @ self.weights[query]
        order = np.argsort(-bounds, kind="stable")
        near, bounds = near[order], bounds[order]
        asked = np.zeros(len(self.weights), np.int64)
        asked[query] = 1
        seen = np.zeros(len(self.room), bool)
        at, size = 0, 8
        while at < len(near) and bounds[at] >= least:
            end = min(at + size, int(np.searchsorted(-bounds, -least, "right")))
            docs = np.unique(np.concatenate([self.blocks[b] for b in near[at:end].tolist()]))
            docs = docs[~seen[docs]]
            seen[docs] = True
            if len(docs):
                least = take(docs, self.scores(docs, asked))
            at, size = end, 2 * size


class Search:
    """The best documents of every query among those added so far."""

    def __init__(self, queries, weights, documents: int, total: int, floors: list[int], depth: int) -> None:
        self.queries, self.weights, self.documents, self.total = queries, weights, documents, total
        self.floors, self.depth = list(floors), depth
        self.best: list[list[tuple]] = [[] for _ in queries]

    def add(self, ids: list, lengths, rooms, terms, counts) -> None:
        starts = np.concatenate(([0], np.cumsum(rooms)))
        segment = Segment(lengths, starts, terms, counts, self.weights, self.documents, self.total)
        for n, query in enumerate(self.queries):
            segment.search(query, self.floors[n], lambda docs, scores, n=n: self._take(n, ids, docs, scores))

    def _take(self, n: int, ids: list, docs: np.ndarray, scores: np.ndarray) -> int:
        good = scores >= self.floors[n]
        new = [
            (-s, ids[d] is None, ids[d] if ids[d] is not None else 0)
            for d, s in zip(docs[good].tolist(), scores[good].tolist())
        ]
        if new:
            self.best[n] = nsmallest(self.depth, self.best[n] + new)
            if len(self.best[n]) == self.depth:
                self.floors[n] = max(self.floors[n], -self.best[n][-1][0])
        return self.floors[n]


def searched(rows: DataFrame, queries: list[np.ndarray], statistic, floors: list[int], depth: int) -> DataFrame:
    """``query, id, score``: each task's best documents for every query, none below its floor."""
    shared = rows.sparkSession.sparkContext.broadcast((queries, *statistic, floors))
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, weights, documents, total, floors = shared.value
        search = Search(queries, weights, documents, total, floors, depth)
        most = max(256, DENSE // max(1, len(weights)))
        waiting: list[pa.RecordBatch] = []
        schema = None

        def flush() -> None:
            table = pa.Table.from_batches(waiting).combine_chunks()
            waiting.clear()
            terms, counts = (
                np.frombuffer(b"".join(table.column(c).to_pylist()), "<i4").astype(np.int64)
                for c in ("terms", "counts")
            )
            rooms = np.array([len(x) // 4 for x in table.column("terms").to_pylist()], np.int64)
            search.add(table.column("id").to_pylist(), table.column("n").to_numpy(), rooms, terms, counts)

        for batch in batches:
            schema = batch.schema.field("id").type
            batch = batch.filter(pa.compute.greater(pa.compute.binary_length(batch.column("terms")), 0))
            while batch.num_rows:
                free = most - sum(b.num_rows for b in waiting)
                waiting.append(batch.slice(0, free))
                batch = batch.slice(free)
                if sum(b.num_rows for b in waiting) >= most:
                    flush()
        if waiting:
            flush()
        for n, best in enumerate(search.best):
            if best:
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(best), n, np.int32)),
                        pa.array([None if null else i for _, null, i in best], schema),
                        pa.array([-s for s, _, _ in best], pa.int64()),
                    ],
                    names=["query", "id", "score"],
                )

    return rows.mapInArrow(run, f"query int, id {kind}, score long")


def best_of(rows: DataFrame, depth: int) -> DataFrame:
    """``query, id, score, rank``: the best rows of each query, in two steps so that a query with
    very many rows is no hot group."""
    order = [F.desc("score"), F.asc_nulls_last("id")]
    salted = Window.partitionBy("query", "salt").orderBy(*order)
    some = rows.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(SALTS)))
    some = some.withColumn("rank", F.row_number().over(salted)).where(F.col("rank") <= depth)
    every = Window.partitionBy("query").orderBy(*order)
    return some.drop("salt").withColumn("rank", F.row_number().over(every)).where(F.col("rank") <= depth)


def _block(documents: DataFrame, pairs: list, depth: int, key: str, text: str) -> tuple[DataFrame, list] | None:
    """The best rows for the queries of one block, and the queries' ids by number."""
    vocabulary = sorted({term for _, term in pairs})
    number = {term: n for n, term in enumerate(vocabulary)}
    ids = list(dict.fromkeys(item for item, _ in pairs))
    place = {item: n for n, item in enumerate(ids)}
    lists: list[list[int]] = [[] for _ in ids]
    for item, term in pairs:
        lists[place[item]].append(number[term])
    queries = [np.array(sorted(found), np.int64) for found in lists]
    rows = staged(forward(documents, key, text, vocabulary), "ranked-forward")
    total, length, frequencies = statistics(rows, len(vocabulary))
    if not total:
        return None
    statistic = (term_weights(total, frequencies), total, length)
    floors = [1] * len(queries)
    parts = max(1, math.isqrt(total // depth))
    if parts > 1:
        few = rows.where(F.pmod(F.xxhash64("id"), F.lit(parts)) == 0)
        last = best_of(searched(few, queries, statistic, floors, depth), depth).where(F.col("rank") == depth)
        for row in last.collect():
            floors[row.query] = row.score
    return best_of(searched(rows, queries, statistic, floors, depth), depth), ids


def ranked(
    documents: DataFrame,
    queries: DataFrame,
    depth: int = DEPTH,
    key: str = "doc_id",
    text: str = "text",
    query_key: str = "item_id",
    query_text: str = "text",
    pairs: int = PAIRS,
) -> DataFrame:
    """``query_key, rank, key, score``: the ``depth`` best documents with a score for each query."""
    spark = documents.sparkSession
    kinds = {query_key: queries.schema[query_key].dataType, key: documents.schema[key].dataType}
    terms = staged(query_terms(queries, query_key, query_text), "ranked-queries")
    blocks = max(1, -(-terms.count() // pairs))
    found = []
    for n in range(blocks):
        some = terms.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == n).collect()
        block = _block(documents, [tuple(r) for r in some], depth, key, text) if some else None
        if block:
            rows, ids = block
            schema = StructType([StructField("query", LongType()), StructField("item", kinds[query_key])])
            names = spark.createDataFrame(list(enumerate(ids)), schema)
            rows = rows.join(F.broadcast(names), "query").select(
                F.col("item").alias(query_key), "rank", F.col("id").alias(key), "score"
            )
            found.append(rows if blocks == 1 else staged(rows, "ranked-rows"))
    if not found:
        return spark.createDataFrame(
            [],
            StructType([
                StructField(query_key, kinds[query_key]), *StructType.fromDDL("rank int"),
                StructField(key, kinds[key]), *StructType.fromDDL("score long"),
            ]),
        )
    out = found[0]
    for rows in found[1:]:
        out = out.union(rows)
    return out
