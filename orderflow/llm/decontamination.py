"""Passages of a benchmark in documents, by the q-gram lemma.

Benchmark items are cut into overlapping windows; a passage is a place where a window
occurs with at most ``e`` edits, ``e`` being a share of its length. An alignment with so
few edits keeps at least ``n - q + 1 - q * e`` of the window's character q-grams, and they
lie on ``e + 1`` neighbouring diagonals. So q-grams that document and window share are
counted in bands of ``2 (e + 1)`` diagonals, each overlapping the next by half; bands below
that bound are dropped, and the text of the others is aligned with the window in a band.

Both sides are compared in lower case with single spaces between words. Matching runs over
flat arrays of a batch of texts: rolling hashes of all q-grams, a bit table to drop most of
them, and binary search for the rest. The benchmark is worked through in blocks of bounded
size, one after the other; each is sent to the workers once and let go.

Null and empty texts hold no passage; a null or empty item occurs nowhere. An item shorter
than ``Q`` is searched for as it is. Texts are never cut. Repeated rows and repeated
items give repeated results; empty tables give none.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce
from itertools import chain

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderflow.llm.common import staged, with_columns

Q = 10
RATE = 0.08
"""Edits that a passage may have, for each of its characters."""
WINDOW = 160
STRIDE = 80
BLOCK = 2_000_000
"""Bytes of benchmark text in a block."""
PLACES = 1 << 21
"""Bytes of document text that are searched at once."""
TABLE_BITS = 20
_P = 0x9E3779B97F4A7C15 | 1

MATCH = "struct<item_id:bigint,edits:int,begin:int,end:int>"


def normal(text: str | None) -> bytes:
    return " ".join((text or "").lower().split()).encode("utf-8", "surrogatepass")


def rolling(data: np.ndarray) -> np.ndarray:
    """Hashes of all q-grams of bytes, put together from those of 1, 2, 4 and 8."""
    h, span, done, left, taken = data.astype(np.uint64) + np.uint64(1), 1, None, Q, 0
    while left:
        if left & 1:
            part = h[taken:]
            if done is None:
                done = part
            else:
                n = len(part)
                done = done[:n] * np.uint64(pow(_P, span, 2**64)) + part
            taken += span
        left >>= 1
        if left:
            h = h[:-span] * np.uint64(pow(_P, span, 2**64)) + h[span:] if len(h) > span else h[:0]
            span *= 2
    return done


class Index:
    """The windows of a block of items with their q-grams."""

    def __init__(self, items: list[tuple[int, str | None]]) -> None:
        self.short: list[tuple[int, bytes]] = []
        self.item: list[int] = []
        texts: list[bytes] = []
        for item, text in items:
            content = normal(text)
            if len(content) < Q:
                self.short += [(item, content)] if content else []
                continue
            last = max(0, len(content) - WINDOW)
            for begin in sorted({*range(0, last, STRIDE), last}):
                self.item.append(item)
                texts.append(content[begin : begin + WINDOW])
        self.texts = [np.frombuffer(t, np.uint8) for t in texts]
        self.length = np.array([len(t) for t in texts], np.int64)
        self.edits = np.minimum((self.length * RATE).astype(np.int64), (self.length - Q) // Q)
        self.least = self.length - Q + 1 - Q * self.edits
        grams = [rolling(t) for t in self.texts]
        hashes = np.concatenate([*grams, np.zeros(0, np.uint64)])
        windows = np.repeat(np.arange(len(texts)), [len(g) for g in grams])
        places = np.concatenate([*(np.arange(len(g)) for g in grams), np.zeros(0, np.int64)])
        order = np.argsort(hashes, kind="stable")
        self.hashes, first = np.unique(hashes[order], return_index=True)
        self.first = np.append(first, len(order))
        self.window, self.place = windows[order], places[order].astype(np.int64)
        self.table = np.zeros(1 << TABLE_BITS, bool)
        self.table[(self.hashes >> np.uint64(64 - TABLE_BITS)).astype(np.int64)] = True

    def shared(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Window and diagonal of every q-gram that the bytes share with a window."""
        if len(data) < Q or not len(self.hashes):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        hashes = rolling(data)
        at = np.flatnonzero(self.table[(hashes >> np.uint64(64 - TABLE_BITS)).astype(np.int64)])
        slot = np.minimum(np.searchsorted(self.hashes, hashes[at]), len(self.hashes) - 1)
        exact = self.hashes[slot] == hashes[at]
        at, slot = at[exact], slot[exact]
        times = self.first[slot + 1] - self.first[slot]
        row = np.repeat(self.first[slot], times)
        row += np.arange(len(row)) - np.repeat(np.cumsum(times) - times, times)
        return self.window[row], np.repeat(at, times) - self.place[row]

    def regions(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Windows and first diagonals of the bands that hold enough shared q-grams."""
        window, diagonal = self.shared(data)
        band = (diagonal + WINDOW) // (self.edits[window] + 1)
        key = np.concatenate(((window << 40) | band, (window << 40) | (band - 1)))
        key, count = np.unique(key, return_counts=True)
        window, band = key >> 40, key & ((1 << 40) - 1)
        enough = count >= self.least[window]
        window, band = window[enough], band[enough]
        return window, band * (self.edits[window] + 1) - WINDOW

    def aligned(self, data: np.ndarray, window: np.ndarray, diagonal: np.ndarray):
        """Fewest edits of each region, and where its passage begins and ends in the bytes."""
        best = np.full(len(window), 1 << 20)
        begin, end = np.zeros(len(window), np.int64), np.zeros(len(window), np.int64)
        shapes = np.unique(np.stack((self.length[window], self.edits[window]), 1), axis=0)
        for length, edits in shapes.tolist():
            rows = np.flatnonzero((self.length[window] == length) & (self.edits[window] == edits))
            for part in np.array_split(rows, len(rows) // 512 + 1):
                pattern = np.stack([self.texts[w] for w in window[part]])
                found = banded(data, pattern, diagonal[part], 2 * edits + 2)
                best[part], begin[part], end[part] = found
        return best, begin, end


def banded(data: np.ndarray, pattern: np.ndarray, start: np.ndarray, width: int):
    """Edit distances of whole patterns to any piece of the bytes, inside bands of diagonals.

    Row ``i`` of the band holds the distances of the first ``i`` letters to pieces that end
    at ``start + i + column``. Begins are carried along.
    """
    count, length = pattern.shape
    column = np.arange(width)
    far = 1 << 20
    begin = start[:, None] + column
    cost = np.where((begin >= 0) & (begin <= len(data)), 0, far)
    padded = np.append(data, 0)
    for i in range(length):
        end = start[:, None] + i + 1 + column
        letter = padded[np.clip(end - 1, 0, len(data))]
        kept = np.where(end >= 1, cost + (letter != pattern[:, i, None]), far)
        # A letter of the pattern is left out: from the column to the right.
        skipped = np.full_like(cost, far)
        skipped[:, :-1] = cost[:, 1:] + 1
        fewer = skipped < kept
        begin = np.where(fewer, np.roll(begin, -1, axis=1), begin)
        # A letter of the text is added: along the row, a prefix minimum.
        level = np.where(fewer, skipped, kept) - column
        low = np.minimum.accumulate(level, axis=1)
        source = np.maximum.accumulate(np.where(level == low, column, 0), axis=1)
        begin = np.take_along_axis(begin, source, axis=1)
        cost = np.where((end >= 0) & (end <= len(data)), low + column, far)
    pick = cost.argmin(axis=1)
    row = np.arange(count)
    return cost[row, pick], begin[row, pick], start + length + pick


def passages(index: Index, texts: list[str | None]) -> list[list[dict]]:
    """For each text one match for each item that occurs: edits, and begin and end in letters."""
    found: list[list[dict]] = [[] for _ in texts]
    coded = [normal(t) for t in texts]
    for n, content in enumerate(coded):
        for item, short in index.short:
            at = content.find(short)
            if at >= 0:
                found[n].append({"item_id": item, "edits": 0, "begin": at, "end": at + len(short)})
    gap = b"\0" * (Q + WINDOW)
    first = 0
    while first < len(coded):
        last, room = first + 1, PLACES - len(coded[first])
        while last < len(coded) and room >= len(coded[last]):
            room -= len(coded[last])
            last += 1
        data = np.frombuffer(gap.join(coded[first:last]), np.uint8)
        starts = np.cumsum([0, *(len(t) + len(gap) for t in coded[first : last - 1])])
        window, diagonal = index.regions(data)
        edits, begin, end = index.aligned(data, window, diagonal)
        good = edits <= index.edits[window] if len(window) else np.zeros(0, bool)
        best: dict[tuple[int, int], dict] = {}
        for w, e, b, z in zip(window[good], edits[good], begin[good], end[good]):
            text = int(np.searchsorted(starts, (b + z) // 2, "right")) - 1
            match = {
                "item_id": index.item[w],
                "edits": int(e),
                "begin": max(0, int(b - starts[text])),
                "end": min(len(coded[first + text]), int(z - starts[text])),
            }
            known = best.get((text, match["item_id"]))
            order = lambda m: (m["edits"], m["begin"], -m["end"])
            if known is None or order(match) < order(known):
                best[text, match["item_id"]] = match
        for (text, _), match in best.items():
            found[first + text].append(match)
        first = last
    for n, matches in enumerate(found):
        if matches:
            _to_text(texts[n], coded[n], matches)
            matches.sort(key=lambda m: (m["item_id"], m["begin"]))
    return found


def _to_text(text: str, content: bytes, matches: list[dict]) -> None:
    """Turns places in the compared bytes into places in the text, word by word."""
    words = [m.span() for m in re.finditer(r"\S+", text)]
    for match in matches:
        first = content.count(b" ", 0, match["begin"] + 1)
        last = content.count(b" ", 0, max(0, match["end"] - 1))
        match["begin"] = words[min(first, len(words) - 1)][0]
        match["end"] = words[min(max(first, last), len(words) - 1)][1]


def blocks(benchmark: DataFrame, key: str, text: str, size: int = BLOCK) -> Iterator[list]:
    """The items in blocks of bounded text, one after the other."""
    block, used = [], 0
    for row in benchmark.select(key, text).orderBy(key, text).toLocalIterator():
        block.append((row[0], row[1]))
        used += len((row[1] or "").encode("utf-8", "surrogatepass"))
        if used >= size:
            yield block
            block, used = [], 0
    if block:
        yield block


def with_matches(
    documents: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    block: int = BLOCK,
) -> DataFrame:
    """The rows with ``matches``: the best passage of each item that occurs in the text.

    One block of items is searched within the scan of the documents. With more, the rows are
    numbered and written once, and each block in turn leaves the matches of the rows that
    have any, so workers hold one index at a time however large the benchmark is.
    """
    context = documents.sparkSession.sparkContext
    found = documents.drop("matches") if text != "matches" else documents
    parts = blocks(benchmark.where(F.col(item).isNotNull()), item, item_text, block)

    def searched(rows: DataFrame, index) -> DataFrame:
        def start():
            return lambda texts: [passages(index.value, texts)]

        return with_columns(rows, [text], f"matches array<{MATCH}>", start)

    first, second = next(parts, []), next(parts, None)
    if second is None:
        return searched(found, context.broadcast(Index(first)))
    rows = found.select(*found.columns, F.monotonically_increasing_id().alias("_row"))
    rows = staged(rows, "decontamination-rows")
    hits = []
    for items in chain([first, second], parts):
        index = context.broadcast(Index(items))
        some = searched(rows.select("_row", text), index).where(F.size("matches") > 0)
        hits.append(staged(some.select("_row", "matches"), "decontamination-matches"))
        index.unpersist()
    whole = reduce(DataFrame.unionByName, hits).groupBy("_row")
    whole = whole.agg(F.flatten(F.collect_list("matches")).alias("_matches"))
    none = F.array().cast(f"array<{MATCH}>")
    joined = rows.join(whole, "_row", "left")
    kept = [c for c in found.columns if c != "matches"]
    return joined.select(*kept, F.coalesce("_matches", none).alias("matches"))


def contaminated(documents: DataFrame, benchmark: DataFrame, key: str = "doc_id") -> DataFrame:
    """``key, item_id, edits, begin, end`` for each document and item that occurs in it."""
    rows = with_matches(documents.select(key, "text"), benchmark)
    matches = rows.select(F.col(key).alias("_key"), F.explode("matches").alias("match"))
    return matches.select(F.col("_key").alias(key), "match.*")
