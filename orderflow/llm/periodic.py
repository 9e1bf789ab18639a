"""Runs of repeated words: stretches that repeat with a period four times or more.

A run is a stretch of words with smallest period ``q`` and a length of at least ``TIMES * q``
and at least ``LEAST`` that no neighbouring word extends with that period.

**Lyndon arrays.** The first phase of Baier's suffix sorter puts suffixes into groups by
their longest Lyndon prefix. Groups are taken from the highest down; each place in a group
points to the last place before it in a lower group, and places that get equally many
pointers out of one group move into a new group right above theirs, whose prefix is their
old one with the pointers' prefixes behind it. So the prefixes' lengths are known directly
when the phase ends, in time linear in the words. This is done for the order of the words
and for the opposite one: every run has a root that is the longest Lyndon word from its
place under one of them.

**Runs.** A root of ``q`` words at place ``i`` is extended to both sides as far as words ``q``
apart are equal: longest common extensions, read from ranks of all stretches of 2, 4, 8, ...
words.

**Regions.** Three words that start inside a run, ``q + 2`` words before its end or earlier,
stand again at most ``q`` words later. Texts are first cut to the stretches where that holds
often enough in a row for some ``q``; a run lies in such a region as a whole, with its
neighbours. Most texts have none.

Null and empty texts have no words and no runs. Texts are never cut. Repeated rows give
repeated results and an empty table an empty one; only the id and the text are read, so
other columns may have any names.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderflow.llm.common import with_columns

TIMES = 4
LEAST = 6
PLACES = 400_000
"""Words of regions that are worked on at once; a longer region is taken alone."""

_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], np.uint64)

Run = tuple[int, int, int]


def lyndon_lengths(symbols: list[int]) -> list[int]:
    """Length of the longest Lyndon word that begins at each place; the end is less than all."""
    places: dict[int, list[int]] = {}
    for i, symbol in enumerate(symbols):
        places.setdefault(symbol, []).append(i)
    members = [places[symbol] for symbol in sorted(places)]
    group = [0] * len(symbols)
    for g, found in enumerate(members):
        for i in found:
            group[i] = g
    lengths = [1] * len(members)
    below = list(range(-1, len(members) - 1))
    above = list(range(1, len(members) + 1))
    above[-1:] = [-1]
    before = [-1] * len(symbols)
    done = bytearray(len(symbols))
    g = len(members) - 1
    while g >= 0:
        pointers: dict[int, int] = {}
        for i in members[g]:
            if group[i] != g:
                continue
            p = i - 1
            while p >= 0 and done[p]:
                p = before[p]
            before[i] = p
            done[i] = 1
            if p >= 0:
                pointers[p] = pointers.get(p, 0) + 1
        moved: dict[tuple[int, int], list[int]] = {}
        for p, times in pointers.items():
            moved.setdefault((times, group[p]), []).append(p)
        for times, old in sorted(moved, reverse=True):
            new, found = len(members), moved[times, old]
            members.append(found)
            lengths.append(lengths[old] + times * lengths[g])
            for p in found:
                group[p] = new
            below.append(old)
            above.append(above[old])
            below[above[old]] = new
            above[old] = new
        g = below[g]
    return [lengths[g] for g in group]


class Extensions:
    """Ranks of the stretches of 1, 2, 4, ... words of one array, equal for equal stretches."""

    def __init__(self, symbols: np.ndarray, longest: int) -> None:
        self.ranks = [symbols.astype(np.int64)]
        while 2 << len(self.ranks) <= 2 * longest and 1 << len(self.ranks) < len(symbols):
            last, size = self.ranks[-1], 1 << (len(self.ranks) - 1)
            pairs = last[:-size] * (int(last.max()) + 1) + last[size:]
            ranks = np.unique(pairs, return_inverse=True)[1]
            if int(ranks.max()) + 1 == len(ranks):
                break
            self.ranks.append(ranks.astype(np.int64))

    def right(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many words are equal from ``a`` and from the later ``b`` on."""
        total = np.zeros_like(a)
        for k in range(len(self.ranks) - 1, -1, -1):
            ranks, size = self.ranks[k], 1 << k
            for _ in range(1 + (k == len(self.ranks) - 1)):
                last = len(ranks) - 1
                x, y = np.minimum(a + total, last), np.minimum(b + total, last)
                total += size * ((b + total <= last) & (ranks[x] == ranks[y]))
        return total

    def left(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many words are equal up to ``a`` and up to the later ``b``, both left out."""
        total = np.zeros_like(a)
        for k in range(len(self.ranks) - 1, -1, -1):
            ranks, size = self.ranks[k], 1 << k
            for _ in range(1 + (k == len(self.ranks) - 1)):
                x, y = a - total - size, b - total - size
                inside = x >= 0
                total += size * (inside & (ranks[np.maximum(x, 0)] == ranks[np.maximum(y, 0)]))
        return total


def _stretches(marks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where stretches of set marks begin and end."""
    edges = np.diff(np.concatenate(([0], marks.astype(np.int8), [0])))
    return np.flatnonzero(edges > 0), np.flatnonzero(edges < 0)


def regions(symbols: np.ndarray, text: np.ndarray, lengths: np.ndarray) -> list[tuple[int, int]]:
    """Stretches of one text that together hold all runs with their neighbours, apart from each other.

    ``text`` numbers the text of each word; ``lengths`` are the words of the texts. Equal
    hashes of unlike words only make regions larger.
    """
    n = len(symbols) - 2
    if n < 1:
        return []
    s = symbols.astype(np.uint64)
    code = s[:-2] * _MIX[0] + s[1:-1] * _MIX[1] + s[2:] * _MIX[2] + text[:-2].astype(np.uint64) * _MIX[3]
    order = np.argsort(code, kind="stable")
    again = np.flatnonzero(code[order[1:]] == code[order[:-1]])
    distance = np.full(n, len(symbols), np.int64)
    distance[order[again]] = order[again + 1] - order[again]
    distance[text[:-2] != text[2:]] = len(symbols)
    limit = lengths[text[:-2]] // TIMES
    for _ in range(3):
        begin, end = _stretches(distance <= limit)
        period = (end - begin + 2) // (TIMES - 1)
        limit = np.zeros(n, np.int64)
        for a, b, q in zip(begin.tolist(), end.tolist(), period.tolist()):
            if b - a >= LEAST - 3:
                limit[a:b] = q
    begin, end = _stretches(distance <= limit)
    wide = end - begin >= LEAST - 3
    begin, end = begin[wide], end[wide]
    starts = np.concatenate(([0], np.cumsum(lengths)))
    owner = text[begin]
    end = end + (end - begin + 2) // (TIMES - 1) + 3
    begin = np.maximum(begin - 1, starts[owner])
    end = np.minimum(end, starts[owner + 1])
    found: list[tuple[int, int]] = []
    for a, b, t in zip(begin.tolist(), end.tolist(), owner.tolist()):
        if found and a < found[-1][1] and text[found[-1][0]] == t:
            found[-1] = (found[-1][0], max(b, found[-1][1]))
        else:
            found.append((a, b))
    return found


def runs_of(parts: list[np.ndarray]) -> np.ndarray:
    """Rows ``part, start, length, period`` of all runs of each sequence, in this order."""
    room = [len(p) for p in parts]
    first = np.cumsum([0, *(n + 1 for n in room)])
    flat = np.empty(first[-1], np.int64)
    # Each part ends with a symbol of its own, so that no extension leaves it.
    own = len(flat) + np.arange(len(parts))
    places: list[np.ndarray] = []
    periods: list[np.ndarray] = []
    for part, a, end in zip(parts, first.tolist(), own.tolist()):
        ranks = np.unique(part, return_inverse=True)[1]
        flat[a : a + len(part)] = ranks
        flat[a + len(part)] = end
        for symbols in (ranks, -ranks):
            lengths = np.array(lyndon_lengths(symbols.tolist()), np.int64)
            short = np.flatnonzero(lengths <= len(part) // TIMES)
            places.append(short + a)
            periods.append(lengths[short])
    roots = np.unique(np.stack((np.concatenate(places), np.concatenate(periods)), axis=1), axis=0)
    at, period = roots[:, 0], roots[:, 1]
    same = Extensions(flat, max(room, default=0))
    start = at - same.left(at, at + period)
    length = at + period + same.right(at, at + period) - start
    enough = length >= np.maximum(LEAST, TIMES * period)
    part = np.searchsorted(first, start[enough], "right") - 1
    rows = np.stack((part, start[enough] - first[part], length[enough], period[enough]), axis=1)
    rows = np.unique(rows, axis=0)
    return rows[np.lexsort((rows[:, 3], rows[:, 1], rows[:, 0]))]


def repeats(texts: list[str | None]) -> tuple[list[list[Run]], list[str]]:
    """For each text its runs ``(start, length, period)`` by start and period, and the text
    with every run cut to its first period and words joined by single spaces."""
    split = [(t or "").encode("utf-8", "surrogatepass").split() for t in texts]
    words = [w for part in split for w in part]
    last = dict(zip(words, range(len(words))))
    symbols = np.fromiter(map(last.__getitem__, words), np.int64, len(words))
    lengths = np.array([len(part) for part in split], np.int64)
    text = np.repeat(np.arange(len(split)), lengths)
    starts = np.cumsum(lengths) - lengths
    found: list[list[Run]] = [[] for _ in texts]
    waiting: list[tuple[int, int]] = []
    places = 0
    for a, b in [*regions(symbols, text, lengths), (0, 0)]:
        if waiting and (b == 0 or places + b - a > PLACES):
            rows = runs_of([symbols[x:y] for x, y in waiting])
            for n, start, length, period in rows.tolist():
                owner = int(text[waiting[n][0]])
                found[owner].append((int(waiting[n][0] - starts[owner]) + start, length, period))
            waiting, places = [], 0
        waiting.append((a, b))
        places += b - a
    kept = []
    for part, runs in zip(split, found):
        if runs:
            drop = np.zeros(len(part) + 1, np.int64)
            for start, length, period in runs:
                drop[start + period] += 1
                drop[start + length] -= 1
            part = [w for w, d in zip(part, np.cumsum(drop).tolist()) if not d]
        kept.append(b" ".join(part).decode("utf-8", "replace"))
    return found, kept


def detected(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, runs, collapsed`` of every row: its runs and the text without what they repeat."""

    def start():
        return lambda texts: list(repeats(texts))

    rows = documents.select(F.col(key).alias("id"), F.col(text).alias("words"))
    schema = "runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string"
    found = with_columns(rows, ["words"], schema, start)
    return found.select(F.col("id").alias(key), "runs", "collapsed")
