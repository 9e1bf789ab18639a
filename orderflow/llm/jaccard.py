"""Exact similarity join of documents on word shingles, by signature trees.

Documents with equal shingle sets form a class, and only classes are compared.

**First level: bands.** Two sets that reach the threshold differ in at most ``k`` shingles,
``k`` following from their sizes. The range of shingle hashes is cut into ``k + 2`` bands;
at least two bands are the same in both sets. The hash of a band's shingles is a key, and
sets meet only under a common key, so no pair is lost and unlike sets hardly ever meet. A
set with at most one empty band leaves it out. Sizes are cut into ranges that fix ``k``;
a set also gives the keys of the next range when a partner can lie there.

**Stars.** Under each key every set is first compared with the smallest class there. That
settles large groups of near copies with as many comparisons as sets.

**Trees.** Keys whose sets still lie in different components are settled by signature trees:
sets are ordered by size into leaves and nodes that hold the union and the intersection of
their token bitmaps and their range of sizes. Two nodes are gone through together; a pair
is pruned if sizes rule it out or if the largest overlap that the bitmaps allow is too
small, and pairs of one component are skipped. Pairs of sets that are left are compared by
their whole texts. Large keys are cut into blocks, and each pair of blocks is a task.

Texts: words are runs without white space, A to Z in lower case. A text of fewer than three
words has its whole sequence as one shingle; null texts and texts without words have none
and link with nothing. Rows of one id count as one document; a null id keeps the class's
smallest id. Shingles are compared by 64-bit hashes. An empty table gives an empty one.
"""

from __future__ import annotations

from bisect import bisect_right
from functools import cache

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderflow.llm.common import small_batches, staged, with_columns
from orderflow.llm.graph import components

WIDTH = 3
PERCENT = 90
STEP = 1.5
"""Ratio of the largest to the smallest size of a range of sizes, about."""
BITS = 2048
LEAF = 16
BLOCK = 512
SLOTS = 1 << 18
"""Slots of the table by which texts that are surely not needed are left out of a shuffle."""
REMEMBERED = 200_000

_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))
_HASHES: dict[bytes, int] = {}


def mixed(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """Well-mixed 64-bit numbers."""
    x = x + np.uint64((seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) & (2**64 - 1))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str | None, width: int = WIDTH) -> np.ndarray:
    """Sorted hashes of the different shingles of a text."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not words:
        return np.zeros(0, np.uint64)
    if len(_HASHES) > REMEMBERED:
        _HASHES.clear()
    for word in words:
        if word not in _HASHES:
            _HASHES[word] = xxhash.xxh3_64_intdigest(word)
    hashes = np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words))
    size = min(width, len(words))
    n = len(words) - size + 1
    found = np.full(n, np.uint64(size))
    for k in range(size):
        found = mixed(found * _A + hashes[k : n + k], k + 1)
    return np.unique(found)


@cache
def size_ranges(percent: int) -> list[tuple[int, int, int]]:
    """Smallest and largest size, and how many shingles partners may differ in, of each range."""
    found, low = [], 1
    while low < 2**31:
        high = max(low, int(low * STEP))
        found.append((low, high, (100 - percent) * 2 * high // (100 + percent)))
        low = high + 1
    return found


def range_of(size: int, percent: int) -> int:
    return bisect_right(size_ranges(percent), size, key=lambda r: r[0]) - 1


@cache
def band_edges(bands: int) -> np.ndarray:
    """The hashes at which bands after the first begin."""
    return np.array([n * 2**64 // bands for n in range(1, bands)], np.uint64)


def band_keys(tokens: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """The keys of a set: of its range of sizes, and of the next if a partner can lie there."""
    n = len(tokens)
    if not n:
        return np.zeros(0, np.int64)
    first, last = range_of(n, percent), range_of(n * 100 // percent, percent)
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mixed(tokens, 9))))
    keys = []
    for r in range(first, last + 1):
        differ = size_ranges(percent)[r][2]
        if not differ:
            continue
        bands = differ + 2
        cuts = np.concatenate(([0], np.searchsorted(tokens, band_edges(bands)), [n]))
        content = sums[cuts[1:]] - sums[cuts[:-1]]
        numbers = np.arange(bands, dtype=np.uint64) + np.uint64(r << 32)
        key = mixed(content * _B + mixed(numbers, 5), 6)
        empty = cuts[1:] == cuts[:-1]
        keys.append(key[~empty] if empty.sum() <= 1 else key)
    return np.concatenate(keys).view(np.int64) if keys else np.zeros(0, np.int64)


def similar(a: np.ndarray, b: np.ndarray, percent: int = PERCENT) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both > 0 and 100 * both >= percent * (len(a) + len(b) - both)


def bitmap(tokens: np.ndarray) -> bytes:
    bits = np.zeros(BITS, np.uint8)
    bits[(mixed(tokens, 3) % np.uint64(BITS)).astype(np.int64)] = 1
    return np.packbits(bits).tobytes()


class Tree:
    """A signature tree: level 0 holds the sets, each further level joins ``LEAF`` nodes."""

    def __init__(self, sizes: np.ndarray, bitmaps: np.ndarray, parts: np.ndarray) -> None:
        order = np.lexsort((parts, sizes))
        self.order = order
        sizes, bitmaps, parts = sizes[order], bitmaps[order], parts[order]
        self.levels = [(sizes, sizes, bitmaps, bitmaps, parts, parts)]
        while len(self.levels[-1][0]) > 1:
            low, high, union, common, first, last = self.levels[-1]
            at = np.arange(0, len(low), LEAF)
            self.levels.append(
                (
                    np.minimum.reduceat(low, at),
                    np.maximum.reduceat(high, at),
                    np.bitwise_or.reduceat(union, at, axis=0),
                    np.bitwise_and.reduceat(common, at, axis=0),
                    np.minimum.reduceat(first, at),
                    np.maximum.reduceat(last, at),
                )
            )


def _possible(a, b, i: np.ndarray, j: np.ndarray, percent: int) -> np.ndarray:
    """Whether node i of one level may hold a partner of a set under node j of another."""
    low_a, high_a, union_a, common_a, first_a, last_a = (x[i] for x in a)
    low_b, high_b, union_b, common_b, first_b, last_b = (x[j] for x in b)
    ok = (100 * high_a >= percent * low_b) & (100 * high_b >= percent * low_a)
    ok &= ~((first_a == last_a) & (first_b == last_b) & (first_a == first_b))
    lacks_b = np.bitwise_count(common_a & ~union_b).sum(axis=1, dtype=np.int64)
    lacks_a = np.bitwise_count(common_b & ~union_a).sum(axis=1, dtype=np.int64)
    most = np.minimum(high_a - lacks_b, high_b - lacks_a)
    return ok & (most * (100 + percent) >= percent * (low_a + low_b))


def tree_pairs(a: Tree, b: Tree, percent: int = PERCENT) -> tuple[np.ndarray, np.ndarray]:
    """Places of sets that may be similar, going down both trees together."""
    same = a is b
    top_a, top_b = len(a.levels) - 1, len(b.levels) - 1
    i, j = np.zeros(1, np.int64), np.zeros(1, np.int64)
    while True:
        level_a, level_b = a.levels[top_a], b.levels[top_b]
        ok = _possible(level_a, level_b, i, j, percent)
        if same:
            ok &= i <= j
        i, j = i[ok], j[ok]
        if top_a == top_b == 0 or not len(i):
            break
        if top_a >= top_b:
            i, j = _children(i, j, len(a.levels[top_a - 1][0]))
        if top_b >= top_a:
            j, i = _children(j, i, len(b.levels[top_b - 1][0]))
        top_a, top_b = (top_a - (top_a >= top_b), top_b - (top_b >= top_a))
    if same:
        i, j = i[i < j], j[i < j]
    return a.order[i], b.order[j]


def _children(i: np.ndarray, j: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    children = (i[:, None] * LEAF + np.arange(LEAF)).reshape(-1)
    partner = np.repeat(j, LEAF)
    return children[children < count], partner[children < count]


def _keyed(documents: DataFrame, key: str, text: str, percent: int, width: int) -> DataFrame:
    """``id, n_shingles, first, second`` (a digest of the set) and the set's ``keys``."""

    def start():
        def work(texts):
            out = [[], [], [], []]
            for value in texts:
                tokens = shingles(value, width)
                out[0].append(len(tokens))
                for n, seed in ((1, 7), (2, 8)):
                    out[n].append(int(mixed(tokens, seed).sum(dtype=np.uint64).view(np.int64)))
                out[3].append(band_keys(tokens, percent))
            return out

        return work

    rows = documents.select(F.col(key).alias("id"), F.col(text).alias("text"))
    schema = "n_shingles long, first long, second long, keys array<long>"
    return with_columns(rows, ["text"], schema, start).drop("text")


def _compared(pairs: DataFrame, texts: DataFrame, percent: int, width: int) -> DataFrame:
    """Those of the pairs ``a, b`` that are similar, by their whole texts."""
    a = texts.select(F.col("id").alias("a"), F.col("text").alias("text_a"))
    b = texts.select(F.col("id").alias("b"), F.col("text").alias("text_b"))

    def start():
        seen: dict[str, np.ndarray] = {}

        def tokens(value):
            if value not in seen:
                if len(seen) >= 64:
                    seen.clear()
                seen[value] = shingles(value, width)
            return seen[value]

        def work(first, second):
            return [[similar(tokens(x), tokens(y), percent) for x, y in zip(first, second)]]

        return work

    joined = pairs.join(a, "a").join(b, "b").select("a", "b", "text_a", "text_b")
    found = with_columns(joined, ["text_a", "text_b"], "same boolean", start)
    return found.where("same").select("a", "b")


def _texts(documents: DataFrame, ids: DataFrame, key: str, text: str) -> DataFrame:
    """``id, text`` of the documents with these ids.

    A table of hash slots, of bounded size, keeps most other texts out of the shuffle.
    """
    rows = documents.select(F.col(key).alias("id"), F.col(text).alias("text"))
    return _near_slots(rows, ids, "left_semi").join(ids, "id", "left_semi").distinct()


def _tree_candidates(members: DataFrame, percent: int) -> DataFrame:
    """Pairs ``a, b`` of ``id, part, size, bits`` under a common ``key`` that trees let through."""
    counts = members.groupBy("key").agg(F.count("*").alias("members"))
    blocks = F.ceil(F.col("members") / BLOCK).cast("int")
    placed = members.join(counts, "key").select(
        "key",
        "id",
        "part",
        "size",
        "bits",
        F.pmod(F.xxhash64("id"), blocks).cast("int").alias("block"),
        blocks.alias("blocks"),
    )
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    tasks = placed.select("*", other.alias("other")).select(
        "key",
        "id",
        "part",
        "size",
        "bits",
        "block",
        F.least("block", "other").alias("left"),
        F.greatest("block", "other").alias("right"),
    )

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        trees, rows = [], []
        for block in sorted({frame["left"].iat[0], frame["right"].iat[0]}):
            part = frame[frame["block"] == block]
            rows.append(part["id"].to_numpy())
            bits = np.frombuffer(b"".join(part["bits"]), np.uint64).reshape(len(part), -1)
            trees.append(Tree(part["size"].to_numpy(), bits, part["part"].to_numpy()))
        if not all(map(len, rows)):
            return pd.DataFrame({"a": [], "b": []}, dtype="int64")
        i, j = tree_pairs(trees[0], trees[-1], percent)
        a, b = rows[0][i], rows[-1][j]
        return pd.DataFrame({"a": np.minimum(a, b), "b": np.maximum(a, b)})

    found = tasks.groupBy("key", "left", "right").applyInPandas(run, "a long, b long")
    return found.distinct()


def joined(
    documents: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    percent: int = PERCENT,
    width: int = WIDTH,
) -> DataFrame:
    """``key, n_shingles, component_id`` of every row."""
    small_batches(documents.sparkSession)
    rows = staged(_keyed(documents, key, text, percent, width), "jaccard-rows")
    digest = ["n_shingles", "first", "second"]
    classes = rows.where("n_shingles > 0").groupBy(*digest).agg(F.min("id").alias("class"))
    first_ids = classes.where("class IS NOT NULL").select(F.col("class").alias("id"), *digest)
    sets = rows.join(first_ids, ["id", *digest], "left_semi").dropDuplicates(["id", *digest])
    keys = staged(
        sets.select(F.col("id").alias("class"), F.explode("keys").alias("key")), "jaccard-keys"
    )
    ends = keys.groupBy("key").agg(F.min("class").alias("center"), F.max("class").alias("last"))
    shared = ends.where("center < last").select("key", "center")
    members = staged(keys.join(shared, "key").distinct(), "jaccard-members")

    ids = members.select(F.col("class").alias("id")).distinct()
    texts = staged(_texts(documents, ids, key, text), "jaccard-texts")
    stars = members.where("class <> center").select(F.col("center").alias("a"), F.col("class").alias("b"))
    links = staged(_compared(stars.distinct(), texts, percent, width), "jaccard-links")
    found = components(links)

    placed = members.join(found.withColumnRenamed("node", "class"), "class", "left")
    placed = placed.select("key", "class", F.coalesce("component", "class").alias("part"))
    open_keys = placed.groupBy("key").agg(
        F.min("part").alias("low"),
        F.max("part").alias("high"),
        F.count("*").alias("members"),
        F.sum(F.xxhash64("class").cast("decimal(38,0)")).alias("mark"),
    )
    open_keys = open_keys.where("low < high").groupBy("members", "mark").agg(F.min("key").alias("key"))
    undecided = staged(
        placed.join(open_keys.select("key"), "key").withColumnRenamed("class", "id"), "jaccard-open"
    )

    def start():
        def work(values):
            sets = [shingles(v, width) for v in values]
            return [[len(s) for s in sets], [bitmap(s) for s in sets]]

        return work

    marks = with_columns(texts, ["text"], "size long, bits binary", start).drop("text")
    pairs = _tree_candidates(undecided.join(marks, "id"), percent)
    more = staged(_compared(pairs, texts, percent, width), "jaccard-links")
    if more.take(1):
        found = components(links.union(more))
    named = classes.join(found, F.col("class") == F.col("node"), "left").select(
        *digest, F.coalesce("component", "class").alias("component_id")
    )
    named = rows.drop("keys").join(named, digest, "left")
    return named.select(
        F.col("id").alias(key), "n_shingles", F.coalesce("component_id", "id").alias("component_id")
    )


def _near_slots(rows: DataFrame, ids: DataFrame, how: str) -> DataFrame:
    """The rows in (or not in) the hash slots of the ids; the slot table is of bounded size."""
    slots = ids.select(F.pmod(F.xxhash64("id"), SLOTS).alias("_slot")).distinct()
    slot = F.pmod(F.xxhash64(rows["id"]), SLOTS)
    return rows.join(F.broadcast(slots), slot == F.col("_slot"), how)


def representatives(
    documents: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    percent: int = PERCENT,
    width: int = WIDTH,
) -> DataFrame:
    """One document of each component: its smallest id. Rows without an id stay.

    Of rows with one id the smallest stays. Only documents in the hash slots of those that go
    or repeat are shuffled.
    """
    columns = documents.columns
    found = joined(documents, key, text, percent, width).where(F.col(key).isNotNull())
    found = found.groupBy(F.col(key).alias("id")).agg(
        F.min("component_id").alias("component"), F.count("*").alias("times")
    )
    found = staged(found.where("component <> id OR times > 1"), "jaccard-touched")
    aside = {c: f"_other_{n}" for n, c in enumerate(columns) if c != key}
    rows = documents.select(
        F.col(key).alias("id"), *(F.col(f"`{c}`").alias(name) for c, name in aside.items())
    )
    alone = rows.where("id IS NULL")
    rows = rows.where("id IS NOT NULL")
    rest = _near_slots(rows, found, "left_semi").join(
        found.where("component <> id").select("id"), "id", "left_anti"
    )
    repeated = found.where("component = id").select("id")
    others = [c for c in rows.columns if c != "id"]
    once = rest.join(repeated, "id", "left_semi").groupBy("id")
    once = once.agg(F.min(F.struct(*others)).alias("_row")).select("id", "_row.*")
    parts = [_near_slots(rows, found, "left_anti"), rest.join(repeated, "id", "left_anti"), once, alone]
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole.select(*(F.col(aside.get(c, "id")).alias(c) for c in columns))
