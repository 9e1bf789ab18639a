import random

import numpy as np
import pytest

from orderflow.llm import jaccard
from orderflow.llm.graph import components
from orderflow.llm.queries import op8_jaccard

WHITE = " \t\n\x0b\x0c\r"


def plain_set(text):
    words, word = [], ""
    for c in (text or "") + " ":
        if c in WHITE:
            words += [word] if word else []
            word = ""
        else:
            word += chr(ord(c) + 32) if "A" <= c <= "Z" else c
    if 0 < len(words) < 3:
        return {tuple(words)}
    return {tuple(words[i : i + 3]) for i in range(len(words) - 2)}


def plain_components(texts):
    """Smallest reachable id by comparing all pairs."""
    sets = {n: plain_set(t) for n, t in texts.items()}
    root = {n: n for n in texts}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= 90 * len(x | y):
                low, high = sorted((find(a), find(b)))
                root[high] = low
    return {n: (len(sets[n]), find(n)) for n in ids}


def corpus(seed, families=25, copies=8):
    """Texts in families that differ by a few words, around the threshold."""
    draw = random.Random(seed)
    texts = {}
    for family in range(families):
        size = draw.choice([2, 3, 5, 12, 13, 25, 40, 80, 200, 400])
        words = [f"w{draw.randint(0, 300)}" for _ in range(size)]
        for _ in range(copies):
            own = list(words)
            for _ in range(draw.choice([0, 0, 1, 1, 2, max(1, size // 60), max(1, size // 40)])):
                place = draw.randrange(len(own))
                own[place : place + 1] = draw.choice([[], ["x"], [f"y{draw.randint(0, 9)}", own[place]]])
            texts[len(texts) * 3 + family % 2] = draw.choice([" ", "\n"]).join(own).title()
    return texts


def found(rows):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in rows.collect()}


@pytest.mark.parametrize("seed", [1, 2])
def test_same_as_all_pairs(spark, seed):
    texts = corpus(seed) | {9001: None, 9002: "", 9003: " \n", 9004: "one", 9005: "ONE", 9006: "one two"}
    rows = [(k, v, 1, "x") for k, v in texts.items()]
    documents = spark.createDataFrame(rows, "doc_id long, text string, size int, keys string")
    assert found(jaccard.joined(documents)) == plain_components(texts)


def test_repeated_rows_and_empty_table(spark):
    rows = [(5, "a b c d"), (5, "a b c d"), (3, "a b c d"), (None, "a b c d"), (None, None)]
    documents = spark.createDataFrame(rows, "doc_id long, text string")
    result = sorted(tuple(r) for r in jaccard.joined(documents).fillna(-1).collect())
    assert result == [(-1, 0, -1), (-1, 2, 3), (3, 2, 3), (5, 2, 3), (5, 2, 3)]
    assert jaccard.joined(documents.where("false")).collect() == []


def test_partners_share_a_band_key():
    draw = np.random.default_rng(3)
    for size in [*range(10, 60), 100, 555, 1000]:
        tokens = np.unique(draw.integers(0, 2**63, size).astype(np.uint64) * np.uint64(2))
        for _ in range(20):
            drop, add = draw.integers(0, size // 8 + 1, 2)
            other = np.concatenate((draw.permutation(tokens)[drop:], draw.integers(0, 2**63, add).astype(np.uint64)))
            other = np.unique(other)
            if jaccard.similar(tokens, other) and len(np.setxor1d(tokens, other)):
                assert len(np.intersect1d(jaccard.band_keys(tokens), jaccard.band_keys(other)))


@pytest.mark.parametrize("count", [1, 5, 40, 600])
def test_trees_lose_no_pair(count):
    draw = np.random.default_rng(count)
    base = np.unique(draw.integers(0, 2**63, 200).astype(np.uint64))
    sets = [np.unique(np.concatenate((draw.permutation(base)[draw.integers(0, 25) :], draw.integers(0, 2**63, draw.integers(0, 12)).astype(np.uint64)))) for _ in range(count)]
    bits = np.stack([np.frombuffer(jaccard.bitmap(s), np.uint64) for s in sets])
    sizes = np.array([len(s) for s in sets])
    parts = draw.integers(0, count, count)
    tree = jaccard.Tree(sizes, bits, parts)
    i, j = jaccard.tree_pairs(tree, tree)
    pairs = {tuple(sorted(x)) for x in zip(i.tolist(), j.tolist())}
    half = count // 2
    wanted = [(a, b) for a in range(min(count, 80)) for b in range(a + 1, min(count, 80))]
    for a, b in wanted:
        if parts[a] != parts[b] and jaccard.similar(sets[a], sets[b]):
            assert (a, b) in pairs
    if half:
        left = jaccard.Tree(sizes[:half], bits[:half], parts[:half])
        right = jaccard.Tree(sizes[half:], bits[half:], parts[half:])
        i, j = jaccard.tree_pairs(left, right)
        across = {(x, y + half) for x, y in zip(i.tolist(), j.tolist())}
        assert {p for p in pairs if p[0] < half <= p[1]} <= across


def test_trees_settle_what_stars_leave(spark, monkeypatch):
    """A chain: neighbours are similar, the ends are not, and the smallest id is an end."""
    monkeypatch.setattr(jaccard, "BLOCK", 4)
    words = [f"w{n}" for n in range(120)]
    texts = {n: " ".join(words[3 * n : 3 * n + 90]) for n in range(11)}
    texts = {(n * 7) % 11: t for n, t in texts.items()}
    documents = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    assert found(jaccard.joined(documents)) == plain_components(texts)


def test_components(spark):
    links = [(5, 4), (4, 3), (9, 8), (3, 9), (20, 21), (7, 7)]
    result = components(spark.createDataFrame(links, "a long, b long")).collect()
    assert dict(map(tuple, result)) == {3: 3, 4: 3, 5: 3, 8: 3, 9: 3, 20: 20, 21: 20}


def test_query(spark, tables_dir):
    rows = spark.read.parquet(f"{tables_dir}/documents.parquet").collect()
    assert found(op8_jaccard(spark, tables_dir)) == plain_components({r.doc_id: r.text for r in rows})


def test_query_against_sql(spark, tables_dir):
    import duckdb

    from orderflow.llm.queries import ORACLES

    oracle = duckdb.connect()
    oracle.sql(f"CREATE VIEW documents AS SELECT * FROM '{tables_dir}/documents.parquet'")
    found = op8_jaccard(spark, tables_dir).select("doc_id", "n_shingles", "component_id")
    assert sorted(map(tuple, found.collect())) == sorted(oracle.sql(ORACLES["op8_jaccard"]).fetchall())
