import hashlib
import random
import time
import zlib

import numpy as np
import pytest

from orderflow.llm import periodic
from orderflow.llm.queries import op13_periodic, with_planted_periods


def plain_lyndon(s):
    out = []
    for i in range(len(s)):
        j = i + 1
        while j < len(s) and s[j:] > s[i:]:
            j += 1
        out.append(j - i)
    return out


def plain_runs(words):
    """Every period in turn, by comparing words that far apart."""
    n, found = len(words), []
    for q in range(1, n // 4 + 1):
        s = 0
        while s + q < n:
            e = s
            while e + q < n and words[e] == words[e + q]:
                e += 1
            length = e + q - s
            if e > s and length >= max(6, 4 * q):
                part = words[s : s + length]
                smaller = any(part[p:] == part[: length - p] for p in range(1, q))
                if not smaller:
                    found.append((s, length, q))
            s = max(e, s + 1)
    return sorted(found, key=lambda r: (r[0], r[2]))


def collapsed(words, runs):
    return " ".join(w for i, w in enumerate(words) if not any(s + q <= i < s + n for s, n, q in runs))


def test_lyndon_lengths():
    chance = random.Random(1)
    for _ in range(1500):
        s = [chance.randint(0, 2) for _ in range(chance.randint(0, 40))]
        assert periodic.lyndon_lengths(s) == plain_lyndon(s)


@pytest.mark.parametrize("places", [400_000, 30])
def test_runs_of_random_repeats(monkeypatch, places):
    monkeypatch.setattr(periodic, "PLACES", places)
    chance = random.Random(places)
    for _ in range(600):
        texts = []
        for _ in range(chance.randint(1, 4)):
            words = []
            while len(words) < chance.randint(0, 80):
                block = [chance.choice("abcdefgh"[: chance.randint(1, 8)]) for _ in range(chance.randint(1, 7))]
                words += block * chance.randint(1, 7) + block[: chance.randint(0, len(block))]
                words += [chance.choice("abcdefghij")] * chance.randint(0, 2)
            texts.append(" ".join(words))
        found, kept = periodic.repeats(texts)
        expected = [plain_runs(t.split()) for t in texts]
        assert found == expected
        assert kept == [collapsed(t.split(), r) for t, r in zip(texts, expected)]


@pytest.mark.parametrize("kind", ["period", "letters", "fibonacci", "one"])
def test_long_texts(kind):
    n = 200_000
    if kind == "period":
        words = [f"w{i % 40_000}" for i in range(n)]
    elif kind == "letters":
        words = ["ab"[b] for b in np.random.default_rng(1).integers(0, 2, n)]
    elif kind == "fibonacci":
        a, b = "a", "ab"
        while len(b) < n:
            a, b = b, b + a
        words = list(b[:n])
    else:
        words = ["x"] * n
    start = time.perf_counter()
    found, kept = periodic.repeats([" ".join(words)])
    assert time.perf_counter() - start < 30
    if kind == "period":
        assert found == [[(0, n, 40_000)]]
        assert kept[0].split() == words[:40_000]
    elif kind == "one":
        assert found == [[(0, n, 1)]] and kept == ["x"]
    elif kind == "fibonacci":
        assert found == [[]]
    else:
        assert all(words[s : s + m - q] == words[s + q : s + m] for s, m, q in found[0])
        head = " ".join(words[:400])
        assert periodic.repeats([head])[0][0] == plain_runs(words[:400])


def test_frame(spark):
    rows = [
        (1, "a b a b a b a b c", "x", 1),
        (1, "a b a b a b a b c", "x", 1),
        (None, "q q q q q q", None, None),
        (2, None, "x", 2),
        (3, "", "x", 2),
        (4, " \t\n", "x", 2),
        (5, "z z z z z", "x", 2),
    ]
    table = spark.createDataFrame(rows, "doc_id long, text string, runs string, id int")
    found = periodic.detected(table)
    assert found.columns == ["doc_id", "runs", "collapsed"]
    got = sorted((r.doc_id or 0, [tuple(x) for x in r.runs], r.collapsed) for r in found.collect())
    assert got == [
        (0, [(0, 6, 1)], "q"),
        (1, [(0, 8, 2)], "a b c"),
        (1, [(0, 8, 2)], "a b c"),
        (2, [], ""),
        (3, [], ""),
        (4, [], ""),
        (5, [], "z z z z z"),
    ]
    assert periodic.detected(table.where("false")).collect() == []


def altered(doc_id, text):
    words = (text or "").encode().split()
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def test_planted_periods(spark):
    texts = [None, "", "  ", "one", "a\tb\x0bc  d e f g h ", "ä ö ü"] * 20
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for row in with_planted_periods(table).collect():
        assert (row.text or "").encode().split() == altered(row.doc_id, texts[row.doc_id])


def test_query_against_brute_force(spark, tables_dir):
    documents = spark.read.parquet(f"{tables_dir}/documents.parquet").collect()
    found = {r.doc_id: tuple(r)[1:] for r in op13_periodic(spark, tables_dir).collect()}
    assert len(found) == len(documents)
    assert sum(r[0] > 0 for r in found.values()) > len(documents) / 20
    for row in documents:
        words = [w.decode() for w in altered(row.doc_id, row.text)]
        if len(words) > 1500:
            continue
        runs = plain_runs(words)
        best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
        exponent = 1000 * best[1] // best[2] if runs else None
        lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        expected = (
            len(runs), *best, exponent, hashlib.sha256(lines.encode()).hexdigest(),
            hashlib.sha256(collapsed(words, runs).encode()).hexdigest(),
        )
        assert found[row.doc_id] == expected, row.doc_id
