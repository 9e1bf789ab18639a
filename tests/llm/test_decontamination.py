import random

import numpy as np
import pytest

from orderflow.llm import decontamination as d
from orderflow.llm.queries import op9_decontamination


def fewest(pattern, text):
    """Edit distance of the pattern to any piece of the text."""
    row = [0] * (len(text) + 1)
    for p in pattern:
        above, row = row, [row[0] + 1]
        for i, c in enumerate(text):
            row.append(min(above[i] + (p != c), above[i + 1] + 1, row[i] + 1))
    return min(row)


def prose(draw, words):
    return " ".join("".join(draw.choices("etaoinsh", k=draw.randint(1, 9))) for _ in range(words))


def altered(draw, text, edits):
    letters = list(text)
    for _ in range(edits):
        place = draw.randrange(len(letters))
        letters[place : place + 1] = draw.choice([[], ["x"], ["q", letters[place]]])
    return "".join(letters)


@pytest.mark.parametrize("seed", range(4))
def test_same_as_full_alignment(seed):
    draw = random.Random(seed)
    items = [(n, prose(draw, draw.randint(4, 24))) for n in range(6)]
    index = d.Index(items)
    texts = [prose(draw, 60) for _ in range(3)] + [None, "", "x"]
    for _, item in items:
        for edits in (0, 2, 5, 9):
            inner = altered(draw, item, edits).replace(" ", draw.choice([" ", "  ", "\n"])).title()
            texts.append(draw.choice(["", prose(draw, 20) + " "]) + inner + draw.choice(["", " " + prose(draw, 20)]))
    windows = {}
    for item, content, edits in zip(index.item, index.texts, index.edits.tolist()):
        windows.setdefault(item, []).append((content.tobytes(), edits))
    for text, matches in zip(texts, d.passages(index, texts)):
        wanted = {
            item: min(fewest(w, d.normal(text)) for w, e in own)
            for item, own in windows.items()
            if any(fewest(w, d.normal(text)) <= e for w, e in own)
        }
        assert {m["item_id"] for m in matches} == set(wanted)
        for m in matches:
            assert m["edits"] >= wanted[m["item_id"]]
            piece = d.normal(text[m["begin"] : m["end"]])
            assert min(fewest(w, piece) for w, _ in windows[m["item_id"]]) <= m["edits"]


def test_rolling_tells_different_grams_apart():
    data = np.frombuffer(b"abcdefghijklmnabcdefghijxx", np.uint8)
    hashes = d.rolling(data)
    assert len(hashes) == len(data) - d.Q + 1
    assert hashes[0] == hashes[14] and len(set(hashes.tolist())) == len(hashes) - 1
    assert len(d.rolling(data[: d.Q - 1])) == 0 and len(d.rolling(data[: d.Q])) == 1


def test_blocks_give_the_same(spark):
    draw = random.Random(5)
    items = [(n, prose(draw, 12)) for n in range(9)] + [(9, None), (10, ""), (11, "tiny"), (None, "x y")]
    texts = [(n, f"{prose(draw, 9)} {items[n % 9][1]} tiny", 1) for n in range(20)] + [(None, None, 0)]
    documents = spark.createDataFrame(texts, "doc_id long, text string, item_id int")
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    whole = d.contaminated(documents, benchmark).collect()
    rows = d.with_matches(documents, benchmark, block=100).selectExpr("doc_id", "explode(matches.item_id)")
    assert sorted((r.doc_id, r.item_id) for r in whole) == sorted(map(tuple, rows.collect()))
    assert {(n, n % 9) for n in range(20)} | {(n, 11) for n in range(20)} == {(r.doc_id, r.item_id) for r in whole}
    assert d.contaminated(documents.where("false"), benchmark).collect() == []
    assert d.contaminated(documents, benchmark.where("false")).collect() == []


def test_many_blocks_hold_one_index_at_a_time(spark):
    """Fifty blocks: repeated rows, a long text, a filled column of the result's name."""
    draw = random.Random(8)
    items = [(n, prose(draw, 12)) for n in range(50)]
    texts = [(n % 30, f"{prose(draw, 9)} {items[n % 50][1]}", "old") for n in range(60)]
    texts += [texts[0], texts[0], (99, " ".join(c for _, c in items) + " x" * 50_000, None), (None, "x" * 100_000, None)]
    documents = spark.createDataFrame(texts, "doc_id long, text string, matches string")
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    apart = d.with_matches(documents, benchmark, block=1)
    assert "MapInArrow" not in apart._jdf.queryExecution().optimizedPlan().toString()
    assert apart.columns == ["doc_id", "text", "matches"]
    kept = lambda rows: sorted((r.doc_id or -1, r.text, sorted(map(tuple, r.matches))) for r in rows)
    assert kept(apart.collect()) == kept(d.with_matches(documents, benchmark).collect())
    assert len(kept(apart.collect())) == len(texts)


def test_query_finds_every_whole_item(spark, tables_dir):
    found = {(r.doc_id, r.item_id) for r in op9_decontamination(spark, tables_dir).collect()}
    items = spark.read.parquet(f"{tables_dir}/benchmark.parquet").collect()
    documents = spark.read.parquet(f"{tables_dir}/documents.parquet").collect()
    whole = {(t.doc_id, b.item_id) for t in documents for b in items if d.normal(b.text) in d.normal(t.text)}
    assert whole and whole <= found and len(found) <= 1.2 * len(whole) + 3
