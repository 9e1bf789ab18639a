import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from orderflow.llm import attention, lm_scoring
from orderflow.llm.queries import op3_lm_scoring, tokenizer_file


def small_model(vocabulary=50, steps=30):
    draw = np.random.default_rng(2)
    windows = np.cumsum(draw.integers(0, 3, (400, attention.LENGTH + 1)), axis=1) % vocabulary
    counts = np.bincount(windows.ravel(), minlength=vocabulary).astype(float)
    valid = np.ones((400, attention.LENGTH), np.float32)
    return attention.train(windows, valid, counts, vocabulary - 1, steps), windows


def test_probabilities_sum_to_one():
    model, _ = small_model()
    scores = [model.log10([np.array([n], np.int32)])[0] for n in range(50)]
    end = model.log10([np.zeros(0, np.int32)])[0]
    both = sum(10**s for s in scores)
    assert both < 1
    given = np.full((1, 1), model.end)
    logs = attention.class_logs(model.weights, given)[0, 0]
    total = sum(10 ** (logs[model.classes[n]] / math.log(10) + model.inside[n]) for n in range(50))
    assert total == pytest.approx(1, abs=1e-3)
    assert 10**end < 1


def test_windows_score_each_id_once():
    model, _ = small_model()
    draw = np.random.default_rng(4)
    texts = [draw.integers(0, 49, n).astype(np.int32) for n in (0, 1, 15, 31, 32, 33, 47, 48, 200)]
    for text, score in zip(texts, model.log10(texts)):
        row, logs = np.append(text, model.end), 0.0
        for place in range(len(row)):
            begin = 0
            if place >= attention.LENGTH:
                begin = -(-(place + 1 - attention.LENGTH) // attention.STRIDE) * attention.STRIDE
            given = np.concatenate(([model.end], row))[begin : place + 1]
            found = attention.class_logs(model.weights, given[None])[0, -1]
            logs += found[model.classes[row[place]]] / math.log(10) + model.inside[row[place]]
        assert score == pytest.approx(logs, rel=1e-3)
    assert model.log10([]).tolist() == []


def test_gradients_by_differences():
    model, windows = small_model(steps=3)
    w = {n: x.astype(np.float64) for n, x in model.weights.items()}
    given, wanted = windows[:3, :-1], model.classes[windows[:3, 1:]]
    valid = np.ones(given.shape)
    valid[0, 20:] = 0
    _, found = attention.gradients(w, given, wanted, valid)
    for name, x in w.items():
        place = np.unravel_index(np.abs(found[name]).argmax(), x.shape)
        for sign in (1,):
            step = dict(w)
            step[name] = x.copy()
            step[name][place] += 1e-5
            up = attention.gradients(step, given, wanted, valid)[0]
            step[name][place] -= 2e-5
            down = attention.gradients(step, given, wanted, valid)[0]
            assert sign * (up - down) / 2e-5 == pytest.approx(found[name][place], rel=2e-2, abs=1e-5)


def test_training_learns():
    before, windows = small_model(200, steps=1)
    after, _ = small_model(200, steps=80)
    texts = [w[1:].astype(np.int32) for w in windows[:50]]
    assert after.log10(texts).sum() > 0.99 * before.log10(texts).sum()


@pytest.mark.parametrize("asked", [[3], [0, 5, 31], list(range(32))])
def test_gradients_of_some_places(asked):
    """The places that are asked have the same part in the gradient as with all others masked."""
    model, windows = small_model(steps=3)
    w = {n: x.astype(np.float64) for n, x in model.weights.items()}
    given, wanted = windows[:4, :-1], model.classes[windows[:4, 1:]]
    places = np.array(asked)
    valid = np.zeros(given.shape)
    valid[:, places] = 1
    loss, found = attention.gradients(w, given, wanted, valid)
    part, some = attention.gradients(w, given, wanted[:, places], valid[:, places], places, False)
    assert part == pytest.approx(loss)
    assert "embed" not in some
    for name, x in some.items():
        assert np.allclose(x, found[name], atol=1e-9), name


def test_blocks_are_of_the_size_that_is_multiplied_fastest():
    """Above a million multiplications a product of matrices first copies them at other places."""
    places, n, total = attention.TOGETHER * attention.LENGTH, attention.SIZE, attention.CLASSES + 4
    assert places * max((n + 1) * total, n * (4 * n + 2)) <= 10**6


@pytest.mark.parametrize("size", [1, 40])
def test_gradients_do_not_depend_on_blocks(monkeypatch, size):
    """Full and partial blocks of windows sum up to the whole, with large weights too."""
    model, windows = small_model(steps=3)
    w = {n: x.astype(np.float64) * size for n, x in model.weights.items()}
    given, wanted = windows[:7, :-1], model.classes[windows[:7, 1:]]
    valid = np.ones(given.shape)
    valid[2, 9:] = 0
    assert attention.is_steady(w, w["q"] / math.sqrt(attention.SIZE)) == (size == 1)
    loss, found = attention.gradients(w, given, wanted, valid)
    monkeypatch.setattr(attention, "TOGETHER", 3)
    part, by_block = attention.gradients(w, given, wanted, valid)
    assert part == pytest.approx(loss)
    for name, x in found.items():
        assert np.isfinite(x).all()
        assert np.allclose(by_block[name], x, atol=1e-9), name


def test_steps_are_those_of_the_formula():
    draw = np.random.default_rng(1)
    w = {"a": draw.normal(size=(3, 2)).astype(np.float32)}
    taken, first, second, at = attention.Steps(w, 0.05), 0.0, 0.0, w["a"].astype(float)
    for n in range(1, 6):
        g = draw.normal(size=(3, 2)).astype(np.float32)
        before = w["a"].copy()
        kept, w = w, taken.taken(w, {"a": g}, 0.5)
        assert (kept["a"] == before).all()
        first, second = 0.9 * first + 0.1 * g, 0.98 * second + 0.02 * g.astype(float) ** 2
        at = at - 0.025 * first / (1 - 0.9**n) / (np.sqrt(second / (1 - 0.98**n)) + 1e-8)
        assert np.allclose(w["a"], at, atol=1e-5) and w["a"].dtype == np.float32


def test_pass_over_sequences_learns():
    model, windows = small_model(200, steps=5)
    texts = [w[1:].astype(np.int32) for w in windows] + [np.zeros(0, np.int32)]
    moves, count = model.passed_over([texts[:200], [], texts[200:]] * 6)
    # Each window has LENGTH ids and its text an end; a window predicts one of PARTS places.
    full = 6 * 400 * attention.LENGTH // attention.PARTS
    assert 0.8 * full <= count <= full + 6 * 401
    assert "embed" not in moves
    after = model.moved(moves)
    assert after.log10(texts).sum() > model.log10(texts).sum()
    assert model.passed_over([])[1] == 0


def test_pass_predicts_every_place_and_moves_all_vectors():
    model, _ = small_model(steps=0)
    draw = np.random.default_rng(4)
    texts = [draw.integers(0, 49, n).astype(np.int32) for n in (0, 1, 31, 32, 33, 200)]
    moves, count = model.passed_over([texts[:2], texts[2:]])
    assert count == sum(len(x) + 1 for x in texts)
    assert all(np.abs(x).max() > 0 for x in moves.values())
    after = model.moved(moves)
    seen = np.unique(np.concatenate(texts))
    assert (np.abs(after.weights["embed"] - model.weights["embed"]).max(axis=1)[seen] > 0).all()


def test_pair_table():
    counts = np.bincount([5] * 9 + [7] * 8 + [2] * 7 + [3] * 2, minlength=10).astype(float)
    frequent = attention.frequent_ids(counts)
    assert frequent.tolist() == [5, 7, 2]
    table = attention.pair_table(np.array([5, 5, 7, 3, 2]), np.array([7, 7, 2, 5, 3]), frequent, 10)
    assert table.tolist() == [[0, 0, 0], [2, 0, 0], [0, 1, 0]]


def test_subwords_are_those_of_the_vocabulary():
    from orderflow.llm import bpe

    path = tokenizer_file()
    words = "the cat. cat, a.b c! 'tis don't x1 é. über ß; ..., 42 ab? 日本。 <|endoftext|> q<|endoftext|>. \u00a0x ?".split(" ")
    raw = [w.encode() for w in words] + [b"\xff\xfea", b"\xed\xa0\x80"]
    expected = bpe.Vocabulary(path).encode([" " + w.decode("utf-8", "replace") for w in raw])
    assert lm_scoring.subwords(bpe.Vocabulary(path), raw) == expected


def test_every_training_document_changes_the_model(spark, monkeypatch):
    """One document more, outside of any sample, moves counts, classes' table and weights."""
    monkeypatch.setattr(lm_scoring, "SAMPLE_DOCUMENTS", 0)
    monkeypatch.setattr(attention, "STEPS", 3)
    draw = np.random.default_rng(3)
    texts = [" ".join(draw.choice(["alpha", "beta", "gamma", "delta"], 40)) for _ in range(40)]
    ids = [n for n in range(100) if zlib.crc32(str(n).encode()) % 5 != 1][:40]
    table = spark.createDataFrame(list(zip(ids, texts)), "doc_id long, text string").coalesce(1)
    kept, models = lm_scoring.model_scores, []
    monkeypatch.setattr(lm_scoring, "model_scores", lambda rows, m: (models.append(m), kept(rows, m))[1])
    for rows in (table, table.where(f"doc_id <> {ids[-1]}")):
        lm_scoring.scored(rows, tokenizer_file())
    with_it, without = models
    assert any(not np.allclose(with_it.weights[n], without.weights[n], atol=1e-6) for n in ("q", "own", "out"))
    assert not np.allclose(with_it.inside, without.inside)


def test_no_document_is_trained_on_apart_from_the_others(spark, monkeypatch):
    """Every training document is in one round, and no steps come before the rounds."""
    ids = np.arange(30, dtype="<u2").tobytes()
    rows = spark.createDataFrame([(n * 7919 - 99, ids) for n in range(40)], "first long, ids binary")
    kept, rounds, steps = attention.train, [], []
    monkeypatch.setattr(attention, "train", lambda *a: (steps.append((len(a[0]), a[4])), kept(*a))[1])
    monkeypatch.setattr(
        lm_scoring, "passed_over", lambda t, m, *a: (rounds.append([r.first for r in t.collect()]), m)[1]
    )
    lm_scoring.trained(rows)
    assert steps == [(0, 0)]
    assert sorted(n for found in rounds for n in found) == sorted(r.first for r in rows.collect())


def plain(texts):
    def tokens(text):
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for c in "\n\t\x0b\x0c\r":
            low = low.replace(c, " ")
        return [w for w in low.split(" ") if w] + ["\n"]

    held = {n: n is not None and zlib.crc32(str(n).encode()) % 5 == 1 for n, _ in texts}
    counts = Counter(t for n, x in texts if not held[n] for t in tokens(x))
    total, different = sum(counts.values()), len(counts)
    found = []
    for n, x in texts:
        own = tokens(x)
        base = sum(math.log10((counts[t] + 0.5) / (total + 0.5 * (different + 1))) for t in own)
        found.append((n, held[n], len(own), sum(counts[t] > 0 for t in own), total, base))
    return found


def check(rows, texts):
    def order(r):
        return (r[0] is None, r[0] or 0, r[2], r[5])

    rows, wanted = sorted(map(tuple, rows), key=order), sorted(plain(texts), key=order)
    assert [r[:5] for r in rows] == [w[:5] for w in wanted]
    assert [r[5] for r in rows] == pytest.approx([w[5] for w in wanted], rel=1e-9)
    assert all(r[6] < 0 for r in rows)


def test_query(spark, tables_dir, monkeypatch):
    monkeypatch.setattr(attention, "STEPS", 60)
    documents = spark.read.parquet(f"{tables_dir}/documents.parquet").select("doc_id", "text")
    rows = op3_lm_scoring(spark, tables_dir).collect()
    check(rows, [tuple(r) for r in documents.collect()])


def test_words_end_at_white_space_only():
    """Words are split and lowered as the contract says, whatever other characters there are."""
    texts = [f"x{chr(n)}Y" for n in range(0x3100)] + ["", None, " ", "\n a  B\t", "É \x85\x1c\u3000z "]
    found = lm_scoring.words_in(pa.array(texts)).to_pylist()
    low = str.maketrans({chr(n): chr(n + 32) for n in range(65, 91)})
    assert [x or [] for x in found] == [
        [w for w in re.split("[\x20\x09-\x0D]+", (t or "").translate(low)) if w] for t in texts
    ]


def test_word_counts_of_one_task(spark):
    rows = spark.createDataFrame([(f"a b{n} A",) for n in range(50)], "text string").coalesce(1)
    counts = lm_scoring.word_counts(rows)
    assert sorted((r.word, r["count"]) for r in counts.collect())[:2] == [("\n", 50), ("a", 100)]


@pytest.mark.parametrize("common", [0, 2, 300_000])
def test_odd_texts(spark, monkeypatch, common):
    monkeypatch.setattr(lm_scoring, "COMMON", common)
    monkeypatch.setattr(attention, "STEPS", 3)
    monkeypatch.setattr(lm_scoring, "FLUSH", 3)
    texts = [
        (1, None), (2, ""), (3, "A a\tB b b"), (3, "A a\tB b b"), (4, "é É " + "x" * 60), (None, "b"),
        (5, "rare " * 300), (6, "new"), (8, " \n"), (9, "y" * 99 + " " + "y" * 99 + " " + "z" * 41),
        (10, "y" * 99 + " b " + "é" * 30),
    ]
    documents = spark.createDataFrame([(*t, "x") for t in texts], "doc_id long, text string, part string")
    check(lm_scoring.scored(documents, tokenizer_file()).collect(), texts)
    assert lm_scoring.scored(documents.where("false"), tokenizer_file()).collect() == []
