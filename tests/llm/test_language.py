import zlib
from collections import Counter

import numpy as np
import pytest

from orderflow.llm import language
from orderflow.llm.common import read
from orderflow.llm.queries import op12_language


@pytest.mark.parametrize("languages", [2, 3, 4, 6, 7, 30])
def test_codewords_differ(languages):
    codes = language.codewords(languages)
    assert set(codes.ravel()) == {-1.0, 1.0}
    assert (np.abs(codes.sum(axis=0)) < languages).all()
    apart = [(codes[a] != codes[b]).sum() for a in range(languages) for b in range(a)]
    # The words of an exhaustive code are equally far apart: half of all splits part any two.
    if languages <= language.EXHAUSTIVE:
        assert set(apart) == {2 ** (languages - 2)}
    else:
        assert min(apart) >= codes.shape[1] / 4
    assert language.codewords(1).shape == (1, 0) and language.codewords(0).shape == (0, 0)


def plain_grams(text):
    """All n-grams inside of words with a space at both ends, as a bag of bytes."""
    lower = (text or "").lower().encode()
    kept = "".join(chr(c) if c >= 0x80 or chr(c).isalpha() else " " for c in lower)
    out = Counter()
    for word in kept.split(" "):
        if word:
            edged = f" {word} "
            for size in language.SIZES:
                out.update(edged[k : k + size] for k in range(len(edged) - size + 1))
    return out


def slot(gram):
    code = len(gram)
    for c in gram:
        code = code * 0x01000193 % 2**32 ^ ord(c)
    return code * 0x9E3779B1 % 2**32 >> 16


@pytest.mark.parametrize("places", [1 << 18, 10])
def test_grams(monkeypatch, places):
    monkeypatch.setattr(language, "PLACES", places)
    texts = ["Ab cd", None, "", "  1  ", "É-é ß", "a", "x" * 50, "one,two;  three\n", "Ab cd"]
    found = {n: Counter() for n in range(len(texts))}
    for begin, end, slots, owner in language.chunks(texts):
        assert begin < end
        for s, o in zip(slots.tolist(), owner.tolist()):
            found[begin + o][s] += 1
    for n, text in enumerate(texts):
        expected = Counter()
        for gram, times in plain_grams(text).items():
            expected[slot(gram)] += times
        assert found[n] == expected, text


def test_margins_and_losses_are_plain_sums():
    random = np.random.default_rng(4)
    codes = language.codewords(4)
    decoder = language.Decoder(
        list("abcd"), codes, random.normal(0, 1, (language.SLOTS, 7)).astype(np.float32),
        random.uniform(1, 3, 7), random.normal(0, 0.2, 7), random.uniform(0.2, 1, (4, 7)),
    )
    texts = ["the cat", "die Katze und", "", "a b c " * 100]
    margins = decoder.margins(texts)
    for n, text in enumerate(texts):
        grams = plain_grams(text)
        mean = sum((times * decoder.slots[slot(g)].astype(float) for g, times in grams.items()), np.zeros(7))
        assert np.allclose(margins[n], mean / max(1, grams.total()), atol=1e-4)
    losses = decoder.losses(margins)
    for n in range(len(texts)):
        for k in range(4):
            odds = decoder.slopes * (margins[n] - decoder.middles)
            loss = sum(t * np.log1p(np.exp(-c * o)) for t, c, o in zip(decoder.trust[k], codes[k], odds))
            assert losses[n, k] == pytest.approx(loss)


ROWS = [
    (1, "the cat and the dog", "en", "x", 1),
    (2, "the bird with the hat", "en", "x", 1),
    (3, "die Katze und der Hund", "de", "x", 1),
    (4, "der Vogel mit dem Hut", "de", "x", 1),
    (4, "der Vogel mit dem Hut", "de", "x", 1),
    (5, None, "de", None, None),
    (6, "", "en", "x", 2),
    (7, "123 !? \t", None, "x", 2),
    (8, "the dog and the hat", None, "x", 2),
    (None, "der Hund und die Katze", None, "x", 2),
    (9, "x", None, "x", 2),
]
SCHEMA = "doc_id long, text string, lang string, lang_pred string, id int"


def test_frame(spark):
    table = spark.createDataFrame(ROWS, SCHEMA)
    decoder = language.fit(table, fold=None)
    found = language.predicted(table, decoder)
    assert found.columns == ["doc_id", "lang_pred", "score", "ambiguous"]
    rows = found.collect()
    assert len(rows) == len(ROWS)
    predicted = {r.doc_id: r for r in rows}
    assert {n: predicted[n].lang_pred for n in (1, 2, 3, 4, 8, None)} == {
        1: "en", 2: "en", 3: "de", 4: "de", 8: "en", None: "de",
    }
    for n in (5, 6, 7):
        assert tuple(predicted[n])[1:] == ("und", 0.0, True)
    assert all(0 <= r.score <= 1 for r in rows)
    assert language.predicted(table.where("false"), decoder).collect() == []


def test_one_language_and_none(spark):
    table = spark.createDataFrame(ROWS, SCHEMA)
    one = language.fit(table.where("lang = 'de'"), fold=None)
    found = {r.doc_id: (r.lang_pred, r.score) for r in language.predicted(table, one).collect()}
    assert found[1] == ("de", 1.0) and found[7] == ("und", 0.0)
    none = language.fit(table.where("lang = 'xx'"), fold=None)
    assert {r.lang_pred for r in language.predicted(table, none).collect()} == {"und"}


def test_ties_are_flagged():
    codes = language.codewords(2)
    blank = language.Decoder(
        ["aa", "bb"], codes, np.zeros((language.SLOTS, 1), np.float32),
        np.ones(1), np.zeros(1), np.full((2, 1), 0.5),
    )
    assert blank.decoded(["some text", "1"]) == (["aa", "und"], [0.5, 0.0], [True, True])


def test_held_out_rows(spark, tables_dir):
    truth = {r.doc_id: r.lang for r in read(spark, tables_dir, "documents").collect()}
    found = op12_language(spark, tables_dir).collect()
    assert len(found) == len(truth)
    assert {r.held_out for r in found if zlib.crc32(str(r.doc_id).encode()) % 4 == 2} == {True}
    held = [r for r in found if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.98 * len(held)


def test_held_out_labels_are_not_read(spark, tables_dir):
    from pyspark.sql import functions as F

    documents = read(spark, tables_dir, "documents")
    held = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    other = documents.withColumn("lang", F.when(held, "xx").otherwise(F.col("lang")))
    a, b = language.fit(documents), language.fit(other)
    assert a.languages == b.languages and np.array_equal(a.slots, b.slots)
    assert np.array_equal(a.slopes, b.slopes) and np.array_equal(a.trust, b.trust)
