import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from orderflow.llm import toxicity as t
from orderflow.llm.queries import op1_toxicity

BIG = "/root/testdata/sf0.1"


def kernel(a, b):
    """The kernel of two words by going through all subsequences of three letters."""

    def grams(word):
        codes = [0, *(int(t.TABLE[c]) for c in word.encode())]
        found, square = {}, 0.0
        for i in range(len(codes)):
            for j in range(i + 1, len(codes)):
                for k in range(j + 1, min(len(codes), i + t.SPAN)):
                    gram = (codes[i], codes[j], codes[k])
                    if t.GAP not in gram:
                        found[gram] = found.get(gram, 0) + t.DECAY ** (k - i + 1)
                        square += t.DECAY ** (2 * (k - i + 1))
        return found, square

    (x, n), (y, m) = grams(a), grams(b)
    return sum(v * y.get(g, 0) for g, v in x.items()) / np.sqrt(max(n, 1e-12) * max(m, 1e-12))


WORDS = ["idiot", "i.d.i.o.t", "Idiots!", "moron", "über", "a", "ab", "x-y_z", "pathetically"]


def test_value_by_subsequences_is_the_value_by_landmarks():
    machine = t.train(WORDS[:4], ["hello", "world", "moran"], landmarks=6)
    for word in WORDS:
        by_landmarks = machine.offset + sum(
            w * kernel(word, x) for w, x in zip(machine.weights, machine.landmarks)
        )
        evidence, words = machine.evidence([f"{word}"])
        assert evidence[0] == pytest.approx(by_landmarks, abs=1e-3)
        assert words == [word]


def test_worst_word_and_odd_texts():
    machine = t.train(["idiot"], ["hello", "world", "house", "tree"])
    texts = ["hello idiot world", None, "", "  \n", "hello", "i d i o t", "y" * 50_000, "world"]
    evidence, words = machine.evidence(texts)
    assert words[0] == "idiot" and evidence[0] == max(evidence)
    assert words[5].replace(" ", "") == "idiot"
    assert list(evidence[1:4]) == [-1, -1, -1] and words[1:4] == ["", "", ""]
    alone = [machine.evidence([x])[0][0] for x in texts]
    assert np.allclose(alone, evidence, atol=1e-3)


def test_no_labels_and_empty_tables(spark):
    documents = spark.createDataFrame([(1, "a b", 1.0), (2, None, 0.0)], "doc_id long, text string, toxicity double")
    labels = spark.createDataFrame([(1, 0), (1, None)], "doc_id long, toxic int")
    machine = t.fit(documents, labels)
    assert all(r.toxicity < 0.5 for r in t.scored(documents, machine).collect())
    assert t.scored(documents.where("false"), t.fit(documents, labels.where("false"))).collect() == []


def test_query_rows(spark, tables_dir):
    rows = op1_toxicity(spark, tables_dir).collect()
    documents = spark.read.parquet(f"{tables_dir}/documents.parquet")
    assert len(rows) == documents.count()
    held = documents.select("doc_id", (F.crc32(F.col("doc_id").cast("string")) % 5 == 0).alias("h"))
    assert {r.doc_id: r.held_out for r in rows} == dict(map(tuple, held.collect()))
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)


@pytest.mark.skipif(not os.path.isdir(BIG), reason="no such table")
def test_held_out_documents(spark):
    labels = spark.read.parquet(f"{BIG}/labels.parquet")
    rows = op1_toxicity(spark, BIG).where("held_out").join(labels, "doc_id").collect()
    toxic = [r.predicted for r in rows if r.toxic]
    clean = [r.predicted for r in rows if not r.toxic]
    assert sum(toxic) / len(toxic) >= 0.9
    assert sum(toxic) / (sum(toxic) + sum(clean)) >= 0.9


@pytest.fixture(scope="module")
def machine(spark):
    tables = [spark.read.parquet(f"{BIG}/{name}.parquet") for name in ("documents", "labels")]
    return t.fit(*tables), *tables


INSULTS = "trash pathetic idiot disgusting worthless stupid loser clown scum moron".split()


@pytest.mark.skipif(not os.path.isdir(BIG), reason="no such table")
def test_altered_insults(machine):
    """Every plain, shouted, hyphenated and doubled form is caught, and most of the gapped ones."""
    found = {}
    for word in INSULTS:
        middle = len(word) // 2
        forms = {
            "plain": word, "upper": word.upper() + "!", "hyphen": f"{word[:middle]}-{word[middle:]}",
            "double": word[:middle] + word[middle - 1 :], "star": f"{word[:middle]}*{word[middle:]}",
            "dots": ".".join(word), "spaces": " ".join(word), "letter": f"{word[:middle]}x{word[middle:]}",
        }
        evidence, _ = machine[0].evidence([f"the {form} of it" for form in forms.values()])
        for form, p in zip(forms, machine[0].probabilities(evidence).tolist()):
            found.setdefault(form, []).append(p >= 0.5)
    assert all(all(found[form]) for form in ("plain", "upper", "hyphen", "double", "star"))
    assert min(sum(found[form]) for form in ("dots", "spaces", "letter")) >= 8
    plain = "the of because person motion under string house water reading".split()
    assert machine[0].probabilities(machine[0].evidence(plain)[0]).max() < 0.5


@pytest.mark.skipif(not os.path.isdir(BIG), reason="no such table")
def test_witnesses_stand_in_several_documents(spark, machine):
    from orderflow.llm.common import labelled

    _, documents, labels = machine
    rows = labelled(documents, labels, "toxic", t.SAMPLE).where("text IS NOT NULL").cache()
    toxic = [set(x.text.lower().split()) for x in rows.where("label > 0").collect()]
    words = [r.word for r in t.witnesses(rows).collect()]
    assert set(INSULTS) <= set(words)
    for word in words:
        assert sum(any(word in w for w in own) for own in toxic) >= t.SUPPORT, word


def test_sentences(spark):
    rows = spark.createDataFrame([(1, 1, "One two. Three! Four\nfive? six"), (2, 0, ""), (3, 0, "a.b")], "doc_id long, label int, text string")
    found = sorted((r.doc_id, r.sentence) for r in t.sentences(rows).collect())
    assert found == [(1, "Four"), (1, "One two."), (1, "Three!"), (1, "five?"), (1, "six"), (3, "a.b")]


def test_null_id_is_not_held_out(spark, tmp_path):
    rows = [(None, "hello", "en", "x", 5), (1, None, "en", "x", 0), (1, None, "en", "x", 0)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, toxicity long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, 0, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    found = op1_toxicity(spark, str(tmp_path)).collect()
    assert len(found) == 3 and {r.held_out for r in found if r.doc_id is None} == {False}
