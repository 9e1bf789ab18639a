import hashlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from orderflow.llm import bpe
from orderflow.llm.queries import op7_bpe, token_digests, tokenizer_file

PATH = public_tokenizers.path("byte_bpe_50k.json")
TEXTS = [
    "",
    None,
    "Hello world, it's 2024!",
    "aaaaaaa aaaa   \n\n  x",
    "a <|endoftext|> b<|endoftext|>",
    "   ",
    "\x1c\x1d\x85 x   y",
    "日本語テキスト🎉👩‍👩‍👧",
    "x" * 5000,
    "ab" * 3000 + "\x00\x01",
    "1²½٣ a٣",
    "Hello world, it's 2024!",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def digest(library, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    return (
        len(ids),
        hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
        hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest(),
    )


def test_equals_the_library(spark, library):
    rows = [(n, text, text) for n, text in enumerate(TEXTS)]
    documents = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    found = {r.doc_id: tuple(r)[1:] for r in token_digests(spark, documents).collect()}
    assert found == {n: digest(library, text) for n, text, _ in rows}


def test_round_trip_is_encode_then_decode(spark):
    rows = [(1, "one two <|endoftext|>"), (2, None), (2, ""), (3, "é\u00a0\n\n x" * 50), (3, "one two <|endoftext|>")]
    texts = spark.createDataFrame(rows, "doc_id long, text string")
    path = tokenizer_file()
    both = bpe.decode(bpe.encode(texts, path), path)
    assert sorted(map(tuple, bpe.round_trip(texts, path).collect())) == sorted(map(tuple, both.collect()))
    assert bpe.round_trip(texts.where("false"), path).collect() == []


def test_repeated_ids_and_empty_table(spark):
    documents = spark.createDataFrame([(1, "a b"), (1, "a b"), (None, "c")], "doc_id long, text string")
    assert token_digests(spark, documents).count() == 3
    assert token_digests(spark, documents.where("false")).collect() == []


def test_every_letter(library):
    texts = [f"a{chr(c)}1 {chr(c)}b" for c in range(0x3000)]
    expected = [np.array(e.ids, "<u4").tobytes() for e in library.encode_batch(texts)]
    assert bpe.vocabulary(PATH).encode(texts) == expected


def test_cache_starts_afresh(monkeypatch, library):
    monkeypatch.setattr(bpe, "CACHED", 2)
    model = bpe.Vocabulary(PATH)
    for text in ("one two three four", "two five", "one six"):
        expected = np.array(library.encode(text).ids, "<u4").tobytes()
        assert model.encode([text]) == [expected]


def test_query_covers_the_table(spark, tables_dir, library):
    found = {r.doc_id: tuple(r)[1:] for r in op7_bpe(spark, tables_dir).collect()}
    rows = spark.read.parquet(f"{tables_dir}/documents.parquet").collect()
    assert found == {r.doc_id: digest(library, r.text) for r in rows}
