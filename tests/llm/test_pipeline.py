import hashlib

import corpus_pipeline as pipeline
from orderflow.llm import bpe, decontamination, quality
from orderflow.llm.queries import op1_toxicity, tokenizer_file
from tests.llm.test_jaccard import plain_components
from tests.llm.test_quality import plain


def test_every_stage_on_its_input(spark, tables_dir):
    docs = spark.read.parquet(f"{tables_dir}/documents.parquet")
    columns, kept = docs.columns, [docs]
    for _, stage in pipeline.STAGES[:-1]:
        kept.append(spark.createDataFrame(stage(spark, kept[-1], tables_dir).collect(), docs.schema))
        assert kept[-1].columns == columns
    texts = [{r.doc_id: r.text for r in rows.collect()} for rows in kept]
    rows = [sorted(map(tuple, x.collect())) for x in kept]
    assert all(set(after) <= set(before) for before, after in zip(rows, rows[1:]))

    toxic = {r.doc_id for r in op1_toxicity(spark, tables_dir).collect() if r.predicted}
    assert set(texts[1]) == set(texts[0]) - toxic

    failed = {n for n, t in texts[1].items() if (c := plain(t))[0] < 10 or 100 * c[4] > 20 * c[0]}
    assert not failed & set(texts[2])
    trees = quality.fit(kept[1], spark.read.parquet(f"{tables_dir}/labels.parquet"))
    judged = quality.scored(kept[1], trees).where("kept").collect()
    assert set(texts[2]) == {r.doc_id for r in judged}

    assert set(texts[3]) == {c for _, c in plain_components(texts[2]).values()}

    items = spark.read.parquet(f"{tables_dir}/benchmark.parquet").collect()
    index = decontamination.Index([(r.item_id, r.text) for r in items])
    found = decontamination.passages(index, list(texts[3].values()))
    assert set(texts[4]) == {n for n, m in zip(texts[3], found) if not m}

    tokens = pipeline.encode(spark, kept[4], tables_dir).collect()
    assert sorted(r.doc_id for r in tokens) == sorted(texts[4])
    model = bpe.Vocabulary(tokenizer_file())
    for r in tokens:
        assert bytes(r.ids) == model.encode([texts[4][r.doc_id]])[0]
        assert r.n_tokens * 4 == len(r.ids)
        assert r.decoded_sha256 == hashlib.sha256(texts[4][r.doc_id].encode()).hexdigest()


def test_run_is_the_stages_one_after_the_other(spark, tables_dir):
    docs = spark.read.parquet(f"{tables_dir}/documents.parquet")
    for _, stage in pipeline.STAGES:
        docs = spark.createDataFrame((d := stage(spark, docs, tables_dir)).collect(), d.schema)
    found = pipeline.run(spark, tables_dir).drop("ids")
    assert sorted(found.collect()) == sorted(docs.drop("ids").collect())


def test_odd_documents(spark, tables_dir):
    long = " ".join(f"word{n}" for n in range(30))
    rows = [
        (1, None, "en"), (2, "", "en"), (3, long, "en"), (3, long, "en"), (4, long, None),
        (None, long, "en"), (5, long + " more", "de"), (6, long[::-1], "en"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, matches string")
    kept = pipeline.drop_near_copies(spark, docs, tables_dir).collect()
    assert sorted((r.doc_id or 0, r.text or "") for r in kept) == sorted(
        [(0, long), (1, ""), (2, ""), (3, long), (6, long[::-1])]
    )
    for _, stage in pipeline.STAGES:
        assert stage(spark, docs.where("false"), tables_dir).collect() == []


CLASHING = [
    "id", "label", "toxicity", "toxic_word", "kept", "n_words", "word_chars", "features",
    "quality_score", "base_failed", "matches", "component", "component_id", "n_shingles", "times",
    "_row", "ids", "a.b", "lang",
]


def test_columns_named_like_those_of_operators(spark, tables_dir):
    """Columns of any name pass all four stages with their values and types."""
    from pyspark.sql import functions as F

    docs = spark.read.parquet(f"{tables_dir}/documents.parquet").select("doc_id", "text")
    extra = [F.concat(F.lit(f"{n} "), F.col("doc_id")).alias(n) for n in CLASHING]
    docs = docs.select(extra[0], "doc_id", *extra[1:4], "text", *extra[4:])
    plain = docs.select("doc_id", "text")
    schema = docs.schema
    for _, stage in pipeline.STAGES[:-1]:
        found = stage(spark, docs, tables_dir)
        assert found.schema.names == schema.names
        assert [f.dataType for f in found.schema] == [f.dataType for f in schema]
        docs = spark.createDataFrame(found.collect(), schema)
        plain = spark.createDataFrame(stage(spark, plain, tables_dir).collect(), plain.schema)
    rows = docs.collect()
    assert rows and all(r[n] == f"{n} {r.doc_id}" for r in rows for n in CLASHING)
    assert sorted(r.doc_id for r in rows) == sorted(r.doc_id for r in plain.collect())


def test_representatives_keep_a_column_called_id(spark):
    from orderflow.llm import jaccard

    text = " ".join(f"w{n}" for n in range(20))
    rows = [(1, text, 7), (2, text, 8), (2, text, 8), (None, text, 9), (3, "other", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, id int")
    found = jaccard.representatives(docs)
    assert found.columns == docs.columns
    assert sorted(map(str, map(tuple, found.collect()))) == sorted(
        map(str, [(1, text, 7), (None, text, 9), (3, "other", None)])
    )
