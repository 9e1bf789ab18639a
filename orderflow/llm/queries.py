"""One query for each operator, over its whole table, and the SQL that checks it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderflow.llm import (
    bpe,
    decontamination,
    html,
    jaccard,
    language,
    licenses,
    lm_scoring,
    periodic,
    quality,
    ranked,
    sharding,
    toxicity,
    urls,
)
from orderflow.llm.common import read, remainder

Query = Callable[[SparkSession, str], DataFrame]


def tokenizer_file() -> str:
    """The public byte-level vocabulary with 50,257 ids."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def token_digests(spark: SparkSession, documents: DataFrame) -> DataFrame:
    tokens = bpe.round_trip(documents, tokenizer_file())
    return tokens.select(
        "doc_id",
        F.expr("octet_length(ids) div 4").cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.sharded(read(spark, sf_dir, "documents"), shards=40)
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op3_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.scored(read(spark, sf_dir, "documents"), tokenizer_file())


def op4_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = html.extracted(read(spark, sf_dir, "pages"))
    return texts.withColumn("n_chars", F.length("text").cast("long"))


def op5_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages")
    return urls.judged(pages, urls.fit(pages))


def op6_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scanned(read(spark, sf_dir, "documents"))


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_digests(spark, read(spark, sf_dir, "documents"))


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read(spark, sf_dir, "documents")
    machine = toxicity.fit(documents, read(spark, sf_dir, "labels"))
    scored = toxicity.scored(documents.select("doc_id", "text"), machine)
    return scored.select(
        "doc_id",
        F.coalesce(remainder(F.col("doc_id")) == 0, F.lit(False)).alias("held_out"),
        F.col("toxicity").alias("score"),
        (F.col("toxicity") >= 0.5).cast("int").alias("predicted"),
        "toxic_word",
    )


def op8_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.joined(read(spark, sf_dir, "documents"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contaminated(
        read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark")
    )


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read(spark, sf_dir, "documents")
    trees = quality.fit(documents, read(spark, sf_dir, "labels"))
    scored = quality.scored(documents.select("doc_id", "text"), trees)
    return scored.select(
        "doc_id", *quality.COUNTS, "base_failed", "kept", F.col("quality_score").alias("score")
    )


def op11_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked.ranked(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op12_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read(spark, sf_dir, "documents")
    found = language.predicted(documents, language.fit(documents))
    held_out = F.coalesce(remainder(F.col("doc_id"), language.PARTS) == language.HELD_OUT, F.lit(False))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "ambiguous")


def with_planted_periods(documents: DataFrame) -> DataFrame:
    """``doc_id, text`` in which every tenth document by crc32(doc_id as text) repeats itself.

    With h that hash, g = h div 10 and n words, the words from a = g mod n on are replaced
    by repeats of the first 1 + (n - a) div (3 + g mod 8) of them.
    """
    parts = F.split(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+")
    hashed = F.crc32(F.col("doc_id").cast("string"))
    g = F.floor(hashed / 10)
    words = F.array(F.filter(parts, lambda word: word != ""))

    def repeated(w):
        n = F.size(w)
        places = F.array(F.struct((g % n).cast("int").alias("a"), n.alias("n")))

        def put(s):
            period = 1 + F.floor((s.n - s.a) / (3 + g % 8)).cast("int")
            at = lambda i: F.when(i < s.a, i).otherwise(s.a + (i - s.a) % period)
            return F.transform(F.sequence(F.lit(0), s.n - 1), lambda i: F.get(w, at(i)))

        joined = F.array_join(F.get(F.transform(places, put), F.lit(0)), " ")
        return F.when(n > 0, joined).otherwise(F.lit(""))

    altered = F.get(F.transform(words, repeated), F.lit(0))
    return documents.select("doc_id", F.when(hashed % 10 == 0, altered).otherwise(F.col("text")).alias("text"))


def op13_periodic(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic.detected(with_planted_periods(read(spark, sf_dir, "documents")))
    longest = F.array_max(
        F.transform("runs", lambda r: F.struct(r.length.alias("length"), (-r.start).alias("start"), (-r.period).alias("period")))
    )
    rows = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r.start, r.length, r.period), F.lit("\n")))
    best = found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        longest.alias("best"),
        F.sha2(F.array_join(rows, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
    return best.select(
        "doc_id",
        "n_runs",
        (-F.col("best.start")).alias("start"),
        F.col("best.length").alias("length"),
        (-F.col("best.period")).alias("period"),
        F.expr("(1000 * best.length) div -best.period").alias("exponent_milli"),
        "runs_sha256",
        "collapsed_sha256",
    )


QUERIES: dict[str, Query] = {
    "op1_toxicity": op1_toxicity,
    "op2_sharding": op2_sharding,
    "op3_lm_scoring": op3_lm_scoring,
    "op4_html": op4_html,
    "op5_urls": op5_urls,
    "op6_licenses": op6_licenses,
    "op7_bpe": op7_bpe,
    "op8_jaccard": op8_jaccard,
    "op9_decontamination": op9_decontamination,
    "op10_quality": op10_quality,
    "op11_ranked": op11_ranked,
    "op12_language": op12_language,
    "op13_periodic": op13_periodic,
}

RANKED_SQL = r"""
WITH found AS (
  SELECT d.row_id, d.doc_id, unnest(regexp_extract_all(
    translate(d.text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM (SELECT row_number() OVER () AS row_id, doc_id, text FROM documents) d
), lengths AS (
  SELECT row_id, doc_id, count(*) AS n FROM found GROUP BY row_id, doc_id
), totals AS (
  SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM lengths
), measures AS (
  SELECT row_id, doc_id, 100 - 50 + ((50 * n * docs) // terms) AS m FROM lengths, totals
), wanted AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark
), postings AS (
  SELECT row_id, term, count(*) AS tf FROM found
  WHERE term IN (SELECT term FROM wanted) GROUP BY row_id, term
), weights AS (
  SELECT term, CAST(floor(1000 * ln((2.0::DOUBLE * docs + 2) / (2.0::DOUBLE * df + 1))) AS BIGINT) AS w
  FROM (SELECT term, count(*) AS df FROM postings GROUP BY term), totals
), scores AS (
  SELECT item_id, doc_id, row_id,
    CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m))) AS BIGINT) AS score
  FROM wanted JOIN weights USING (term) JOIN postings USING (term) JOIN measures USING (row_id)
  GROUP BY item_id, doc_id, row_id
)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM (
  SELECT item_id, doc_id, score,
    row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST, row_id) AS rank
  FROM scores WHERE score > 0
) WHERE rank <= 50
"""

JACCARD_SQL = r"""
WITH RECURSIVE worded AS (
  SELECT row_number() OVER () AS row_id, doc_id, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w
  FROM documents
), shingled AS (
  SELECT row_id, doc_id, CASE WHEN w IS NULL OR len(w) = 0 THEN []
    WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_distinct([array_to_string(w[i : i + 2], ' ') FOR i IN range(1, len(w) - 1)]) END AS s
  FROM worded
), flat AS (
  SELECT row_id, doc_id, len(s) AS n, unnest(s) AS shingle FROM shingled
), pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM flat a JOIN flat b USING (shingle)
  WHERE a.row_id < b.row_id AND 100 * least(a.n, b.n) >= 90 * greatest(a.n, b.n)
  GROUP BY a.row_id, b.row_id, a.doc_id, b.doc_id, a.n, b.n
  HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))
), links AS (
  SELECT a, b FROM pairs UNION SELECT b, a FROM pairs
), reached AS (
  SELECT doc_id AS node, doc_id AS other FROM documents WHERE doc_id IS NOT NULL
  UNION SELECT r.node, l.b FROM reached r JOIN links l ON l.a = r.other
)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, c.component_id
FROM shingled s LEFT JOIN (SELECT node, min(other) AS component_id FROM reached GROUP BY node) c
  ON c.node = s.doc_id
"""

ORACLES: dict[str, str] = {"op8_jaccard": JACCARD_SQL, "op11_ranked": RANKED_SQL}
