"""Registered queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import (
    licenses,
    mixing,
    naming,
    pages,
    phrases,
    quality,
    ranked,
    segmentation,
    simhash,
    substrings,
    tokenstore,
    toxicity,
    vectors,
)
from strata.llm.words import table

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


@query
def op10_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.components(table(spark, sf_dir, "documents"), width=3, max_bits=2)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query
def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substrings.dedup(table(spark, sf_dir, "documents").select("doc_id", "text"), window=20)
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept_words", 256).alias("kept_sha256"))


@query
def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).select(
        "doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"))


@query
def op5_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    manifest = tokenstore.write(docs, tokenstore.shared_folder(spark, "tokens"),
                                public_tokenizers.path("word_bpe_49k.json"), end_id=2)
    return tokenstore.checksums(tokenstore.read(manifest, docs.select("doc_id")))


@query
def op6_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mixing.mix(table(spark, sf_dir, "documents"), share=1.5, most=2.0, weights=(3, 1, 2))
    return found.select("doc_id", "size", "source_size", "target", "taken")


ORACLES["op6_source_mixing"] = mixing.ORACLE


@query
def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judged(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


ORACLES["op8_quality_rules"] = quality.ORACLE


@query
def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.size("sentence_ids").cast("long").alias("n_sentences"),
                        F.array_join("sentence_ids", ",").alias("sentence_ids"),
                        F.array_join("licences", ",").alias("licences"))


@query
def op3_sentencepiece_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return segmentation.encode(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"),
                               k=2, alpha=1.0)


@query
def op1_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return vectors.search(rows, rows.filter("vec_id % 20 = 0"), k=20)


ORACLES["op1_exact_top_k"] = r"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
c AS (SELECT vec_id, unnest(e) AS x, unnest(range(len(e))) AS d FROM v),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(sum(q.x * c.x) AS BIGINT) AS score
  FROM c AS q JOIN c ON q.d = c.d AND q.vec_id <> c.vec_id
  WHERE q.vec_id % 20 = 0 GROUP BY ALL)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 20
"""


@query
def op2_html_rendering(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pages.rendered(table(spark, sf_dir, "pages").select("page_id", "html"))
    return found.select("page_id", F.col("rendered").alias("text"), F.length("rendered").cast("long").alias("n_chars"),
                        F.size(F.split("rendered", "\n")).cast("long").alias("n_lines"))

ORACLES["op7_substring_dedup"] = substrings.ORACLE
ORACLES["op9_license_scan"] = licenses.oracle()


@query
def op11_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = phrases.collocations(table(spark, sf_dir, "documents"), longest=4, least=30, most=2000, share=80)
    return found.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


ORACLES["op11_phrase_collocations"] = phrases.ORACLE


@query
def op12_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return naming.groups(table(spark, sf_dir, "documents"))


ORACLES["op12_exact_dedup"] = naming.ORACLE


@query
def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=50)


ORACLES["op13_ranked_search"] = ranked.ORACLE
