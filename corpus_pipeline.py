"""Corpus pipeline over ``documents``: five stages, each working on all that the
one before kept.

Toxic documents go; one document of each SimHash component stays; passages that
repeat are cut, and documents that lose every word go; sources are mixed to
their target weights, a document twice where its source is repeated; what is
left is encoded, two sampled segmentations for each row.

Defined results: null texts count as empty throughout; texts without words are
equal, so one of them stays. Rows without an id are kept by the second stage and are
one document to the third. Rows that repeat an id stay or go together where the id
decides, and each as often as the mix takes it. Ties go to the smaller id. An empty
table gives an empty result.

The last stage returns (doc_id, sample, n_pieces, ids_crc32, log_prob,
perturbed, inclusion, restored, ids), the others the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strata.llm import mixing, segmentation, simhash, substrings, toxicity, words


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.without_toxic(docs, docs, words.table(spark, sf_dir, "labels"))


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs, width=3, max_bits=2)


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return substrings.without_repeats(docs, window=20)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed(docs, share=1.5, most=2.0, weights=(3, 1, 2))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return segmentation.encode(docs, public_tokenizers.path("piece_bpe_32k.model"), k=2, alpha=1.0)


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", keep_one_of_near_copies),
    ("substring_dedup", cut_repeated_passages),
    ("source_mixing", mix_sources),
    ("sentencepiece", encode),
]

# A trained classifier and sampled segmentations have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; what a stage returns is written and read again."""
    docs = words.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = words.stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
