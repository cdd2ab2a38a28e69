"""From raw documents to token ids: five stages over whole tables.

Each stage takes (spark, docs, sf_dir) and gives a DataFrame, which is written as
Parquet and read again as the next stage's documents. All but the last return the
columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspur.llm import bpe, jaccard_join, mixing, quality_model, suffix_dedup
from larkspur.llm.queries import quality_labels
from larkspur.session import materialize
from larkspur.sources import table

RANKS = "byte_bpe_multi_50k.tiktoken"


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, fitted on the labelled ones, does not reject."""
    model = quality_model.fit_quality(docs, quality_labels(spark, sf_dir))
    return quality_model.keep_good(docs, model)


def one_of_each_class(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The least doc_id of every class of near duplicates."""
    return jaccard_join.keep_first(docs)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 50 words or more stay in the first document that holds them only."""
    return suffix_dedup.drop_repeats(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources in the ratio of their targets: documents are left out or come up to three times."""
    return mixing.take_mix(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the ids and of the decoded bytes of every document."""
    return bpe.round_trip(docs, public_tokenizers.path(RANKS), public_tokenizers.PATTERN)


STAGES = [
    ("quality_classifier", good_documents),
    ("ngram_jaccard_join", one_of_each_class),
    ("suffix_array_dedup", without_repeats),
    ("mixing", mixed),
    ("byte_bpe", encoded),
]

# Classifier and tokenizer cannot be written in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, applied to the documents of a folder of tables."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
