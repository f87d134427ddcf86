"""A training-text pipeline over ``documents``: each stage is written as Parquet, and the next one reads it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from millrace.llm import langid, mixing, near_copies, pack, secret_scan
from millrace.llm.common import stored, table
from millrace.llm.queries import MIX, WORD_TOKENIZER


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that language identification does not reject, as they are."""
    model = langid.fit(docs.filter(~langid.held_out()))
    return langid.accepted(docs, model)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (five-word shingles, Jaccard 0.8): the one with the smallest id."""
    return near_copies.one_per_group(docs)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with a mark in place of every secret."""
    return secret_scan.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the target weights take them; those of a later epoch are repeated rows."""
    return mixing.mixed(docs, MIX)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences of 2,048 tokens."""
    return pack.pack(docs, WORD_TOKENIZER, 2048).drop("doc_row")


STAGES = [
    ("language_id", keep_known_languages),
    ("simhash_near_dedup", drop_near_duplicates),
    ("secret_scan", redact_secrets),
    ("mix_sources", mix_sources),
    ("pack", pack_sequences),
]

# Centroids, fingerprint groups and token ids are not expressible in SQL: tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows over the given documents."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
