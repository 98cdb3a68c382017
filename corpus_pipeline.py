"""A training corpus from ``documents``: five stages, each written as Parquet and read by the next.

Language ID rejects documents without a language; repeated lines go; of near duplicates one document stays;
sources are mixed to their weights, in training order; what is left is encoded. Nulls, empty texts, repeated
rows, empty tables and extra columns are handled as each operator says; the first four stages return the
columns of their input."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tallyframe.llm import bpe, langid, lines, minhash, mixing
from tallyframe.sources.sinks import cleared, stored


def identify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return langid.keep_identified(docs)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return lines.without_repeated_lines(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids (little-endian unsigned 32-bit integers) of each row of the mix."""
    return bpe.encoded(docs, public_tokenizers.path("word_bpe_49k.json"), decoded=False)


STAGES = [
    ("language_id", identify),
    ("line_dedup", drop_lines),
    ("near_dedup", drop_near_duplicates),
    ("mixing", mix_sources),
    ("bpe", encode),
]
#: Classification, similarity links and encoding are beyond SQL; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        with cleared() as kept:  # what a stage has written goes as its result is there
            docs = stored(stage(spark, docs, sf_dir))
            kept.append(docs)
    return STAGES[-1][1](spark, docs, sf_dir)
