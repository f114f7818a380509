"""The corpus pipeline: documents in, token ids out."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tripmill.llm import bytebpe, langid, linededup, mixing, simhash
from tripmill.llm.common import TEXT_ROWS, hand_over, stored
from tripmill.llm.queries import (
    BOILERPLATE_SITES,
    BYTE_BPE,
    MIX_BLOCK,
    MIX_ENTROPY,
    MIX_REPEATS,
    NEAR_BITS,
    NEAR_SHINGLE,
)

# Models, spreads and mixtures are no SQL; tests/llm compares the stages with brute force.
ORACLE_SQL = None


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the model accepts; the model learns from the labelled ones."""
    return langid.accepted(docs, langid.train(docs))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines that stand on many sources, but for one copy of each line."""
    return linededup.without_spread_lines(docs, BOILERPLATE_SITES).drop("n_lines", "n_removed")


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    hand_over(spark, TEXT_ROWS)
    return simhash.one_of_each_group(docs, NEAR_SHINGLE, NEAR_BITS)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document at least once; documents of small sources up to the limit of repeats.

    They leave in the order of the mixture: permuted blocks, the sources taking turns by weight.
    """
    mixed = mixing.mix(docs, MIX_ENTROPY, MIX_REPEATS, block_tokens=MIX_BLOCK)
    return mixed.select(docs.columns)


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and whether they decode to its text."""
    hand_over(spark, TEXT_ROWS)
    kept = docs.select("doc_id", "lang", "source", "text")
    return bytebpe.encode(kept, BYTE_BPE, public_tokenizers.PATTERN)


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("simhash_dedup", simhash_dedup),
    ("source_mixing", source_mixing),
    ("byte_bpe", byte_bpe),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in turn; each writes its documents to the shared folder for the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
