"""The corpus pipeline: five stages over documents, each written as Parquet and read again by the next."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tilth.llm import langid, mixing, packing, simhash, suffix_dedup
from tilth.llm.common import forget, table, written

BPE, BPE_RANKS, MULTI = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "byte_bpe_50k.tiktoken", "byte_bpe_multi_50k.tiktoken"))


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that is recognised; learned from those that name theirs."""
    return langid.accepted(docs, langid.learn(docs, MULTI), MULTI)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the smallest id."""
    return simhash.one_of_each(docs)


def repeat_removal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without the passages that an earlier one has; one that loses all stays, empty."""
    return suffix_dedup.without_repeats(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each use of a document in the mix."""
    return mixing.mixed(docs)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of training windows with their token ids."""
    return packing.pack(docs, BPE, BPE_RANKS)


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("repeat_removal", repeat_removal),
    ("source_mix", source_mix),
    ("sequences", sequences),
]

#: Learned models, hashes and tokens have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
        if before is not None:
            forget(before)
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)
