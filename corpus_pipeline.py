"""From raw documents to shards of training text: five stages over the whole corpus.

Each stage takes (spark, docs, sf_dir) and returns a frame; all but the last return the
columns of documents.  Stages are written and read again between each other, so a lost
executor costs no more than the stage that it worked on.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from loanlens.llm import decontamination, mixing, quality_rules, sharding, simhash_wide
from loanlens.llm.queries import SHARDS, SLOTS, table
from loanlens.llm.text import prepared
from loanlens.session import materialised

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the cutoffs proven on the labels."""
    return quality_rules.keep_good(docs, table(prepared(spark), sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word similarity of 0.8 or more."""
    prepared(spark)
    return simhash_wide.keep_first(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of the benchmark."""
    return decontamination.keep_clean(docs, table(prepared(spark), sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: not at all, once or twice."""
    prepared(spark)
    return mixing.apply_mix(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document with its shard."""
    prepared(spark)
    return sharding.place(docs, SHARDS, SLOTS)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality),
    ("simhash_near_dedup", near_duplicates),
    ("benchmark_decontamination", decontaminate),
    ("mixing", mix),
    ("sharding", shard),
]

# Fingerprints, retrieval and test bounds are beyond SQL; the tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    docs = table(prepared(spark), sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialised(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
