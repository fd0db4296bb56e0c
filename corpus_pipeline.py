"""A training corpus from raw documents: each stage works on what the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from maskflow.llm import contamination, fingerprints, mixing, quality, sharding
from maskflow.llm.common import load, stored
from maskflow.llm.queries import QUALITY_AT_LEAST, SHARDS


def keep_good(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    return quality.keep_good(docs, load(spark, folder, "labels"), QUALITY_AT_LEAST)


def drop_copies(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return fingerprints.one_of_each(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that hold a test item go."""
    return contamination.without_leaks(docs, load(spark, folder, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents as often as the mix of their sources takes them."""
    return mixing.mix(docs)


def deal_out(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents with their shard and their slot in it."""
    return sharding.with_slots(sharding.shard(docs, sharding.Tree(SHARDS)))


STAGES = [
    ("quality classifier", keep_good),
    ("SimHash near-dedup", drop_copies),
    ("benchmark decontamination", drop_leaks),
    ("mixing sources", mix_sources),
    ("sharding", deal_out),
]

# No stage but the last two could be put in SQL; tests use brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    """All stages over ``documents``, each result stored and read back."""
    docs = load(spark, folder, "documents")
    for number, (_, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, folder)
        if number < len(STAGES):
            docs = stored(docs, f"stage-{number}")
    return docs
