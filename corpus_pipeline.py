"""From raw documents to training shards: each stage reads what the one before it kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerloom.llm import decontam, langid, mixing, sharding, simhash
from ledgerloom.llm.common import free_name, stored, table
from ledgerloom.plans.registry import Query

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the model does not reject; the model is fitted on their own labels."""
    name = free_name(docs.columns, "identified")
    found = langid.identified(docs, langid.train(docs), name=name)
    return found.where(~F.col(name)["rejected"]).drop(name)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return simhash.one_of_each_group(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of the benchmark."""
    return decontam.without_benchmark(docs, table(spark, sf_dir, "benchmark"))


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mixture(docs)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their shard and their slot in it."""
    return sharding.sharded(docs)


STAGES: list[tuple[str, Stage]] = [
    ("language ID", known_language),
    ("SimHash near-dedup", near_dedup),
    ("benchmark decontamination", decontaminated),
    ("mixing sources", mixed_sources),
    ("sharding", shards),
]

#: The stages learn models and follow links through a graph, which SQL cannot express.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied in order to ``documents``; each result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return docs


PIPELINE = Query("pipeline", run, ORACLE_SQL)
