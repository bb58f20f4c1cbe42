"""Queries of the operators that learn from the corpus."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..plans.registry import Collected
from . import ann, decontam, lm
from .common import fold, table

_QUERIES = Collected()
QUERIES = _QUERIES.queries


@_QUERIES.add()
def op7_latent_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = decontam.benchmark_hits(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return hits.drop("row_key").distinct()


@_QUERIES.add()
def op8_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return ann.search(ann.build_index(vectors), vectors.where(F.col("vec_id") % 50 == 0))


@_QUERIES.add()
def op9_context_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("held_out", fold(F.col("doc_id"), 7) == 2)
    return lm.scored(docs)
