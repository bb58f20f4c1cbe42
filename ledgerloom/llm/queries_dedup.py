"""Query of the near-duplicate operator."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..plans.registry import Collected
from .common import table
from .simhash import fingerprint_text, near_duplicates

_QUERIES = Collected()
QUERIES = _QUERIES.queries


@_QUERIES.add()
def op1_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", fingerprint_text(found.fp).alias("fingerprint"), "component_id")
