"""Small summaries that can be merged later, when the rows they were made from are gone.

A summary row holds sums and Spark's own sketches: KLL for quantiles, HyperLogLog for
distinct numbers, theta for the overlap of sets. Merging rows gives what one pass over all rows would
have given, within the same bounds.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from .events import ERROR, LATENCY_PERCENTILES

#: Size of a quantile sketch; about 0.1 % of the ranks (``rank_error``).
QUANTILE_K = 2000

#: Size of the distinct and overlap sketches, as a power of two; 1.6 % (``distinct_error``).
DISTINCT_LOG2 = 12


def rank_error(k: int = QUANTILE_K) -> float:
    """How far the rank of an estimated quantile may be off, as a share of all rows, in 99 of 100 cases.

    The published error of the KLL sketch; merging doesn't add to it.
    """
    return 2.296 / k**0.9723


def distinct_error(log2: int = DISTINCT_LOG2) -> float:
    """Relative standard error of a distinct estimate."""
    return 1 / math.sqrt(1 << log2)


# ---- Metrics of image events ------------------------------------------------------------


def daily_summaries(events: DataFrame, k: int = QUANTILE_K, log2: int = DISTINCT_LOG2) -> DataFrame:
    """One row per day and source: counts, bytes, and sketches of durations and image ids.

    A few kilobytes a row, whatever the day held; made while the events are there.
    """
    return events.groupBy("dt", "source").agg(
        F.count(F.lit(1)).alias("images"), F.count_if(F.col("status") == ERROR).alias("failed"),
        F.coalesce(F.sum("bytes_in"), F.lit(0)).alias("bytes_in"),
        F.kll_sketch_agg_bigint(F.col("duration_ms").cast("long"), k).alias("durations"),
        F.hll_sketch_agg("image_id", log2).alias("image_ids"),
    )


def rolled_up(summaries: DataFrame, groups: Mapping[str, Column]) -> DataFrame:
    """Summary rows of coarser groups, such as weeks or all sources; they can be rolled up again."""
    named = summaries.withColumns(dict(groups))
    return named.groupBy(*groups).agg(
        F.sum("images").alias("images"), F.sum("failed").alias("failed"), F.sum("bytes_in").alias("bytes_in"),
        F.kll_merge_agg_bigint("durations").alias("durations"), F.hll_union_agg("image_ids").alias("image_ids"),
    )


def summary_metrics(summaries: DataFrame, percentiles: Mapping[str, float] = LATENCY_PERCENTILES) -> DataFrame:
    """The metrics that summary rows tell: failure rate, estimated percentiles, estimated distinct images.

    Percentiles of a group without durations are null.
    """
    measured = F.kll_sketch_get_n_bigint("durations") > 0
    told = {
        "failure_rate": F.round(F.col("failed") / F.col("images"), 6), "distinct_images": F.hll_sketch_estimate("image_ids"),
        **{name: F.when(measured, F.kll_sketch_get_quantile_bigint("durations", F.lit(float(share)))) for name, share in percentiles.items()},
    }
    return summaries.withColumns(told).drop("durations", "image_ids")


# ---- Identities of batches ----------------------------------------------------------------


def identity_sketches(rows: DataFrame, groups: Sequence[str], values: Mapping[str, Column], log2: int = DISTINCT_LOG2) -> DataFrame:
    """Per group the number of rows and, for each of ``values``, its non-null rows, an HLL and a theta sketch."""
    aggregates = [F.count(F.lit(1)).alias("rows")]
    for name, value in values.items():
        aggregates += [F.count(value).alias(f"{name}_rows"), F.hll_sketch_agg(value, log2).alias(f"{name}_distinct"),
                       F.theta_sketch_agg(value, log2).alias(f"{name}_set")]
    return rows.groupBy(*groups).agg(*aggregates)


def merged_identities(sketches: DataFrame, groups: Sequence[str], values: Sequence[str]) -> DataFrame:
    """The same per coarser groups, from the sketches alone; no groups gives one row."""
    aggregates = [F.coalesce(F.sum("rows"), F.lit(0)).alias("rows")]
    for name in values:
        aggregates += [F.coalesce(F.sum(f"{name}_rows"), F.lit(0)).alias(f"{name}_rows"),
                       F.hll_union_agg(f"{name}_distinct").alias(f"{name}_distinct"), F.theta_union_agg(f"{name}_set").alias(f"{name}_set")]
    return sketches.groupBy(*groups).agg(*aggregates)


def overlap_estimate(sketches: DataFrame, side: str, pair: Sequence[str], value: str) -> DataFrame:
    """One row: distinct values on each side of ``pair``, on either, and on both, all estimated.

    ``sketches`` has one row per value of ``side``. Sets with fewer members than the sketch holds are exact.
    """
    def of(member: str) -> Column:
        return F.max(F.when(F.col(side) == member, F.col(f"{value}_set")))

    one = sketches.agg(*[of(member).alias(f"set_{i}") for i, member in enumerate(pair)])
    both = F.theta_sketch_estimate(F.theta_intersection("set_0", "set_1"))
    either = F.theta_sketch_estimate(F.theta_union("set_0", "set_1"))
    return one.select(
        *[F.coalesce(F.theta_sketch_estimate(f"set_{i}"), F.lit(0)).alias(member) for i, member in enumerate(pair)],
        F.coalesce(either, F.theta_sketch_estimate("set_0"), F.theta_sketch_estimate("set_1"), F.lit(0)).alias("either"),
        F.coalesce(both, F.lit(0)).alias("both"),
    )
