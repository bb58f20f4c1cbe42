"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import stored


def _state(links: DataFrame) -> tuple[int, int]:
    # Summed as decimals, which do not overflow.
    row = links.agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")
    ).first()
    return row["n"], int(row["h"] or 0)


def _large_star(links: DataFrame) -> DataFrame:
    both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m"))
    return (
        both.join(least, "a").where(F.col("b") > F.col("a"))
        .select(F.col("b").alias("a"), F.least("a", "m").alias("b"))
    )


def _small_star(links: DataFrame) -> DataFrame:
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    moved = links.join(least, "a").where(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b")))


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links``; root is the least node reachable.

    ``links`` has two columns of one ordered type, in any direction, repeats allowed.
    Alternating large and small stars: each round is two aggregates and two joins over
    the links, the number of links never grows, and rounds grow with the logarithm of
    the number of nodes. Only a count and a checksum reach the driver. A node with very
    many links is one row of ``least`` and many rows of the other side, which adaptive
    execution splits.
    """
    first, second = links.columns
    now = stored(
        links.select(F.greatest(first, second).alias("a"), F.least(first, second).alias("b"))
        .where("a <> b").distinct(),
        "links",
    )
    before = _state(now)
    while before[0]:
        now = stored(_small_star(_large_star(now)).distinct(), "links")
        after = _state(now)
        if after == before:
            break
        before = after
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )
