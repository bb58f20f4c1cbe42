"""First rows, keep-first deduplication and weighted sampling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import settled
from .joins import lookup_join


def first_rows(rows: DataFrame, n: int, position: Sequence[str]) -> DataFrame:
    """The first ``n`` rows in ``position`` order: a per-task top-n, then one merge of those."""
    return rows.orderBy(*position).limit(n)


def keep_first(rows: DataFrame, keys: Sequence[str], position: Sequence[str]) -> DataFrame:
    """The earliest row of each key.

    Spark applies the ``= 1`` limit per task before the shuffle (WindowGroupLimit),
    so at most one row per key and task moves, whatever the size of a group.
    """
    earliest = Window.partitionBy(*keys).orderBy(*position)
    return rows.withColumn("_place", F.row_number().over(earliest)).where("_place = 1").drop("_place")


def dropped_duplicates(rows: DataFrame, keys: Sequence[str], position: Sequence[str]) -> DataFrame:
    """The rows ``keep_first`` leaves out.

    Only rows whose key occurs more than once are looked at any further. They are
    matched on ``position``, which is unique per row: a key held by a third of the rows
    is spread evenly, where ranking whole groups would not be.
    """
    repeated = settled(rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select(*keys))
    again = lookup_join(rows, repeated, keys, "left_semi", null_safe=True)
    return again.join(keep_first(again, keys, position).select(*position), list(position), "left_anti")


def seed_members(accepted: DataFrame, position: Sequence[str], n: int) -> DataFrame:
    """First ``n`` accepted rows, then the first row per id; removed rows are not replaced."""
    return keep_first(first_rows(accepted, n, position), ["membership_id"], position)


def seeded_uniform(seed: int, *parts: str) -> Column:
    """A number in (0, 1) that depends only on ``seed`` and the columns, so it can be replayed."""
    text = F.concat_ws("|", F.lit(str(seed)), *[F.col(p).cast("string") for p in parts])
    # 13 hex digits are 52 bits: exact in a double.
    draw = F.conv(F.substring(F.sha2(text, 256), 1, 13), 16, 10).cast("long")
    return (draw.cast("double") + F.lit(0.5)) / F.lit(float(16**13))


def weighted_sample(
    population: DataFrame, groups: Sequence[str], item: str, weight: str, k: int, seed: int = 0
) -> DataFrame:
    """Up to ``k`` distinct items per group, drawn without replacement by weight.

    Each row gets the key -ln(u) / weight and the k smallest win (Efraimidis and
    Spirakis). Items without a positive weight are never drawn. The k-limit is
    applied per task before the shuffle.
    """
    uniform = seeded_uniform(seed, *groups, item)
    drawn = population.where(F.col(weight) > 0).withColumn(
        "_key", -F.log(uniform) / F.col(weight).cast("double")
    )
    smallest = Window.partitionBy(*groups).orderBy("_key", item)
    return (
        drawn.withColumn("draw", F.row_number().over(smallest))
        .where(F.col("draw") <= k)
        .select(*groups, item, weight, "draw")
    )


def position_differences(first: DataFrame, second: DataFrame, position: str) -> DataFrame:
    """Positions at which two ordered tables do not hold the same row."""
    columns = [c for c in first.columns if c != position]
    left = first.select(position, F.struct(*columns).alias("_first"))
    right = second.select(position, F.struct(*columns).alias("_second"))
    return (
        left.join(right, position, "full")
        .where(~F.col("_first").eqNullSafe(F.col("_second")))
        .select(position, F.col("_first").isNotNull().alias("in_first"),
                F.col("_second").isNotNull().alias("in_second"))
    )
