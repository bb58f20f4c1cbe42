"""Surrogate ids for appended rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from ..session import settled

#: monotonically_increasing_id keeps the row's place in its partition in the low 33 bits.
_ROW_BITS = 33


def assign_surrogate_ids(
    rows: DataFrame, order_by: Sequence[str], name: str, start_after: int = 0
) -> DataFrame:
    """Add ``name``: start_after + 1, + 2, ... without gaps, following ``order_by``.

    The rows are range-sorted (a shuffle balanced by sampling) and keep their place
    inside their partition; one total per partition is then turned into an offset.
    Only that list of totals, one row per partition, is ever gathered. The sorted
    rows are stored first, so the places that were counted and the places
    that are numbered are the same even if an executor is lost in between.
    ``order_by`` should identify a row; equal rows get ids in no particular order.
    """
    placed = settled(
        rows.orderBy(*order_by)
        .withColumn("_place", F.monotonically_increasing_id())
        .withColumn("_part", F.shiftright("_place", _ROW_BITS))
        .withColumn("_row", F.col("_place").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)))
        .drop("_place")
    )
    in_order = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
        .select("_part", F.coalesce(F.sum("_n").over(in_order), F.lit(0)).alias("_offset"))
    )
    # One row per partition of ``placed``: a size known from the partition count.
    return (
        placed.join(F.broadcast(offsets), "_part")
        .withColumn(name, (F.lit(start_after) + F.col("_offset") + F.col("_row") + 1).cast("long"))
        .drop("_part", "_row", "_offset")
    )


def append_with_ids(
    existing: DataFrame, rows: DataFrame, order_by: Sequence[str], name: str
) -> DataFrame:
    """``rows`` numbered from the highest ``name`` in ``existing``; an empty table starts at 1."""
    highest = existing.agg(F.coalesce(F.max(name), F.lit(0)).alias("top")).first()["top"]
    return assign_surrogate_ids(rows, order_by, name, start_after=int(highest))
