"""Percentiles per group."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import settled
from .joins import lookup_join

#: Bands that one band is cut into; no window sees more of them.
BANDS = 1024


def band_widths(counted: DataFrame, value: str) -> list[float]:
    """Widths, wide to narrow, from the values: their range cut by BANDS, again and again.

    As many levels as give each distinct value a band of its own if they lie evenly, so
    a narrowest band has about BANDS values at most, whatever the range.
    """
    seen = counted.agg(
        F.min(value).cast("double").alias("low"), F.max(value).cast("double").alias("high"), F.count(value).alias("n")
    ).first()
    extent = (seen["high"] or 0.0) - (seen["low"] or 0.0)
    levels = max(1, math.ceil(math.log(max(2, seen["n"]), BANDS)))
    return [max(extent, 1.0) / BANDS ** k for k in range(1, levels + 1)]


def exact_percentiles(
    rows: DataFrame,
    groups: Sequence[str],
    value: str,
    percentages: Mapping[str, float],
    widths: Sequence[float] | None = None,
) -> DataFrame:
    """Interpolated percentiles of ``value`` per group, exact for groups of any size.

    The built-in exact ``percentile`` keeps a group's distinct values in one task.
    Here rows are reduced to counts per (group, value), spread by value, and the
    rest works on those; see ``percentiles_of_counts``.
    """
    counts = (
        rows.where(F.col(value).isNotNull())
        .groupBy(*groups, value).agg(F.count(F.lit(1)).alias("_n"))
    )
    return percentiles_of_counts(settled(counts), groups, value, "_n", percentages, widths)


def percentiles_of_counts(
    counted: DataFrame,
    groups: Sequence[str],
    value: str,
    count: str,
    percentages: Mapping[str, float],
    widths: Sequence[float] | None = None,
) -> DataFrame:
    """Percentiles from one row per (group, value) with its number of occurrences.

    Counts are totalled in bands to find those that hold the wanted ranks; these are
    cut into bands of the next width, and so on. What is left is ranked value by value.
    A window sees the bands of one width inside one wider band, or the distinct values
    of a narrowest band, never the rows of a group. ``widths`` follow
    from the values unless given. ``counted`` is read twice per width, so it should be stored or cheap.
    """
    groups = list(groups)

    def rank(share: float) -> Column:
        return (F.col("_total") - 1) * F.lit(float(share))

    def ends(share: float) -> tuple[Column, Column]:
        return F.floor(rank(share)), F.ceil(rank(share))

    def covers(target: Column, start: str, size: str) -> Column:
        return (F.col(start) <= target) & (target < F.col(start) + F.col(size))

    def running(size: str, keys: Sequence[str], by: str) -> Column:
        earlier = Window.partitionBy(*keys).orderBy(by).rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum(size).over(earlier), F.lit(0))

    def narrow(width: float) -> Column:
        return F.floor(F.col("_value") / F.lit(width)).cast("long")

    def cut(region: DataFrame, width: float, *place: str) -> DataFrame:
        return region.withColumn("_narrow", narrow(width)).groupBy(*groups, "_band", *place, "_narrow").agg(
            F.sum("_n").alias("_rows")
        )

    widths = band_widths(counted, value) if widths is None else list(widths)
    if not widths:
        raise ValueError("at least one band width is needed")
    region = counted.where(F.col(value).isNotNull()).select(
        *groups, F.col(value).alias("_value"), F.col(count).alias("_n"), F.lit(0).cast("long").alias("_band")
    )
    wanted = [end for share in percentages.values() for end in ends(share)]
    # ``_before`` and ``_total``: the group's rows before a band, and in all. At first
    # the whole group is one band.
    bands = cut(region, widths[0]).withColumns({
        "_before": F.lit(0).cast("long"), "_total": F.sum("_rows").over(Window.partitionBy(*groups)),
    })
    for level, width in enumerate(widths):
        if level:
            bands = cut(region, width, "_before", "_total")
        hits = (
            bands.withColumn("_start", F.col("_before") + running("_rows", [*groups, "_band"], "_narrow"))
            .where(reduce(or_, [covers(end, "_start", "_rows") for end in wanted]))
            .select(*groups, F.col("_narrow").alias("_band"), F.col("_start").alias("_before"), "_total")
        )
        inside = region.withColumn("_band", narrow(width)).drop("_before", "_total")
        region = lookup_join(inside, settled(hits), [*groups, "_band"], "inner", null_safe=True)

    ranked = region.withColumn("_start", F.col("_before") + running("_n", [*groups, "_band"], "_value"))
    found = ranked.groupBy(*groups).agg(
        F.max("_total").alias("_total"),
        *[
            F.max(F.when(covers(end, "_start", "_n"), F.col("_value"))).alias(f"_{side}_{name}")
            for name, share in percentages.items()
            for side, end in zip(("low", "high"), ends(share))
        ],
    )

    def interpolate(name: str, share: float) -> Column:
        low, high = F.col(f"_low_{name}").cast("double"), F.col(f"_high_{name}").cast("double")
        return (low + (high - low) * (rank(share) - F.floor(rank(share)))).alias(name)

    return found.select(*groups, *[interpolate(n, p) for n, p in percentages.items()])


def estimated_percentiles(
    rows: DataFrame,
    groups: Sequence[str],
    value: str,
    percentages: Mapping[str, float],
    accuracy: int = 10000,
) -> DataFrame:
    """One-pass estimate with a sketch of fixed size; rank error at most 1 / ``accuracy``."""
    sketch = F.percentile_approx(value, list(percentages.values()), accuracy)
    return rows.groupBy(*groups).agg(sketch.alias("_p")).select(
        *groups, *[F.get("_p", F.lit(i)).alias(n) for i, n in enumerate(percentages)]
    )
