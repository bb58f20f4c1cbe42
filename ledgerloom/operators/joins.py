"""Joins that stay balanced when one key holds a large part of the rows.

Most operators here avoid the question by aggregating per key before they join.
These helpers serve the joins that must keep every row of the large side.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, functions as F

from ..session import settled

#: A side is broadcast only when it was measured to be at most this large.
BROADCAST_BYTES = 64 * 1024 * 1024

#: A key is hot when it holds more than this share of the rows, or more rows than one task
#: should get, whichever is less. That bounds the list of hot keys by the rows of the table.
HOT_SHARE = 0.001
HOT_ROWS = 5_000_000

#: Pieces a hot key is split into.
SALTS = 64

#: Equal rows of a hot key that stay together.
_EQUAL_ROWS = 4096

_ROW_OVERHEAD = 64
_VARIABLE_WIDTH = ("string", "binary")
_NESTED = ("array", "map", "struct")


def measured_bytes(side: DataFrame) -> int:
    """Size of ``side`` from one distributed aggregate over its rows."""
    texts = [F.octet_length(F.col(n)) for n, t in side.dtypes if t in _VARIABLE_WIDTH]
    # Arrays, maps and structs are as wide as what they hold.
    texts += [F.octet_length(F.to_json(F.struct(F.col(n)))) for n, t in side.dtypes if t.startswith(_NESTED)]
    fixed = _ROW_OVERHEAD + 16 * len(side.columns)
    per_row = reduce(lambda a, b: a + b, [F.coalesce(t, F.lit(0)) for t in texts], F.lit(fixed))
    return side.agg(F.coalesce(F.sum(per_row.cast("long")), F.lit(0)).alias("bytes")).first()["bytes"]


def hot_keys(
    rows: DataFrame, keys: Sequence[str], share: float = HOT_SHARE, most: int = HOT_ROWS
) -> DataFrame:
    """Keys (null included) holding more than ``share`` of the rows, or more than ``most`` rows."""
    total = rows.count()
    return (
        rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
        .where(F.col("_n") > F.lit(min(total * share, float(most))))
        .select(*keys)
    )


def _join(
    rows: DataFrame, side: DataFrame, keys: Sequence[str], how: str, null_safe: bool, broadcast: bool = False
) -> DataFrame:
    renamed = {k: f"_k_{k}" for k in keys} if null_safe else {}
    side = side.withColumnsRenamed(renamed)
    side = F.broadcast(side) if broadcast else side
    if not null_safe:
        return rows.join(side, list(keys), how)
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(r)) for k, r in renamed.items()])
    return rows.join(side, same, how).drop(*renamed.values())


def _mark_hot(frame: DataFrame, hot: DataFrame, keys: Sequence[str]) -> DataFrame:
    marks = hot.select(*[F.col(k).alias(f"_hot_{k}") for k in keys], F.lit(True).alias("_hot"))
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_hot_{k}")) for k in keys])
    return frame.join(F.broadcast(marks), same, "left").drop(*[f"_hot_{k}" for k in keys])


def lookup_join(
    rows: DataFrame,
    side: DataFrame,
    keys: Sequence[str],
    how: str,
    max_bytes: int = BROADCAST_BYTES,
    share: float = HOT_SHARE,
    salts: int = SALTS,
    null_safe: bool = False,
) -> DataFrame:
    """Join every row of ``rows`` to ``side``, which has at most one row per key.

    Null keys match each other only with ``null_safe``. ``how`` is ``inner``, ``left``, ``left_semi`` or ``left_anti``. A side measured
    below ``max_bytes`` is broadcast and ``rows`` does not move. Beyond that both
    sides are shuffled: rows with cold keys are joined as they are, rows with hot keys are
    spread over ``salts`` pieces and only those keys repeated on the side.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"unsupported join type: {how}")
    keys = list(keys)
    if measured_bytes(side) <= max_bytes:
        return _join(rows, side, keys, how, null_safe, broadcast=True)

    hot = settled(hot_keys(rows, keys, share))
    if hot.isEmpty():
        return _join(rows, side, keys, how, null_safe)
    marked = _mark_hot(rows, hot, keys)
    cold = _join(marked.where("_hot is null").drop("_hot"), side, keys, how, null_safe)

    # Equal rows travel as one row with a number, dealt out in lots; the piece of a lot depends
    # on its values only, so a task that runs again sends it to the same place.
    lots = (
        marked.where("_hot").drop("_hot").groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_lot", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("_n") - 1) / _EQUAL_ROWS))))
        .withColumn("_n", F.least(F.lit(_EQUAL_ROWS).cast("long"), F.col("_n") - F.col("_lot") * _EQUAL_ROWS).cast("int"))
        .withColumn("_salt", F.pmod(F.xxhash64(*[F.col(c) for c in rows.columns], "_lot"), F.lit(salts)).cast("int"))
        .drop("_lot")
    )
    repeated = (
        _mark_hot(side, hot, keys).where("_hot").drop("_hot")
        .withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    )
    spread = _join(lots, repeated, [*keys, "_salt"], how, null_safe)
    again = spread.withColumn("_again", F.explode(F.sequence(F.lit(1), F.col("_n"))))
    return cold.unionByName(again.select(*cold.columns))
