"""Shards of near-equal bytes by histogram sort."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, Window

from ..session import settled
from .common import free_name, stored

SHARDS = 24

#: How far a boundary may lie from its exact place, as a share of one shard's bytes.
TOLERANCE = 0.001

#: Bytes of one part of a shard; a part is what one task sorts.
PART_BYTES = 256 << 20

#: Keys tried for each boundary in one pass.
PROBES = 64

_TOP = (1 << 63) - 1
_ID_BITS = 23
_OVERHEAD = 8


def place(doc_id: Column, text: Column) -> Column:
    """Sort key: 40 bits of the text's hash, then 23 bits of the id's; equal texts lie together."""
    high = F.xxhash64(text).bitwiseAND(F.lit((1 << (63 - _ID_BITS)) - 1))
    return F.shiftleft(high, _ID_BITS).bitwiseOR(F.xxhash64(doc_id).bitwiseAND(F.lit((1 << _ID_BITS) - 1)))


def _histogram(rows: DataFrame, probes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Exact bytes and rows below each probe. Each task sends one sum per gap between probes."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size, number = np.zeros(len(probes) + 1, np.int64), np.zeros(len(probes) + 1, np.int64)
        for batch in batches:
            gap = np.searchsorted(probes, batch.column(0).to_numpy(), side="left")
            np.add.at(size, gap, batch.column(1).to_numpy())
            number += np.bincount(gap, minlength=len(probes) + 1)
        hit = np.flatnonzero(number)
        yield pa.RecordBatch.from_arrays([pa.array(hit), pa.array(size[hit]), pa.array(number[hit])], ["gap", "bytes", "rows"])

    sums = rows.select("place", "size").mapInArrow(count, "gap long, bytes long, rows long").groupBy("gap").agg(
        F.sum("bytes").alias("bytes"), F.sum("rows").alias("rows")
    )
    size, number = np.zeros(len(probes) + 1, np.int64), np.zeros(len(probes) + 1, np.int64)
    for row in sums.collect():  # at most one row per probe
        size[row["gap"]], number[row["gap"]] = row["bytes"], row["rows"]
    return np.cumsum(size)[:-1], np.cumsum(number)[:-1]


def splitters(
    rows: DataFrame, parts: int, total: int, tolerance: float = TOLERANCE, probes: int = PROBES
) -> tuple[list[int], list[int]]:
    """Keys that cut ``rows`` (place, size) into ``parts`` of near-equal bytes, and the rows below each.

    Every pass counts the exact bytes below ``probes`` candidate keys between the two known
    keys around each boundary, and keeps the pair that encloses it. A boundary is settled when
    its bytes are within ``tolerance`` of a part, or when the two keys are neighbours: then a
    single key holds more than that, and it stays whole. Only sums per candidate reach the driver.
    """
    goal = [total * i / parts for i in range(1, parts)]
    allowed = tolerance * total / parts
    low = [(0, 0, 0)] * len(goal)
    high = [(_TOP, total, -1)] * len(goal)
    best: list[tuple[int, int, int] | None] = [None] * len(goal)
    open_ = list(range(len(goal)))
    while open_:
        tried = sorted({
            low[i][0] + (high[i][0] - low[i][0]) * k // (probes + 1) for i in open_ for k in range(1, probes + 1)
        } | {high[i][0] for i in open_ if high[i][2] < 0})
        size, number = _histogram(rows, np.array(tried, np.int64) - 1)  # below x: at most x - 1
        known = list(zip(tried, size.tolist(), number.tolist()))
        at = 0
        for i in open_:
            while at < len(known) and known[at][1] < goal[i]:
                at += 1
            under, over = known[at - 1] if at else low[i], known[at] if at < len(known) else high[i]
            low[i] = max(low[i], under)
            high[i] = min(high[i], over) if high[i][2] >= 0 else over
            best[i] = min((low[i], high[i]), key=lambda x: abs(x[1] - goal[i]))
        open_ = [i for i in open_ if abs(best[i][1] - goal[i]) > allowed and high[i][0] - low[i][0] > 1]
    return [b[0] for b in best], [b[2] for b in best]


def _part(cuts: Sequence[int]):
    edges = np.array(cuts, np.int64)

    def find(places: pa.Array) -> pa.Array:
        return pa.array(np.searchsorted(edges, places.to_numpy(zero_copy_only=False), side="right").astype(np.int32))

    find.__annotations__ = {"places": pa.Array, "return": pa.Array}
    return F.arrow_udf(find, "int")


def _keys(whole: DataFrame, text: str) -> DataFrame:
    size = F.coalesce(F.octet_length(F.col(f"shard_row.{text}")), F.lit(0)).cast("long") + _OVERHEAD
    return stored(whole.select(F.col("shard_place").alias("place"), size.alias("size")), "shard-keys")


def _spread(whole: DataFrame, heavy: DataFrame) -> DataFrame:
    """``whole`` with the rows of ``heavy`` keys dealt over all keys that begin with the same hash of the text.

    Such rows repeat an id and a text, so any of them may lie anywhere among the group. What tells them apart is the
    number that each gets when they are stored; they are stored once, so it stays theirs.
    """
    marked = whole.join(F.broadcast(heavy), F.col("shard_place") == F.col("shard_heavy"), "left")
    low = F.xxhash64(F.monotonically_increasing_id()).bitwiseAND(F.lit((1 << _ID_BITS) - 1))
    high = F.shiftleft(F.shiftright("shard_place", _ID_BITS), _ID_BITS)
    repeats = marked.where(F.col("shard_heavy").isNotNull()).select("shard_row", high.bitwiseOR(low).alias("shard_place"))
    return marked.where(F.col("shard_heavy").isNull()).drop("shard_heavy").unionByName(stored(repeats, "shard-repeats"))


def sharded(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shards: int = SHARDS,
    tolerance: float = TOLERANCE, part_bytes: int = PART_BYTES,
) -> DataFrame:
    """``docs`` with ``shard`` (0 to shards - 1) and ``slot`` (its place in the shard, from 0, no gaps).

    A row's size is the bytes of its text (null: none) plus 8. Shards hold near-equal bytes:
    boundaries are refined on exact counts and may fall inside a group of equal texts, also among rows
    that repeat both id and text (``_spread``). Every shard consists of parts
    of about ``part_bytes``; the rows cross the network once, to the task of their part, and a
    slot is the rows in front of the part, known from the counts, plus the place in the part.
    Columns called ``shard`` or ``slot`` in ``docs`` stay; the new ones then get a longer name.
    An empty table gives no rows.
    """
    own = F.struct(*[docs[c] for c in docs.columns]).alias("shard_row")
    whole = docs.select(own, place(F.col(doc_id), F.col(text)).alias("shard_place"))
    keys = _keys(whole, text)
    total = keys.agg(F.sum("size").alias("bytes")).first()["bytes"] or 0
    # Keys that hold more than the tolerance: 1 / tolerance a shard at most.
    heavy = settled(keys.groupBy("place").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n"))
                    .where((F.col("n") > 1) & (F.col("bytes") > tolerance * total / shards)).select(F.col("place").alias("shard_heavy")))
    if not heavy.isEmpty():
        whole = _spread(whole, heavy)
        keys = _keys(whole, text)
    inner = max(1, -(-total // (shards * part_bytes)))
    # The tolerance is a share of a shard, so it is ``inner`` times as large a share of a part.
    cuts, below = splitters(keys, shards * inner, total, min(0.25, tolerance * inner)) if total else ([], [])
    starts = [0, *below]
    first = [starts[p] - starts[p // inner * inner] for p in range(len(starts))]
    # One row per part: bytes of the table over ``part_bytes``.
    offsets = docs.sparkSession.createDataFrame(
        pa.table({"shard_part": pa.array(range(len(first)), pa.int32()), "shard_first": pa.array(first, pa.int64())})
    )
    inside = Window.partitionBy("shard_part").orderBy("shard_place", F.col(f"shard_row.{doc_id}"))
    # Every part has its row in ``offsets``. An inner join would ask for parts that are not null in front of the window,
    # and so compute them twice, in two Python workers of each task.
    shard, slot = (free_name(docs.columns, n) for n in ("shard", "slot"))
    return (
        whole.withColumn("shard_part", _part(cuts)("shard_place"))
        .withColumn("shard_index", F.row_number().over(inside).cast("long") - 1)
        .join(F.broadcast(offsets), "shard_part", "left")
        .select("shard_row.*", F.floor(F.col("shard_part") / inner).cast("int").alias(shard),
                (F.col("shard_index") + F.col("shard_first")).alias(slot))
    )


def write_shards(rows: DataFrame, path: str, shard: str = "shard", slot: str = "slot") -> None:
    """One folder per shard, rows in slot order inside each file."""
    rows.sortWithinPartitions(shard, slot).write.partitionBy(shard).parquet(path)
