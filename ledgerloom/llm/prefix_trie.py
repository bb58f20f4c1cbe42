"""The trie of conversation prefixes, from sorted sequences and range minima over their common prefixes."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, Window

from .common import stored

#: A turn in a sequence: 16 bytes of a digest of role and text, and the text's code points in 4 bytes.
TOKEN = 20

#: Ids of one sequence that travel as one piece.
PIECE = 4096

#: Bytes of distinct sequences in one block; small tables are cut into more and smaller blocks.
BLOCK_BYTES, SMALL_BLOCK_BYTES, SMALL_BLOCKS = 32 << 20, 128 << 10, 64

#: Candidate prefixes whose extents are searched at once.
_CANDIDATES = 200_000

EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()

_NODE = ("conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
         "saved_tokens long, ends_sha256 string")
_SUMS = ["n", "leaves", "weighted", "new", "equal", "first"]


# ---- sequences -------------------------------------------------------------------------------

def turn_token(role: Column, text: Column) -> Column:
    body = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    digest = F.substring(F.unhex(F.sha2(body, 256)), 1, TOKEN - 4)
    return F.concat(digest, F.unhex(F.lpad(F.hex(F.length(text)), 8, "0")))


def sequences(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, sequence): the tokens of each conversation's turns, joined.

    Turns are ordered by number, a null number first, ties by role, then by the turn's digest. A
    null role or text is empty; a turn that repeats counts as often as it is there; rows
    without a conversation id belong to no conversation. Texts don't leave the scan: a turn travels as
    its token, and a conversation's tokens are one row (20 bytes a turn).
    """
    who, what = F.coalesce(F.col(role), F.lit("")), F.coalesce(F.col(text), F.lit(""))
    own = turns.where(F.col(conv_id).isNotNull()).select(
        F.col(conv_id).cast("long").alias("conv_id"),
        F.struct(F.col(turn).alias("turn"), who.alias("role"), turn_token(who, what).alias("token")).alias("turn"),
    )
    ordered = F.array_sort(F.collect_list("turn"))
    return own.groupBy("conv_id").agg(F.unhex(F.array_join(F.transform(ordered, lambda t: F.hex(t["token"])), "")).alias("sequence"))


def with_shared_heads(found: DataFrame, block: int = 100, most: int = 6) -> DataFrame:
    """``found`` where conversation c starts with the first h turns of conversation c - c % block.

    h is the unsigned crc32 of c in decimal digits, modulo ``most``. The head is as long as that
    conversation allows, and empty where it is missing; c's own turns after its first h follow.
    """
    heads = found.where(F.col("conv_id") % block == 0).select(
        F.col("conv_id").alias("base"), F.substring("sequence", 1, (most - 1) * TOKEN).alias("head"))
    taken = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most).cast("int") * TOKEN
    joined = found.withColumn("base", F.col("conv_id") - F.col("conv_id") % block).join(heads, "base", "left")
    none = F.lit(b"")
    return joined.select("conv_id", F.concat(
        F.coalesce(F.substring("head", F.lit(1), taken), none), F.substring("sequence", taken + 1, F.octet_length("sequence"))
    ).alias("sequence"))


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of rows with one sequence, at most ``PIECE`` ids in each; rows come sorted."""
    key, ids = None, []

    def piece() -> list:
        return [key, ids[0], len(ids), ",".join(map(str, ids))]

    for batch in batches:
        out = []
        for sequence, conv_id in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if ids and (sequence != key or len(ids) >= PIECE):
                out.append(piece())
                ids = []
            key = sequence
            ids.append(conv_id)
        yield _batch(out, ["sequence", "first", "n", "ids"], [pa.binary(), pa.int64(), pa.int64(), pa.string()])
    if ids:
        yield _batch([piece()], ["sequence", "first", "n", "ids"], [pa.binary(), pa.int64(), pa.int64(), pa.string()])


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per sequence from its pieces, which come sorted; the digest of its ids is fed piece by piece."""
    names, types = ["part", "sequence", "first", "n", "ends"], [pa.int32(), pa.binary(), pa.int64(), pa.int64(), pa.string()]
    held, digest = None, None
    for batch in batches:
        out = []
        for part, sequence, first, n, ids in zip(*[batch.column(i).to_pylist() for i in range(5)]):
            if held and held[1] == sequence:
                digest.update(b"," + ids.encode())
                held[3] += n
                continue
            if held:
                out.append([*held, digest.hexdigest()])
            held, digest = [part, sequence, first, n], hashlib.sha256(ids.encode())
        yield _batch(out, names, types)
    if held:
        yield _batch([[*held, digest.hexdigest()]], names, types)


def _batch(rows: list, names: list[str], types: list[pa.DataType]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[]] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types)], names)


def sorted_blocks(found: DataFrame) -> DataFrame:
    """(part, sequence, first, n, ends): distinct sequences in order, cut into blocks.

    ``first`` is the smallest id with the sequence, ``n`` how many have it, ``ends`` the SHA-256 of
    their ids, ascending, joined by commas. Copies are collapsed twice: in a range sort by sequence and id, which splits a
    sequence with very many copies among tasks, to pieces; then to one row. The digest is sequential by
    its definition, so the pieces of one sequence pass one task, which holds one of them at a time.
    """
    ordered = found.select("sequence", "conv_id").repartitionByRange("sequence", "conv_id").sortWithinPartitions("sequence", "conv_id")
    pieces = stored(ordered.mapInArrow(_pieces, "sequence binary, first long, n long, ids string"), "sequence-pieces")
    size = pieces.agg(F.sum(F.octet_length("sequence") + TOKEN)).first()[0] or 0
    count = 1 + max(size // BLOCK_BYTES, min(size // SMALL_BLOCK_BYTES, SMALL_BLOCKS))
    placed = pieces.repartitionByRange(count, "sequence").sortWithinPartitions("sequence", "first")
    merged = placed.select(F.spark_partition_id().alias("part"), "sequence", "first", "n", "ids").mapInArrow(
        _merged, "part int, sequence binary, first long, n long, ends string")
    return stored(merged, "sequence-blocks")


# ---- range minima ----------------------------------------------------------------------------

class RangeMinimum:
    """Minima of all ranges of a power of two: the sparse table."""

    def __init__(self, values: np.ndarray):
        self.levels = [values]
        while 1 << len(self.levels) <= len(values):
            half = 1 << (len(self.levels) - 1)
            self.levels.append(np.minimum(self.levels[-1][:-half], self.levels[-1][half:]))

    def right_extent(self, at: np.ndarray, depth: np.ndarray) -> np.ndarray:
        """First position from ``at`` on whose value is below ``depth``; the length where there is none."""
        at = at.copy()
        for k in reversed(range(len(self.levels))):
            level = self.levels[k]
            inside = at < len(level)
            at[inside] += (level[at[inside]] >= depth[inside]).astype(at.dtype) << k
        return at

    def left_extent(self, at: np.ndarray, depth: np.ndarray) -> np.ndarray:
        """Last position up to ``at`` whose value is below ``depth``; -1 where there is none."""
        at = at.copy()
        for k in reversed(range(len(self.levels))):
            start = at - (1 << k) + 1
            inside = start >= 0
            at[inside] -= (self.levels[k][start[inside]] >= depth[inside]).astype(at.dtype) << k
        return at

    def least(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Minimum of [left, right), which holds a position at least."""
        out = np.empty(len(left), self.levels[0].dtype)
        level = np.frexp((right - left).astype(np.float64))[1] - 1
        for k in np.unique(level):
            rows = np.flatnonzero(level == k)
            table = self.levels[k]
            out[rows] = np.minimum(table[left[rows]], table[right[rows] - (1 << int(k))])
        return out


class EqualCounts:
    """How many positions of a range hold a value; positions may count more than once."""

    def __init__(self, values: np.ndarray, weights: np.ndarray | None = None):
        self.span = len(values) + 1
        keys = (values.astype(np.int64) + 1) * self.span + np.arange(len(values))
        order = np.argsort(keys)
        self.keys = keys[order]
        self.sums = np.concatenate([[0], np.cumsum(np.ones(len(values), np.int64) if weights is None else weights[order])])

    def count(self, value: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        base = (value.astype(np.int64) + 1) * self.span
        return self.sums[np.searchsorted(self.keys, base + right)] - self.sums[np.searchsorted(self.keys, base + left)]


def _running(values: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(values, dtype=np.int64)])


class Block:
    """Sorted sequences of one block with the common prefixes of neighbours, across both borders too.

    ``common[i]`` is the number of turns that sequence i shares with the one before it; the last entry
    belongs to the first sequence of the next block. Before the first and after the last of all it is -1.
    """

    def __init__(self, table: pa.Table, left: int, right: int):
        order = np.array(sorted(range(len(table)), key=table.column("sequence").to_pylist().__getitem__), np.int64)
        table = table.take(pa.array(order))
        keys = table.column("sequence").to_pylist()
        self.m = len(keys)
        self.length = np.array([len(k) // TOKEN for k in keys], np.int64)
        self.offset = _running(self.length)
        tokens = np.frombuffer(b"".join(keys), np.uint8).reshape(-1, TOKEN)
        self.chars = _running(tokens[:, -4:].astype(np.int64) @ np.array([1 << 24, 1 << 16, 1 << 8, 1]))
        self.common = np.concatenate([[left], self._neighbours(tokens.copy().view("<u4")), [right]]).astype(np.int64)
        self.n = table.column("n").to_numpy().astype(np.int64)
        self.first = table.column("first").to_numpy().astype(np.int64)
        self.ends = np.array(table.column("ends").to_pylist(), object)
        whole = self.chars_to(np.arange(self.m), self.length)
        self.whole = whole
        leaf = self.common[1:] < self.length
        self.sums = [_running(self.n), _running(leaf), _running(self.n * whole),
                     _running(whole - self.chars_to(np.arange(self.m), np.maximum(self.common[:-1], 0)))]
        self.minima = RangeMinimum(self.common)
        self.first_minima = RangeMinimum(self.first)
        self.equal = EqualCounts(self.common)

    def _neighbours(self, tokens: np.ndarray) -> np.ndarray:
        """Turns shared with the sequence before, for all sequences but the first."""
        shared = np.minimum(self.length[1:], self.length[:-1])
        starts = _running(shared)
        inside = np.arange(starts[-1]) - np.repeat(starts[:-1], shared)
        same = (tokens[np.repeat(self.offset[1:-1], shared) + inside] == tokens[np.repeat(self.offset[:-2], shared) + inside]).all(1)
        differing = np.flatnonzero(~same)
        owner = np.searchsorted(starts, differing, side="right") - 1
        out = shared.copy()
        np.minimum.at(out, owner, inside[differing])
        return out

    def chars_to(self, row: np.ndarray, depth: np.ndarray) -> np.ndarray:
        """Code points of the first ``depth`` turns of ``row``."""
        return self.chars[self.offset[row] + depth] - self.chars[self.offset[row]]

    def summed(self, left: np.ndarray, right: np.ndarray, after_first: bool) -> list[np.ndarray]:
        """Sums over [left, right) in the order of ``_SUMS`` without the last two; new turns of the first row count only if asked for."""
        n, leaves, weighted, new = self.sums
        start = left + 1 if after_first else left
        return [n[right] - n[left], leaves[right] - leaves[left], weighted[right] - weighted[left], new[right] - new[start]]

    def candidates(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(row, depth) of all prefixes whose leftmost sequence is here, some at a time."""
        counts = self.length - self.common[:-1]
        total = _running(counts)
        for start in range(0, int(total[-1]), _CANDIDATES):
            number = np.arange(start, min(start + _CANDIDATES, int(total[-1])))
            row = np.searchsorted(total, number, side="right") - 1
            yield row, self.common[row] + 1 + number - total[row]

    def border_rows(self, index: int) -> list[tuple]:
        """What neighbours need to know: sums of the whole block, of its start and of its end at each depth that crosses a border."""
        whole = [int(x[0]) for x in self.summed(np.array([0]), np.array([self.m]), False)]
        least = int(self.common[:-1].min())
        rows = [("all", index, least, *whole, int((self.common[:-1] == least).sum()), int(self.first.min()), 0, 0, 0, None)]
        depth = np.arange(self.common[0] + 1)
        end = self.minima.right_extent(np.ones(len(depth), np.int64), depth)
        depth, end = depth[end < self.m], end[end < self.m]
        if len(depth):
            start = np.zeros(len(depth), np.int64)
            values = [*self.summed(start, end, False), self.equal.count(depth, start, end), self.first_minima.least(start, end)]
            rows += [("start", index, *line, 0, 0, 0, None) for line in zip(*[v.tolist() for v in (depth, *values)])]
        depth = np.arange(self.common[self.m] + 1)
        start = self.minima.left_extent(np.full(len(depth), self.m - 1), depth)
        depth, start = depth[start >= 0], start[start >= 0]
        if len(depth):
            end = np.full(len(depth), self.m)
            values = [*self.summed(start, end, True), self.equal.count(depth, start + 1, end), self.first_minima.least(start, end),
                      self.chars_to(start, np.maximum(depth - 1, 0)), self.whole[start], self.length[start]]
            ends = np.where(self.length[start] == depth, self.ends[start], None)
            rows += [("end", index, *line) for line in zip(*[v.tolist() for v in (depth, *values)], ends.tolist())]
        return rows

    def nodes(self, left_parent: dict[int, int], right_parent: dict[int, int]) -> Iterator[pa.Table]:
        """Nodes whose members all lie in this block. Parents that cross a border are looked up by their depth."""
        for row, depth in self.candidates():
            left = self.minima.left_extent(row, depth)
            right = self.minima.right_extent(row + 1, depth)
            inside = right <= self.m
            row, depth, left, right = row[inside], depth[inside], left[inside], right[inside]
            if not len(row):
                continue
            # The candidate is its node's leftmost sequence, so its left extent is the row itself.
            n, leaves, weighted, new = self.summed(left, right, True)
            before = self.chars_to(row, np.maximum(depth - 1, 0))
            above = depth - 1
            parent_left, parent_right = self.minima.left_extent(row, above), self.minima.right_extent(row + 1, above)
            parent = np.zeros(len(row), np.int64)
            known = (parent_left >= 0) & (parent_right <= self.m)
            parent[known] = self.first_minima.least(parent_left[known], parent_right[known])
            for side, rows in ((left_parent, parent_left < 0), (right_parent, (parent_left >= 0) & (parent_right > self.m))):
                rows &= depth > 0
                parent[rows] = [side[d] for d in above[rows].tolist()]
            yield pa.table({
                "conv_id": self.first_minima.least(left, right), "depth": depth,
                "parent_conv_id": pa.array(parent, mask=depth == 0), "n_convs": n,
                "n_children": self.equal.count(depth, left + 1, right) + (self.length[row] > depth),
                "n_leaves": leaves, "saved_tokens": weighted - n * before - new - (self.whole[row] - before),
                "ends_sha256": pa.array(np.where(self.length[row] == depth, self.ends[row], EMPTY_SHA256), pa.string()),
            })


# ---- nodes across blocks ---------------------------------------------------------------------

@dataclass(frozen=True)
class Borders:
    """Order of the blocks, and the turns shared across the border in front of each; -1 outside."""

    index: dict[int, int]
    common: list[int]

    def block(self, table: pa.Table) -> tuple[int, Block]:
        at = self.index[table.column("part")[0].as_py()]
        return at, Block(table, self.common[at], self.common[at + 1])


def _borders(blocks: DataFrame) -> Borders:
    edges = blocks.groupBy("part").agg(F.min("sequence").alias("low"), F.max("sequence").alias("high"))
    # One row per block; the window only hands a row's neighbour over.
    paired = edges.withColumn("before", F.lag("high").over(Window.orderBy("part")))
    shorter = F.floor(F.least(F.octet_length("low"), F.octet_length("before")) / TOKEN).cast("int")
    turns = F.when(shorter > 0, F.sequence(F.lit(0), shorter - 1)).otherwise(F.array().cast("array<int>"))
    differing = F.filter(turns, lambda i: F.substring("low", i * TOKEN + 1, F.lit(TOKEN)) != F.substring("before", i * TOKEN + 1, F.lit(TOKEN)))
    shared = F.when(F.col("before").isNull(), -1).otherwise(F.coalesce(F.get(differing, F.lit(0)), shorter))
    found = paired.select("part", shared.alias("common")).orderBy("part").collect()
    return Borders({r["part"]: i for i, r in enumerate(found)}, [*[r["common"] for r in found], -1])


_BORDER = ("kind string, block int, depth long, n long, leaves long, weighted long, new long, equal long, first long, "
           "before long, whole long, length long, ends string")


def _border_table(blocks: DataFrame, borders: Borders) -> DataFrame:
    def describe(table: pa.Table) -> pa.Table:
        at, block = borders.block(table)
        return pa.Table.from_batches([_batch(block.border_rows(at), [c.split()[0] for c in _BORDER.split(", ")], [
            pa.string(), pa.int32(), *[pa.int64()] * 10, pa.string()])])

    return stored(blocks.groupBy("part").applyInArrow(describe, _BORDER), "sequence-borders")


def _crossing(described: DataFrame, borders: Borders) -> DataFrame:
    """Nodes whose members lie in several blocks, without their parents, and the borders they cross.

    Found as inside a block: a node's right extent over the blocks' minima. Whole blocks in between come from
    running sums, one number per block and kind; the start of the last block from its rows at that depth.
    """
    whole = described.where("kind = 'all'").orderBy("block").select("depth", *_SUMS).collect()  # one row per block
    columns = [np.array([r[c] for r in whole], np.int64) for c in ("depth", *_SUMS)]

    def extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        minima, firsts = RangeMinimum(columns[0]), RangeMinimum(columns[6])
        sums, equal = [_running(c) for c in columns[1:5]], EqualCounts(columns[0], columns[5])
        border = np.array(borders.common)
        for batch in batches:
            if not len(batch):
                continue
            row = {name: batch.column(name).to_numpy(zero_copy_only=False) for name in batch.schema.names if name != "ends"}
            start, depth = row["block"].astype(np.int64) + 1, row["depth"]
            stop = minima.right_extent(start, depth)  # first block that the node doesn't fill
            partly = border[stop] >= depth
            added = [s[stop] - s[start] for s in sums]
            first = row["first"].copy()
            several = np.flatnonzero(stop > start)
            first[several] = np.minimum(first[several], firsts.least(start[several], stop[several]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(start.astype(np.int32)), pa.array((stop - 1 + partly).astype(np.int32)),
                 pa.array(np.where(partly, stop, -1).astype(np.int32)), pa.array(depth),
                 *[pa.array(row[c] + a) for c, a in zip(_SUMS, added)], pa.array(row["equal"] + equal.count(depth, start, stop)),
                 pa.array(first), *[pa.array(row[c]) for c in ("before", "whole", "length")], batch.column("ends")],
                ["border", "last_border", "stop", "depth", *_SUMS, "before", "whole", "length", "ends"],
            )

    types = "border int, last_border int, stop int, " + _BORDER.split("block int, ")[1]
    opened = described.where("kind = 'end'").drop("kind").mapInArrow(extend, types)
    starts = described.where("kind = 'start'").select(F.col("block").alias("stop"), "depth", *[F.col(c).alias(f"more_{c}") for c in _SUMS])
    more = {c: F.col(c) + F.coalesce(F.col(f"more_{c}"), F.lit(0)) for c in _SUMS[:-1]}
    joined = opened.join(starts, ["stop", "depth"], "left").withColumns({**more, "first": F.least("first", "more_first")})
    return stored(joined.select(
        "border", "last_border", "depth", F.col("first").alias("conv_id"), F.col("n").alias("n_convs"),
        (F.col("equal") + (F.col("length") > F.col("depth")).cast("long")).alias("n_children"), F.col("leaves").alias("n_leaves"),
        (F.col("weighted") - F.col("n") * F.col("before") - F.col("new") - (F.col("whole") - F.col("before"))).alias("saved_tokens"),
        F.coalesce("ends", F.lit(EMPTY_SHA256)).alias("ends_sha256"),
    ), "sequence-crossing")


def prefix_trie(found: DataFrame) -> DataFrame:
    """One row per distinct prefix of the sequences (conv_id, sequence), the empty one included.

    (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256): a node's members are
    the conversations that start with it; conv_id is the smallest of them, and depth the number of turns. parent_conv_id is null
    for the root. n_leaves and saved_tokens cover the node's subtree, the node included: childless nodes, and
    (n_convs - 1) times the code points of the last text, summed. ends_sha256 is the digest of the ids that
    end here. Repeated rows of an id are members each. No rows without conversations.

    Distinct sequences are sorted and cut into blocks of bounded size. Over the common prefix lengths of
    neighbours lies a sparse table of range minima; each candidate prefix finds its left and right extent, and those of its parent,
    by its own binary search. Everything else about a node follows from running sums at the two extents. Nodes that
    cross blocks are found the same way over the blocks' minima; there is at most one for each depth shared across a border.
    """
    blocks = sorted_blocks(found)
    borders = _borders(blocks)
    described = _border_table(blocks, borders)
    crossing = _crossing(described, borders)
    across = crossing.select("depth", "conv_id", F.explode(F.sequence("border", "last_border")).alias("at"))
    parents = across.select((F.col("at")).alias("border"), (F.col("depth") + 1).alias("depth"), F.col("conv_id").alias("parent_conv_id"))
    outer = crossing.join(parents, ["border", "depth"], "left")

    # A border is the left one of a block and the right one of the block before it.
    numbers = blocks.sparkSession.createDataFrame([(i, p) for p, i in borders.index.items()], "block int, part int")
    sides = across.select(F.explode(F.array(
        F.struct(F.col("at").alias("block"), F.lit(True).alias("left")), F.struct((F.col("at") - 1).alias("block"), F.lit(False).alias("left"))
    )).alias("side"), "depth", "conv_id").select("side.*", "depth", "conv_id").join(numbers, "block").drop("block")

    def local(block_rows: pa.Table, side_rows: pa.Table) -> pa.Table:
        _, block = borders.block(block_rows)
        known: tuple[dict, dict] = ({}, {})
        for left, depth, conv_id in zip(*[side_rows.column(c).to_pylist() for c in ("left", "depth", "conv_id")]):
            known[0 if left else 1][depth] = conv_id
        found_nodes = list(block.nodes(*known))
        return pa.concat_tables(found_nodes) if found_nodes else pa.table(
            {c.split()[0]: pa.array([], pa.string() if c.endswith("string") else pa.int64()) for c in _NODE.split(", ")})

    inner = blocks.groupBy("part").cogroup(sides.groupBy("part")).applyInArrow(local, _NODE)
    return inner.unionByName(outer.select(*inner.columns))
