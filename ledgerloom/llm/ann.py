"""Approximate nearest neighbours: NN-descent builds a graph, queries walk it greedily."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .common import stored

#: Neighbours a node keeps; as many nodes that point to it take part in a round.
NEIGHBOURS = 20

#: Rounds of neighbours of neighbours.
ROUNDS = 5

#: New neighbours that one meeting may propose to a node.
PROPOSALS = 8

#: First neighbours come from hash trees (random hyperplanes) and one random dealing.
TREES = 20
BLOCK = 1024

#: Nodes a query keeps in view; it stops when all of them have been expanded.
BEAM = 96

#: Nodes that a query from outside the index starts at.
ENTRIES = 64

_SEED = 23
_NODE = "array<struct<node:bigint,floor:double,vector:binary>>"


@dataclass(frozen=True)
class Index:
    """``nodes``: node, vector (unit, half precision), original, members; ``edges``: u, v, s; ``links``: both ways."""

    nodes: DataFrame
    edges: DataFrame
    links: DataFrame
    dimension: int


def _usable(vectors: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    value = F.col("original")
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).cast("array<double>").alias("original"))
    finite = F.forall(value, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return rows.where(F.col("vec_id").isNotNull() & value.isNotNull()).where(finite).where(F.exists(value, lambda x: x != 0))


def _halves(dimension: int):
    def shorten(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            matrix = batch.flatten().to_numpy(zero_copy_only=False).reshape(-1, dimension)
            # Scaled first, so that very large and very small components neither overflow nor vanish.
            matrix = matrix / np.abs(matrix).max(1, keepdims=True) if len(matrix) else matrix
            unit = (matrix / np.linalg.norm(matrix, axis=1, keepdims=True)).astype("<f2")
            yield pa.array([u.tobytes() for u in unit], pa.binary())

    shorten.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(shorten, "binary")


def _matrix(column: pa.Array, dimension: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<f2").reshape(-1, dimension).astype(np.float32)


def _hash_codes(dimension: int, bits: int):
    planes = np.random.default_rng(_SEED).normal(size=(TREES, dimension, bits)).astype(np.float32)

    def codes(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            matrix = _matrix(batch, dimension)
            signs = np.stack([matrix @ p > 0 for p in planes], 1) @ (1 << np.arange(bits, dtype=np.int64))
            yield pa.array(list(signs), pa.list_(pa.int64()))

    codes.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(codes, "array<long>")


def _meet(dimension: int, proposals: int):
    """For each group of nodes: each member's nearest others in the group, if nearer than its floor."""
    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            groups = batch.column(0)
            flat = groups.flatten()
            nodes = flat.field(0).to_numpy(zero_copy_only=False)
            floors = flat.field(1).to_numpy(zero_copy_only=False)
            matrix = _matrix(flat.field(2), dimension)
            ends = groups.value_lengths().to_numpy(zero_copy_only=False).cumsum()
            out, begin = [], 0
            for end in ends:
                own, some = nodes[begin:end], matrix[begin:end]
                near = some @ some.T
                np.fill_diagonal(near, -2)
                count = min(proposals, len(own) - 1)
                if count > 0:
                    best = np.argpartition(-near, count - 1, axis=1)[:, :count]
                    value = np.take_along_axis(near, best, 1)
                    row, col = np.nonzero(value > floors[begin:end, None])
                    out.append((own[row], own[best[row, col]], value[row, col]))
                begin = end
            parts = [np.concatenate(x) for x in zip(*out)] if out else [np.zeros(0, np.int64)] * 2 + [np.zeros(0)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(parts[0]), pa.array(parts[1]), pa.array(parts[2].astype(np.float64))], ["u", "v", "s"]
            )

    return meet


def _groups(members: DataFrame, *keys: str) -> DataFrame:
    return members.groupBy(*keys).agg(F.collect_list(F.struct("node", "floor", "vector")).alias("group")).select(
        F.col("group").cast(_NODE)
    )


def _nearest(edges: DataFrame, count: int) -> DataFrame:
    """The ``count`` nearest of each node, each once; one shuffle by node."""
    by_node = Window.partitionBy("u").orderBy(F.col("s").desc(), "v")
    return (
        edges.repartition("u").groupBy("u", "v").agg(F.max("s").alias("s"))
        .withColumn("place", F.row_number().over(by_node)).where(F.col("place") <= count).drop("place")
    )


def _first_groups(nodes: DataFrame, dimension: int, number: int) -> DataFrame:
    """Blocks of about BLOCK nodes: per hash tree, nodes with one code, dealt out where a code has
    many nodes; and one dealing that ignores the vectors, so that every node meets some others."""
    bits = max(1, math.ceil(math.log2(max(2, number / BLOCK))))
    coded = nodes.select("node", "vector", F.posexplode(_hash_codes(dimension, bits)("vector")).alias("tree", "code"))
    pieces = coded.groupBy("tree", "code").agg(F.ceil(F.count(F.lit(1)) / (2 * BLOCK)).alias("pieces"))
    dealt = coded.join(pieces, ["tree", "code"]).select(
        "node", "vector", "tree", "code", F.pmod(F.xxhash64("node", "tree"), F.col("pieces")).alias("piece")
    )
    random = nodes.select(
        "node", "vector", F.lit(-1).alias("tree"), F.pmod(F.xxhash64("node"), F.lit(max(1, number // BLOCK))).alias("code"),
        F.lit(0).cast("long").alias("piece"),
    )
    return _groups(dealt.unionByName(random).withColumn("floor", F.lit(-2.0)), "tree", "code", "piece")


def build_index(
    vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", neighbours: int = NEIGHBOURS,
    rounds: int = ROUNDS, copies: int = 6,
) -> Index:
    """Neighbour graph of every usable vector.

    Equal vectors are one node, which remembers the ``copies`` smallest ids; that is exact for
    searches that ask for fewer. Each round joins a node with the vectors of its neighbours and of
    nodes that point to it; these meet in one small group and propose each other where that is nearer
    than what a node has. Groups have at most 2 * ``neighbours`` + 1 members: of the nodes that point
    to one, the nearest take part, as the method samples them; a node's own list is what it keeps.

    Vectors that are null, empty or zero, or hold null or non-finite components, and ids that are null, take
    no part, nor do vectors whose length differs from the most frequent one (the shorter on a tie).
    An empty table gives an empty index.
    """
    usable = _usable(vectors, vec_id, embedding)
    lengths = usable.groupBy(F.size("original").alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "d").first()
    dimension = lengths["d"] if lengths else 1
    by_vector = Window.partitionBy("original").orderBy("vec_id")
    # The rank is cut in each task before the shuffle, so copies without number cost little.
    smallest = usable.where(F.size("original") == dimension).withColumn("place", F.dense_rank().over(by_vector)).where(F.col("place") <= copies)
    grouped = smallest.groupBy("original").agg(F.array_sort(F.collect_set("vec_id")).alias("members"))
    nodes = stored(
        grouped.withColumn("node", F.get("members", F.lit(0))).withColumn("vector", _halves(dimension)("original"))
        .select("node", "vector", "original", "members"), "ann-nodes"
    )
    vectors_only = nodes.select("node", "vector")
    first = _first_groups(vectors_only, dimension, nodes.count())
    edges = stored(_nearest(first.mapInArrow(_meet(dimension, neighbours // 2), "u long, v long, s double"), neighbours), "ann-edges")
    for _ in range(rounds):
        floors = edges.groupBy("u").agg(F.when(F.count(F.lit(1)) >= neighbours, F.min("s")).otherwise(F.lit(-2.0)).alias("floor"))
        known = vectors_only.join(floors, F.col("node") == F.col("u"), "left").select(
            "node", "vector", F.coalesce("floor", F.lit(-2.0)).alias("floor")
        )
        members = (
            _both_ways(edges, neighbours).union(edges.select("u", F.col("u").alias("v"))).distinct()
            .join(known, F.col("v") == F.col("node"))
        )
        proposed = _groups(members, "u").mapInArrow(_meet(dimension, PROPOSALS), "u long, v long, s double")
        edges = stored(_nearest(edges.union(proposed), neighbours), "ann-edges")
    return Index(nodes, edges, stored(_both_ways(edges, neighbours).distinct(), "ann-links"), dimension)


def _both_ways(edges: DataFrame, neighbours: int) -> DataFrame:
    """(u, v): a node's list, and the nearest ``neighbours`` of those that list it."""
    back = Window.partitionBy("v").orderBy(F.col("s").desc(), "u")
    pointing = edges.withColumn("place", F.row_number().over(back)).where(F.col("place") <= neighbours)
    return edges.select("u", "v").union(pointing.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _score(dimension: int):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near = np.einsum("ij,ij->i", _matrix(batch.column("asked"), dimension), _matrix(batch.column("vector"), dimension))
            yield pa.RecordBatch.from_arrays(
                [batch.column("q"), batch.column("node"), pa.array(near.astype(np.float64)), pa.array(np.zeros(len(near), bool))],
                ["q", "node", "s", "expanded"],
            )

    return score


def _cosine(dimension: int):
    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (batch.column(c).flatten().to_numpy(zero_copy_only=False).reshape(-1, dimension) for c in ("asked", "original"))
            a, b = (x / np.abs(x).max(1, keepdims=True) if len(x) else x for x in (a, b))
            value = (a * b).sum(1) / (np.sqrt((a * a).sum(1)) * np.sqrt((b * b).sum(1)))
            yield pa.RecordBatch.from_arrays([batch.column("q"), batch.column("vec_id"), pa.array(value)], ["query_id", "vec_id", "score"])

    return exact


def search(index: Index, queries: DataFrame, k: int = 5, vec_id: str = "vec_id", embedding: str = "embedding", beam: int = BEAM) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found for each usable query, without its own id.

    A query that is in the index starts at its own node, another one at ENTRIES nodes. Every
    round expands what is new among the ``beam`` nearest nodes seen so far: one join with the
    graph, one with the vectors, for all queries at once. Rounds end when nothing is new. The
    nearest are then scored in double precision on the original vectors, ties to the smaller id.
    """
    nodes, links, dimension = index.nodes, index.links, index.dimension
    asked = stored(
        _usable(queries, vec_id, embedding).where(F.size("original") == dimension).distinct()
        .select(F.col("vec_id").alias("q"), F.col("original").alias("wanted"), _halves(dimension)("original").alias("asked")), "ann-queries"
    )
    schema = "q long, node long, s double, expanded boolean"

    def scored(pairs: DataFrame) -> DataFrame:
        return (
            pairs.join(nodes.select("node", "vector"), "node").join(asked.select("q", "asked"), "q")
            .select("q", "node", "asked", "vector").mapInArrow(_score(dimension), schema)
        )

    home = asked.join(nodes.select("node", "original"), F.col("wanted") == F.col("original")).select("q", "node")
    outside = asked.join(home.select("q"), "q", "left_anti").select("q")
    entries = nodes.orderBy(F.xxhash64("node"), "node").limit(ENTRIES).agg(F.collect_list("node").alias("all"))
    # One row with ENTRIES ids.
    starts = outside.join(F.broadcast(entries)).select("q", F.explode("all").alias("node"))
    seen = stored(scored(home.union(starts).distinct()), "ann-seen")
    nearest = Window.partitionBy("q").orderBy(F.col("s").desc(), "node")
    while True:
        view = stored(seen.withColumn("place", F.row_number().over(nearest)).where(F.col("place") <= beam).drop("place"), "ann-view")
        front = view.where("not expanded").select("q", "node")
        if front.isEmpty():
            break
        reached = front.join(links, front.node == links.u).select("q", F.col("v").alias("node")).distinct()
        fresh = reached.join(seen.select("q", "node"), ["q", "node"], "left_anti")
        marked = seen.join(front.withColumn("now", F.lit(True)), ["q", "node"], "left").select(
            "q", "node", "s", (F.col("expanded") | F.coalesce("now", F.lit(False))).alias("expanded")
        )
        seen = stored(marked.union(scored(fresh)), "ann-seen")
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (
        view.join(nodes.select("node", "original", "members"), "node").join(asked.select("q", F.col("wanted").alias("asked")), "q")
        .select("q", "asked", "original", F.explode("members").alias("vec_id")).where("vec_id <> q")
        .mapInArrow(_cosine(dimension), "query_id long, vec_id long, score double").distinct()
        .withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
    )
