"""SimHash near-duplicates through an inverted index on byte positions."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from ..operators.joins import lookup_join
from .common import lowered_words, stored
from .components import components

SHINGLE_WORDS = 3
MAX_DISTANCE = 3
SEED = 42

#: Members of one posting list that are compared in one piece; longer lists are cut into
#: pieces of about this size and every pair of pieces is compared in a task of its own.
LIST_PIECE = 1024

_HASHES_AT_ONCE = 1 << 16
_BYTES = 8


def fingerprint(text: bytes | None, words: int = SHINGLE_WORDS) -> int:
    """64-bit SimHash of a text; 0 for a text without words and for null."""
    ones, total = np.zeros(64, np.int64), 0
    tail: list[bytes] = []
    digest = xxhash.xxh64_intdigest

    def add(shingles) -> None:
        nonlocal ones, total
        for at in range(0, len(shingles), _HASHES_AT_ONCE):
            hashes = np.array([digest(s, SEED) for s in shingles[at:at + _HASHES_AT_ONCE]], "<u8")
            ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
            total += len(hashes)

    for block in lowered_words(text or b""):
        run = tail + block
        add([b" ".join(s) for s in zip(*(run[i:] for i in range(words)))])
        tail = run[max(0, len(run) - words + 1):]
    if not total and tail:
        add([b" ".join(tail)])
    return int(sum(1 << int(i) for i in np.flatnonzero(2 * ones > total)))


def _fingerprints(words: int):
    def texts(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            found = [fingerprint(t, words) for t in batch.cast(pa.binary()).to_pylist()]
            yield pa.array(np.array(found, np.uint64).view(np.int64))

    # The decorator reads the annotations, which are texts here.
    texts.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(texts, "long")


def with_fingerprints(docs: DataFrame, text: str = "text", words: int = SHINGLE_WORDS) -> Column:
    """Column with the fingerprint of ``text`` as a signed 64-bit number."""
    return _fingerprints(words)(docs[text])


def fingerprint_text(value: Column) -> Column:
    return F.lpad(F.lower(F.hex(value)), 16, "0")


def _positions(distance: int) -> list[tuple[int, ...]]:
    """Sets of byte positions that index a fingerprint.

    Fingerprints at ``distance`` bits differ in at most that many of the eight bytes, so they
    share ``8 - distance`` positional bytes or more. The positions are dealt into two halves;
    one half holds at least half of the shared ones, so some set of ceil(shared / 2) positions
    inside a half is shared whole. At distance 3 these are the eight triples inside a half.
    """
    from itertools import combinations

    shared = _BYTES - distance
    if not 0 <= distance < _BYTES:
        raise ValueError("distance must be from 0 to 7 bits: beyond that no byte need be shared")
    half = _BYTES // 2
    return [c for h in (range(half), range(half, _BYTES)) for c in combinations(h, -(-shared // 2))]


def _star_links(members: np.ndarray, distance: int) -> np.ndarray:
    """Links that connect what is connected among ``members``: at most one per member.

    Counts the positional bytes each pair shares, keeps pairs with the guaranteed minimum,
    verifies their bits, and gives each member the least member it reaches.
    """
    near = np.zeros((len(members), len(members)), np.uint8)
    parts = members.view(np.uint8).reshape(-1, _BYTES)
    for position in range(_BYTES):
        column = parts[:, position]
        near += column[:, None] == column[None, :]
    linked = near >= _BYTES - distance
    left, right = np.nonzero(linked)
    linked[left, right] = np.bitwise_count(members[left] ^ members[right]) <= distance
    label = np.arange(len(members))
    while True:
        reached = np.where(linked, label[None, :], len(members)).min(1)
        reached = reached[reached]
        if (reached == label).all():
            break
        label = reached
    moved = np.flatnonzero(label != np.arange(len(members)))
    return np.stack([members[moved], members[label[moved]]], 1)


def _linker(distance: int):
    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(0)
            flat = lists.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
            ends = np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))
            found = [_star_links(np.ascontiguousarray(m), distance) for m in np.split(flat, ends[:-1]) if len(m) > 1]
            pairs = np.concatenate(found) if found else np.zeros((0, 2), np.uint64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.ascontiguousarray(pairs[:, i]).view(np.int64)) for i in (0, 1)], ["a", "b"]
            )

    return link


def fingerprint_links(prints: DataFrame, distance: int = MAX_DISTANCE, piece: int = LIST_PIECE) -> DataFrame:
    """(a, b) links that connect all fingerprints at ``distance`` bits or fewer.

    ``prints`` has one column ``fp`` without repeats. Each fingerprint is posted under its
    positional bytes. A list that is longer than ``piece`` is dealt into pieces by a hash, and
    each pair of pieces meets in a task of its own, so no list is too long and none is cut.
    Only links that connect are returned, not every near pair.
    """
    def byte(position: int) -> Column:
        return F.shiftright("fp", 8 * position).bitwiseAND(F.lit(0xFF))

    lists = []
    for number, positions in enumerate(_positions(distance)):
        key = F.lit(number).cast("long")
        for position in positions:
            key = key * 256 + byte(position)
        lists.append(key)
    postings = prints.select("fp", F.explode(F.array(*lists)).alias("key"))
    sizes = postings.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    shared = sizes.where("n > 1").select("key", F.ceil(F.col("n") / piece).cast("int").alias("pieces"))
    own = F.pmod(F.xxhash64("fp"), F.col("pieces")).cast("int")
    cells = (
        postings.join(shared, "key")
        .select("key", "fp", own.alias("own"), F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)).alias("other"))
        .groupBy("key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))
        .agg(F.collect_list("fp").alias("members"))
    )
    return cells.select("members").mapInArrow(_linker(distance), "a long, b long")


def _grouped(docs: DataFrame, doc_id: str, text: str, words: int, distance: int) -> DataFrame:
    """(doc_id, row_key, fp, root, component_id), one row per row of ``docs``."""
    marked = stored(docs.select(
        F.col(doc_id).alias("doc_id"), F.xxhash64(F.col(doc_id), F.col(text)).alias("row_key"),
        with_fingerprints(docs, text, words).alias("fp"),
    ), "simhash")
    distinct = stored(marked.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-distinct")
    roots = components(fingerprint_links(distinct.select("fp"), distance))
    named = distinct.join(roots, distinct.fp == roots.node, "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    return marked.join(named.join(least, "root").select("fp", "root", "component_id"), "fp")


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = SHINGLE_WORDS,
    distance: int = MAX_DISTANCE,
) -> DataFrame:
    """(doc_id, fp, component_id): every document, its fingerprint and the least id it reaches.

    Documents link when their fingerprints differ in at most ``distance`` bits; links chain.
    Equal fingerprints are one node, so copies cost one row each whatever their number.
    Null and wordless texts have fingerprint 0 and link like any other. Rows that repeat an id
    are returned as often as they occur. A null id never becomes a component's name unless
    all its members have none; then the name is null. An empty table gives no rows.
    """
    return _grouped(docs, doc_id, text, words, distance).select("doc_id", "fp", "component_id")


def one_of_each_group(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = SHINGLE_WORDS,
    distance: int = MAX_DISTANCE,
) -> DataFrame:
    """Rows of ``docs`` without their near duplicates: of each component the row with the least id stays.

    A null id stays only where its component has no other. Rows that repeat both id and text
    are near duplicates of each other too, so one of them stays.
    """
    found = stored(_grouped(docs, doc_id, text, words, distance).select("doc_id", "row_key", "root"), "simhash-groups")
    first = found.groupBy("root").agg(
        F.min(F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("row_key"))).alias("best")
    ).select("root", F.col("best.row_key").alias("kept"))
    gone = found.join(first, "root").where("row_key <> kept").select("row_key").distinct()
    again = found.groupBy("row_key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("row_key")
    rows = docs.select(
        F.struct(*[docs[c] for c in docs.columns]).alias("doc"), F.xxhash64(F.col(doc_id), F.col(text)).alias("row_key")
    )
    left = lookup_join(rows, stored(gone, "simhash-gone"), ["row_key"], "left_anti")
    again = stored(again, "simhash-again")
    # Only rows that repeat are moved to drop their repeats.
    once = lookup_join(left, again, ["row_key"], "left_anti")
    repeats = lookup_join(left, again, ["row_key"], "left_semi").dropDuplicates(["row_key"])
    return once.union(repeats).select("doc.*")
