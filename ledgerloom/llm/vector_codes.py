"""Vectors compressed to codebook indexes; assignments are kept by norm-of-sum bounds."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..operators.joins import lookup_join
from .common import stored

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024

#: What a row remembers of each part: its entry, a bound above the distance to that entry, one
#: below the distance to every other entry, and the rounds in which these two were measured.
_STATE = np.dtype([("entry", "<u2"), ("above", "<f4"), ("below", "<f4"), ("above_round", "u1"), ("below_round", "u1")])

#: Distances up to here are exact in double precision; beyond, whole numbers of 64 bits are used.
_EXACT_DOUBLE, _EXACT_LONG = 1 << 53, 1 << 62

#: Bounds are compared with this much room for rounding, relative to their size.
_SLACK = 1e-9


@dataclass(frozen=True)
class Shape:
    """What is common to all vectors of a table: their length, the largest component, the number of entries."""

    width: int
    top: int
    entries: int
    parts: int

    @property
    def stored_type(self) -> np.dtype:
        return np.dtype("<i2") if self.top < 1 << 15 else np.dtype("<i4")

    @property
    def work_type(self) -> np.dtype:
        return np.dtype(np.float64 if 4 * self.top * self.top * self.width < _EXACT_DOUBLE else np.int64)

    @property
    def part_width(self) -> int:
        return self.width // self.parts


class Displacements:
    """How far entries of one part are now from where they were in each earlier round.

    The codebooks of all rounds are retained, so a bound stamped with a round moves by the net way
    of an entry since then, however far it wandered in between.
    """

    def __init__(self, history: list[np.ndarray]):
        now = history[-1].astype(np.float64)
        self.own = np.array([np.sqrt(((now - old) ** 2).sum(1)) for old in history])
        first = self.own.argmax(1)
        rest = self.own.copy()
        rest[np.arange(len(history)), first] = 0
        #: The largest way of any entry but the one asked for.
        self.others = np.repeat(self.own.max(1)[:, None], self.own.shape[1], 1)
        self.others[np.arange(len(history)), first] = rest.max(1)


def _up(x: np.ndarray) -> np.ndarray:
    return np.nextafter(x.astype(np.float32), np.float32(np.inf))


def _down(x: np.ndarray) -> np.ndarray:
    return np.nextafter(x.astype(np.float32), np.float32(-np.inf))


def scan(x: np.ndarray, book: np.ndarray) -> np.ndarray:
    """Squared distance of each row to each entry."""
    return (x * x).sum(1)[:, None] - 2 * (x @ book.T) + (book * book).sum(1)[None, :]


def _rescan(x: np.ndarray, book: np.ndarray, state: np.ndarray, rows: np.ndarray, at: int) -> None:
    """Exact nearest entry (ties to the lower index) and fresh bounds for ``rows``."""
    if not len(rows):
        return
    squared = scan(x[rows], book)
    line, entry = np.arange(len(rows)), squared.argmin(1)
    nearest = squared[line, entry].astype(np.float64)
    second = np.full(len(rows), np.inf)
    if squared.shape[1] > 1:
        squared[line, entry] = squared.max() + 1
        second = squared.min(1).astype(np.float64)
    state["entry"][rows], state["above"][rows], state["below"][rows] = entry, _up(np.sqrt(nearest)), _down(np.sqrt(second))
    state["above_round"][rows] = state["below_round"][rows] = at


def reassign(x: np.ndarray, history: list[np.ndarray], moved: Displacements, state: np.ndarray) -> int:
    """Bring ``state`` of one part to the last codebook of ``history``; returns how many rows were scanned in full.

    A row keeps its entry while the bound above, raised by its entry's net displacement since that
    bound's round, stays under the bound below, lowered by the largest net displacement of another
    entry since its round. Where they meet, the distance to the own entry is measured; only
    rows that this doesn't settle are scanned against all entries.
    """
    at = len(history) - 1
    entry = state["entry"]
    below = state["below"] - moved.others[state["below_round"], entry]
    above = state["above"] + moved.own[state["above_round"], entry]

    def open_rows(above: np.ndarray, below: np.ndarray) -> np.ndarray:
        with np.errstate(invalid="ignore"):
            return ~(above + _SLACK * (above + np.abs(below)) < below) & ~np.isposinf(below)

    rows = np.flatnonzero(open_rows(above, below))
    own = x[rows] - history[-1][entry[rows]]
    tight = np.sqrt((own * own).sum(1).astype(np.float64))
    state["above"][rows], state["above_round"][rows] = _up(tight), at
    rows = rows[open_rows(tight, below[rows])]
    _rescan(x, history[-1], state, rows, at)
    return len(rows)


def _integers(batch: pa.RecordBatch, shape: Shape) -> np.ndarray:
    """Components of the rows of a batch: from stored bytes, or scaled from the vectors themselves."""
    column = batch.column("vector")
    if pa.types.is_binary(column.type):
        return np.frombuffer(b"".join(column.to_pylist()), shape.stored_type).reshape(len(batch), -1).astype(shape.work_type)
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(batch), -1)
    return np.floor(values * SCALE).astype(shape.work_type)


def _bytes(rows: np.ndarray) -> pa.Array:
    return pa.array([row.tobytes() for row in rows], pa.binary())


def _assigned(frame: DataFrame, books: list[np.ndarray], shape: Shape, passed: list[str]) -> DataFrame:
    """(``passed``, vector, state, error) with every part assigned to the last of ``books``; books are (part, entry, position)."""
    width, dtype = shape.part_width, shape.stored_type

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        histories = [[book[p].astype(shape.work_type) for book in books] for p in range(shape.parts)]
        moved = [Displacements(h) for h in histories]
        for batch in batches:
            if not len(batch):
                continue
            whole = _integers(batch, shape)
            error = np.zeros(len(batch), np.int64)
            if "state" in batch.schema.names:
                state = np.frombuffer(b"".join(batch.column("state").to_pylist()), _STATE).reshape(len(batch), -1).copy()
            else:
                state = np.zeros((len(batch), shape.parts), _STATE)
            for p, history in enumerate(histories):
                x = np.ascontiguousarray(whole[:, p * width:(p + 1) * width])
                if "state" in batch.schema.names:
                    reassign(x, history, moved[p], state[:, p])
                else:
                    _rescan(x, history[-1], state[:, p], np.arange(len(x)), len(history) - 1)
                own = x - history[-1][state["entry"][:, p]]
                error += (own * own).sum(1).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in passed], _bytes(whole.astype(dtype)), _bytes(state), pa.array(error)],
                [*passed, "vector", "state", "error"],
            )

    kept = ", ".join(f"{c} {frame.schema[c].dataType.simpleString()}" for c in passed)
    return frame.mapInArrow(assign, f"{kept}, vector binary, state binary, error long")


def _moved_book(rows: DataFrame, book: np.ndarray, shape: Shape) -> np.ndarray:
    """Every entry replaced by the floor of the mean of its parts; unused entries stay.

    A task adds up its own rows and sends at most one line per part and entry; what reaches the
    driver is one line per part and entry.
    """
    parts, entries, width = book.shape

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros((parts * entries, width), np.int64), np.zeros(parts * entries, np.int64)
        for batch in batches:
            if not len(batch):
                continue
            x = _integers(batch, shape).astype(np.int64)
            state = np.frombuffer(b"".join(batch.column("state").to_pylist()), _STATE).reshape(len(batch), -1)
            for p in range(parts):
                line = state["entry"][:, p].astype(np.int64) + p * entries
                np.add.at(sums, line, x[:, p * width:(p + 1) * width])
                counts += np.bincount(line, minlength=len(counts))
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(used), pa.array(counts[used]), pa.array(list(sums[used]), pa.list_(pa.int64()))], ["line", "n", "sums"])

    lines = rows.select("vector", "state").mapInArrow(add, "line long, n long, sums array<long>").groupBy("line").agg(
        F.sum("n").alias("n"), F.array(*[F.sum(F.get("sums", F.lit(i))) for i in range(width)]).alias("sums"))
    moved = book.copy()
    for row in lines.collect():
        moved[row["line"] // entries, row["line"] % entries] = [s // row["n"] for s in row["sums"]]
    return moved


def compressed(
    vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label",
    parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
) -> tuple[DataFrame, np.ndarray]:
    """(vec_id, label, codes, error) per kept vector, and the codebooks (part, entry, position).

    Components are floor(1024 x). Vectors that are null, or hold null or non-finite components, take no
    part; nor do those shorter than the longest. The length must be a multiple of ``parts``, and
    the squared distances must fit a long, or a ValueError tells so. Codebooks start from the
    ``entries`` smallest ids (null ids last, rows of one id by their vectors; all rows if fewer) and are
    refined in ``rounds`` rounds; ``codes`` are the indexes under the last codebooks, ties to
    the lower one, and ``error`` is the squared distance to what they stand for. Repeated rows count as often as they
    are there. An empty table gives no rows and empty codebooks.

    Each round reads and writes the vectors once, with a few bytes of bounds; only sums per entry are
    shuffled. The codebooks of all rounds go to the tasks; they hold ``entries`` times the length.
    """
    value = F.col(embedding)
    sound = F.forall(value, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    whole = vectors.where(value.isNotNull() & F.coalesce(sound, F.lit(False))).select(
        F.col(vec_id).alias("vec_id"), F.col(label).alias("label"), F.transform(value, lambda x: x.cast("double")).alias("vector"))
    facts = whole.agg(
        F.max(F.size("vector")).alias("width"), F.max(F.array_max(F.transform("vector", lambda x: F.abs(x)))).alias("top")
    ).first()
    width = facts["width"] or 0
    if not width:
        return vectors.sparkSession.createDataFrame([], whole.select("vec_id", "label").schema).selectExpr(
            "vec_id", "label", "cast(array() as array<int>) as codes", "cast(0 as bigint) as error"), np.zeros((parts, 0, 0), np.int64)
    if width % parts:
        raise ValueError(f"vectors of {width} components cannot be cut into {parts} equal parts")
    scaled = facts["top"] * SCALE + 1
    if not 4 * scaled * scaled * width < _EXACT_LONG:
        raise ValueError(f"components up to {facts['top']} give squared distances beyond a long")
    whole = whole.where(F.size("vector") == width)

    first = whole.orderBy(F.col("vec_id").asc_nulls_last(), "vector").limit(entries).select("vector").collect()
    start = np.floor(np.array([r["vector"] for r in first]) * SCALE).astype(np.int64)
    shape = Shape(width, int(scaled) + 1, len(start), parts)
    books = [np.stack(np.split(start, parts, axis=1))]
    passed = ["vec_id", "label"]
    rows = whole
    for _ in range(rounds):
        rows = stored(_assigned(rows, books, shape, passed).drop("error"), "vector-codes")
        books.append(_moved_book(rows, books[-1], shape))
    last = _assigned(rows, books, shape, passed)
    # The entry of a part is the first two bytes of its state.
    size = _STATE.itemsize
    codes = F.array(*[
        F.conv(F.hex(F.concat(F.substring("state", p * size + 2, 1), F.substring("state", p * size + 1, 1))), 16, 10).cast("int")
        for p in range(parts)
    ])
    return stored(last.select(*passed, codes.alias("codes"), "error"), "vector-codes"), books[-1]


def with_label_errors(coded: DataFrame) -> DataFrame:
    """``coded`` with ``label_error``: errors summed over equal labels, nulls together."""
    sums = coded.groupBy("label").agg(F.sum("error").alias("label_error"))
    return lookup_join(coded, sums, ["label"], "left", null_safe=True)


def code_text(codes: Column) -> Column:
    """Two lowercase hexadecimal digits for each index."""
    return F.array_join(F.transform(codes, lambda c: F.lower(F.lpad(F.hex(c), 2, "0"))), "")


def decoded(codes: Column, books: np.ndarray) -> Column:
    """The vector that ``codes`` stand for."""
    entries = [F.array(*[F.array(*[F.lit(float(v) / SCALE) for v in entry]) for entry in book]) for book in books]
    return F.concat(*[F.get(book, F.get(codes, F.lit(p))) for p, book in enumerate(entries)])


def books_sha256(books: np.ndarray) -> str:
    """Digest of all entries' components by part, entry and position, joined by commas."""
    return hashlib.sha256(",".join(str(v) for v in books.reshape(-1).tolist()).encode()).hexdigest()
