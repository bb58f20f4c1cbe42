"""Language-model scoring: logistic mixing of hashed-context bit predictors."""

from __future__ import annotations

import heapq
import math
import pickle
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, replace
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from .common import LONG_ROWS, add_lines, distinct_words, stored

#: Kinds of texts, told apart by their letters; one is spelt out before a text.
CLASSES = 8
CLASS_ROUNDS = 2

#: Each predictor has a table of 2 ** bits slots, at least SLOTS_PER_DECISION for each distinct
#: decision in a context of the corpus; these are counted among one in _SAMPLED, chosen by hash.
PREDICTORS = 5
SLOTS_PER_DECISION = 1.5
LEAST_BITS = 16
_SAMPLED = 64

#: Gates choose the set of weights: how often the contexts of predictors 5, 4 and 3 were seen,
#: in powers of two up to 15, and in powers of four up to 3.
GATES = 16 * 4 * 4

#: Words with their counts that every task holds; rarer words are looked up by a join.
HEAD_WORDS = 1 << 19

#: Words of batches a task holds before it adds up equal ones, when it counts, and the bytes these have.
COUNTED_WORDS, _COUNTED_BYTES = 1_500_000, 1 << 26

#: Steps of the mixer: share of a Newton step per weight, chunks until it is halved, the
#: curvature a weight is taken to have before anything is seen, and the largest step.
_RATE, _COOLING, _CAUTION, _STRIDE = 0.3, 200, 2.0, 0.2

#: Mixed log odds end here.
_SUREST = 14.0

#: Portions of words between two steps of the mixer, and decisions that are worked on at once.
_LESSON, _PART = 1024, 1 << 15

#: Occurrences of one word that are learned from at once.
_LOT = 64

#: Lessons between two looks at the curvature.
_CURVES = 4

#: Bytes of words that a task spells at once, which make a lot, and lots that are learned from in any order.
_SPELT, _MIXED = 1 << 19, 2

#: Tables are cut into slices of so many slots, wider ones where there would be more than _SLICES.
_SLICE, _SLICES = 1 << 20, 2048
#: Answers of a slice that are sent at once.
_ANSWERS = 64
_REFINED = 33
_LETTERS = 512
_STARTS = 64
_BLOCK = 1 << 20
#: Texts whose letters are counted at once.
_TEXTS = 64

#: Documents scored at once, and bytes of texts whose words are looked up at once.
_DOCUMENTS, _LOOKED_UP = 500, 1 << 24
_TEXT = ["word"] + [f"n{c}" for c in range(CLASSES)]
WORD_SCHEMA = ", ".join(["word string"] + [f"n{c} long" for c in range(CLASSES)] + ["asked long"])


def _lowered(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct words of texts with A-Z lower-cased, then the end, which is the empty word; the numbers of
    the words of all texts without their ends, and how many each text has."""
    words, numbers, first = distinct_words(pc.ascii_lower(texts))
    return pa.concat_arrays([words, pa.array([""], words.type)]), numbers, np.diff(first)


# ---- Kinds of texts -----------------------------------------------------------


def _hashed_pairs() -> np.ndarray:
    """The hash of each pair of bytes, read as one number, with A-Z lower-cased."""
    lowered = np.frombuffer(bytes(range(256)).lower(), np.uint8).astype(np.uint32)
    hashed = (lowered * np.uint32(257) + lowered[:, None]) * np.uint32(0x9E3779B1) >> np.uint32(23)
    return hashed.ravel().astype(np.intp)


_PAIRS = _hashed_pairs()


def _shares(counts: np.ndarray) -> np.ndarray:
    return np.sqrt(counts / np.maximum(1, counts.sum(-1, keepdims=True)))


def letters(text: bytes) -> np.ndarray:
    """Roots of the shares of hashed pairs of bytes: a vector of length 1, or 0 without pairs."""
    counts = np.zeros(_LETTERS, np.int64)
    for at in range(0, len(text) - 1, _BLOCK):
        codes = np.frombuffer(text[at:at + _BLOCK + 1], np.uint8).astype(np.uint16)
        counts += np.bincount(np.take(_PAIRS, codes[:-1] | codes[1:] << np.uint16(8)), minlength=_LETTERS)
    return _shares(counts)


def letter_rows(texts: pa.Array) -> Iterator[np.ndarray]:
    """``letters`` of all texts, of some at a time; a null text is empty."""
    texts = pc.fill_null(texts, "").cast(pa.binary())
    sizes = pc.binary_length(texts).to_numpy().astype(np.int64)
    for at in range(0, len(texts), _TEXTS):
        some, own = texts.slice(at, _TEXTS), sizes[at:at + _TEXTS]
        ends = np.cumsum(own)
        if ends[-1] > _BLOCK:
            yield np.array([letters(t.as_py()) for t in some])
            continue
        codes = np.frombuffer(b"".join(some.to_pylist()), np.uint8).astype(np.uint16)
        cells = np.take(_PAIRS, codes[:-1] | codes[1:] << np.uint16(8)) if len(codes) else np.zeros(0, np.intp)
        cells += np.repeat(np.arange(len(own)) * _LETTERS, own)[:len(cells)]
        cells[ends[(own > 0) & (ends < ends[-1])] - 1] = len(own) * _LETTERS  # pairs of two texts
        yield _shares(np.bincount(cells, minlength=len(own) * _LETTERS + 1)[:-1].reshape(-1, _LETTERS))


def text_kinds(texts: pa.Array, lengths: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """The nearest centres of texts of so many words; texts without words are of the first kind."""
    nearest = [np.argmax(rows @ centres.T, 1) for rows in letter_rows(texts)]
    return np.where(lengths > 0, np.concatenate([np.zeros(0, np.int64), *nearest]), 0)


def _class_sums(centres: np.ndarray):
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((CLASSES, _LETTERS))
        for batch in batches:
            for rows in letter_rows(batch.column(0)):
                sums += (np.argmax(rows @ centres.T, 1) == np.arange(CLASSES)[:, None]).astype(np.float64) @ rows
        hit = np.flatnonzero(sums.any(1))
        yield pa.RecordBatch.from_arrays([pa.array(hit), pa.array(list(sums[hit]), pa.list_(pa.float64()))], ["term", "line"])

    return add


def text_classes(training: DataFrame, text: str = "text", rounds: int = CLASS_ROUNDS) -> np.ndarray:
    """Centres of CLASSES kinds of texts by their letters (spherical k-means over all of ``training``).

    Starts from texts that lie far apart among the _STARTS with the least hash. Each round
    adds up the texts of each kind inside the tasks; CLASSES lines reach the driver.
    """
    texts = training.select(F.col(text).alias("text"))
    hashed = texts.select(F.xxhash64("text", F.lit(3)).alias("h")).distinct().orderBy("h").limit(_STARTS).collect()
    rows = texts.where(F.xxhash64("text", F.lit(3)).isin([r["h"] for r in hashed])).withColumn("h", F.xxhash64("text", F.lit(3)))
    rows = rows.dropDuplicates(["h"])  # a text may have any number of copies
    found = {r["h"]: r["v"] for r in rows.select("h", F.arrow_udf(_letters_of, "array<double>")("text").alias("v")).collect()}
    starts = np.array([found[h] for h in sorted(found)]).reshape(-1, _LETTERS)
    chosen = list(range(min(1, len(starts))))
    while 0 < len(chosen) < min(CLASSES, len(starts)):
        chosen.append(int(np.argmin((starts @ starts[chosen].T).max(1))))
    centres = np.zeros((CLASSES, _LETTERS))
    centres[:len(chosen)] = starts[chosen]
    for _ in range(rounds):
        lines = texts.mapInArrow(_class_sums(centres), "term long, line array<double>").repartition("term")
        for row in lines.mapInArrow(add_lines, "term long, line array<double>").collect():
            line = np.array(row["line"])
            centres[row["term"]] = line / max(1e-12, float(np.linalg.norm(line)))
    return centres


def _letters_of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for batch in batches:
        yield pa.array([letters(t.as_py() or b"").tolist() for t in batch.cast(pa.binary())], pa.list_(pa.float64()))


_letters_of.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}


# ---- Counts of words and bits -------------------------------------------------


def _word_counter(centres: np.ndarray):
    def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, words_held, bytes_held = [], 0, 0

        def flush() -> pa.RecordBatch:
            """Sums over the words of all held batches, which Arrow numbers."""
            merged = pa.concat_arrays([words for words, *_ in held]).dictionary_encode()
            cells, counts, asked = map(np.concatenate, list(zip(*held))[1:])
            cells = merged.indices.to_numpy()[cells // CLASSES].astype(np.int64) * CLASSES + cells % CLASSES
            size = len(merged.dictionary)
            # Exact below 2 ** 53.
            counts = np.bincount(cells, counts, size * CLASSES).astype(np.int64).reshape(size, CLASSES)
            wanted = np.zeros(size * CLASSES, bool)
            wanted[cells[asked]] = True
            asked = wanted.reshape(size, CLASSES) @ (1 << np.arange(CLASSES))
            return pa.RecordBatch.from_arrays(
                [merged.dictionary, *(pa.array(counts[:, c]) for c in range(CLASSES)), pa.array(asked)], [*_TEXT, "asked"])

        for batch in batches:
            words, numbers, lengths = _lowered(batch.column(0))
            kinds = text_kinds(batch.column(0), lengths, centres)
            cells, found = numbers * CLASSES + np.repeat(kinds, lengths), []
            for flags in batch.columns[1:]:
                use = flags.to_numpy(zero_copy_only=False).astype(bool)
                own = np.bincount(cells if use.all() else cells[np.repeat(use, lengths)], minlength=len(words) * CLASSES)
                own[-CLASSES:] += np.bincount(kinds[use], minlength=CLASSES)
                found.append(own)
            learned, asked = found
            hit = np.flatnonzero(learned + asked)
            held.append((words, hit + words_held * CLASSES, learned[hit], asked[hit] > 0))
            words_held += len(words)
            bytes_held += words.nbytes
            if words_held > COUNTED_WORDS or bytes_held > _COUNTED_BYTES:
                yield flush()
                held, words_held, bytes_held = [], 0, 0
        if held:
            yield flush()

    return count_words


def word_counts(training: DataFrame, centres: np.ndarray, text: str = "text",
                learn: Column | None = None, ask: Column | None = None) -> DataFrame:
    """(word, n0 .. n7, asked): how often each token occurs in each kind of text; '' is the end.

    Rows where ``learn`` holds are counted. ``asked`` has a bit for each kind of text in which the
    token occurs where ``ask`` holds, so that it is to be scored.
    """
    flags = [F.coalesce(c, F.lit(False)) for c in (F.lit(True) if learn is None else learn, F.lit(False) if ask is None else ask)]
    # Words are distinct by task already, so adding up again before they are dealt would spare nothing.
    counted = training.select(F.col(text), *flags).mapInArrow(_word_counter(centres), WORD_SCHEMA).repartition("word")
    return counted.groupBy("word").agg(*[F.sum(f"n{c}").alias(f"n{c}") for c in range(CLASSES)], F.bit_or("asked").alias("asked"))


def _hash(value: np.ndarray, salt: int) -> np.ndarray:
    mixed = (value + np.uint32(salt * 0x632BE5AB & 0xFFFFFFFF)) * np.uint32(0x85EBCA6B)
    mixed ^= mixed >> np.uint32(15)
    return mixed * np.uint32(0xC2B2AE35)


@dataclass(frozen=True)
class ByteCode:
    """Binary decisions that spell a byte: the node passed and the bit taken at each, by byte.

    ``sizes``: bits of each predictor's table.
    """

    nodes: np.ndarray
    bits: np.ndarray
    lengths: np.ndarray
    sizes: tuple[int, ...] = (LEAST_BITS,) * PREDICTORS

    @property
    def slots(self) -> int:
        return sum(1 << size for size in self.sizes)


def byte_code(counts: np.ndarray) -> ByteCode:
    """Code of least average length for bytes that occur ``counts`` times; every byte has one.

    Half as many decisions as with eight bits a byte, so half the work.
    """
    heap = [(int(c) + 1, b) for b, c in enumerate(counts)]
    heapq.heapify(heap)
    children: dict[int, tuple[int, int]] = {}
    while len(heap) > 1:
        (n, left), (m, right) = heapq.heappop(heap), heapq.heappop(heap)
        children[256 + len(children)] = (left, right)
        heapq.heappush(heap, (n + m, 255 + len(children)))
    paths: dict[int, list[tuple[int, int]]] = {heap[0][1]: []}
    for node in sorted(children, reverse=True):
        for bit, child in enumerate(children[node]):
            paths[child] = [*paths[node], (node - 256, bit)]
    lengths = np.array([len(paths[b]) for b in range(256)])
    nodes, bits = (np.zeros((256, lengths.max()), t) for t in (np.uint32, np.uint8))
    for byte in range(256):
        for at, (node, bit) in enumerate(paths[byte]):
            nodes[byte, at], bits[byte, at] = node, bit
    return ByteCode(nodes, bits, lengths)


def _count_bytes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros(256, np.int64)
    for batch in batches:
        words = batch.column(0).cast(pa.binary()).to_pylist()
        counts += np.bincount(np.frombuffer(b" ".join(words) + b" ", np.uint8), minlength=256)
    yield pa.RecordBatch.from_arrays([pa.array(np.arange(256)), pa.array(counts)], ["byte", "n"])


@dataclass
class Spelling:
    """All decisions of some tokens, one after the other.

    ``slots`` (predictor, decision) are places in the tables; ``bits`` and ``nodes`` are what was
    decided where; ``owner`` is the number of the token and ``first`` each token's first decision.
    """

    slots: np.ndarray
    bits: np.ndarray
    nodes: np.ndarray
    owner: np.ndarray
    first: np.ndarray


def spell(words: Sequence[bytes], classes: np.ndarray, code: ByteCode) -> Spelling:
    """Decisions for words and their closing space, with the slots their contexts hash to."""
    text = _Text(words, classes)
    place, nodes, bits, first = _steps(text.letters, code)
    # Places are two for each slot; 32 bits are faster where they do.
    wide = np.uint32 if 2 * code.slots < 1 << 32 else np.int64
    slots, begin = np.empty((PREDICTORS, len(bits)), wide), 0
    for row, (context, size) in enumerate(zip(text.contexts(), code.sizes)):
        slots[row] = _decisions(context[place], nodes) >> np.uint32(32 - size)
        slots[row] += wide(begin)
        begin += 1 << size
    return Spelling(slots, bits, nodes, text.owner[place], first[text.first])


def _steps(letters: np.ndarray, code: ByteCode) -> tuple[np.ndarray, ...]:
    """For all decisions that spell some letters the letter, the node and the bit, and each letter's first decision."""
    lengths = code.lengths[letters]
    first = np.cumsum(lengths) - lengths
    place = np.repeat(np.arange(len(letters)), lengths)
    step, letter = np.arange(len(place)) - first[place], letters[place]
    return place, code.nodes[letter, step], code.bits[letter, step], first


def _decisions(contexts: np.ndarray, nodes: np.ndarray) -> np.ndarray:
    """Hashes of nodes in contexts."""
    return (contexts ^ nodes * np.uint32(0x9E3779B1)) * np.uint32(0x27D4EB2F)


def _sorted(numbers: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The order that sorts numbers of so many bits, these numbers sorted, and where each distinct one begins."""
    spare = 64 - bits
    if len(numbers) < 1 << spare:  # number and place fit one word
        both = numbers.astype(np.uint64)
        both <<= np.uint64(spare)
        both |= np.arange(len(numbers), dtype=np.uint64)
        both.sort()
        order = (both & np.uint64((1 << spare) - 1)).astype(np.int64)
        both >>= np.uint64(spare)
        numbers = both.view(np.int64)
    else:
        order = np.argsort(numbers, kind="stable")
        numbers = numbers[order].astype(np.int64)
    return order, numbers, np.flatnonzero(np.concatenate([[True], numbers[1:] != numbers[:-1]]))


def _ranks(order: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """Which of the distinct numbers each number is."""
    ranks = np.empty(len(order), np.int64)
    ranks[order] = np.repeat(np.arange(len(begin)), np.diff(np.append(begin, len(order))))
    return ranks


class _Text:
    """Bytes of words and their closing spaces with what their contexts are made of."""

    def __init__(self, words: Sequence[bytes], classes: np.ndarray) -> None:
        self.letters = np.frombuffer(b" ".join(words) + b" ", np.uint8)
        lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
        self.first = np.cumsum(lengths) - lengths
        self.owner = np.repeat(np.arange(len(words)), lengths)
        at = np.arange(len(self.letters)) - self.first[self.owner]
        byte = self.letters.astype(np.uint32)

        def before(distance: int) -> np.ndarray:
            moved = np.full(len(byte), 32, np.uint32)
            moved[distance:] = byte[:-distance] if distance < len(byte) else 32
            moved[at < distance] = 32
            return moved

        one, two, three, four = (before(d) for d in (1, 2, 3, 4))
        self.four = one | two << np.uint32(8) | three << np.uint32(16) | four << np.uint32(24)
        self.kind = np.asarray(classes).astype(np.uint32)[self.owner]
        powers = np.cumprod(np.full(int(lengths.max()), 0x01000193, np.uint32), dtype=np.uint32)
        terms = (byte + np.uint32(1)) * powers[at]
        sums = np.cumsum(terms, dtype=np.uint32) - terms
        self.prefix = sums - sums[self.first][self.owner]

    def contexts(self, at: np.ndarray | slice = slice(None)) -> list[np.ndarray]:
        """Hashes of the contexts of some bytes, for each predictor.

        The five contexts of a byte lie inside its token: two, three and four bytes before it, each
        with the kind of text, all bytes before it, and these with the kind of text.
        """
        four, kind, prefix = self.four[at], self.kind[at], self.prefix[at]
        return [
            _hash((four & np.uint32(0xFFFF)) | kind << np.uint32(16), 1),
            _hash((four & np.uint32(0xFFFFFF)) | kind << np.uint32(24), 2),
            _hash(four * np.uint32(CLASSES + 1) + kind, 3),
            _hash(prefix, 4), _hash(prefix * np.uint32(CLASSES + 1) + kind, 5),
        ]

    def branches(self) -> tuple[np.ndarray, np.ndarray]:
        """One byte of each group that has the same letter in the same contexts, and the number of each byte's group.

        Words that begin alike share most of their bytes. Two groups may be the same.
        """
        size, kind = len(self.letters), self.kind << np.uint32(8) | self.letters  # kinds have 3 bits
        order, key, _ = _sorted(self.prefix.astype(np.uint64) << np.uint64(11) | kind.astype(np.uint64), 43)
        four = self.four[order]
        begin = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]) | (four[1:] != four[:-1])]))
        # Numbered as they come, so that a word's lie together.
        earliest = order[begin][_ranks(order, begin)]
        own = earliest == np.arange(size)
        return np.flatnonzero(own), (np.cumsum(own) - 1)[earliest]


def _words_of(batch: pa.RecordBatch) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Words, kinds of text and counts of the pairs that occur or, where the batch tells, are asked for."""
    counts = np.stack([batch.column(1 + c).to_numpy() for c in range(CLASSES)], 1)
    occur = counts > 0
    if batch.num_columns > 1 + CLASSES:
        occur |= (batch.column(1 + CLASSES).to_numpy()[:, None] >> np.arange(CLASSES)) & 1 > 0
    rows, classes = np.nonzero(occur)
    words = batch.column(0).cast(pa.binary()).to_pylist()
    return [words[r] for r in rows], classes, counts[rows, classes]


def _gathered(batches: Iterator[pa.RecordBatch]):
    """The same for many rows, at least _SPELT bytes at a time."""
    held, size = [], 0
    for batch in batches:
        own = _words_of(batch)
        if own[0]:
            held.append(own)
            size += sum(map(len, own[0])) + len(own[0])
        if size > _SPELT:
            yield [w for h in held for w in h[0]], *map(np.concatenate, list(zip(*held))[1:])
            held, size = [], 0
    if held:
        yield [w for h in held for w in h[0]], *map(np.concatenate, list(zip(*held))[1:])


def _chunks(size: int, *columns: Sequence):
    for at in range(0, len(columns[0]), size):
        yield [c[at:at + size] for c in columns]


def _decision_finder(code: ByteCode):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Hashes of one in _SAMPLED decisions, by predictor."""
        for words, classes, _ in _gathered(batches):
            text = _Text(words, classes)
            # Scrambled, so that the sample does not follow the order of the slots.
            at, _ = text.branches()
            place, nodes, _, _ = _steps(text.letters[at], code)
            hashed = (_decisions(context[place], nodes) for context in text.contexts(at))
            own = [np.unique(h[_hash(h, 9) < np.uint32((1 << 32) // _SAMPLED)]) for h in hashed]
            yield pa.RecordBatch.from_arrays([
                pa.array(np.repeat(np.arange(PREDICTORS), [len(h) for h in own])), pa.array(np.concatenate(own).astype(np.int64)),
            ], ["predictor", "hash"])

    return find


def table_sizes(words: DataFrame, code: ByteCode) -> tuple[int, ...]:
    """Bits of each predictor's table, from the distinct decisions in its contexts over all of ``words``."""
    found = words.mapInArrow(_decision_finder(code), "predictor long, hash long").distinct()
    counts = {r["predictor"]: r["n"] for r in found.groupBy("predictor").agg(F.count(F.lit(1)).alias("n")).collect()}
    wanted = [max(1.0, SLOTS_PER_DECISION * _SAMPLED * counts.get(p, 0)) for p in range(PREDICTORS)]
    # Hashes have 32 bits.
    return tuple(min(32, max(LEAST_BITS, math.ceil(math.log2(n)))) for n in wanted)


def _planes(numbers: np.ndarray) -> bytes:
    """First bytes of all numbers, then their second bytes, ...: small numbers become runs of zeros."""
    return numbers.reshape(-1, 1).view(np.uint8).T.tobytes()


def _from_planes(raw: bytes, kind: str) -> np.ndarray:
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(width, -1).T).view(kind)[:, 0]


def _packed(*columns: np.ndarray) -> bytes:
    """Columns of whole numbers from 0 up, each as narrow as it can be."""
    narrow = [c.astype(np.min_scalar_type(int(c.max(initial=0))).newbyteorder("<")) for c in columns]
    raw = b"".join(map(_planes, narrow))
    return bytes([c.itemsize for c in narrow]) + len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def _unpacked(data: bytes, columns: int) -> list[np.ndarray]:
    """The columns, still narrow."""
    widths, whole = data[:columns], int.from_bytes(data[columns:columns + 8], "little")
    raw, at, out = pa.decompress(data[columns + 8:], whole, codec="zstd", asbytes=True), 0, []
    size = whole // sum(widths)
    for width in widths:
        own = _from_planes(raw[at:at + size * width], f"<u{width}")
        out.append(own if width < 8 else own.astype(np.int64))
        at += size * width
    return out


@dataclass
class _Shared:
    """Decisions of one predictor, held once for all branches with the same letter in the same context.

    ``group`` tells each branch its group, ``first`` is each group's first decision, ``owner`` each
    decision's group. ``order`` sorts the decisions by slot; ``begin`` is where each of the ``slots`` begins.
    Without ``group`` each branch is its own.
    """

    group: np.ndarray | None
    first: np.ndarray
    owner: np.ndarray
    bits: np.ndarray
    order: np.ndarray
    begin: np.ndarray
    slots: np.ndarray

    def counts(self, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How often a zero and a one were taken at each slot by branches that occur ``times`` times."""
        if self.group is not None:  # exact below 2 ** 53
            times = np.bincount(self.group, times, len(self.first))
        # The count and, in the last place, the bit of each decision.
        taken = np.take(times.astype(np.int64) << 1, self.owner)
        taken |= self.bits
        taken = np.take(taken, self.order)
        bits = taken & 1
        taken >>= 1
        both = np.add.reduceat(taken, self.begin)
        taken *= bits
        ones = np.add.reduceat(taken, self.begin)
        return both - ones, ones

    def places(self, first: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Which of the slots each decision of the branches has."""
        ranks = _ranks(self.order, self.begin)
        if self.group is None:
            return ranks
        at = np.repeat(self.first[self.group] - first, lengths)
        at += np.arange(len(at))
        return ranks[at]


def _shared(text: _Text, at: np.ndarray, code: ByteCode) -> Iterator[_Shared]:
    """For each predictor the decisions of the branches that begin at some bytes."""
    letters, table = text.letters[at], 0
    steps = _steps(letters, code)
    for row, (context, size) in enumerate(zip(text.contexts(at), code.sizes)):
        group, (owner, nodes, bits, first) = None, steps
        if row < PREDICTORS - 2:  # the last contexts hold all bytes before, so hardly two branches share one
            order, _, begin = _sorted(context.astype(np.uint64) << np.uint64(8) | letters, 40)
            chosen = order[begin]
            owner, nodes, bits, first = _steps(letters[chosen], code)
            context, group = context[chosen], _ranks(order, begin)
        slots = (_decisions(context[owner], nodes) >> np.uint32(32 - size)).astype(np.int64) + table
        order, slots, begin = _sorted(slots, 36)
        yield _Shared(group, first, owner, bits, order, begin, slots[begin])
        table += 1 << size  # tables of predictors follow each other


_SENT = "slice long, lot long, data binary"


def _sent_rows(*rows: tuple[int, int, bytes]) -> pa.RecordBatch:
    kinds = pa.int64(), pa.int64(), pa.binary()
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["slice", "lot", "data"])


def _table_filler(code: ByteCode, width: int, answers: bool):
    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Bit counts of lots of words, as slices of the tables: slots and counts of the slots that they use.

        Where ``answers`` are wanted the words of each lot go along, under a negative slice.
        """
        first = TaskContext.get().partitionId() << 32
        for lot, (words, classes, counts) in enumerate(_gathered(batches), first):
            text = _Text(words, classes)
            at, branch = text.branches()
            times = np.bincount(branch, counts[text.owner], len(at))
            slots, zeros, ones = (np.concatenate(c) for c in zip(*((s.slots, *s.counts(times)) for s in _shared(text, at, code))))
            edges, sent = np.flatnonzero(np.concatenate([[True], slots[1:] // width != slots[:-1] // width])), []
            for start, end in zip(edges, np.append(edges[1:], len(slots))):
                inside = slots[start:end] % width
                sent.append((slots[start] // width, lot, _packed(np.diff(inside, prepend=0), zeros[start:end], ones[start:end])))
            if answers:
                sent.append((-1 - lot, lot, pickle.dumps((words, classes, counts))))
            yield _sent_rows(*sent)

    return fill


def _add_slices(width: int, answers: bool):
    """Sums of the parts of each slice; rows come ordered by slice, so one is held at a time.

    Each lot is answered with what all have in its slots; otherwise the slice itself is returned.
    """
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []

        def flush() -> Iterator[pa.RecordBatch]:
            zeros, ones = np.zeros(width, np.int64), np.zeros(width, np.int64)
            asked = []
            for lot, data in held:
                steps, z, o = _unpacked(data, 3)
                at = np.cumsum(steps, dtype=np.int64)
                zeros[at] += z
                ones[at] += o
                asked.append((lot, at.astype(np.int32)))  # a slice is narrow
            if not answers:
                yield _sent_rows((now, 0, zlib.compress(np.stack([zeros, ones], 1).tobytes(), 1)))
                return
            for (some,) in _chunks(_ANSWERS, asked):
                yield _sent_rows(*((now, lot, _packed(zeros[at], ones[at])) for lot, at in some))

        for batch in batches:
            for slice_, lot, data in zip(*(batch.column(c).to_pylist() for c in range(3))):
                if slice_ < 0:
                    yield _sent_rows((-1, lot, data))
                    continue
                if slice_ != now:
                    if held:
                        yield from flush()
                    now, held = slice_, []
                held.append((lot, data))
        if held:
            yield from flush()

    return add


def _slice_width(code: ByteCode) -> int:
    return max(_SLICE, -(-code.slots // _SLICES))


def decision_counts(words: DataFrame, code: ByteCode) -> DataFrame:
    """Lots of words under slice -1, and what all lots have seen in the slots of each, by slice.

    The tables never exist in one place. Each lot sends the counts of its own slots to the slices of
    the tables; a slice adds up what it gets and answers each lot.
    """
    width = _slice_width(code)
    sent = words.mapInArrow(_table_filler(code, width, True), _SENT).repartition("slice").sortWithinPartitions("slice")
    return stored(sent.mapInArrow(_add_slices(width, True), _SENT), "lm-decisions", LONG_ROWS, once=True)


def _by_lot(answers: DataFrame) -> DataFrame:
    return answers.repartition("lot").sortWithinPartitions("lot", "slice")


def bit_tables(words: DataFrame, code: ByteCode) -> np.ndarray:
    """Counts of zeros and ones per slot, over all tokens of ``words``: the whole tables of a small corpus."""
    width = _slice_width(code)
    sent = words.mapInArrow(_table_filler(code, width, False), _SENT).repartition("slice").sortWithinPartitions("slice")
    tables = np.zeros((-(-code.slots // width), 2 * width), np.float32)
    for row in sent.mapInArrow(_add_slices(width, False), _SENT).toLocalIterator():
        tables[row["slice"]] = np.frombuffer(zlib.decompress(row["data"]), "<i8")
    return tables.reshape(-1, 2)[:code.slots]


def _stretch(zeros: np.ndarray, ones: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log odds of a one, and the power of two up to which the context was seen."""
    zeros, ones = (np.maximum(n.astype(np.float32), 0) for n in (zeros, ones))
    odds = np.log((ones + np.float32(0.4)) / (zeros + np.float32(0.4)))
    return odds, np.minimum(np.log2(zeros + ones + np.float32(1)), 15).astype(np.uint8)


class _Lot:
    """Words with their decisions and what was seen at them, from the answers of the slices.

    Decisions that words share are held once: ``counted`` are the zeros and ones seen at each, ``at``
    are those of all words, one after the other.
    """

    def __init__(self, words: bytes, answers: list[bytes], code: ByteCode) -> None:
        self.words, self.kinds, self.counts = pickle.loads(words)
        text = _Text(self.words, self.kinds)
        at, branch = text.branches()
        _, self.nodes, self.bits, first = _steps(text.letters[at], code)
        lengths = np.diff(np.append(first, len(self.bits)))
        totals, answered = [np.concatenate(c) for c in zip(*(_unpacked(a, 2) for a in answers))], 0
        self.counted = np.empty((2, PREDICTORS, len(self.bits)), np.float32)
        for row, shared in enumerate(_shared(text, at, code)):
            places, own = shared.places(first, lengths), slice(answered, answered + len(shared.slots))
            for seen, total in zip(self.counted[:, row], totals):
                np.take(total[own].astype(np.float32), places, out=seen, mode="clip")  # unbuffered
            answered = own.stop
        start = np.cumsum(lengths[branch]) - lengths[branch]
        size = int(lengths[branch].sum())
        kind = np.int32 if size < 1 << 31 else np.int64
        self.at = np.repeat((first[branch] - start).astype(kind), lengths[branch])
        self.at += np.arange(size, dtype=kind)
        self.first = np.append(start[text.first], size)

    @property
    def seen(self) -> np.ndarray:
        """Zeros and ones at each decision of each word."""
        return self.counted[:, :, self.at]

    def parts(self, *more: np.ndarray):
        """``more``, zeros, ones, bits and nodes of some of the decisions at a time."""
        for at in range(0, len(self.bits), _PART):
            part = slice(at, at + _PART)
            yield *(m[part] for m in more), *self.counted[:, :, part], self.bits[part], self.nodes[part]

    def to_learn(self) -> _Lot:
        """The lot with log odds (decision, predictor) and gates to learn with in place of the counts."""
        self.odds, self.gated = np.empty((len(self.bits), PREDICTORS), np.float32), np.empty(len(self.bits), np.int16)
        for own, gate, zeros, ones, bits, _ in self.parts(self.odds, self.gated):
            # A token must not vouch for itself: one such bit is taken out.
            fresh, seen = _stretch(zeros - (bits == 0), ones - (bits == 1))
            own[:], gate[:] = fresh.T, _gates(seen)
        del self.counted
        return self

    def lesson(self, pairs: np.ndarray) -> tuple[np.ndarray, ...]:
        """Log odds, gates, bits and nodes of some of the words, one after the other, and how many each has."""
        first = self.first[pairs]
        sizes = self.first[pairs + 1] - first
        at = np.repeat(first - (np.cumsum(sizes) - sizes), sizes)
        at += np.arange(len(at))
        at = np.take(self.at, at).astype(np.int64)
        return *(np.take(c, at, 0) for c in (self.odds, self.gated, self.bits, self.nodes)), sizes


def _lots(batches: Iterator[pa.RecordBatch], code: ByteCode) -> Iterator[_Lot]:
    """Lots, one at a time; rows come ordered by lot and slice."""
    now, held = None, []
    for batch in batches:
        for lot, data in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            if lot != now:
                if held:
                    yield _Lot(held[0], held[1:], code)
                now, held = lot, []
            held.append(data)
    if held:
        yield _Lot(held[0], held[1:], code)


def _gates(seen: np.ndarray) -> np.ndarray:
    """The gate of each bit."""
    return (seen[4].astype(np.int64) * 4 + np.minimum(seen[3] >> 1, 3)) * 4 + np.minimum(seen[2] >> 1, 3)


def _weighted(weights: np.ndarray, odds: np.ndarray, gates: np.ndarray) -> np.ndarray:
    """Mixed log odds."""
    return np.clip(sum(weights[i][gates] * o for i, o in enumerate(odds)), -_SUREST, _SUREST)


def _refined_place(nodes: np.ndarray, z: np.ndarray) -> np.ndarray:
    return nodes.astype(np.int64) * _REFINED + np.rint((np.clip(z, -8, 8) + 8) * 2).astype(np.int64)


def start_weights() -> np.ndarray:
    return np.full((PREDICTORS, GATES), 0.3, np.float32)


def _mixer(code: ByteCode):
    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, total, lesson = start_weights().astype(np.float64), 0.0, 0
        refined, curves = np.zeros((2, 256 * _REFINED)), None
        lots = _lots(batches, code)
        while held := [lot.to_learn() for lot in islice(lots, _MIXED)]:
            # Frequent words come in portions, those of several lots in any order.
            counts_ = np.concatenate([lot.counts for lot in held])
            starts = np.cumsum([0, *(len(lot.counts) for lot in held)])
            times = -(-counts_ // _LOT)
            pairs = np.repeat(np.arange(len(times)), times)
            portion = np.arange(len(pairs)) - np.repeat(np.cumsum(times) - times, times)
            counts_ = np.minimum(_LOT, counts_[pairs] - portion * _LOT)
            order = np.random.default_rng(len(pairs)).permutation(len(pairs))
            for some, counts in _chunks(_LESSON, pairs[order], counts_[order]):
                parts, weight = [], []
                for lot, start, end in zip(held, starts, starts[1:]):
                    inside = (some >= start) & (some < end)
                    *part, sizes = lot.lesson(some[inside] - start)
                    parts.append(part)
                    weight.append(np.repeat(counts[inside], sizes))
                inputs, gates, bits, nodes = (np.concatenate(c) for c in zip(*parts))
                inputs, gates = np.ascontiguousarray(inputs.T), gates.astype(np.int64)
                weight = np.concatenate(weight).astype(np.float64)
                z = _weighted(weights, inputs, gates)
                mixed = 1 / (1 + np.exp(-z))
                error = (bits - mixed) * weight
                if curves is None or lesson % _CURVES == 0:
                    spread = mixed * (1 - mixed) * weight
                    fresh = np.stack([np.bincount(gates, spread * value * value, GATES) for value in inputs])
                    curves = fresh if curves is None else 0.5 * curves + 0.5 * fresh
                rate = _RATE / (1 + lesson / _COOLING)
                for own, value, curve in zip(weights, inputs, curves):
                    own += np.clip(rate * np.bincount(gates, error * value, GATES) / (curve + _CAUTION), -_STRIDE, _STRIDE)
                bins = _refined_place(nodes, z)
                refined[0] += np.bincount(bins, weight, refined.shape[1])
                refined[1] += np.bincount(bins, weight * bits, refined.shape[1])
                total += float(counts.sum())
                lesson += 1
            held = lot = None  # before the next lots come
        if total:
            yield pa.RecordBatch.from_arrays([
                pa.array(np.arange(weights.size + refined.shape[1])),
                pa.array(np.concatenate([weights.ravel() * total, refined[1]])),
                pa.array(np.concatenate([np.full(weights.size, total), refined[0]])),
            ], ["cell", "value", "weight"])

    return learn


@dataclass(frozen=True)
class MixingModel:
    """What the driver holds of a model: the code, the weights and the refinement, all of fixed size.

    ``answers`` are the ``decision_counts`` of ``words``.
    """

    code: ByteCode
    weights: np.ndarray
    refined: np.ndarray
    words: DataFrame
    answers: DataFrame

    def chances(self, spelt: Spelling) -> np.ndarray:
        """Probability of each decision that was taken, by the tables of a small corpus."""
        zeros, ones = np.moveaxis(bit_tables(self.words, self.code)[spelt.slots], 2, 0)
        return _chances(self.weights, self.refined, zeros, ones, spelt.bits, spelt.nodes)

    def costs(self) -> DataFrame:
        """(word, n, costs): each word's count, and log10 of its probability after each kind of text in which it occurs or is asked for."""
        return _by_lot(self.answers).mapInArrow(_coster(self.code, self.weights, self.refined), "word string, n long, costs array<float>")


def _chances(weights: np.ndarray, refined: np.ndarray, zeros: np.ndarray, ones: np.ndarray, bits: np.ndarray, nodes: np.ndarray) -> np.ndarray:
    odds, seen = _stretch(zeros, ones)
    z = _weighted(weights, odds, _gates(seen))
    one = 0.5 / (1 + np.exp(-z)) + 0.5 * refined[_refined_place(nodes, z)]
    return np.clip(np.where(bits == 1, one, 1 - one), 1e-6, 1)


def _coster(code: ByteCode, weights: np.ndarray, refined: np.ndarray):
    def cost(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lot in _lots(batches, code):
            logs = np.concatenate([np.log10(_chances(weights, refined, *part)) for part in lot.parts()])[lot.at]
            # The pairs of a word lie side by side.
            fresh = [at for at, word in enumerate(lot.words) if not at or word != lot.words[at - 1]]
            word = np.repeat(np.arange(len(fresh)), np.diff([*fresh, len(lot.words)]))
            table = np.full((len(fresh), CLASSES), np.nan, np.float32)
            table[word, lot.kinds] = np.add.reduceat(logs, lot.first[:-1])
            yield pa.RecordBatch.from_arrays([
                pa.array([lot.words[at] for at in fresh], pa.binary()).cast(pa.string()),
                pa.array(np.add.reduceat(lot.counts, fresh)),
                pa.ListArray.from_arrays(pa.array(np.arange(len(fresh) + 1, dtype=np.int32) * CLASSES), pa.array(table.ravel())),
            ], ["word", "n", "costs"])
            del lot, logs  # before the next lot comes

    return cost


def fit(words: DataFrame) -> MixingModel:
    """Model of stored ``word_counts``.

    The bit counts cover every training token. Then the tokens run by once more, frequent ones in
    portions that are dealt over their lot: each task corrects its weights after
    every lesson, on predictions from which the token itself is taken out, and the weights are
    averaged by the tokens behind them. The last stage, a table of what share of ones followed
    each mixed prediction, is added up alongside.
    """
    learned = words.select(*_TEXT).where(F.greatest(*[F.col(f"n{c}") for c in range(CLASSES)]) > 0)
    letters_ = learned.select("word").mapInArrow(_count_bytes, "byte long, n long").groupBy("byte").agg(F.sum("n").alias("n")).collect()
    seen_bytes = np.zeros(256, np.int64)
    for row in letters_:
        seen_bytes[row["byte"]] = row["n"]
    code = byte_code(seen_bytes)
    code = replace(code, sizes=table_sizes(learned, code))
    answers = decision_counts(words, code)
    learned_cells = stored(_by_lot(answers).mapInArrow(_mixer(code), "cell long, value double, weight double"), "lm-cells", once=True)
    cells = learned_cells.groupBy("cell").agg(F.sum("value").alias("value"), F.sum("weight").alias("weight")).collect()
    size = GATES * PREDICTORS
    values, mass = np.zeros(size + 256 * _REFINED), np.zeros(size + 256 * _REFINED)
    for row in cells:
        values[row["cell"]], mass[row["cell"]] = row["value"], row["weight"]
    averaged = values[:size] / np.maximum(mass[:size], 1e-300)
    weights = np.where(mass[:size] > 0, averaged, start_weights().ravel()).astype(np.float32).reshape(PREDICTORS, GATES)
    expected = np.tile(1 / (1 + np.exp(8 - np.arange(_REFINED) / 2)), 256)
    refined = (values[size:] + 8 * expected) / (mass[size:] + 8)
    return MixingModel(code, weights, refined.astype(np.float32), words, answers)


def _looked_up(batches: Iterator[pa.RecordBatch], head: pa.Array):
    """At most _DOCUMENTS rows at a time with the distinct words of their texts, where these lie in the
    head (beyond it: -1), the numbers of the words of all texts and how many each text has.

    Lookups begin with a table of the whole head, so many batches are looked up at once.
    """
    held, size = [], 0

    def flush():
        places = pc.fill_null(pc.index_in(pa.concat_arrays([words for _, words, *_ in held]), value_set=head), -1).to_numpy()
        begin = 0
        for batch, words, numbers, lengths in held:
            yield batch, words, places[begin:begin + len(words)], numbers, lengths
            begin += len(words)

    for batch in (whole.slice(at, _DOCUMENTS) for whole in batches for at in range(0, whole.num_rows, _DOCUMENTS)):
        words, numbers, lengths = _lowered(batch.column("text"))
        held.append((batch, words, numbers.astype(np.int32), lengths))
        size += batch.nbytes
        if size > _LOOKED_UP:
            yield from flush()
            held, size = [], 0
    if held:
        yield from flush()


def _scorer(sent, centres: np.ndarray):
    """Scores of documents by the words of the head; the other words are left over."""
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, counts, costs = sent.value
        # The last place is for words that are left over.
        logs, met = np.append(np.log10(counts + 1.0), 0.0), np.append(counts > 0, False).astype(np.int64)
        flat = np.concatenate([costs.ravel(), np.zeros(CLASSES, np.float32)])
        row = TaskContext.get().partitionId() << 33
        for batch, words, places, numbers, lengths in _looked_up(batches, head):
            sizes = pc.binary_length(words).to_numpy().astype(np.int64) + 1

            tokens = np.insert(numbers, np.cumsum(lengths), len(words) - 1)
            first = np.cumsum(lengths + 1) - lengths - 1
            kinds = text_kinds(batch.column("text"), lengths, centres)
            docs, spots = np.repeat(np.arange(len(lengths)), lengths + 1), np.where(places < 0, len(head), places)[tokens]

            def total(values: np.ndarray) -> pa.Array:
                return pa.array(np.add.reduceat(values, first))

            beyond = spots == len(head)
            left, times = np.unique(docs[beyond] * len(words) + tokens[beyond], return_counts=True)
            ends = np.cumsum(np.bincount(left // len(words), minlength=len(lengths)))
            rest = pa.ListArray.from_arrays(
                pa.array(np.concatenate([[0], ends]).astype(np.int32)),
                pa.StructArray.from_arrays([words.take(pa.array(left % len(words))), pa.array(times.astype(np.int64))], ["word", "n"]),
            )
            yield pa.RecordBatch.from_arrays([
                pa.array(row + np.arange(len(lengths))),
                batch.column("doc_id"), batch.column("held_out"),
                pa.array(lengths + 1), total(met[spots]), total(sizes[tokens]), total(logs[spots]),
                pc.subtract(total(flat[spots * CLASSES + kinds[docs]].astype(np.float64)), math.log10(CLASSES)),
                pa.array(kinds, pa.int32()), rest,
            ], ["row", "doc_id", "held_out", "n_tokens", "known", "bytes", "logs", "score", "kind", "rest"])
            row += len(lengths)

    return score


def least_count(words: DataFrame, at_most: int) -> int:
    """The least count ``n`` such that at most ``at_most`` words occur that often."""
    sizes = sorted(((r["n"], r["words"]) for r in words.groupBy("n").agg(F.count(F.lit(1)).alias("words")).collect()), reverse=True)
    least, held = (sizes[0][0] + 1 if sizes else 1), 0
    for n, number in sizes:  # one row per distinct count
        if held + number > at_most:
            break
        least, held = n, held + number
    return int(least)


def _head(words: DataFrame, at_most: int) -> tuple[tuple[pa.Array, np.ndarray, np.ndarray], int]:
    """The most frequent words, at most ``at_most``, their counts and costs, and their least count."""
    least = least_count(words, at_most)
    head = words.where(F.col("n") >= least).select("word", "n", "costs").toArrow()
    costs = head.column("costs").combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float32)
    return (head.column("word").combine_chunks(), head.column("n").to_numpy().astype(np.int64), costs.reshape(-1, CLASSES)), least


def scored(docs: DataFrame, training: DataFrame | None = None, doc_id: str = "doc_id", text: str = "text",
           held_out: str = "held_out", head_words: int = HEAD_WORDS) -> DataFrame:
    """Every document of ``docs`` with its score under a model of ``training``.

    (doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte).
    Tokens are words with A-Z lower-cased, then one end. ``score`` is log10 of the probability of
    the kind of text, one of CLASSES, and of the tokens, each spelt in bits up to its closing
    space; ``bits_per_byte`` divides its bits by the bytes spelt. ``base_score`` comes from add-one counts of tokens.
    A null or empty text is the end alone. With nothing to learn from, every decision costs one bit
    and the base score is 0. Rows that repeat are scored each. Long texts are read block by block.

    Without ``training``, the rows of ``docs`` that are not held out are learned from.

    Counts and costs of the ``head_words`` most frequent words travel to the tasks; the others are
    looked up by a join on the words that are left over.
    """
    asked = docs.select(F.col(text).alias("text"), (~F.col(held_out)).alias("learn"), F.lit(True).alias("ask"))
    if training is None:
        learned = docs.where(~F.col(held_out))
        texts = asked
    else:
        learned = training
        texts = training.select(F.col(text).alias("text"), F.lit(True).alias("learn"), F.lit(False).alias("ask")).unionAll(
            asked.withColumn("learn", F.lit(False)))
    centres = text_classes(learned, text)
    counts = stored(word_counts(texts, centres, "text", F.col("learn"), F.col("ask")), "lm-counts", once=True)
    # In order over all of them, the words of a lot share contexts; ranges are drawn from the stored words.
    model = fit(stored(counts.repartitionByRange("word").sortWithinPartitions("word"), "lm-words", once=True))
    words = stored(model.costs(), "lm-costs", once=True)
    total = words.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("tokens"), F.count_if(F.col("n") > 0).alias("words")).first()
    head, least = _head(words, head_words)
    found = stored(
        docs.select(F.col(doc_id).alias("doc_id"), F.col(held_out).alias("held_out"), F.col(text).alias("text"))
        .mapInArrow(_scorer(docs.sparkSession.sparkContext.broadcast(head), centres),
                    "row long, doc_id long, held_out boolean, n_tokens long, known long, bytes long, "
                    "logs double, score double, kind int, rest array<struct<word:string,n:bigint>>"),
        "lm-scored",
    )
    times, n = F.col("times"), F.col("n")
    looked_up = (
        found.select("row", "kind", F.explode("rest").alias("r")).select("row", "kind", "r.word", F.col("r.n").alias("times"))
        .join(words.where(n < least), "word")
        .groupBy("row").agg(
            F.sum(F.when(n > 0, times).otherwise(0)).alias("more_known"), F.sum(times * F.log10(n + F.lit(1.0))).alias("more_logs"),
            F.sum(times * F.get("costs", F.col("kind")).cast("double")).alias("more_score"),
        )
    )
    weight = float(np.log10(float(total["tokens"] + total["words"] + 1)))
    score = F.col("score") + F.coalesce("more_score", F.lit(0.0))
    return found.join(looked_up, "row", "left").select(
        "doc_id", "held_out", "n_tokens",
        (F.col("known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(total["tokens"]).cast("long").alias("train_tokens"),
        (F.col("logs") + F.coalesce("more_logs", F.lit(0.0)) - F.col("n_tokens") * F.lit(weight)).alias("base_score"),
        score.alias("score"), (-score * F.lit(float(np.log2(10))) / F.col("bytes")).alias("bits_per_byte"),
    )
