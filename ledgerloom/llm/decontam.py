"""Benchmark passages in documents: latent semantic retrieval, then word-order and answer checks."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..operators.joins import lookup_join
from .common import add_lines, stored, word_count, words_in_blocks

#: A passage is two blocks of this many words; passages overlap by one block. Items of at most a
#: block are also sought in passages of one block, which overlap by half a block.
BLOCK_WORDS = 24

#: Columns of the randomised range finder, which is the rank of the latent space: one for each
#: PASSAGES_PER_RANK passages of items, and at least RANK.
RANK = 64
PASSAGES_PER_RANK = 4
SEED = 5

#: Cosine in the latent space from which a passage is compared word by word.
COSINE = 0.4

#: Mass of the items' passages in the matrix, in that of all documents' passages: the rank must
#: tell the items apart, not the common words of the documents.
ITEM_MASS = 20.0

#: Longest common subsequence, as a share of the item's words: from the first on it is a copy,
#: from the second on a paraphrase, provided the answer is there too.
COPY = 0.9
PARAPHRASE = 0.6

#: Share of the answer's words that must occur in order.
ANSWER = 0.75

#: Bytes of benchmark texts, and about the passages of items, searched at once; a larger
#: benchmark is searched in several blocks, so that rank and tables stay small.
BENCHMARK_BYTES = 8 << 20
BENCHMARK_PASSAGES = 1024

_PUNCTUATION = bytes(0x20 if b < 0x80 and not chr(b).isalnum() else b for b in range(256))
_OCCURRENCES = 50_000
_PAIRS = 1 << 20
_DENSE = 1 << 24
_REGION_WORDS = 1 << 18
_PIECE = 32
_SENTENCE = re.compile(r"[.?!;\n]+")
_ANSWER = re.compile(r"(?i)\banswer\s*[:=]")


def normal_words(text: str) -> list[bytes]:
    """Lower-cased words without ASCII punctuation."""
    return text.lower().encode("utf-8", "replace").translate(_PUNCTUATION).split()


def answer_words(text: str) -> list[bytes]:
    """Words after the last "answer:", else of the last sentence; of a lone sentence its last third."""
    marks = list(_ANSWER.finditer(text))
    if marks and normal_words(text[marks[-1].end():]):
        return normal_words(text[marks[-1].end():])
    sentences = [w for w in map(normal_words, _SENTENCE.split(text)) if w]
    if len(sentences) > 1:
        return sentences[-1]
    words = sentences[0] if sentences else []
    return words[-max(1, len(words) // 3):] if words else []


@dataclass(frozen=True)
class Items:
    """One block of the benchmark: ids, words and answers as term numbers, and the terms."""

    ids: tuple[int, ...]
    words: tuple[np.ndarray, ...]
    answers: tuple[np.ndarray, ...]
    terms: dict[bytes, int]


def read_items(rows: Sequence[tuple[int, str]]) -> Items:
    usable = sorted({(i, t) for i, t in rows if i is not None and t and normal_words(t)})
    terms = {w: n for n, w in enumerate(sorted({w for _, t in usable for w in normal_words(t)}))}

    def numbers(words: list[bytes]) -> np.ndarray:
        return np.array([terms[w] for w in words if w in terms], np.int32)

    return Items(tuple(i for i, _ in usable), tuple(numbers(normal_words(t)) for _, t in usable),
                 tuple(numbers(answer_words(t)) for _, t in usable), terms)


def _term_finder(terms: dict[bytes, int]):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = terms.get
        for batch in batches:
            keep, places, found, lengths = [], [], [], []
            for row, text in enumerate(batch.column("text")):
                raw = (text.as_py() or "").lower().encode("utf-8", "replace").translate(_PUNCTUATION)
                parts, seen = [], 0
                for words in words_in_blocks(raw):
                    parts.append(np.fromiter(map(known, words, repeat(-1)), np.int32, len(words)))
                numbers = np.concatenate(parts) if parts else np.zeros(0, np.int32)
                hit = np.flatnonzero(numbers >= 0)
                if len(hit):
                    keep.append(row)
                    places.append(hit.astype(np.int32))
                    found.append(numbers[hit])
                    lengths.append(len(numbers))
            ends = np.concatenate([[0], np.cumsum([len(p) for p in places])]).astype(np.int32)
            flat = [np.concatenate(x) if x else np.zeros(0, np.int32) for x in (places, found)]
            kept = batch.select(["row_key", "doc_id"]).take(pa.array(keep, pa.int64()))
            yield pa.RecordBatch.from_arrays([
                kept.column(0), kept.column(1), pa.array(lengths, pa.int32()),
                *(pa.ListArray.from_arrays(pa.array(ends), pa.array(f)) for f in flat),
            ], ["row_key", "doc_id", "n_words", "places", "terms"])

    return find


def _slices(batch: pa.RecordBatch, parts: int = 1) -> Iterator[tuple[slice, np.ndarray, np.ndarray, np.ndarray]]:
    """Documents of a batch, some at a time: rows, block of each occurrence, its term, blocks per document.

    ``parts``: each block is cut into so many, and occurrences get the number of the part.
    """
    ends = batch.column("places").value_lengths().to_numpy(zero_copy_only=False).cumsum()
    places = batch.column("places").flatten().to_numpy(zero_copy_only=False)
    terms = batch.column("terms").flatten().to_numpy(zero_copy_only=False)
    blocks = np.maximum(1, -(-batch.column("n_words").to_numpy(zero_copy_only=False) // BLOCK_WORDS)).astype(np.int64)
    at = 0
    while at < len(ends):
        begin = ends[at - 1] if at else 0
        stop = max(at + 1, int(np.searchsorted(ends, begin + _OCCURRENCES, side="right")))
        own = blocks[at:stop]
        counts = np.diff(np.concatenate([[begin], ends[at:stop]]))
        base = np.repeat(np.cumsum(own) - own, counts)
        part = base * parts + places[begin:ends[stop - 1]] // (BLOCK_WORDS // parts)
        yield slice(at, stop), part, terms[begin:ends[stop - 1]], own
        at = stop


def _sums(table: np.ndarray, rows: np.ndarray, block: np.ndarray, blocks: int) -> np.ndarray:
    """Sums of ``table[rows]`` over equal values of ``block``, which ascends.

    Adds the first rows of all blocks, then the second ones, and so on: a few whole-array steps
    where the longest block is short.
    """
    counts = np.bincount(block, minlength=blocks)
    start = np.cumsum(counts) - counts
    order = np.argsort(-counts, kind="stable")
    falling, begin = -counts[order], start[order]
    sums = np.zeros((blocks, table.shape[1]), table.dtype)
    for place in range(int(counts.max(initial=0))):
        still = int(np.searchsorted(falling, -place, side="left"))
        sums[:still] += table[rows[begin[:still] + place]]
    out = np.empty_like(sums)
    out[order] = sums
    return out


def _add_by_term(total: np.ndarray, vectors: np.ndarray, rows: np.ndarray, terms: np.ndarray) -> None:
    """Adds ``vectors[rows]`` to the lines of ``total`` named by ``terms``."""
    order = np.argsort(terms.astype(np.int16) if len(total) < 1 << 15 else terms, kind="stable")
    ordered = terms[order]
    if not len(ordered):
        return
    fresh = np.concatenate([[True], ordered[1:] != ordered[:-1]])
    inside = np.arange(len(ordered)) - np.maximum.accumulate(np.where(fresh, np.arange(len(ordered)), 0))
    piece = inside % _PIECE == 0
    sums = _sums(vectors, rows[order], np.cumsum(piece) - 1, int(piece.sum()))
    lines = ordered[piece]
    first = np.flatnonzero(np.concatenate([[True], lines[1:] != lines[:-1]]))
    total[lines[first]] += np.add.reduceat(sums.astype(total.dtype), first, axis=0)


def _passages(sums: np.ndarray, blocks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Passage vectors: a block and the next one of the same document. Also: is there a passage at the block?"""
    last = np.zeros(len(sums), bool)
    last[np.cumsum(blocks) - 1] = True
    joined = sums.copy()
    joined[:-1][~last[:-1]] += sums[1:][~last[:-1]]
    # The last block alone is a passage only where it is the whole document.
    return joined, ~last | np.repeat(blocks == 1, blocks)


def _count_documents(size: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        documents, passages = np.zeros(size, np.int64), 0
        for batch in batches:
            for _, block, terms, blocks in _slices(batch):
                owner = np.repeat(np.arange(len(blocks)), blocks)[block]
                seen = np.unique(owner * np.int64(size) + terms)
                documents += np.bincount(seen % size, minlength=size)
                passages += int(np.maximum(1, blocks - 1).sum())
        hit = np.flatnonzero(documents)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(hit, -1)), pa.array(np.append(documents[hit], passages))], ["term", "n"])

    return count


def _sketcher(weights: np.ndarray, test: np.ndarray):
    """Adds up A'(A test) of one partition; A has a row for each passage, of unit length."""
    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = (test * weights[:, None]).astype(np.float32)
        square = (weights ** 2).astype(np.float32)[:, None]
        total = np.zeros(test.shape)
        for batch in batches:
            for _, block, terms, blocks in _slices(batch):
                n = int(blocks.sum())
                image, there = _passages(_sums(table, terms, block, n), blocks)
                length, _ = _passages(_sums(square, terms, block, n), blocks)
                image *= there[:, None] / np.maximum(length, 1e-12)
                # An occurrence lies in the passage that starts at its block and in the one before.
                behind = np.zeros_like(image)
                behind[1:] = image[:-1]
                behind[np.cumsum(blocks) - blocks] = 0
                _add_by_term(total, image + behind, block, terms)
        hit = np.flatnonzero(total.any(1))
        lines = (total * weights[:, None])[hit]
        yield pa.RecordBatch.from_arrays([pa.array(hit), pa.array(list(lines), pa.list_(pa.float64()))], ["term", "line"])

    return sketch


def _item_rows(items: Items, weights: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Unit TF-IDF rows of the items' passages (terms x passages are few), and each passage's item."""
    rows, owner = [], []
    for number, words in enumerate(items.words):
        last = max(0, len(words) - 2 * BLOCK_WORDS)
        for start in sorted({*range(0, last + 1, BLOCK_WORDS), last}):
            some = words[start:start + 2 * BLOCK_WORDS]
            rows.append((some, weights[some] / max(1e-12, float(np.linalg.norm(weights[some])))))
            owner.append(number)
    return rows, np.array(owner, np.int64)


def latent_space(found: DataFrame, items: Items, documents: int, rank: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Term weights, and the latent basis times these weights (terms x rank).

    Inverse document frequencies count all documents. The matrix of TF-IDF passages A (all
    documents' and, ITEM_MASS times as heavy, the items') is never gathered: every partition
    adds up A'(A test) for a random ``test`` of ``rank`` columns, tasks add the lines of a term, and
    the leading right singular vectors follow from that one sketch (Nystrom). Terms are those of
    the items: others cannot bring a passage nearer to an item.
    """
    size = len(items.terms)
    counted = found.mapInArrow(_count_documents(size), "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()
    frequency, passages = np.zeros(size), 0
    for row in counted:  # at most one row per term
        if row["term"] < 0:
            passages = row["n"]
        else:
            frequency[row["term"]] = row["n"]
    weights = np.log((documents + 1.0) / (frequency + 0.5)).clip(1e-3)
    rows, _ = _item_rows(items, weights, size)
    rank = min(rank or max(RANK, -(-len(rows) // PASSAGES_PER_RANK)), size)
    test, _ = np.linalg.qr(np.random.default_rng(SEED).normal(size=(size, rank)))
    sketch = np.zeros((size, rank))
    lines = found.mapInArrow(_sketcher(weights, test), "term long, line array<double>").repartition("term")
    for row in lines.mapInArrow(add_lines, "term long, line array<double>").collect():
        sketch[row["term"]] = row["line"]
    mass = ITEM_MASS * max(1.0, passages / max(1, len(rows)))
    for some, values in rows:
        np.add.at(sketch, some, mass * values[:, None] * (values @ test[some]))
    shift = 1e-9 * np.linalg.norm(sketch) + 1e-12
    shifted = sketch + shift * test
    core = test.T @ shifted
    lower = np.linalg.cholesky((core + core.T) / 2 + shift * np.eye(rank))
    basis, _, _ = np.linalg.svd(np.linalg.solve(lower, shifted.T).T, full_matrices=False)
    return weights, basis * weights[:, None]


def _common_order(masks: dict[int, int], length: int, terms: list[int]) -> int:
    """Length of the longest common subsequence, all rows of the table at once as bits of a number."""
    full = state = (1 << length) - 1
    for term in terms:
        mask = masks.get(term)
        if mask:
            shared = state & mask
            state = ((state + shared) | (state - shared)) & full
    return length - state.bit_count()


def _masks(words: np.ndarray) -> dict[int, int]:
    masks: dict[int, int] = {}
    for at, term in enumerate(words.tolist()):
        masks[term] = masks.get(term, 0) | 1 << at
    return masks


def _near(sums: np.ndarray, blocks: np.ndarray, width: int, targets: np.ndarray, owner: np.ndarray, cosine: float) -> np.ndarray:
    """Passages of two blocks of ``width`` words near an item: lines of document, item, first word, end and cosine."""
    vectors, there = _passages(sums, blocks)
    norms = np.linalg.norm(vectors, axis=1)
    usable = np.flatnonzero(there & (norms > 1e-9))
    first = np.cumsum(blocks) - blocks
    step = max(1, _PAIRS // max(1, len(targets)))
    out = [np.zeros((0, 5))]
    for at in range(0, len(usable), step):
        some = usable[at:at + step]
        likeness = (vectors[some] / norms[some, None]) @ targets.T
        p, t = np.nonzero(likeness >= cosine)
        doc = np.searchsorted(first, some[p], side="right") - 1
        start = (some[p] - first[doc]) * width
        out.append(np.column_stack([doc, owner[t], start, start + 2 * width, likeness[p, t]]))
    return np.concatenate(out)


class SharedWords:
    """Upper bounds of the longest common subsequence: words that a region shares with an item, order aside."""

    def __init__(self, items: Items):
        self.size = len(items.terms)
        counts = [np.unique(w, return_counts=True) for w in items.words]
        self.keys = np.concatenate([n * np.int64(self.size) + terms for n, (terms, _) in enumerate(counts)] or [np.zeros(0, np.int64)])
        self.counts = np.concatenate([c for _, c in counts] or [np.zeros(0, np.int64)])
        self.table = None
        if len(items.words) * self.size <= _DENSE:  # the same counts, looked up faster
            self.table = np.zeros(len(items.words) * self.size, np.int32)
            self.table[self.keys] = self.counts

    def _limits(self, keys: np.ndarray) -> np.ndarray:
        if self.table is not None:
            return self.table[keys]
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.counts[at], 0)

    def reach(self, terms: np.ndarray, left: np.ndarray, right: np.ndarray, item: np.ndarray, least: np.ndarray) -> np.ndarray:
        """Which regions ``terms[left:right]`` share at least ``least`` words with their item, each as often as both have it."""
        out = np.zeros(len(left), bool)
        lengths = right - left
        ends = np.cumsum(lengths)
        at = 0
        while at < len(left):
            stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + _REGION_WORDS, side="right")))
            own = lengths[at:stop]
            begin = np.cumsum(own) - own
            region = np.repeat(np.arange(stop - at), own)
            found = terms[np.arange(int(own.sum())) + np.repeat(left[at:stop] - begin, own)]
            limits = self._limits(item[at:stop][region] * np.int64(self.size) + found)
            known = limits > 0
            # All shared words first; then, for what is left, no word more often than the item has it.
            enough = np.bincount(region[known], minlength=stop - at) >= least[at:stop]
            known &= enough[region]
            pairs, first, times = np.unique(region[known] * np.int64(self.size) + found[known], return_index=True, return_counts=True)
            shared = np.bincount(pairs // self.size, np.minimum(times, limits[known][first]), minlength=stop - at)
            out[at:stop] = shared >= least[at:stop]
            at = stop
        return out


def _searcher(items: Items, table: np.ndarray, targets: np.ndarray, owner: np.ndarray,
              cosine: float, copy: float, paraphrase: float, answer: float):
    """Hits of each batch: passages near an item, of these the regions that share enough words, of these the ones in order."""
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        small = table.astype(np.float32)
        sizes = np.array([len(w) for w in items.words], np.int64)
        short = np.flatnonzero(sizes[owner] <= BLOCK_WORDS)
        masks = [_masks(w) for w in items.words]
        answers = [_masks(w) for w in items.answers]
        shared = SharedWords(items)
        least = np.ceil(paraphrase * sizes - 1e-9).astype(np.int64)
        for batch in batches:
            out = []
            ends = np.concatenate([[0], batch.column("places").value_lengths().to_numpy(zero_copy_only=False).cumsum()])
            all_places = batch.column("places").flatten().to_numpy(zero_copy_only=False)
            all_terms = batch.column("terms").flatten().to_numpy(zero_copy_only=False)
            for rows, part, terms, blocks in _slices(batch, 2):
                halves = _sums(small, terms, part, 2 * int(blocks.sum()))
                near = [_near(halves[::2] + halves[1::2], blocks, BLOCK_WORDS, targets, owner, cosine)]
                if len(short):
                    near.append(_near(halves, 2 * blocks, BLOCK_WORDS // 2, targets[short], owner[short], cosine))
                lines = np.concatenate(near)
                if not len(lines):
                    continue
                doc, item, start, end = lines[:, :4].astype(np.int64).T
                # Each region once, in the order of documents and items; starts are multiples of half a block.
                pair, half = doc * len(sizes) + item, BLOCK_WORDS // 2
                keys = (pair * (int(start.max()) // half + 1) + start // half) * 2 + (end - start > BLOCK_WORDS)
                _, pick, back = np.unique(keys, return_index=True, return_inverse=True)
                doc, item, start, end, pair = (x[pick] for x in (doc, item, start, end, pair))
                fresh = np.concatenate([[True], pair[1:] != pair[:-1]])
                pairs, number = pair[fresh], np.cumsum(fresh) - 1
                nearest = np.zeros(len(pairs))
                np.maximum.at(nearest, number[back], lines[:, 4])
                # Places of all documents of the slice on one line, so all regions are found at once.
                counts = np.diff(ends[rows.start:rows.stop + 1])
                line = (np.repeat(np.arange(len(counts)), counts).astype(np.int64) << 32) + all_places[ends[rows.start]:ends[rows.stop]]
                left = np.searchsorted(line, (doc << 32) + np.maximum(0, start - sizes[item]))
                right = np.searchsorted(line, (doc << 32) + end + sizes[item])
                best: dict[int, tuple[float, float]] = {}
                for at in np.flatnonzero(shared.reach(terms, left, right, item, least[item])).tolist():
                    own = int(item[at])
                    region = terms[left[at]:right[at]].tolist()
                    share = _common_order(masks[own], int(sizes[own]), region) / int(sizes[own])
                    if share < paraphrase:
                        continue
                    said = items.answers[own]
                    told = _common_order(answers[own], len(said), region) / len(said) if len(said) else 1.0
                    if share >= copy or told >= answer:
                        best[number[at]] = max(best.get(number[at], (0.0, 0.0)), (share, told))
                for at, shares in best.items():
                    out.append((rows.start + int(pairs[at]) // len(sizes), items.ids[int(pairs[at]) % len(sizes)], float(nearest[at]), *shares))
            kept = batch.select(["row_key", "doc_id"]).take(pa.array([o[0] for o in out], pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [kept.column(0), kept.column(1), pa.array([o[1] for o in out], pa.int64()),
                 *(pa.array([o[k] for o in out], pa.float64()) for k in (2, 3, 4))],
                ["row_key", "doc_id", "item_id", "cosine", "order_share", "answer_share"],
            )

    return search


HIT_SCHEMA = "row_key long, doc_id long, item_id long, cosine double, order_share double, answer_share double"


def benchmark_hits(
    docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
    item_text: str = "text", cosine: float = COSINE, copy: float = COPY, paraphrase: float = PARAPHRASE,
    answer: float = ANSWER, rank: int | None = None, benchmark_bytes: int = BENCHMARK_BYTES,
) -> DataFrame:
    """(row_key, doc_id, item_id, cosine, order_share, answer_share): items found in documents.

    Every passage of every document (48 words, each 24; for items of up to 24 words also 24 words,
    each 12) is a TF-IDF vector in a latent space from a distributed randomised SVD, whose rank grows
    with the items' passages unless ``rank`` is given. Passages with a cosine of ``cosine`` or more to a passage of an
    item are candidates. There the longest common subsequence of words between the item and the
    surroundings decides: ``copy`` of the item's words in order is a hit, ``paraphrase`` is one if
    ``answer`` of the words of the item's answer are in order too. Each place of a document is judged
    by itself; the shares are those of the best place that is a hit.

    The benchmark is the query side; it is searched in blocks of about ``benchmark_bytes`` and
    BENCHMARK_PASSAGES passages, and only such a block, its terms and basis are sent to tasks. Documents never move. ``row_key`` is
    a hash of id and text, the same for rows that repeat. Null and wordless texts, documents and
    items alike, and items without id match nothing. Empty tables give no rows.
    """
    spark = docs.sparkSession
    per_item = F.greatest(F.lit(1), F.ceil(word_count(F.col(item_text)) / BLOCK_WORDS))
    size = benchmark.agg(
        F.coalesce(F.sum(F.octet_length(item_text)), F.lit(0)).alias("bytes"), F.coalesce(F.sum(per_item), F.lit(0)).alias("passages")
    ).first()
    pieces = max(1, -(-size["bytes"] // benchmark_bytes), -(-size["passages"] // BENCHMARK_PASSAGES))
    keyed = docs.select(row_key(docs, doc_id, text).alias("row_key"), F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    documents = docs.count()
    # No rows, from the JVM: a list would be read by Python workers of its own.
    hits = spark.range(0).select(*[F.lit(None).cast(kind).alias(name) for name, kind in map(str.split, HIT_SCHEMA.split(", "))])
    for piece in range(pieces):
        own = benchmark.where(F.pmod(F.xxhash64(item_id, item_text), F.lit(pieces)) == piece)
        items = read_items([(r[0], r[1]) for r in own.select(F.col(item_id).cast("long"), item_text).collect()])
        if not items.ids:
            continue
        found = stored(keyed.mapInArrow(
            _term_finder(items.terms), "row_key long, doc_id long, n_words int, places array<int>, terms array<int>"
        ), "benchmark-terms")
        weights, table = latent_space(found, items, documents, rank)
        rows, owner = _item_rows(items, weights, len(items.terms))
        targets = np.stack([(table[some]).sum(0) for some, _ in rows])
        targets /= np.maximum(np.linalg.norm(targets, axis=1, keepdims=True), 1e-12)
        hits = hits.unionByName(found.mapInArrow(
            _searcher(items, table, targets.astype(np.float32), owner, cosine, copy, paraphrase, answer), HIT_SCHEMA
        ))
    return hits


def without_benchmark(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """Rows of ``docs`` in which no item of ``benchmark`` was found; the columns stay as they are."""
    hits = stored(benchmark_hits(docs, benchmark, doc_id, text, **options).select("row_key").distinct(), "benchmark-hits")
    rows = docs.select(
        F.struct(*[docs[c] for c in docs.columns]).alias("doc"), row_key(docs, doc_id, text).alias("row_key")
    )
    return lookup_join(rows, hits, ["row_key"], "left_anti").select("doc.*")


def row_key(docs: DataFrame, doc_id: str = "doc_id", text: str = "text"):
    return F.xxhash64(docs[doc_id], docs[text])
