"""Token ids of documents in ORC files."""

from __future__ import annotations

import json
import os
import re
import string
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from .common import byte_list, distinct_words

END_ID = 2

#: A stripe is what one task reads at least; a row index entry covers this many documents.
STRIPE_BYTES = 8 << 20
INDEX_ROWS = 1000
BLOOM_FALSE_POSITIVES = 0.01

#: Words of some texts that are looked up before it is seen whether too many are remembered.
_WORDS = 10_000

#: Distinct words whose ids a worker process remembers before it starts anew.
REMEMBERED_WORDS = 400_000

FILE_SCHEMA = "doc_id long, part int, part_start long, n_tokens int, ids array<int>"


#: The normalizer and pre-tokenizer under which a text's ids are its words' ids.
WORD_WISE = {
    "normalizer": {"type": "Sequence", "normalizers": [
        {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"},
    ]},
    "pre_tokenizer": {"type": "Sequence", "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"},
         "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
    ]},
}

#: Letters below this are their own NFC form and have one lower-case form in any Unicode version.
_PLAIN = "\u0250"
#: Such letters, but for the one whose lower-case form has two characters.
_PLAIN_WORD = "^[A-Za-zªµºÀ-ÖØ-öø-įı-ɏ]+$"


def _byte_letters() -> dict[int, int]:
    """The character that stands for each byte in byte-level vocabularies: printable ones
    themselves, the others 256, 257, ... in order."""
    kept = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return {b: b if b in kept else next(others) for b in range(256)}


class TextEncoder:
    """Ids of whole texts as little-endian unsigned 32-bit numbers.

    A tokenizer with the settings of ``WORD_WISE`` drops white space and never joins characters
    across it, so each distinct word is encoded once and texts are put together from their words.
    A plain word, letters with ASCII punctuation after them, is two pre-tokens whose normal form
    is known; it goes straight to the tokenizer's model. A-Z are lower-cased before, unless a text may
    hold added tokens, which are found as they are spelt. Other tokenizers get the whole text.
    """

    def __init__(self, path: str, remembered: int = REMEMBERED_WORDS) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks already use every core
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            settings = json.load(file)
        self._by_word = all(settings[k] == v for k, v in WORD_WISE.items())
        self._split = self._tokenizer.model.tokenize
        self._letters = _byte_letters()
        added = [token["content"].lower() for token in settings.get("added_tokens", [])]
        self._added = "|".join(map(re.escape, added))
        self._closing = "".join(set(string.punctuation).difference(*added))
        size = self._tokenizer.get_vocab_size(with_added_tokens=True)
        self._packed = [n.to_bytes(4, "little") for n in range(size)]
        self._known = _Remembered(self._word)
        self._remembered = remembered

    def _whole(self, text: str) -> bytes:
        found = self._tokenizer.encode_batch_fast([text], add_special_tokens=False)
        return np.array(found[0].ids, "<u4").tobytes()

    def _word(self, word: bytes) -> bytes:
        letters, plain = word.decode().lower(), word.isascii()
        if not letters.isalpha() or not (plain or max(letters) < _PLAIN):
            return self._whole(word.decode())
        # ASCII letters stand for themselves.
        spelt = letters if plain else letters.encode().decode("latin-1").translate(self._letters)
        packed = self._packed
        return b"".join([packed[t.id] for t in self._split(spelt)])

    def _look_up(self, words: list[bytes]) -> list[bytes]:
        ids, known = [], self._known
        for at in range(0, len(words), _WORDS):
            if 2 * len(known) > self._remembered:
                known.age()
            ids.extend(map(known.__getitem__, words[at:at + _WORDS]))
        return ids

    def encode(self, text: bytes) -> bytes:
        return b"".join(self.encode_all(pa.array([text], pa.binary()).cast(pa.string())))

    def encode_all(self, texts: pa.Array) -> list[bytes]:
        """Ids of each text; a null text has none."""
        if not self._by_word:
            return [self._whole(t.as_py().decode()) if t.is_valid else b"" for t in texts.cast(pa.binary())]
        texts = pc.fill_null(texts, "")
        lowered = pc.ascii_lower(texts)
        if self._added:
            lowered = pc.if_else(pc.match_substring_regex(lowered, self._added), texts, lowered)
        words, numbers, first = distinct_words(lowered)
        stems = pc.ascii_rtrim(words, self._closing)
        plain, sizes = pc.match_substring_regex(stems, _PLAIN_WORD), pc.binary_length(stems)
        keys = pc.if_else(plain, pc.utf8_lower(stems), words).dictionary_encode()
        ids = pa.array(self._look_up(byte_list(keys.dictionary)), pa.large_binary()).take(keys.indices)
        closed = np.flatnonzero(pc.and_(plain, pc.less(sizes, pc.binary_length(words))).to_numpy(zero_copy_only=False))
        if len(closed):
            ends = np.full(len(words), b"", object)
            ends[closed] = self._look_up([w[n:] for w, n in zip(byte_list(words.take(pa.array(closed))), sizes.to_numpy()[closed])])
            ids = pc.binary_join_element_wise(ids, pa.array(ends, pa.large_binary()), pa.scalar(b"", pa.large_binary()))
        parts = ids.take(pa.array(numbers))
        # The ids of all texts lie one after the other.
        _, ends, data = parts.buffers()
        ends = np.frombuffer(ends, np.int64, len(parts) + 1)[first] if len(parts) else np.zeros(len(first), np.int64)
        data = memoryview(data or b"")
        return [bytes(data[start:end]) for start, end in zip(ends[:-1], ends[1:])]


class _Remembered(dict):
    """Words with their ids; a word that is missing is looked up once.

    When ``age`` is called the words become the older half: those met again come back, the others go
    with the next call. So frequent words stay and memory has a bound.
    """

    def __init__(self, look_up) -> None:
        self._look_up = look_up
        self._older: dict[bytes, bytes] = {}

    def __missing__(self, word: bytes) -> bytes:
        ids = self._older.get(word)
        if ids is None:
            ids = self._look_up(word)
        self[word] = ids
        return ids

    def age(self) -> None:
        self._older = dict(self)
        self.clear()


@lru_cache(maxsize=1)
def _worker_encoder(path: str, changed: int, remembered: int) -> TextEncoder:
    """The encoder of this worker process; the tasks it runs one after the other share what it remembers."""
    return TextEncoder(path, remembered)


def _encoder(path: str, end_id: int, remembered: int):
    end = np.array([end_id], "<u4").tobytes()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, start = _worker_encoder(path, os.stat(path).st_mtime_ns, remembered), 0
        part = TaskContext.get().partitionId()
        for batch in batches:
            ids = [own + end for own in encoder.encode_all(batch.column("text"))]
            lengths = np.array([len(i) // 4 for i in ids], np.int64)
            ends = np.cumsum(lengths)
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"),
                pa.array(np.full(len(ids), part, np.int32)),
                pa.array(start + ends - lengths),
                pa.array(lengths.astype(np.int32)),
                pa.ListArray.from_arrays(
                    pa.array(np.concatenate([[0], ends]).astype(np.int32)),
                    pa.array(np.frombuffer(b"".join(ids), "<i4")),
                ),
            ], ["doc_id", "part", "part_start", "n_tokens", "ids"])
            start += int(ends[-1]) if len(ends) else 0

    return encode


def write_tokens(
    docs: DataFrame, path: str, tokenizer: str, doc_id: str = "doc_id", text: str = "text",
    end_id: int = END_ID, remembered: int = REMEMBERED_WORDS,
) -> None:
    """Encode every whole text and write ORC files in ascending order of ids.

    Rows are dealt into ranges of ids and sorted before they are encoded, so files and stripes
    cover disjoint, ascending ranges. Ids are stored with ORC's integer run-length encoding; every
    stripe has a row index and a Bloom filter on ``doc_id``, so a reader skips files, stripes and
    index groups by metadata. ``part`` numbers the files and ``part_start`` counts the tokens
    before a document in its file. A null text is empty: its document is the end id alone. Null
    ids come first; rows that repeat an id lie next to each other, ordered by a hash of the text.
    """
    order = ["doc_id", "text_hash"]
    (
        docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
        .withColumn("text_hash", F.xxhash64("text"))
        .repartitionByRange(*order).sortWithinPartitions(*order)
        .select("doc_id", "text").mapInArrow(_encoder(tokenizer, end_id, remembered), FILE_SCHEMA)
        .write.option("compression", "zstd")
        .option("orc.stripe.size", STRIPE_BYTES).option("orc.row.index.stride", INDEX_ROWS)
        .option("orc.create.index", "true")
        .option("orc.bloom.filter.columns", "doc_id").option("orc.bloom.filter.fpp", BLOOM_FALSE_POSITIVES)
        .orc(path)
    )


def read_tokens(spark: SparkSession, path: str, first: int | None = None, last: int | None = None,
                only: list[int] | None = None) -> DataFrame:
    """Documents of a token file set; bounds and ids are pushed down to files, stripes and row groups."""
    rows = spark.read.schema(FILE_SCHEMA).orc(path)
    if first is not None:
        rows = rows.where(F.col("doc_id") >= first)
    if last is not None:
        rows = rows.where(F.col("doc_id") <= last)
    if only is not None:
        rows = rows.where(F.col("doc_id").isin(only))
    return rows


def part_offsets(spark: SparkSession, path: str) -> DataFrame:
    """(part, before): tokens in all earlier files. One row per file; reads two narrow columns."""
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return (
        spark.read.schema(FILE_SCHEMA).orc(path).groupBy("part").agg(F.sum("n_tokens").alias("tokens"))
        .select("part", F.coalesce(F.sum("tokens").over(earlier), F.lit(0)).alias("before"))
    )


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = batch.column("ids")
        lengths = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        values = lists.flatten().to_numpy(zero_copy_only=False).astype("<u4")
        ends = np.cumsum(lengths)
        sums = [zlib.crc32(values[e - n:e].tobytes()) for e, n in zip(ends, lengths)]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("part"), batch.column("part_start"), pa.array(lengths), pa.array(sums, pa.int64())],
            ["doc_id", "part", "part_start", "n_tokens", "ids_crc32"],
        )


def token_digests(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the ids in the files."""
    rows = read_tokens(spark, path).mapInArrow(
        _digests, "doc_id long, part int, part_start long, n_tokens long, ids_crc32 long"
    )
    # One row per file of many megabytes.
    return rows.join(F.broadcast(part_offsets(spark, path)), "part").select(
        "doc_id", (F.col("before") + F.col("part_start")).alias("start"), "n_tokens", "ids_crc32"
    )
