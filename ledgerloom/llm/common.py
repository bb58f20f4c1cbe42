"""What several operators of this package share."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator, Mapping

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import scratch_path

#: ASCII white space; everything else belongs to words.
WORD = "[^\\x20\\x09-\\x0D]+"

_BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": "250", "spark.sql.execution.arrow.maxBytesPerBatch": "4m"}

_GAP = re.compile(rb"[\x20\x09-\x0D]")
_BLOCK = 1 << 20


def bound_batches(spark: SparkSession) -> None:
    """Batches of rows sent to Python hold at most so many rows and about so many bytes.

    Texts may be long, and the default takes ten thousand of them at a time.
    """
    for key, most in _BATCHES.items():
        spark.conf.set(key, most)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bound_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: For rows of megabytes: row groups end after a few of them, so that readers and writers hold few at a time.
LONG_ROWS = {"parquet.block.size": str(4 << 20), "parquet.page.size.row.check.min": "1", "parquet.page.size.row.check.max": "4"}


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(frame: DataFrame, label: str, options: Mapping[str, str] | None = None, once: bool = False) -> DataFrame:
    """``frame`` written to the shared scratch folder and read back; ``options`` are those of the writer.

    once: ``frame`` is not computed again, so its shuffle files go as soon as it is written.

    Cuts the lineage: what is read afterwards does not depend on executors that
    computed it. Compressed columns take less room there than a checkpoint.
    """
    bound_batches(frame.sparkSession)
    path = scratch_path(frame.sparkSession, label)
    conf = frame.sparkSession.conf
    before = conf.get(_CLEANUP, "false")
    conf.set(_CLEANUP, "true" if once else before)
    try:
        frame.write.options(**(options or {})).option("compression", "zstd").parquet(path)
    finally:
        conf.set(_CLEANUP, before)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def words_in_blocks(text: bytes, block: int = _BLOCK) -> Iterator[list[bytes]]:
    """Words of a text in lists that cover at most about ``block`` bytes.

    A text of any length is passed through whole; only one list exists at a time.
    """
    start, end = 0, len(text)
    while start < end:
        gap = _GAP.search(text, start + block) if start + block < end else None
        stop = gap.start() if gap else end
        words = text[start:stop].split()  # bytes.split knows the six ASCII white spaces only
        if words:
            yield words
        start = stop


def lowered_words(text: bytes, block: int = _BLOCK) -> Iterator[list[bytes]]:
    """The same with A-Z lower-cased; bytes.lower knows ASCII letters only."""
    return words_in_blocks(text.lower(), block)


def distinct_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct words of some texts, the number among them of each word of all texts, and where each
    text begins there, then the end. A null text has no words.
    """
    lists = pc.ascii_split_whitespace(pc.fill_null(texts, ""))  # the six ASCII white spaces only
    encoded = lists.flatten().dictionary_encode()
    numbers, first = encoded.indices.to_numpy().astype(np.int64), lists.offsets.to_numpy().astype(np.int64)
    first -= first[0]
    kept = numbers != pc.index(encoded.dictionary, "").as_py()
    if not kept.all():  # nothing stands before and after white space
        numbers, first = numbers[kept], np.concatenate([[0], np.cumsum(kept)])[first]
    return encoded.dictionary, numbers, first


def byte_list(words: pa.Array) -> list[bytes]:
    return words.cast(pa.binary()).to_numpy(zero_copy_only=False).tolist()


def free_name(taken: Iterable[str], name: str) -> str:
    """``name``, with underscores after it while a column is called that, upper or lower case."""
    used = {t.lower() for t in taken}
    while name.lower() in used:
        name += "_"
    return name


def add_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of the ``line`` arrays of each ``term``; for rows that are partitioned by term."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        width = len(batch.column(1)[0]) if len(batch) else 0
        lines = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, max(1, width))
        for term, line in zip(batch.column(0).to_pylist(), lines):
            sums[term] = sums[term] + line if term in sums else line.copy()
    if sums:
        yield pa.RecordBatch.from_arrays([pa.array(list(sums)), pa.array(list(sums.values()), pa.list_(pa.float64()))], ["term", "line"])


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once: a lambda's variable is not an expression that runs again."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def running_sums(lengths: Column, lot: int = 256) -> Column:
    """What comes before each element of an array of whole numbers: 0, the first, the first two, ...

    A fold copies its list at each step, so it runs inside lots and then over the sums of lots.
    """
    none = F.array().cast("array<bigint>")

    def before(numbers: Column) -> Column:
        state = F.struct(F.lit(0).cast("long").alias("sum"), none.alias("all"))
        return F.aggregate(numbers, state, lambda s, n: F.struct(
            (s["sum"] + n).alias("sum"), F.concat(s["all"], F.array(s["sum"])).alias("all")), lambda s: s["all"])

    def whole(numbers: Column) -> Column:
        starts = F.when(F.size(numbers) > 0, F.sequence(F.lit(0), F.size(numbers) - 1, F.lit(lot))).otherwise(F.array().cast("array<int>"))
        return bound(F.transform(starts, lambda at: F.slice(numbers, at + 1, F.lit(lot))), lambda lots: F.flatten(F.zip_with(
            lots, before(F.transform(lots, lambda l: F.aggregate(l, F.lit(0).cast("long"), lambda a, b: a + b))),
            lambda l, start: F.transform(before(l), lambda x: x + start))))

    return bound(lengths, whole)


def word_count(text):
    """Number of words of a text column; null counts as the empty text."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def fold(doc_id, parts: int):
    """Remainder of crc32 of the id written as text; a null id is the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % F.lit(parts)
