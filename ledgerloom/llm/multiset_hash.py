"""Fingerprints of texts as sums of wide vectors hashed from their paragraphs. Built-in expressions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, Window

from ..operators.joins import lookup_join
from .common import free_name, stored

#: Lanes that tell multisets of paragraphs apart: sums of 32 hashed bits each.
EXACT = 16

#: Lanes that measure likeness: sums of signed weights hashed from the sentences of the paragraphs.
LIKE = 64

#: Every lane is a sum modulo this power.
MODULUS = 1 << 32

#: Where paragraphs end, and where the pieces for the likeness lanes end.
PARAGRAPH, SENTENCE = "\n", "[.!?] |\n"

#: Rows with the same id and text above this number travel as one row with a count.
REPEATS = 4096

#: Bytes of texts in one range of ids; small tables are cut into more and smaller ranges.
RANGE_BYTES, SMALL_RANGE_BYTES, SMALL_RANGES = 256 << 20, 8 << 20, 128

_HEX = 8


def _word(digest: Column, number: int) -> Column:
    """The ``number``-th group of 32 bits of a digest in hexadecimal digits."""
    return F.conv(F.substring(digest, number * _HEX + 1, _HEX), 16, 10).cast("long")


def _zeros(width: int) -> Column:
    return F.array_repeat(F.lit(0).cast("long"), width)


def _exact_lanes(text: Column) -> Column:
    """Sums of the vectors of all paragraphs; two digests of a paragraph give its sixteen lanes."""
    half = EXACT // 2
    digests = F.transform(F.split(text, PARAGRAPH, -1), lambda p: F.struct(
        F.sha2(F.concat(F.lit("0:"), p), 256).alias("a"), F.sha2(F.concat(F.lit("1:"), p), 256).alias("b")
    ))
    lanes = F.transform(digests, lambda d: F.array(*[_word(d[side], i) for side in "ab" for i in range(half)]))
    return F.aggregate(lanes, _zeros(EXACT), lambda total, v: F.zip_with(total, v, lambda a, b: a + b))


def _like_lanes(text: Column) -> Column:
    """Sums over all sentences of plus or minus the root of the sentence's length, sign by hashed bit."""
    weighed = F.transform(F.split(text, SENTENCE, -1), lambda s: F.struct(
        F.round(F.sqrt(F.length(s))).cast("long").alias("weight"), F.sha2(s, 256).alias("digest")
    ))
    words = F.transform(F.filter(weighed, lambda s: s["weight"] > 0), lambda s: F.struct(
        s["weight"].alias("weight"), F.array(*[_word(s["digest"], i) for i in range(LIKE // 32)]).alias("bits")
    ))
    lanes = F.sequence(F.lit(0), F.lit(LIKE - 1))

    def add(total: Column, s: Column) -> Column:
        return F.zip_with(total, lanes, lambda sum_, lane: sum_ + F.when(
            F.getbit(F.get(s["bits"], F.shiftright(lane, 5)), lane.bitwiseAND(31)) == 1, s["weight"]
        ).otherwise(-s["weight"]))

    return F.aggregate(words, _zeros(LIKE), add)


def lanes_of(text: Column) -> Column:
    """All lanes of a text, exact ones first, as array<bigint> from 0 to 2^32 - 1; null counts as empty.

    A sum of at most 2^31 lanes below 2^32 fits a long, so the power is taken once, at the end.
    """
    whole = F.coalesce(text, F.lit(""))
    return F.transform(F.concat(_exact_lanes(whole), _like_lanes(whole)), lambda n: F.pmod(n, F.lit(MODULUS)))


def fingerprint_text(lanes: Column) -> Column:
    """Eight lowercase hexadecimal digits for each lane."""
    return F.array_join(F.transform(lanes, lambda n: F.lower(F.lpad(F.hex(n), _HEX, "0"))), "")


def lanes_from(fingerprint: Column) -> Column:
    """The lanes of a fingerprint string."""
    return F.transform(F.sequence(F.lit(0), F.lit(EXACT + LIKE - 1)), lambda i: F.conv(
        F.substring(fingerprint, i * _HEX + 1, F.lit(_HEX)), 16, 10).cast("long"))


def combined(a: Column, b: Column) -> Column:
    """Lanes of the two multisets together: paragraphs ``b`` inserted into ``a``."""
    return F.zip_with(a, b, lambda x, y: F.pmod(x + y, F.lit(MODULUS)))


def without(a: Column, b: Column) -> Column:
    """Lanes of ``a`` after the paragraphs ``b`` were deleted."""
    return F.zip_with(a, b, lambda x, y: F.pmod(x - y, F.lit(MODULUS)))


def _product(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def likeness(a: Column, b: Column) -> Column:
    """How much of two texts is shared, from their lanes alone: 0 to 1.

    Signs of different sentences are independent, so the product of two likeness vectors estimates
    the length that both texts have, and their squares estimate the lengths of the texts; the result
    is twice the first over the sum of the others. Equal multisets of paragraphs give 1. The standard
    error of the estimate is about 1 / sqrt(64).
    """
    def signed(lanes: Column) -> Column:
        return F.transform(F.slice(lanes, EXACT + 1, LIKE), lambda n: (
            n - F.when(n >= MODULUS // 2, F.lit(MODULUS)).otherwise(F.lit(0))).cast("double"))

    x, y = signed(a), signed(b)
    both = _product(x, x) + _product(y, y)
    share = F.when(both > 0, F.lit(2.0) * _product(x, y) / both).otherwise(0.0)
    same = F.slice(a, 1, EXACT) == F.slice(b, 1, EXACT)
    return F.when(same, 1.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), share)))


def with_fingerprint(docs: DataFrame, text: str = "text", name: str = "fingerprint") -> DataFrame:
    """``docs`` with the fingerprint of each text; a column called ``name`` stays and the new one gets a longer name.

    Two texts have equal fingerprints when their paragraphs (what lies between line breaks) are the
    same ones equally often, in any order, and otherwise differ but for a clash of 512 hashed bits.
    A null text counts as the empty one, which is a single empty paragraph. ``combined`` and
    ``without`` on the lanes insert and delete paragraphs. Whole texts are read, row by row.
    """
    return docs.withColumn(free_name(docs.columns, name), fingerprint_text(lanes_of(F.col(text))))


def _ranges(keys: DataFrame, count: int) -> list[str]:
    """First key of each of ``count`` ranges with near-equal numbers of keys, ascending, as JSON.

    Spark's own range exchange draws the borders; one key a range reaches the driver.
    """
    first = (
        keys.select("key").repartitionByRange(count, "key").groupBy(F.spark_partition_id().alias("range"))
        .agg(F.min("key").alias("key")).orderBy("key").select(F.to_json("key", {"ignoreNullFields": "false"}).alias("key"))
    )
    return [r["key"] for r in first.collect()]


def with_next(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, text, lanes, next_text, next_lanes): each text and the one after it by ascending id; the first follows the last.

    Ids that are null come last; rows of one id are ordered by a hash of their text. The ids are
    sorted alone, to find the first key of each range. Then the texts cross the network once, to
    their range, and the first row of a range goes to the range before as well, so no task sees more than its
    range. Rows that repeat an id and a text often travel as one row with a count: all but one
    are followed by themselves. A null text counts as empty; an empty table gives no rows.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    key = F.struct(F.col(doc_id).isNull().alias("missing"), F.col(doc_id).alias("id"), F.xxhash64(body).alias("hash"))
    rows = docs.select(key.alias("key"), body.alias("text"))
    keys = stored(rows.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("text").cast("long")).alias("bytes")),
                  "document-keys")
    size = keys.agg(F.sum("bytes")).first()[0] or 0
    firsts = _ranges(keys, 1 + max(size // RANGE_BYTES, min(size // SMALL_RANGE_BYTES, SMALL_RANGES)))

    counted = rows.withColumn("n", F.lit(1).cast("long"))
    repeated = keys.where(F.col("n") > REPEATS).select("key", F.lit(True).alias("often"))
    if not repeated.isEmpty():
        marked = lookup_join(rows, repeated, ["key"], "left")
        often = marked.where("often").groupBy("key", "text").agg(F.count(F.lit(1)).alias("n"))
        counted = marked.where("often is null").select("key", "text", F.lit(1).cast("long").alias("n")).unionByName(often)

    cuts = F.from_json(F.lit("[" + ",".join(firsts) + "]"), f"array<{rows.schema['key'].dataType.simpleString()}>")
    steps = [1 << k for k in reversed(range(len(firsts).bit_length()))]
    # Binary search: the last range whose first key is not above the row's.
    at = F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0), lambda found, step: F.when(
        F.coalesce(F.get(cuts, found + step) <= F.col("key"), F.lit(False)), found + step).otherwise(found))
    ranged = counted.withColumn("range", at)
    own = F.struct(F.col("range"), F.lit(False).alias("after"))
    before = F.struct(F.pmod(F.col("range") - 1, F.lit(max(1, len(firsts)))).alias("range"), F.lit(True).alias("after"))
    placed = ranged.withColumn("to", F.explode(
        F.when(F.col("key") == F.get(cuts, F.col("range")), F.array(own, before)).otherwise(F.array(own))
    )).select("key", "text", "n", "to.range", "to.after").repartition("range").withColumn("lanes", lanes_of(F.col("text")))

    order = Window.partitionBy("range").orderBy("after", "key", "text")
    following = placed.withColumns({"next_text": F.lead("text").over(order), "next_lanes": F.lead("lanes").over(order)}).where(~F.col("after"))
    last = F.struct(F.lit(1).cast("long").alias("n"), F.col("next_text").alias("text"), F.col("next_lanes").alias("lanes"))
    same = F.struct((F.col("n") - 1).alias("n"), F.col("text").alias("text"), F.col("lanes").alias("lanes"))
    spread = following.withColumn("next", F.explode(F.when(F.col("n") > 1, F.array(last, same)).otherwise(F.array(last))))
    again = spread.withColumn("again", F.explode(F.sequence(F.lit(1).cast("long"), F.col("next.n"))))
    return again.select(F.col("key.id").alias("doc_id"), "text", "lanes", F.col("next.text").alias("next_text"), F.col("next.lanes").alias("next_lanes"))


def edited_fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_chars, edited, fingerprint, edited_fingerprint, near_edited, near_next) for each row of ``docs``.

    The edited text is the text whose last floor(n_chars / 2) code points are replaced by the first
    as many (or all) of the next document, which is chosen as in ``with_next``.
    """
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - half), F.substring("next_text", F.lit(1), half))
    pairs = with_next(docs, doc_id, text).withColumns({"n_chars": n.cast("long"), "edited": edited}).drop("text", "next_text")
    known = pairs.withColumn("edited_lanes", lanes_of(F.col("edited")))
    return known.select(
        "doc_id", "n_chars", "edited", fingerprint_text(F.col("lanes")).alias("fingerprint"),
        fingerprint_text(F.col("edited_lanes")).alias("edited_fingerprint"),
        likeness(F.col("lanes"), F.col("edited_lanes")).alias("near_edited"),
        likeness(F.col("lanes"), F.col("next_lanes")).alias("near_next"),
    )
