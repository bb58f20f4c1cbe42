"""Mixing sources to target weights with Pareto order sampling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..operators.joins import lookup_join
from ..session import settled
from .common import stored, word_count

WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
MOST = 2.0
SEED = 17

#: A document's place in the order is a whole number of this many bits, cut into digits.
_PLACE_BITS = 52
_DIGIT_BITS = 12


def source_targets(
    sizes: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: float = MOST
) -> DataFrame:
    """(source, source_size, target) from rows of (source, size).

    Sources in code-point order, null last, take ``weights`` in turn and share ``share``
    times all sizes; a target stops at ``most`` times its source's size, and the excess goes
    to the others by weight until none is above. That rest state is a common level: target =
    least(most * size, weight * level), and the level follows from running sums over the
    sources ordered by where they stop. The windows see one row per source, never documents.
    """
    if not 0 <= share <= most:
        raise ValueError("share must lie between 0 and most")
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    by_stop = Window.orderBy("stop", F.col("source").asc_nulls_last())
    earlier = by_stop.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_stop.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everywhere = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    turn = (F.row_number().over(by_name) - 1) % len(weights)
    return (
        sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
        .withColumn("weight", F.get(F.array(*[F.lit(float(w)) for w in weights]), turn))
        .withColumn("cap", F.lit(float(most)) * F.col("source_size"))
        .withColumn("stop", F.col("cap") / F.col("weight"))
        .withColumn("all", F.lit(float(share)) * F.sum("source_size").over(everywhere))
        .withColumn("level", (F.col("all") - F.coalesce(F.sum("cap").over(earlier), F.lit(0.0)))
                    / F.sum("weight").over(onward))
        .withColumn("number", F.row_number().over(by_stop))
        .withColumn("level", F.min(F.when(F.col("level") <= F.col("stop"), F.struct("number", "level"))).over(everywhere))
        .select("source", "source_size",
                F.least(F.col("cap"), F.col("weight") * F.col("level.level")).alias("target"))
    )


def _digest(text: Column) -> Column:
    return F.md5(F.coalesce(text, F.lit("")).cast("binary"))


def _draw(seed: int) -> Column:
    """A number between 0 and 1, both excluded, from the id, the text and its number among equal rows."""
    key = F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col("mix_id").cast("string"), F.lit("")), F.col("mix_digest"), F.col("mix_number").cast("string"))
    digits = F.substring(F.md5(key.cast("binary")), 1, 13)
    return (F.conv(digits, 16, 10).cast("long") + F.lit(0.5)) / F.lit(float(1 << 52))


def numbered(rows: DataFrame) -> DataFrame:
    """``rows`` with ``mix_number``: 0, 1, 2, ... among rows of equal ``mix_id`` and ``mix_digest``.

    Rows that occur once stay where they are. The others are stored, numbered inside the part of the
    store that they lie in, and the parts of a group are added up, so no task orders a group.
    """
    keys = ["mix_id", "mix_digest"]
    repeated = settled(rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(*keys, F.lit(True).alias("mix_often")))
    if repeated.isEmpty():
        return rows.withColumn("mix_number", F.lit(0).cast("long"))
    marked = lookup_join(rows, repeated, keys, "left", null_safe=True)
    place = F.monotonically_increasing_id()
    often = stored(marked.where("mix_often").drop("mix_often").withColumn("mix_place", place), "mix-repeats").withColumn(
        "mix_part", F.shiftright("mix_place", 33))
    inside = Window.partitionBy(*keys, "mix_part").orderBy("mix_place")
    earlier = Window.partitionBy(*keys).orderBy("mix_part").rowsBetween(Window.unboundedPreceding, -1)
    before = often.groupBy(*keys, "mix_part").agg(F.count(F.lit(1)).alias("n")).select(
        *keys, "mix_part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("mix_before"))
    told = lookup_join(often.withColumn("mix_own", F.row_number().over(inside)), before, [*keys, "mix_part"], "inner", null_safe=True)
    again = told.withColumn("mix_number", F.col("mix_own").cast("long") - 1 + F.col("mix_before")).select(*rows.columns, "mix_number")
    return marked.where("mix_often is null").drop("mix_often").withColumn("mix_number", F.lit(0).cast("long")).unionByName(again)


def _cut_within(rows: DataFrame, digit: Column) -> DataFrame:
    """One row per source: last digit that is taken whole, the digit in which the need ends, words before it.

    ``rows``: source, need, before, size, place. At most 4096 sums per source reach the window.
    """
    earlier = Window.partitionBy("source").orderBy("digit").rowsBetween(Window.unboundedPreceding, -1)
    sums = (
        rows.groupBy("source", "need", "before", digit.alias("digit")).agg(F.sum("size").alias("words"))
        .withColumn("start", F.col("before") + F.coalesce(F.sum("words").over(earlier), F.lit(0)))
        .withColumn("end", F.col("start") + F.col("words"))
    )
    split = (F.col("start") < F.col("need")) & (F.col("end") > F.col("need"))
    return sums.groupBy("source").agg(
        F.max(F.when(F.col("end") <= F.col("need"), F.col("digit"))).alias("whole_digit"),
        F.max(F.when(split, F.col("digit"))).alias("split_digit"),
        F.max(F.when(split, F.col("start"))).alias("split_start"),
    )


def _top(prefix: Column, bits: int) -> Column:
    """Largest place whose leading digits are at most ``prefix``."""
    return F.shiftleft(prefix.cast("long") + 1, bits) - 1


def order_cuts(drawn: DataFrame) -> DataFrame:
    """(source, cut): documents with a place up to ``cut`` are in the sample of their source.

    ``drawn``: source, need, size, place. The sample's size is fixed in words: places are taken
    in order while at least half of the next one still fits, so the words miss the need by at
    most half a document. The end is found digit by digit: sums per leading digit, then only the
    rows of the digit that holds the end, then its places; no task orders a whole source.
    Rows with the same place are taken together; no two rows of a source draw one but by chance.
    """
    first_bits, second_bits = _PLACE_BITS - _DIGIT_BITS, _PLACE_BITS - 2 * _DIGIT_BITS
    mask = F.lit((1 << _DIGIT_BITS) - 1)
    rows = drawn.where("need > 0").select("source", "need", "size", "place", F.lit(0).cast("long").alias("before"))
    top = F.shiftright("place", first_bits).cast("int")
    next_digit = F.shiftright("place", second_bits).bitwiseAND(mask).cast("int")
    first = stored(_cut_within(rows, top), "mix-first")
    inside = stored(
        lookup_join(rows.drop("before"), first.where("split_digit is not null"), ["source"], "inner", null_safe=True)
        .where(top == F.col("split_digit")).withColumn("before", F.col("split_start")), "mix-inside"
    )
    second = stored(_cut_within(inside, next_digit), "mix-second")
    last = lookup_join(
        inside.select("source", "need", "size", "place"), second.where("split_digit is not null"), ["source"],
        "inner", null_safe=True,
    ).where(next_digit == F.col("split_digit"))
    earlier = Window.partitionBy("source").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    places = (
        last.groupBy("source", "need", "split_start", "place").agg(F.sum("size").alias("words"))
        .withColumn("start", F.col("split_start") + F.coalesce(F.sum("words").over(earlier), F.lit(0)))
        .where(F.col("start") + F.col("words") / 2 <= F.col("need"))
        .groupBy("source").agg(F.max("place").alias("cut"))
    )
    leading = first.select(F.col("source"), F.col("split_digit").alias("lead"))
    middle = (
        second.alias("s").join(leading.alias("l"), F.col("s.source").eqNullSafe(F.col("l.source")))
        .select("s.source", _top(F.shiftleft(F.col("lead").cast("long"), _DIGIT_BITS) + F.col("whole_digit"), second_bits).alias("cut"))
    )
    return (
        first.select("source", _top(F.col("whole_digit"), first_bits).alias("cut"))
        .unionByName(middle).unionByName(places)
        .groupBy("source").agg(F.max("cut").alias("cut"))
    )


def _place(liked: Column, seed: int) -> Column:
    """Place in the order: random odds divided by inclusion odds, from 0 to 1, as a whole number."""
    draw = _draw(seed)
    odds = F.col("chance") / (F.lit(1.0) - F.col("chance")) * liked
    rank = F.when(F.col("chance") > 0, draw / (F.lit(1.0) - draw) / odds).otherwise(F.lit(0.0))
    return F.floor(rank / (F.lit(1.0) + rank) * F.lit(float(1 << _PLACE_BITS))).cast("long")


def _liked(preference: str | None) -> Column:
    if preference is None:
        return F.lit(1.0)
    value = F.col(preference).cast("double")
    return F.when(value > 0, value).otherwise(F.lit(1.0))


def mixing_plan(
    sizes: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: float = MOST, seed: int = SEED
) -> DataFrame:
    """One row per source: what is certain, the chance of one more copy, and where the sample ends.

    ``sizes``: stored rows of (source, size, liked) and what the draw is made from. Columns: source, source_size, target,
    certain, chance, need, cut.
    """
    targets = stored(
        source_targets(sizes, weights, share, most)
        .withColumn("rate", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0)))
        .withColumn("certain", F.floor("rate"))
        .withColumn("chance", F.col("rate") - F.col("certain"))
        .withColumn("need", F.when(F.col("chance") > 0, F.col("target") - F.col("certain") * F.col("source_size"))
                    .otherwise(F.lit(0.0))).drop("rate"), "mix-targets"
    )
    drawn = lookup_join(sizes, targets, ["source"], "left", null_safe=True).withColumn(
        "place", _place(F.col("liked"), seed)
    )
    cuts = stored(order_cuts(stored(drawn.select("source", "need", "size", "place"), "mix-drawn")), "mix-cuts")
    # Both sides have one row per source.
    return targets.alias("t").join(cuts.alias("c"), F.col("t.source").eqNullSafe(F.col("c.source")), "left").select("t.*", "c.cut")


def _copies(place: Column) -> Column:
    extra = F.when(F.col("need") > 0, (place <= F.col("cut")).cast("int"))
    return (F.col("certain") + F.coalesce(extra, F.lit(0))).cast("int")


def _sizes(docs: DataFrame, doc_id: str, text: str, source: str, preference: str | None) -> DataFrame:
    return stored(numbered(docs.select(
        F.col(doc_id).alias("mix_id"), _digest(F.col(text)).alias("mix_digest"), F.col(source).alias("source"),
        word_count(F.col(text)).alias("size"), _liked(preference).alias("liked"),
    )), "mix-sizes")


def mixed(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
    weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: float = MOST, seed: int = SEED,
    preference: str | None = None,
) -> DataFrame:
    """(doc_id, source, size, source_size, target, copies, taken) for every row of ``docs``.

    A source is to give target / source_size copies of each document. The whole part of that
    is certain; the rest is the inclusion probability of one more copy. Documents are ranked by
    their random odds divided by their inclusion odds, and the lowest ranks that fill the
    source's remaining words get the extra copy. ``preference`` names a column that multiplies
    a document's inclusion odds (null, zero and negative values count as 1).

    A null text has size 0 and takes 0 words. A null source is a source of its own, ranked last.
    Draws depend on the seed, the id, the text and, for rows that repeat both, a number among them, so reruns
    agree and each row is included by itself. An empty table gives no rows. Sizes are in words.
    """
    sizes = _sizes(docs, doc_id, text, source, preference)
    plan = stored(mixing_plan(sizes, weights, share, most, seed), "mix-plan")
    return lookup_join(sizes, plan, ["source"], "left", null_safe=True).withColumn(
        "copies", _copies(_place(F.col("liked"), seed))
    ).select(F.col("mix_id").alias("doc_id"), "source", "size", "source_size", "target", "copies",
             (F.col("copies") * F.col("size")).cast("long").alias("taken"))


def mixture(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
    weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: float = MOST, seed: int = SEED,
    preference: str | None = None,
) -> DataFrame:
    """Rows of ``docs``, each as often as ``mixed`` says; the columns stay as they are.

    What a row gets depends on the row and on the plan of its source, so whole documents are
    not joined with documents: only the plan, one row per source, is. Sources without words get
    no target, so their documents are left out.
    """
    sizes = _sizes(docs, doc_id, text, source, preference)
    plan = stored(mixing_plan(sizes, weights, share, most, seed), "mix-plan")
    whole = numbered(docs.select(
        F.struct(*[docs[c] for c in docs.columns]).alias("mix_row"), F.col(doc_id).alias("mix_id"), _digest(F.col(text)).alias("mix_digest"),
        F.col(source).alias("source"), _liked(preference).alias("liked"),
    ))
    copies = _copies(_place(F.col("liked"), seed))
    return (
        lookup_join(whole, plan, ["source"], "inner", null_safe=True)
        .withColumn("mix_copies", copies).where("mix_copies > 0")
        .select("mix_row", F.explode(F.sequence(F.lit(1), F.col("mix_copies"))).alias("mix_copy")).select("mix_row.*")
    )
