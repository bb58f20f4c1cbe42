"""Preference records from pairs of conversations. Built-in expressions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .common import bound, running_sums

#: A turn reads OPEN role CLOSE, a line break, its text, END and a line break. Marks inside texts are taken apart.
OPEN, CLOSE, END = "<|", "|>", "<|end|>"
TRAINED_ROLE = "assistant"

_FIRST = -(1 << 63)


def _header(role: Column) -> Column:
    return F.concat(F.lit(OPEN), role, F.lit(CLOSE + "\n"))


def _plain_role(role: Column) -> Column:
    """A role that can neither close its mark nor open one of its own."""
    whole = F.coalesce(role, F.lit(""))
    for mark, apart in ((OPEN, "< |"), (CLOSE, "| >"), ("\n", " ")):
        whole = F.replace(whole, F.lit(mark), F.lit(apart))
    return whole


def _rendered(turn: Column) -> Column:
    text = F.replace(turn["text"], F.lit(OPEN), F.lit("< |"))
    return F.concat(_header(turn["role"]), text, F.lit(END + "\n"))


def _mask(turns: Column, trained_role: str) -> Column:
    """(start, end) of what is trained on in the rendered turns: a trained role's text and end mark."""
    own = F.length(_header(F.lit(trained_role)))

    def spans(sizes: Column) -> Column:
        placed = F.zip_with(sizes, running_sums(F.transform(sizes, lambda s: s["size"])), lambda s, at: F.struct(
            s["trained"].alias("trained"), (at + own).cast("int").alias("start"), (at + s["size"] - 1).cast("int").alias("end")))
        return F.transform(F.filter(placed, lambda s: s["trained"]), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end")))

    return bound(F.transform(turns, lambda turn: F.struct(
        (turn["role"] == trained_role).alias("trained"), F.length(_rendered(turn)).cast("long").alias("size"))), spans)


def preference_records(
    turns: DataFrame, pair_id: str = "pair_id", chosen: str = "chosen", turn: str = "turn", role: str = "role",
    text: str = "text", trained_role: str = TRAINED_ROLE,
) -> DataFrame:
    """(pair_id, n_common, prompt, chosen, rejected, chosen_mask, rejected_mask), one row per pair.

    ``turns`` has one row per turn; ``chosen`` tells the preferred conversation of a pair from the
    other. Their longest common prefix of turns is rendered once, as the prompt; what follows in
    each is a completion. A mask lists (start, end) in code points of the completion: texts and
    end marks of ``trained_role``. Prompts are never trained on.

    Turns are ordered by their number, then role and text; a null number comes first, a null role or
    text is empty, and rows that repeat in a conversation count once. The prefix ends before the
    first turn number at which the two differ. Equal conversations have empty completions; a pair
    with one conversation has an empty prompt and one empty completion; a null ``chosen`` counts
    as rejected. Rows without a pair id belong to no pair. Marks and line breaks inside roles are taken apart, so
    neither a role nor a text can pass for a turn of its own. A pair is one record, so it is put together in
    one task; turns are reduced to distinct ones before.
    """
    preferred = F.coalesce(F.col(chosen).cast("boolean"), F.lit(False))
    distinct = turns.where(F.col(pair_id).isNotNull()).select(
        F.col(pair_id).alias("pair_id"), F.coalesce(F.col(turn).cast("long"), F.lit(_FIRST)).alias("turn"),
        _plain_role(F.col(role)).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text"),
        preferred.alias("preferred"),
    ).groupBy("pair_id", "turn", "role", "text").agg(
        F.bool_or("preferred").alias("good"), F.bool_or(~F.col("preferred")).alias("bad")
    )
    lists = distinct.groupBy("pair_id").agg(
        F.array_sort(F.collect_list(F.struct("turn", "role", "text", "good", "bad"))).alias("turns")
    )
    differing = F.filter("turns", lambda t: ~(t["good"] & t["bad"]))
    ended = lists.withColumn("end", F.get(differing, F.lit(0))["turn"])
    parts = ended.select(
        "pair_id",
        F.filter("turns", lambda t: F.col("end").isNull() | (t["turn"] < F.col("end"))).alias("common"),
        F.filter("turns", lambda t: t["good"] & (t["turn"] >= F.col("end"))).alias("good"),
        F.filter("turns", lambda t: t["bad"] & (t["turn"] >= F.col("end"))).alias("bad"),
    )

    def rendered(name: str) -> Column:
        return F.array_join(F.transform(name, _rendered), "")

    return parts.select(
        "pair_id", F.size("common").alias("n_common"), rendered("common").alias("prompt"), rendered("good").alias("chosen"),
        rendered("bad").alias("rejected"), _mask(F.col("good"), trained_role).alias("chosen_mask"),
        _mask(F.col("bad"), trained_role).alias("rejected_mask"),
    )


def mask_text(mask: Column) -> Column:
    """start:end of every span, joined by commas."""
    return F.array_join(F.transform(mask, lambda s: F.concat_ws(":", s["start"].cast("string"), s["end"].cast("string"))), ",")
