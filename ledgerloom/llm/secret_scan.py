"""Secrets in texts: patterns, and stretches of high entropy. Built-in expressions only."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from .common import bound, running_sums


def _either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


#: The names before an assigned secret, and the patterns of the three base kinds.
#: A maximal run is found whole by its least length, so two kinds state it in the pattern; a
#: short assignment still uses up its text, so that kind is filtered after matching.
ASSIGN_NAMES = ("password", "passwd", "secret", "token", "api_?key")
ASSIGN = (
    "(" + "|".join(_either_case(n) for n in ASSIGN_NAMES) + ")"
    + "[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ASSIGN_LENGTH = 12
ACCESS = "AKIA[A-Z0-9]{14,}"
HEX = "[0-9a-f]{16,}"
BASE_KINDS = ("assign", "access", "hex")

#: Characters in a window of the entropy scan; shorter candidates are not scanned.
WINDOW = 20


@dataclass(frozen=True)
class CharacterClass:
    """Candidates made of ``characters`` only; a window counts from ``bits`` per character on."""

    kind: str
    characters: str
    bits: float


#: Narrow to wide: a candidate belongs to the first class that has all its characters.
CLASSES = (
    CharacterClass("entropy_hex", "0-9A-Fa-f", 3.0),
    CharacterClass("entropy_alnum", "0-9A-Za-z", 3.6),
    CharacterClass("entropy_base64", "0-9A-Za-z+/_=-", 3.7),
)

#: Candidates that match one of these are no secrets: UUIDs, words and paths without digits,
#: plain numbers, strings that say they are examples, counted-up alphabets and digits.
ALLOWED = (
    "^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$",
    "^[^0-9]*$",
    "^[0-9+/_=-]*$",
    "(?i)example|sample|placeholder|changeme|dummy|xxxx|0123456789|1234567890|abcdefghij",
)

#: Entropies are compared in whole numbers of this fraction, so a long run of updates is exact.
_UNIT = 1 << 20


def entropy_terms(window: int) -> list[int]:
    """n log2 n for each count n in a window, in units."""
    return [0] + [round(n * math.log2(n) * _UNIT) for n in range(1, window + 1)]


def entropy_limit(window: int, bits: float) -> int:
    """Largest sum of terms at which a window still has ``bits`` per character."""
    return math.floor(window * (math.log2(window) - bits) * _UNIT)


def _matches(text: Column, pattern: str, group: int | None = None) -> Column:
    """Matches from left to right with their start; code points. Null when there is none.

    What lies between the matches comes from ``split``, so starts are running sums of lengths.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    inner = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else found
    both = F.arrays_zip(found.alias("found"), inner.alias("inner"),
                        F.split(text, pattern, -1).alias("gap"))

    def placed(matches: Column) -> Column:
        before = running_sums(F.transform(matches, lambda m: (F.length(m["gap"]) + F.length(m["found"])).cast("long")))
        return F.zip_with(matches, before, lambda m, start: F.struct(
            (start + F.length(m["gap"])).cast("int").alias("start"), m["found"].alias("found"), m["inner"].alias("inner")))

    run = bound(F.filter(both, lambda m: m["found"].isNotNull()), placed)
    return F.when(text.rlike(pattern), run)


def _spans(matches: Column, kind: str, number: int) -> Column:
    return F.transform(matches, lambda m: F.struct(
        m["start"].alias("start"), F.lit(number).alias("number"),
        (m["start"] + F.length(m["found"])).alias("end"), F.lit(kind).alias("kind"),
    ))


def _none() -> Column:
    return F.array().cast("array<struct<start:int,number:int,end:int,kind:string>>")


def _dense_stretch(candidate: Column, limit: Column, window: int) -> Column:
    """(first, last) start of the windows of ``candidate`` within ``limit``; nulls when there is none.

    Counts per symbol move with the window: the character that leaves and the one that enters
    change two counts and two terms of the sum.
    """
    terms = F.array(*[F.lit(t).cast("long") for t in entropy_terms(window)])

    def scan(symbols: Column, codes: Column, limit: Column) -> Column:
        counts = F.transform(symbols, lambda s, j: F.size(F.filter(F.slice(codes, 1, window), lambda c: c == j)))
        total = F.aggregate(counts, F.lit(0).cast("long"), lambda s, n: s + F.get(terms, n))

        def note(total: Column, at: Column, first: Column, last: Column) -> tuple[Column, Column]:
            hit = total <= limit
            return (F.coalesce(first, F.when(hit, at)).alias("first"), F.coalesce(F.when(hit, at), last).alias("last"))

        def step(state: Column, at: Column) -> Column:
            # Symbols, then counts and sum, are each looked up once a step.
            ends = F.struct(F.get(codes, at - 1).alias("gone"), F.get(codes, at + window - 1).alias("new"))
            return bound(ends, lambda e: bound(moved(state, e), lambda total: F.struct(
                shifted(state["counts"], e).alias("counts"), total.alias("total"), *note(total, at, state["first"], state["last"]))))

        def moved(state: Column, e: Column) -> Column:
            before = F.get(state["counts"], e["gone"])
            met = F.get(state["counts"], e["new"]) - F.when(e["gone"] == e["new"], 1).otherwise(0)
            return state["total"] - F.get(terms, before) + F.get(terms, before - 1) - F.get(terms, met) + F.get(terms, met + 1)

        def shifted(counts: Column, e: Column) -> Column:
            change = F.transform(counts, lambda n, j: n - F.when(j == e["gone"], 1).otherwise(0) + F.when(j == e["new"], 1).otherwise(0))
            return F.when(e["gone"] == e["new"], counts).otherwise(change)

        moves = F.when(F.size(codes) > window, F.sequence(F.lit(1), F.size(codes) - window)).otherwise(F.array().cast("array<int>"))
        none = F.lit(None).cast("int")
        start = F.struct(counts.alias("counts"), total.alias("total"), *note(total, F.lit(0), none, none))
        return F.aggregate(moves, start, step, lambda state: F.struct(state["first"].alias("first"), state["last"].alias("last")))

    # Limit, characters, symbols and codes are each computed once, not at every step.
    def coded(characters: Column, symbols: Column) -> Column:
        codes = F.transform(characters, lambda c: (F.array_position(symbols, c) - 1).cast("int"))
        return bound(codes, lambda known: bound(limit, lambda most: scan(symbols, known, most)))

    return bound(F.split(candidate, ""), lambda characters: bound(
        F.array_distinct(characters), lambda symbols: coded(characters, symbols)))


def _entropy_spans(
    text: Column, classes: Sequence[CharacterClass], allowed: Sequence[str], window: int
) -> Column:
    widest = classes[-1].characters
    limits = [F.lit(entropy_limit(window, c.bits)).cast("long") for c in classes]

    def of_class(candidate: Column, values: Sequence[Column]) -> Column:
        chosen = F.lit(None)
        for group, value in reversed(list(zip(classes, values))):
            chosen = F.when(candidate.rlike(f"^[{group.characters}]*$"), value).otherwise(chosen)
        return chosen

    def suspicious(m: Column) -> Column:
        kept = F.lit(True)
        for pattern in allowed:
            kept = kept & ~m["found"].rlike(pattern)
        return kept

    candidates = F.filter(_matches(text, f"[{widest}]{{{window},}}"), suspicious)
    dense = F.transform(candidates, lambda m: F.struct(
        m["start"].alias("start"),
        of_class(m["found"], [F.lit(c.kind) for c in classes]).alias("kind"),
        of_class(m["found"], [F.lit(len(BASE_KINDS) + i) for i in range(len(classes))]).alias("number"),
        _dense_stretch(m["found"], of_class(m["found"], limits), window).alias("hit"),
    ))
    return F.transform(F.filter(dense, lambda d: d["hit"]["first"].isNotNull()), lambda d: F.struct(
        (d["start"] + d["hit"]["first"]).alias("start"), d["number"].alias("number"),
        (d["start"] + d["hit"]["last"] + window).alias("end"), d["kind"].alias("kind"),
    ))


def with_secrets(
    docs: DataFrame, text: str = "text", name: str = "secrets", classes: Sequence[CharacterClass] = CLASSES,
    allowed: Sequence[str] = ALLOWED, window: int = WINDOW,
) -> DataFrame:
    """``docs`` with ``name``: an array of (start, number, end, kind), ordered by start and kind.
    A column of that name is replaced.

    Base kinds are pattern matches, leftmost and non-overlapping per kind. Further spans come
    from candidate strings (maximal runs of the widest class, ``window`` characters or more, that
    no ``allowed`` pattern suppresses): a window slides over the candidate, and its Shannon entropy
    is held against the candidate's class; the span reaches from the first to the last window
    that is dense enough. A span inside a base span is not added; base spans always stay.
    Positions are code points, ends exclusive. A null or empty text has no spans. Whole texts are
    read; the work is per row, without shuffles.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    assigned = F.filter(_matches(whole, ASSIGN, 2), lambda m: F.length(m["inner"]) >= ASSIGN_LENGTH)
    base = F.concat(*[
        F.coalesce(_spans(found, kind, number), _none())
        for number, (kind, found) in enumerate(zip(BASE_KINDS, (assigned, _matches(whole, ACCESS), _matches(whole, HEX))))
    ])
    staged = docs.withColumn(name, F.struct(base.alias("base"), F.coalesce(_entropy_spans(whole, classes, allowed, window), _none()).alias("dense")))
    found = F.col(name)
    added = F.filter(found["dense"], lambda d: ~F.exists(
        found["base"], lambda b: (b["start"] <= d["start"]) & (d["end"] <= b["end"])
    ))
    return staged.withColumn(name, F.array_sort(F.concat(found["base"], added)))


def span_text(spans: Column) -> Column:
    """kind:start:end of every span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def base_spans(spans: Column) -> Column:
    return F.filter(spans, lambda s: s["number"] < len(BASE_KINDS))


def count_kind(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")
