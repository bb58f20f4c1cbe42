"""Splitting a submitted name into first and last name.

Each step reads its input once. A filter on the verdict is pushed below the
projections and repeats these expressions, so they must not multiply.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, functions as F

from .. import rules


def name_tokens(name: Column) -> Column:
    """Whitespace-separated tokens; null stays null, a blank name gives ``[]``."""
    return F.regexp_extract_all(name, F.lit(r"(?U)\S+"), F.lit(0))


def _any_of(words: Iterable[str]) -> str:
    return "(?:" + "|".join(words) + r")\.*"


#: Whitespace that is not already a single space.
_UNEVEN = r"(?U)\s{2,}|[^\S ]"


def core_name(
    name: Column,
    salutations: Iterable[str] = rules.SALUTATIONS,
    post_nominals: Iterable[str] = rules.POST_NOMINALS,
) -> Column:
    """The name with single spaces, without one leading title and one trailing post-nominal.

    Words match in any case and with any number of trailing dots. A post-nominal
    needs a token before it, so one submitted alone is kept. ``''`` when no name is left.
    """
    # Between words of ``even`` there is one space and none in front, so a space
    # before the post-nominal means there is a token before it.
    even = F.btrim(F.regexp_replace(name, _UNEVEN, " "))
    extra = rf"(?i)\A{_any_of(salutations)}(?= |\z)| {_any_of(post_nominals)}\z"
    return F.btrim(F.regexp_replace(even, extra, ""))


def core_tokens(core: Column) -> Column:
    """Tokens of a core name."""
    return F.regexp_extract_all(core, F.lit("[^ ]+"), F.lit(0))


def first_name(core: Column) -> Column:
    """First token of the core name; null when there is none."""
    return F.nullif(F.substring_index(core, " ", 1), F.lit(""))


def last_name(core: Column) -> Column:
    """The core name after its first token.

    ``''`` for a single-token name, null when there is no name at all.
    """
    after_first = F.length(F.substring_index(core, " ", 1)) + 2
    return F.when(core != "", core.substr(after_first, F.length(core)))
