"""Birthdays, ages, contact fields and membership ids."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date
from functools import reduce
from operator import or_

from pyspark.sql import Column, functions as F

from .. import rules


_SPACE = f"[{rules.WHITESPACE}]*"
_PARTS = {"yyyy": "([0-9]{4})", "MM": "([0-9]{2})", "dd": "([0-9]{2})"}


def _shape(layout: str) -> str:
    """Regex for a layout such as ``dd-MM-yyyy``, one group per part."""
    for part, digits in _PARTS.items():
        layout = layout.replace(part, digits)
    return layout


def _stripped(value: Column) -> Column:
    return F.btrim(value, F.lit(rules.WHITESPACE))


def layout_of(birthday: Column, layouts: Iterable[str] = rules.BIRTHDAY_LAYOUTS) -> Column:
    """Which layout the text has the shape of (null when none), valid date or not."""
    text = _stripped(birthday)
    return F.coalesce(*[F.when(text.rlike(rf"\A{_shape(l)}\z"), F.lit(l)) for l in layouts])


def _parse(birthday: Column, layouts: Iterable[str]) -> Column:
    # One pass rewrites a text of any layout to yyyy-MM-dd: only the groups of the
    # layout that matched hold text, so they can be strung together. Any other text
    # becomes "--". Both are then cast without exceptions.
    groups: dict[str, str] = {part: "" for part in _PARTS}
    for number, layout in enumerate(layouts):
        for place, part in enumerate(sorted(_PARTS, key=layout.index), start=1):
            groups[part] += f"${3 * number + place}"
    shapes = "|".join(_shape(l) for l in layouts)
    pattern = rf"(?s)\A{_SPACE}(?:{shapes}){_SPACE}\z|\A.*\z"
    return F.regexp_replace(birthday, pattern, "{yyyy}-{MM}-{dd}".format(**groups)).try_cast("date")


def parse_birthday(birthday: Column, layouts: Iterable[str] = rules.BIRTHDAY_LAYOUTS) -> Column:
    """Date from the first layout that fits; null for impossible or unknown dates."""
    layouts = tuple(layouts)
    if len({_shape(l) for l in layouts}) == len(layouts):
        return _parse(birthday, layouts)
    return F.coalesce(*[_parse(birthday, (l,)) for l in layouts])


def format_birthday(birthday_date: Column) -> Column:
    return F.date_format(birthday_date, rules.BIRTHDAY_OUT)


def age_on(birthday_ymd: Column, reference: date = rules.REFERENCE_DATE) -> Column:
    """Whole years completed on ``reference``, from a ``YYYYMMDD`` birthday.

    The difference of the two numbers counts a year per 10000 and falls short while
    month and day are still to come: a calendar comparison, exact on 29 February.
    """
    today = int(reference.strftime("%Y%m%d"))
    return F.floor((F.lit(today) - birthday_ymd.cast("int")) / 10000).cast("int")


def above_limit(age: Column, limit: int = rules.AGE_LIMIT) -> Column:
    return age > F.lit(limit)


def bare_mobile(mobile: Column) -> Column:
    """The number without any whitespace; other punctuation is kept."""
    return F.translate(mobile, rules.WHITESPACE, "")


def is_mobile(bare: Column, digits: int = rules.MOBILE_DIGITS) -> Column:
    return bare.rlike(rf"\A[0-9]{{{digits}}}\z")


def clean_email(email: Column) -> Column:
    """Form used for tests only; outputs keep the address as submitted."""
    return F.lower(_stripped(email))


def has_suffix(email: Column, suffixes: Iterable[str] = rules.EMAIL_SUFFIXES) -> Column:
    address = clean_email(email)
    return reduce(or_, [address.endswith(s.lower()) for s in suffixes])


def email_domain(email: Column) -> Column:
    """Text after the last ``@``; null when there is none."""
    address = clean_email(email)
    return F.when(address.contains("@"), F.substring_index(address, "@", -1))


def birthday_hash(birthday_ymd: Column, chars: int = rules.HASH_CHARS) -> Column:
    return F.substring(F.sha2(birthday_ymd, 256), 1, chars)


def membership_id(last: Column, birthday_ymd: Column, chars: int = rules.HASH_CHARS) -> Column:
    """``<last name>_<hash of the birthday>``; a single-token name gives ``_<hash>``."""
    return F.concat(last, F.lit("_"), birthday_hash(birthday_ymd, chars))
