"""Cleaning, validating and splitting membership applications."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from datetime import date
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F

from .. import functions as fx, rules

SUCCESSFUL_COLUMNS = (
    "membership_id", "first_name", "last_name", "email", "birthday", "above_18", "mobile",
)
UNSUCCESSFUL_COLUMNS = (
    "name", "email", "birthday_raw", "mobile_raw", "first_name", "last_name", "birthday",
    "age", "above_18", "rejection_reason", "source_file",
)


@dataclass(frozen=True)
class Rule:
    """A reason code and the condition that must hold; null counts as a failure."""

    code: str
    passes: Column

    def holds(self) -> Column:
        return F.coalesce(self.passes, F.lit(False))


def application_rules(email_suffixes: Iterable[str] = rules.EMAIL_SUFFIXES) -> tuple[Rule, ...]:
    """The onboarding rules over a cleaned frame, in reporting order.

    The age rule passes when the birthday is unreadable: that row already fails
    ``unparseable_birthday`` and no age is known.
    """
    return (
        Rule(rules.MISSING_NAME, F.col("first_name").isNotNull()),
        Rule(rules.UNPARSEABLE_BIRTHDAY, F.col("birthday_date").isNotNull()),
        Rule(rules.UNDER_18, F.coalesce("above_18", F.lit(True))),
        Rule(rules.INVALID_MOBILE, fx.is_mobile(F.col("mobile_normalised"))),
        Rule(rules.INVALID_EMAIL, fx.has_suffix(F.col("email"), tuple(email_suffixes))),
    )


def clean(applications: DataFrame, reference: date = rules.REFERENCE_DATE) -> DataFrame:
    """Add the derived columns; the submitted ones stay untouched."""
    return (
        applications
        .withColumn("_core", fx.core_name(F.col("name")))
        .withColumns({
            "first_name": fx.first_name(F.col("_core")),
            "last_name": fx.last_name(F.col("_core")),
            "birthday_date": fx.parse_birthday(F.col("birthday")),
            "mobile_normalised": fx.bare_mobile(F.col("mobile")),
        })
        .drop("_core")
        .withColumn("birthday_ymd", fx.format_birthday(F.col("birthday_date")))
        .withColumn("age", fx.age_on(F.col("birthday_ymd"), reference))
        .withColumn("above_18", fx.above_limit(F.col("age")))
    )


def failed_codes(checks: Sequence[Rule]) -> Column:
    """Codes of all failed rules joined by ``;``, or ``''`` when none failed."""
    return F.concat_ws(rules.REASON_SEPARATOR, *[F.when(~r.holds(), F.lit(r.code)) for r in checks])


def all_hold(checks: Sequence[Rule]) -> Column:
    return reduce(and_, [r.holds() for r in checks])


def validate(cleaned: DataFrame, checks: Sequence[Rule] | None = None) -> DataFrame:
    """Add ``is_successful``, ``rejection_reason`` and ``membership_id``; keeps every row.

    Only adds columns, so a filter on a submitted column reaches the scan.
    """
    checks = application_rules() if checks is None else checks
    flags = {f"_holds_{r.code}": r.holds() for r in checks}
    noted = [Rule(r.code, F.col(f"_holds_{r.code}")) for r in checks]
    return (
        cleaned
        .withColumns(flags)
        .withColumns({"is_successful": all_hold(noted), "rejection_reason": failed_codes(noted)})
        .drop(*flags)
        .withColumn(
            "membership_id",
            F.when(F.col("is_successful"), fx.membership_id(F.col("last_name"), F.col("birthday_ymd"))),
        )
    )


def decided(validated: DataFrame) -> DataFrame:
    """``validated`` with its verdicts decided once, for the split into two outputs.

    A filter on the verdict would otherwise be moved to the scan together with a second
    copy of every expression behind it, which ran five times slower on 8 million rows.
    Observing the run counters (see ``DataFrame.observe``) ends the reach of that move.
    """
    return validated.observe(
        f"applications-{uuid.uuid4().hex}",
        F.count(F.lit(1)).alias("rows_in"), F.count_if("is_successful").alias("successful"),
    )


def rule_matrix(frame: DataFrame, checks: Sequence[Rule], keep: Sequence[str] = ()) -> DataFrame:
    """One boolean per rule, true where the row fails it, next to the ``keep`` columns."""
    return frame.select(*keep, *[(~r.holds()).alias(r.code) for r in checks])


def successful(validated: DataFrame) -> DataFrame:
    """Accepted applications in the output layout, with the cleaned values."""
    return decided(validated).where("is_successful").select(
        "membership_id", "first_name", "last_name", "email",
        F.col("birthday_ymd").alias("birthday"), "above_18",
        F.col("mobile_normalised").alias("mobile"),
    )


def unsuccessful(validated: DataFrame) -> DataFrame:
    """Rejected applications: what was submitted, how it was read, and why it failed."""
    return decided(validated).where("NOT is_successful").select(
        "name", "email",
        F.col("birthday").alias("birthday_raw"), F.col("mobile").alias("mobile_raw"),
        "first_name", "last_name", F.col("birthday_ymd").alias("birthday"),
        "age", "above_18", "rejection_reason", "source_file",
    )


def recheck_accepted(
    accepted: DataFrame, reference: date = rules.REFERENCE_DATE, email_suffixes: Iterable[str] = rules.EMAIL_SUFFIXES
) -> DataFrame:
    """Accepted rows that break what acceptance promises, with the broken promises in ``broken``.

    Checked from the stored values alone: the birthday's layout, the age on ``reference``,
    the age flag, the mobile, the e-mail suffix, and the id from last name and birthday.
    """
    birthday = F.when(F.col("birthday").rlike(r"\A[0-9]{8}\z"), F.try_to_date("birthday", rules.BIRTHDAY_OUT))
    adult = fx.above_limit(fx.age_on(F.col("birthday"), reference))
    promises = (
        Rule("birthday_layout", birthday.isNotNull()),
        Rule("above_18", F.when(birthday.isNotNull(), adult & F.col("above_18"))),
        Rule("mobile", fx.is_mobile(F.col("mobile"))),
        Rule("email", fx.has_suffix(F.col("email"), tuple(email_suffixes))),
        Rule("membership_id", F.col("membership_id") == fx.membership_id(F.col("last_name"), F.col("birthday"))),
    )
    return accepted.withColumn("broken", failed_codes(promises)).where("broken <> ''")


def recheck_rejections(
    audit: DataFrame,
    reference: date = rules.REFERENCE_DATE,
    checks: Sequence[Rule] | None = None,
) -> DataFrame:
    """Audit rows whose stored reason is not what the raw fields give today."""
    raw = audit.select(
        "name", "email", F.col("birthday_raw").alias("birthday"),
        F.col("mobile_raw").alias("mobile"), "source_file",
        F.col("rejection_reason").alias("stored_reason"),
    )
    again = validate(clean(raw, reference), checks)
    return again.where(~F.col("stored_reason").eqNullSafe(F.col("rejection_reason"))).select(
        "name", "email", F.col("birthday").alias("birthday_raw"),
        F.col("mobile").alias("mobile_raw"), "stored_reason",
        F.col("rejection_reason").alias("recomputed_reason"), "source_file",
    )
