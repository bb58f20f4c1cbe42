"""Profiles of a validated application frame."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, Window, functions as F

from .. import functions as fx, rules
from ..session import settled
from .applications import Rule, decided
from .joins import lookup_join


def rejection_histogram(validated: DataFrame) -> DataFrame:
    """Rejected rows per combination of reasons, with the share of all rejections.

    The window runs over the grouped result, at most 2^rules rows.
    """
    per_reason = (
        decided(validated).where("NOT is_successful")
        .groupBy("rejection_reason").agg(F.count(F.lit(1)).alias("applications"))
    )
    return per_reason.withColumn(
        "share", F.round(F.col("applications") / F.sum("applications").over(Window.partitionBy()), 6)
    )


def rejections_by_rule(frame: DataFrame, checks: Sequence[Rule]) -> DataFrame:
    """Failures per rule, zero included; a row counts once for each rule it fails.

    One pass with one counter per rule: no row is multiplied and one row is shuffled per task.
    """
    counts = frame.agg(*[F.count_if(~r.holds()).alias(r.code) for r in checks])
    return counts.unpivot([], [r.code for r in checks], "rule", "failures")


def rejections_by_file(validated: DataFrame) -> DataFrame:
    """Rows and rejections per source file."""
    return validated.groupBy("source_file").agg(
        F.count(F.lit(1)).alias("rows_in"),
        F.count_if(~F.col("is_successful")).alias("unsuccessful"),
    )


def id_uniqueness(accepted: DataFrame) -> DataFrame:
    """One row: accepted rows against distinct membership ids."""
    per_id = accepted.groupBy("membership_id").agg(F.count(F.lit(1)).alias("n"))
    return per_id.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("members"),
        F.count("membership_id").alias("distinct_ids"),
        F.count_if(F.col("n") > 1).alias("colliding_ids"),
    )


def id_collisions(accepted: DataFrame) -> DataFrame:
    """Membership ids held by more than one accepted row, with the size of each group."""
    return (
        accepted.groupBy("membership_id").agg(F.count(F.lit(1)).alias("applicants"))
        .where("applicants > 1")
    )


def collision_rows(accepted: DataFrame) -> DataFrame:
    """Every accepted row whose membership id is shared, next to the size of its group.

    Rows stay rows: a group may be any size, so it is never collected into a list.
    """
    return lookup_join(accepted, settled(id_collisions(accepted)), ["membership_id"], "inner")


def email_domain_profile(applications: DataFrame) -> DataFrame:
    """Rows that carry a domain and how many different domains there are (exact)."""
    per_domain = (
        applications.select(fx.email_domain(F.col("email")).alias("domain"))
        .where(F.col("domain").isNotNull())
        .groupBy("domain").agg(F.count(F.lit(1)).alias("n"))
    )
    return per_domain.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("emails"), F.count(F.lit(1)).alias("distinct_domains")
    )


def email_domain_estimate(applications: DataFrame, error: float = 0.02) -> DataFrame:
    """The same with a fixed-size sketch instead of a shuffle of the domains."""
    domain = fx.email_domain(F.col("email"))
    return applications.agg(
        F.count(domain).alias("emails"),
        F.approx_count_distinct(domain, error).alias("distinct_domains"),
    )


def birthday_layout_profile(
    applications: DataFrame, layouts: Iterable[str] = rules.BIRTHDAY_LAYOUTS
) -> DataFrame:
    """Rows per birthday layout, and how many have a first or second part above 12.

    A part above 12 can only be a day, which is the evidence for reading ``/`` as
    month-first and ``-`` as day-first. Text with no known layout is ``other``.
    """
    text = F.btrim(F.col("birthday"), F.lit(rules.WHITESPACE))
    parts = F.split(text, "[-/]")
    shaped = applications.where(F.col("birthday").isNotNull()).select(
        F.coalesce(fx.layout_of(F.col("birthday"), layouts), F.lit("other")).alias("layout"),
        F.get(parts, F.lit(0)).alias("first"), F.get(parts, F.lit(1)).alias("second"),
    )
    return shaped.groupBy("layout").agg(
        F.count(F.lit(1)).alias("applications"),
        F.count_if(F.expr("try_cast(first AS int) > 12")).alias("first_above_12"),
        F.count_if(F.expr("try_cast(second AS int) > 12")).alias("second_above_12"),
    )


def run_counts(validated: DataFrame) -> DataFrame:
    """One row of run counters plus the conservation check, in one pass."""
    return validated.agg(
        F.count(F.lit(1)).alias("rows_in"),
        F.count_if("is_successful").alias("successful"),
        F.count_if(~F.col("is_successful")).alias("unsuccessful"),
    ).withColumn("balanced", F.expr("rows_in = successful + unsuccessful"))


def shared_applicants(accepted: DataFrame, rejected: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys present in both outputs, with the rows on each side.

    A tagged union grouped by the key: null keys match each other, each side is
    pre-aggregated, and no pair of rows is ever formed.
    """
    tagged = accepted.select(*keys, F.lit(1).alias("a"), F.lit(0).alias("r")).unionByName(
        rejected.select(*keys, F.lit(0).alias("a"), F.lit(1).alias("r"))
    )
    return (
        tagged.groupBy(*keys)
        .agg(F.sum("a").alias("accepted_rows"), F.sum("r").alias("rejected_rows"))
        .where("accepted_rows > 0 AND rejected_rows > 0")
    )


def shared_within(validated: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``shared_applicants`` of the two halves of one frame, which is read once."""
    return (
        validated.groupBy(*keys)
        .agg(F.count_if("is_successful").alias("accepted_rows"), F.count_if(~F.col("is_successful")).alias("rejected_rows"))
        .where("accepted_rows > 0 AND rejected_rows > 0")
    )


def replay_difference(first: DataFrame, second: DataFrame) -> DataFrame:
    """Distinct rows that occur more often in one run than in the other.

    ``only_in`` names the run, ``copies`` the surplus. Empty means equal as bags.
    Both runs are counted in a single aggregation keyed by the whole row.
    """
    columns = first.columns
    votes = first.withColumn("_vote", F.lit(1)).unionByName(second.withColumn("_vote", F.lit(-1)))
    return (
        votes.groupBy(*columns).agg(F.sum("_vote").alias("_balance"))
        .where("_balance <> 0")
        .select(
            *columns,
            F.when(F.col("_balance") > 0, "first").otherwise("second").alias("only_in"),
            F.abs("_balance").alias("copies"),
        )
    )
