"""Table constraints as queries that report what breaks them.

Each reports offending keys or rows; nothing is enforced or changed.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from .. import rules
from .applications import Rule


def null_counts(frame: DataFrame, table: str, columns: Sequence[str]) -> DataFrame:
    """Null cells per column that has any, from one pass over the table."""
    counted = frame.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return (
        counted.unpivot([], list(columns), "column_name", "violations")
        .where("violations > 0")
        .select(F.lit(table).alias("table_name"), "column_name", "violations")
    )


def duplicate_keys(frame: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values held by more than one row. Serves primary keys and unique constraints."""
    return frame.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")


def orphans(children: DataFrame, parents: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Child key values without a parent and the number of rows that carry them.

    Children are reduced to one row per key first: neither a key with very many
    rows nor the width of the child table reaches the join. Null keys are not
    orphans, as in SQL.
    """
    used = (
        children.where(F.col(child_key).isNotNull())
        .groupBy(F.col(child_key).alias("orphan_key")).agg(F.count(F.lit(1)).alias("child_rows"))
    )
    known = parents.select(F.col(parent_key).alias("orphan_key"))
    return used.join(known, "orphan_key", "left_anti")


def without_children(parents: DataFrame, children: DataFrame, key: str) -> DataFrame:
    """Parents no child row refers to."""
    used = children.select(key).distinct()
    return parents.join(used, key, "left_anti")


def violating_rows(frame: DataFrame, checks: Sequence[Rule], keep: Sequence[str]) -> DataFrame:
    """Rows that break at least one check, with the names of all they break.

    As in SQL a check on a null value is not broken; ``null_counts`` reports nulls.
    """
    broken = F.array_compact(F.array(*[F.when(~c.passes, F.lit(c.code)) for c in checks]))
    return (
        frame.select(*keep, broken.alias("_broken"))
        .where(F.size("_broken") > 0)
        .select(*keep, F.array_join("_broken", ";").alias("violated"))
    )


def check_counts(frame: DataFrame, table: str, checks: Sequence[Rule]) -> DataFrame:
    """Rows breaking each check, zero included, from one pass."""
    counted = frame.agg(*[F.count_if(~c.passes).alias(c.code) for c in checks])
    return counted.unpivot([], [c.code for c in checks], "check_name", "violations").select(
        F.lit(table).alias("table_name"), "check_name", "violations"
    )


def latest_adult_birthday(reference: date = rules.REFERENCE_DATE, limit: int = rules.AGE_LIMIT) -> Column:
    """Last birthday that is older than ``limit`` on ``reference``."""
    return F.add_months(F.lit(reference), -12 * (limit + 1))


def sales_checks(reference: date = rules.REFERENCE_DATE) -> Mapping[str, tuple[Rule, ...]]:
    """The value constraints of the sales tables, by table."""
    return {
        "members": (
            Rule("mobile_is_8_digits", F.col("mobile").rlike(rf"\A[0-9]{{{rules.MOBILE_DIGITS}}}\z")),
            Rule("above_18_matches_birthday",
                 F.col("above_18") == (F.col("birthday") <= latest_adult_birthday(reference))),
        ),
        "items": (
            Rule("cost_non_negative", F.col("cost") >= 0),
            Rule("weight_positive", F.col("weight_kg") > 0),
        ),
        "transactions": (
            Rule("total_price_non_negative", F.col("total_items_price") >= 0),
            Rule("total_weight_non_negative", F.col("total_items_weight") >= 0),
        ),
        "transaction_items": (
            Rule("quantity_positive", F.col("quantity") > 0),
            Rule("unit_cost_non_negative", F.col("unit_cost_at_purchase") >= 0),
            Rule("unit_weight_positive", F.col("unit_weight_at_purchase") > 0),
        ),
    }


#: Columns that must hold a value: every column of every table.
REQUIRED_COLUMNS = {
    "members": ("membership_id", "first_name", "last_name", "email", "birthday", "above_18", "mobile"),
    "items": ("item_id", "item_name", "manufacturer_name", "cost", "weight_kg"),
    "transactions": ("transaction_id", "membership_id", "transaction_ts",
                     "total_items_price", "total_items_weight"),
    "transaction_items": ("transaction_id", "item_id", "quantity",
                          "unit_cost_at_purchase", "unit_weight_at_purchase"),
}
