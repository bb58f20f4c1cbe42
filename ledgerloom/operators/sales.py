"""Basket totals, rankings and table maintenance of the sales mart.

Tables, by column name: ``members(membership_id, first_name, last_name, ...)``,
``items(item_id, item_name, manufacturer_name, cost, weight_kg)``,
``transactions(transaction_id, membership_id, transaction_ts, total_items_price,
total_items_weight)`` and ``transaction_items(transaction_id, item_id, quantity,
unit_cost_at_purchase, unit_weight_at_purchase)``. Money and weight are decimals.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..session import settled
from .joins import lookup_join
from .keys import assign_surrogate_ids

_PRICE = "quantity * unit_cost_at_purchase"
_WEIGHT = "quantity * unit_weight_at_purchase"


def _zero(column: str, kind: str) -> Column:
    return F.coalesce(F.col(column), F.lit(0)).cast(kind)


# ---- Rankings ---------------------------------------------------------------


def _spending_per_member(transactions: DataFrame) -> DataFrame:
    return transactions.groupBy("membership_id").agg(
        F.count("transaction_id").alias("transaction_count"),
        F.sum("total_items_price").alias("total_spent"),
    )


def members_by_spending(members: DataFrame, transactions: DataFrame, top: int | None = 10) -> DataFrame:
    """Members with purchases, ranked by what they spent; ties by membership id.

    Transactions are summed per member before the names are joined, so a member
    with very many transactions travels as one row per task.
    """
    ranked = (
        _spending_per_member(transactions)
        .join(members.select("membership_id", "first_name", "last_name"), "membership_id")
        .select("membership_id", "first_name", "last_name", "transaction_count",
                F.col("total_spent").cast("decimal(22,2)").alias("total_spent"))
        .orderBy(F.desc("total_spent"), "membership_id")
    )
    return ranked if top is None else ranked.limit(top)


def all_members_by_spending(members: DataFrame, transactions: DataFrame) -> DataFrame:
    """Every member with count and spend, 0 for members without a purchase."""
    return (
        members.select("membership_id", "first_name", "last_name")
        .join(_spending_per_member(transactions), "membership_id", "left")
        .select("membership_id", "first_name", "last_name",
                F.coalesce("transaction_count", F.lit(0)).alias("transaction_count"),
                _zero("total_spent", "decimal(22,2)").alias("total_spent"))
    )


def items_by_purchases(
    items: DataFrame, lines: DataFrame, top: int | None = 3, rank_by: str = "baskets"
) -> DataFrame:
    """Items ranked by baskets that hold them or, with ``rank_by="units"``, by units sold.

    Spark plans the distinct count as (item, transaction) groups first, so an item
    sold in a third of all lines is spread by transaction before it is counted.
    """
    order = {"baskets": ("times_bought", "total_quantity"), "units": ("total_quantity", "times_bought")}
    if rank_by not in order:
        raise ValueError(f"rank_by must be one of {sorted(order)}")
    sold = lines.groupBy("item_id").agg(
        F.countDistinct("transaction_id").alias("times_bought"),
        F.sum("quantity").alias("total_quantity"),
    )
    ranked = (
        sold.join(items.select("item_id", "item_name", "manufacturer_name"), "item_id")
        .select("item_id", "item_name", "manufacturer_name", "times_bought", "total_quantity")
        .orderBy(*[F.desc(c) for c in order[rank_by]], "item_id")
    )
    return ranked if top is None else ranked.limit(top)


# ---- Header totals ----------------------------------------------------------


def basket_totals(lines: DataFrame) -> DataFrame:
    """Price and weight per transaction that has lines."""
    return lines.groupBy("transaction_id").agg(
        F.sum(F.expr(_PRICE)).alias("price"), F.sum(F.expr(_WEIGHT)).alias("weight")
    )


def refresh_totals(transactions: DataFrame, lines: DataFrame) -> DataFrame:
    """Headers with both totals recomputed; 0 when no line is left."""
    return (
        transactions.drop("total_items_price", "total_items_weight")
        .join(basket_totals(lines), "transaction_id", "left")
        .withColumn("total_items_price", _zero("price", "decimal(22,2)"))
        .withColumn("total_items_weight", _zero("weight", "decimal(22,3)"))
        .drop("price", "weight")
    )


def touched_transactions(feed: DataFrame) -> DataFrame:
    """Ids a change feed ``(op, old_transaction_id, new_transaction_id)`` affects.

    Inserts carry only a new id, deletes only an old one; an update carries both,
    so moving a line to another basket touches the one it left as well.
    """
    both = F.array("old_transaction_id", "new_transaction_id")
    return (
        feed.select(F.explode(F.array_compact(both)).alias("transaction_id")).distinct()
    )


def touched_totals(lines: DataFrame, feed: DataFrame) -> DataFrame:
    """New totals of the touched transactions only: the delta to merge into the headers.

    ``lines`` is the state after the change. The touched ids are broadcast if they
    measure small, so untouched lines are dropped before any shuffle.
    """
    touched = settled(touched_transactions(feed))
    mine = lookup_join(lines, touched, ["transaction_id"], "left_semi")
    return (
        touched.join(basket_totals(mine), "transaction_id", "left")
        .select("transaction_id", _zero("price", "decimal(22,2)").alias("price"),
                _zero("weight", "decimal(22,3)").alias("weight"))
    )


def refresh_touched_totals(transactions: DataFrame, lines: DataFrame, feed: DataFrame) -> DataFrame:
    """Headers after a change feed: touched ones recomputed, all others as they were."""
    delta = touched_totals(lines, feed).withColumn("_touched", F.lit(True))

    def pick(new: str, old: str, kind: str) -> Column:
        return F.when(F.col("_touched"), F.col(new)).otherwise(F.col(old)).cast(kind)

    # A small delta is broadcast, so headers that are not touched do not move.
    return lookup_join(transactions, settled(delta), ["transaction_id"], "left").withColumns({
        "total_items_price": pick("price", "total_items_price", "decimal(22,2)"),
        "total_items_weight": pick("weight", "total_items_weight", "decimal(22,3)"),
    }).drop("price", "weight", "_touched")


def totals_mismatches(transactions: DataFrame, lines: DataFrame) -> DataFrame:
    """Headers whose stored totals are not the sum of their lines."""
    stored = transactions.select(
        "transaction_id",
        F.col("total_items_price").cast("decimal(22,2)").alias("stored_price"),
        F.col("total_items_weight").cast("decimal(22,3)").alias("stored_weight"),
    )
    return (
        stored.join(basket_totals(lines), "transaction_id", "left")
        .withColumn("line_price", _zero("price", "decimal(22,2)"))
        .withColumn("line_weight", _zero("weight", "decimal(22,3)"))
        .drop("price", "weight")
        .where(~(F.col("stored_price").eqNullSafe(F.col("line_price"))
                 & F.col("stored_weight").eqNullSafe(F.col("line_weight"))))
    )


# ---- Reports ----------------------------------------------------------------


def sales_profile(members: DataFrame, transactions: DataFrame, items: DataFrame, lines: DataFrame) -> DataFrame:
    """One row: table sizes, basket and quantity extremes, first and last purchase."""
    baskets = lines.groupBy("transaction_id").agg(
        F.count(F.lit(1)).alias("n"), F.min("quantity").alias("q_min"), F.max("quantity").alias("q_max")
    ).agg(
        F.sum("n").alias("line_rows"), F.min("n").alias("min_basket"), F.max("n").alias("max_basket"),
        F.min("q_min").alias("min_quantity"), F.max("q_max").alias("max_quantity"),
    )
    headers = transactions.agg(
        F.count(F.lit(1)).alias("transaction_rows"),
        F.min("transaction_ts").alias("first_ts"), F.max("transaction_ts").alias("last_ts"),
    )
    # Four single-row frames laid over each other: each column is set in one of them.
    out = (
        baskets.unionByName(headers, allowMissingColumns=True)
        .unionByName(members.agg(F.count(F.lit(1)).alias("member_rows")), allowMissingColumns=True)
        .unionByName(items.agg(F.count(F.lit(1)).alias("item_rows")), allowMissingColumns=True)
    )
    out = out.agg(*[F.max(c).alias(c) for c in out.columns])
    return out.select(
        "member_rows", "item_rows", "transaction_rows", "line_rows", "min_basket", "max_basket",
        "min_quantity", "max_quantity", "first_ts", "last_ts",
    )


def monthly_revenue(transactions: DataFrame, start: str, end: str) -> DataFrame:
    """Transactions and revenue per month for ``start <= transaction_ts < end``.

    The bounds are plain comparisons on the column, so they reach the Parquet scan
    (and prune folders when the table is stored by month).
    """
    return (
        transactions
        .where((F.col("transaction_ts") >= F.lit(start).cast("timestamp_ntz"))
               & (F.col("transaction_ts") < F.lit(end).cast("timestamp_ntz")))
        .groupBy(F.date_format(F.to_date("transaction_ts"), "yyyy-MM").alias("month"))
        .agg(F.count(F.lit(1)).alias("transactions"),
             F.sum("total_items_price").cast("decimal(22,2)").alias("revenue"))
    )


def price_drift(items: DataFrame, lines: DataFrame) -> DataFrame:
    """List price against the prices paid, per sold item whose price ever differed.

    Lines are reduced to one row per item before the catalogue is joined.
    """
    paid = lines.groupBy("item_id").agg(
        F.count(F.lit(1)).alias("lines"),
        F.min("unit_cost_at_purchase").alias("min_paid"),
        F.max("unit_cost_at_purchase").alias("max_paid"),
    )
    return (
        items.select("item_id", F.col("cost").alias("list_price"))
        .join(paid, "item_id")
        .where("min_paid <> list_price OR max_paid <> list_price")
    )


def snapshot_lines(basket: DataFrame, items: DataFrame) -> DataFrame:
    """Lines to append for ``(transaction_id, item_id, quantity)``, at today's cost and weight.

    The values are stored in the line, so a later catalogue change leaves it alone.
    """
    now = items.select(
        "item_id", F.col("cost").alias("unit_cost_at_purchase"),
        F.col("weight_kg").alias("unit_weight_at_purchase"),
    )
    return lookup_join(basket, now, ["item_id"], "inner").select(
        "transaction_id", "item_id", "quantity", "unit_cost_at_purchase", "unit_weight_at_purchase"
    )


# ---- Deletes and key changes ------------------------------------------------


def cascade_delete(lines: DataFrame, deleted: DataFrame) -> DataFrame:
    """Lines that remain after the transactions in ``deleted`` (distinct ids) are removed."""
    return lookup_join(lines, deleted.select("transaction_id"), ["transaction_id"], "left_anti")


def blocked_deletes(to_delete: DataFrame, children: DataFrame, key: str) -> DataFrame:
    """Keys that may not be deleted because child rows use them, with how many do."""
    used = children.groupBy(key).agg(F.count(F.lit(1)).alias("child_rows"))
    return to_delete.select(key).join(used, key)


def remap_members(transactions: DataFrame, renamed: DataFrame) -> DataFrame:
    """Transactions after membership ids changed from ``old_id`` to ``new_id``."""
    mapping = renamed.select(F.col("old_id").alias("membership_id"), "new_id")
    joined = lookup_join(transactions, mapping, ["membership_id"], "left")
    return joined.withColumn(
        "membership_id", F.coalesce("new_id", "membership_id")
    ).select(*transactions.columns)


# ---- Manufacturer split-out -------------------------------------------------


def manufacturer_dimension(items: DataFrame) -> DataFrame:
    """One row per manufacturer name with a surrogate id, in name order from 1; no name is no manufacturer."""
    names = items.where(F.col("manufacturer_name").isNotNull()).select("manufacturer_name").distinct()
    return assign_surrogate_ids(names, ["manufacturer_name"], "manufacturer_id")


def items_with_manufacturer_id(items: DataFrame, manufacturers: DataFrame) -> DataFrame:
    """Items with the manufacturer's id in place of its name."""
    return lookup_join(items, manufacturers, ["manufacturer_name"], "left").drop("manufacturer_name")
