"""Queries of the sales mart, over ``customer``, ``orders``, ``part`` and ``lineitem``."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators import integrity, keys, sales, sampling
from ..session import scratch_path, settled
from ..sources import mart, tables, totals as kept
from .onboarding import accepted, cleaned
from .registry import Collected
from .views import duck, items, lines, members, transactions

_q = Collected()
QUERIES = _q.queries

# ---- Rankings ---------------------------------------------------------------------


@_q.add(duck("""
    select m.membership_id, m.first_name, m.last_name, count(t.transaction_id) as transaction_count,
      cast(sum(t.total_items_price) as decimal(22,2)) as total_spent
    from members m join transactions t on t.membership_id = m.membership_id
    group by all order by total_spent desc, m.membership_id limit 10""", "members", "transactions"))
def top10_members_by_spending(spark: SparkSession, folder: str) -> DataFrame:
    return sales.members_by_spending(members(spark, folder), transactions(spark, folder))


@_q.add(duck("""
    select m.membership_id, m.first_name, m.last_name, count(t.transaction_id) as transaction_count,
      cast(coalesce(sum(t.total_items_price), 0) as decimal(22,2)) as total_spent
    from members m left join transactions t on t.membership_id = m.membership_id
    group by all""", "members", "transactions"))
def all_members_by_spending(spark: SparkSession, folder: str) -> DataFrame:
    return sales.all_members_by_spending(members(spark, folder), transactions(spark, folder))


_TOP_ITEMS = """
    select i.item_id, i.item_name, i.manufacturer_name, count(distinct l.transaction_id) as times_bought,
      cast(sum(l.quantity) as bigint) as total_quantity
    from lines l join items i on i.item_id = l.item_id
    group by all order by {order} desc, i.item_id limit 3"""


@_q.add(duck(_TOP_ITEMS.format(order="times_bought desc, total_quantity"), "lines", "items"))
def top3_items_by_frequency(spark: SparkSession, folder: str) -> DataFrame:
    return sales.items_by_purchases(items(spark, folder), lines(spark, folder))


@_q.add(duck(_TOP_ITEMS.format(order="total_quantity desc, times_bought"), "lines", "items"))
def top3_items_by_units(spark: SparkSession, folder: str) -> DataFrame:
    return sales.items_by_purchases(items(spark, folder), lines(spark, folder), rank_by="units")


# ---- Totals -----------------------------------------------------------------------

_TOTALS = """
    totals as (
      select transaction_id, sum(quantity * unit_cost_at_purchase) as price,
        sum(quantity * unit_weight_at_purchase) as weight
      from {lines} group by transaction_id)"""

_REFRESHED = """
    select t.transaction_id, t.membership_id, t.transaction_ts,
      cast(coalesce(s.price, 0) as decimal(22,2)) as total_items_price,
      cast(coalesce(s.weight, 0) as decimal(22,3)) as total_items_weight
    from transactions t left join totals s using (transaction_id)"""


@_q.add(duck(f"with {_TOTALS.format(lines='lines').strip()} {_REFRESHED}", "transactions", "lines"))
def transaction_totals(spark: SparkSession, folder: str) -> DataFrame:
    return sales.refresh_totals(transactions(spark, folder), lines(spark, folder))


# The change, about one basket in a hundred: a first line moves to the next basket, or
# what was returned is deleted.
_MOVED = "transaction_id % 200 = 7 and line_number = 1"
_DELETED = "transaction_id % 200 = 107 and return_flag = 'R'"

_CHANGED = f"""
    after_change as (
      select case when {_MOVED} then transaction_id + 1 else transaction_id end as transaction_id,
        quantity, unit_cost_at_purchase, unit_weight_at_purchase
      from lines where not ({_DELETED})),
    touched as (
      select transaction_id from lines where ({_MOVED}) or ({_DELETED})
      union select transaction_id + 1 from lines where {_MOVED}),
    {_TOTALS.format(lines='after_change').strip()}"""


def _change(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Lines after the change, and its feed."""
    before = lines(spark, folder)
    after = before.where(f"not ({_DELETED})").withColumn(
        "transaction_id", F.expr(f"case when {_MOVED} then transaction_id + 1 else transaction_id end")
    )
    feed = before.where(f"({_MOVED}) or ({_DELETED})").select(
        F.expr(f"case when {_MOVED} then 'update' else 'delete' end").alias("op"),
        F.col("transaction_id").alias("old_transaction_id"),
        F.expr(f"case when {_MOVED} then transaction_id + 1 end").alias("new_transaction_id"),
    )
    return after, feed


@_q.add(duck(f"""
    with {_CHANGED.strip()}
    select transaction_id, cast(coalesce(s.price, 0) as decimal(22,2)) as price,
      cast(coalesce(s.weight, 0) as decimal(22,3)) as weight
    from touched left join totals s using (transaction_id)""", "lines"))
def touched_totals(spark: SparkSession, folder: str) -> DataFrame:
    return sales.touched_totals(*_change(spark, folder))


@_q.add(duck(f"""
    with {_CHANGED.strip()}
    select t.transaction_id, t.membership_id, t.transaction_ts,
      cast(case when c.transaction_id is null then t.total_items_price else coalesce(s.price, 0) end as decimal(22,2)) as total_items_price,
      cast(case when c.transaction_id is null then t.total_items_weight else coalesce(s.weight, 0) end as decimal(22,3)) as total_items_weight
    from transactions t left join touched c using (transaction_id) left join totals s using (transaction_id)""",
    "transactions", "lines"))
def incremental_totals(spark: SparkSession, folder: str) -> DataFrame:
    """Stored headers after the change: touched ones recomputed, the others as they are stored."""
    after, feed = _change(spark, folder)
    return sales.refresh_touched_totals(transactions(spark, folder), after, feed)


# Three feeds with images: first lines move to the next basket; what was returned is deleted; quantities
# change and lines are added.
_REPRICED, _ADDED = "transaction_id % 200 = 57", "transaction_id % 200 = 157 and line_number = 1"

_AFTER_FEEDS = f"""
    after_feeds as (
      select case when {_MOVED} then transaction_id + 1 else transaction_id end as transaction_id,
        case when {_REPRICED} then quantity + 2 else quantity end as quantity, unit_cost_at_purchase, unit_weight_at_purchase
      from lines where not ({_DELETED})
      union all select transaction_id, 3, unit_cost_at_purchase, unit_weight_at_purchase from lines where {_ADDED}),
    totals as (
      select transaction_id, sum(quantity * unit_cost_at_purchase) as price, sum(quantity * unit_weight_at_purchase) as weight,
        count(*) as line_count from after_feeds group by transaction_id)"""


def _feeds(spark: SparkSession, folder: str) -> list[DataFrame]:
    before, image = lines(spark, folder), kept.line_image()
    moved = kept.line_image(transaction_id=F.col("transaction_id") + 1)
    more, added = kept.line_image(quantity=F.col("quantity") + 2), kept.line_image(quantity=F.lit(3))
    return [
        before.where(_MOVED).select(*kept.change("update", image, moved)),
        before.where(_DELETED).select(*kept.change("delete", image)),
        before.where(_REPRICED).select(*kept.change("update", image, more)).union(
            before.where(_ADDED).select(*kept.change("insert", None, added))),
    ]


def _kept_totals(spark: SparkSession, folder: str) -> str:
    """Kept totals after three feeds: the second came twice, then both were folded, and the first came again."""
    root = scratch_path(spark, "totals")
    kept.create_totals(lines(spark, folder), root)
    first, second, third = _feeds(spark, folder)
    for number, feed in ((1, first), (2, second), (2, second)):
        kept.apply_feed(spark, root, number, feed)
    kept.fold_totals(spark, root)
    kept.apply_feed(spark, root, 1, first)
    kept.apply_feed(spark, root, 3, third)
    return root


@_q.add(duck(f"""
    with {_AFTER_FEEDS.strip()}
    select t.transaction_id, t.membership_id, t.transaction_ts, cast(coalesce(s.price, 0) as decimal(22,2)) as total_items_price,
      cast(coalesce(s.weight, 0) as decimal(22,3)) as total_items_weight, coalesce(s.line_count, 0) as line_count
    from transactions t left join totals s using (transaction_id)""", "transactions", "lines"))
def totals_by_signed_deltas(spark: SparkSession, folder: str) -> DataFrame:
    """Headers with totals kept by adding and retracting; lines are in the feeds only."""
    totals = kept.read_totals(spark, _kept_totals(spark, folder))
    headers = transactions(spark, folder).drop("total_items_price", "total_items_weight")
    return headers.join(totals, "transaction_id", "left").select(
        *headers.columns, F.coalesce("price", F.lit(0)).cast("decimal(22,2)").alias("total_items_price"),
        F.coalesce("weight", F.lit(0)).cast("decimal(22,3)").alias("total_items_weight"), F.coalesce("line_count", F.lit(0)).alias("line_count"))


@_q.add(duck(f"""
    with {_AFTER_FEEDS.strip()},
    touched as (select distinct transaction_id from lines where ({_REPRICED}) or ({_ADDED}))
    select transaction_id, cast(price as decimal(22,2)) as price, cast(weight as decimal(22,3)) as weight, line_count
    from touched join totals using (transaction_id)""", "lines"))
def touched_by_signed_deltas(spark: SparkSession, folder: str) -> DataFrame:
    """Totals of the baskets that the last feed touched."""
    return kept.touched_totals(spark, _kept_totals(spark, folder), since=3)


@_q.add(duck(f"""
    with {_TOTALS.format(lines='lines').strip()}
    select t.transaction_id, cast(t.total_items_price as decimal(22,2)) as stored_price,
      cast(t.total_items_weight as decimal(22,3)) as stored_weight,
      cast(coalesce(s.price, 0) as decimal(22,2)) as line_price,
      cast(coalesce(s.weight, 0) as decimal(22,3)) as line_weight
    from transactions t left join totals s using (transaction_id)
    where t.total_items_price <> coalesce(s.price, 0) or t.total_items_weight <> coalesce(s.weight, 0)
    """, "transactions", "lines"))
def totals_reconciliation(spark: SparkSession, folder: str) -> DataFrame:
    return sales.totals_mismatches(transactions(spark, folder), lines(spark, folder))


# ---- Reports ----------------------------------------------------------------------


@_q.add(duck("""
    select (select count(*) from members) as member_rows, (select count(*) from items) as item_rows,
      (select count(*) from transactions) as transaction_rows, (select count(*) from lines) as line_rows,
      (select min(n) from (select count(*) as n from lines group by transaction_id)) as min_basket,
      (select max(n) from (select count(*) as n from lines group by transaction_id)) as max_basket,
      (select min(quantity) from lines) as min_quantity, (select max(quantity) from lines) as max_quantity,
      (select min(transaction_ts) from transactions) as first_ts,
      (select max(transaction_ts) from transactions) as last_ts""", "members", "items", "transactions", "lines"))
def sales_profile(spark: SparkSession, folder: str) -> DataFrame:
    return sales.sales_profile(
        members(spark, folder), transactions(spark, folder), items(spark, folder), lines(spark, folder)
    )


@_q.add(duck("""
    select strftime(transaction_ts, '%Y-%m') as month, count(*) as transactions,
      cast(sum(total_items_price) as decimal(22,2)) as revenue
    from transactions where transaction_ts >= timestamp '1996-01-01' and transaction_ts < timestamp '1998-01-01'
    group by 1""", "transactions"))
def monthly_revenue(spark: SparkSession, folder: str) -> DataFrame:
    return sales.monthly_revenue(transactions(spark, folder), "1996-01-01", "1998-01-01")


@_q.add(duck("""
    select strftime(transaction_ts, '%Y-%m') as month, count(*) as transactions,
      cast(sum(total_items_price) as decimal(22,2)) as revenue
    from transactions where strftime(transaction_ts, '%Y-%m') between '1997-03' and '1997-08'
    group by 1""", "transactions"))
def monthly_partition_scan(spark: SparkSession, folder: str) -> DataFrame:
    root = scratch_path(spark, "by-month")
    tables.write_by_month(transactions(spark, folder), root)
    months = tables.read_months(spark, root, "1997-03", "1997-08")
    return sales.monthly_revenue(months, "1997-03-01", "1997-09-01")


@_q.add(duck("""
    select strftime(transaction_ts, '%Y-%m') as month, concat(year(transaction_ts), '-Q', quarter(transaction_ts)) as quarter,
      count(*) as transactions, cast(sum(total_items_price) as decimal(22,2)) as revenue
    from transactions where year(transaction_ts) in (1994, 1997) and quarter(transaction_ts) = 2 group by all""", "transactions"))
def revenue_of_quarters(spark: SparkSession, folder: str) -> DataFrame:
    """Months picked by a calendar table at run time; only their folders are opened."""
    root = scratch_path(spark, "quarters")
    tables.write_by_month(transactions(spark, folder), f"{root}/sales")
    tables.calendar_months(spark, "1990-01", "1999-12").write.parquet(f"{root}/calendar")
    wanted = F.col("quarter").isin("1994-Q2", "1997-Q2")
    rows = tables.read_months_of(spark, f"{root}/sales", spark.read.parquet(f"{root}/calendar"), wanted)
    return rows.groupBy("month", "quarter").agg(
        F.count(F.lit(1)).alias("transactions"), F.sum("total_items_price").cast("decimal(22,2)").alias("revenue"))


# ---- Stored in buckets ----------------------------------------------------------------


def _with_mart(spark: SparkSession, folder: str, ask) -> DataFrame:
    """What ``ask`` makes of the bucketed tables, settled before they are dropped."""
    stored = mart.store_mart(f"mart_{uuid.uuid4().hex}", members(spark, folder), transactions(spark, folder), lines(spark, folder), buckets=16)
    try:
        return settled(ask(stored))
    finally:
        mart.drop_mart(spark, stored)


@_q.add(duck(f"with {_TOTALS.format(lines='lines').strip()} {_REFRESHED}", "transactions", "lines"))
def transaction_totals_bucketed(spark: SparkSession, folder: str) -> DataFrame:
    """Basket totals from tables in buckets of the transaction: no row is exchanged."""
    return _with_mart(spark, folder, lambda m: sales.refresh_totals(mart.bucketed(spark, m.headers), mart.bucketed(spark, m.lines)))


@_q.add(duck("""
    select m.membership_id, m.first_name, m.last_name, count(t.transaction_id) as transaction_count,
      cast(sum(t.total_items_price) as decimal(22,2)) as total_spent
    from members m join transactions t using (membership_id) group by all
    order by total_spent desc, m.membership_id limit 10""", "members", "transactions"))
def top10_members_bucketed(spark: SparkSession, folder: str) -> DataFrame:
    """The ranking from tables in buckets of the member: only the ten best of each task move."""
    return _with_mart(spark, folder, lambda m: sales.members_by_spending(mart.bucketed(spark, m.members), mart.bucketed(spark, m.purchases)))


@_q.add(duck("""
    select i.item_id, i.cost as list_price, count(*) as lines, min(l.unit_cost_at_purchase) as min_paid,
      max(l.unit_cost_at_purchase) as max_paid
    from items i join lines l on l.item_id = i.item_id group by i.item_id, i.cost
    having min(l.unit_cost_at_purchase) <> i.cost or max(l.unit_cost_at_purchase) <> i.cost""", "items", "lines"))
def price_snapshot_drift(spark: SparkSession, folder: str) -> DataFrame:
    return sales.price_drift(items(spark, folder), lines(spark, folder))


@_q.add(duck("""
    select l.transaction_id, l.item_id, l.quantity, i.cost as unit_cost_at_purchase,
      i.weight_kg as unit_weight_at_purchase
    from lines l join items i on i.item_id = l.item_id""", "items", "lines"))
def price_snapshot_lines(spark: SparkSession, folder: str) -> DataFrame:
    basket = lines(spark, folder).select("transaction_id", "item_id", "quantity")
    return sales.snapshot_lines(basket, items(spark, folder))


# ---- Sampling and keys ------------------------------------------------------------


@_q.add(duck("""
    select manufacturer_name, item_id, weight, draw from (
      select manufacturer_name, item_id, cast(weight_kg as double) as weight, row_number() over (
        partition by manufacturer_name order by
          -ln((('0x' || substring(sha256('7|' || manufacturer_name || '|' || item_id), 1, 13))::bigint + 0.5::double)
            / 4503599627370496::double) / weight_kg::double, item_id) as draw
      from items) where draw <= 5""", "items"))
def weighted_sample_per_group(spark: SparkSession, folder: str) -> DataFrame:
    population = items(spark, folder).withColumn("weight", F.col("weight_kg").cast("double"))
    drawn = sampling.weighted_sample(population, ["manufacturer_name"], "item_id", "weight", k=5, seed=7)
    return drawn.withColumn("draw", F.col("draw").cast("long"))


@_q.add(duck("""
    select (select max(transaction_id) from transactions) + row_number() over (order by membership_id) as transaction_id,
      membership_id from members""", "members", "transactions"))
def assign_surrogate_ids(spark: SparkSession, folder: str) -> DataFrame:
    new = members(spark, folder).select("membership_id")
    return keys.append_with_ids(transactions(spark, folder), new, ["membership_id"], "transaction_id")


@_q.add(duck("""
    select manufacturer_name, row_number() over (order by manufacturer_name) as manufacturer_id
    from (select distinct manufacturer_name from items)""", "items"))
def manufacturer_dimension(spark: SparkSession, folder: str) -> DataFrame:
    return sales.manufacturer_dimension(items(spark, folder))


@_q.add(duck("""
    with dimension as (select manufacturer_name, row_number() over (order by manufacturer_name) as manufacturer_id
      from (select distinct manufacturer_name from items))
    select item_id, item_name, cost, weight_kg, manufacturer_id from items join dimension using (manufacturer_name)
    """, "items"))
def items_by_manufacturer_id(spark: SparkSession, folder: str) -> DataFrame:
    rows = items(spark, folder)
    return sales.items_with_manufacturer_id(rows, sales.manufacturer_dimension(rows))


# ---- Constraints ------------------------------------------------------------------


def _member_table(spark: SparkSession, folder: str) -> DataFrame:
    """All applications in the member layout, so that the constraints have something to find."""
    return cleaned(spark, folder).select(
        F.col("app_id").cast("string").alias("membership_id"), "first_name", "last_name", "email",
        F.col("birthday_date").alias("birthday"), "above_18", F.col("mobile_normalised").alias("mobile"),
    )


_MEMBER_TABLE = """
    member_table as (select cast(app_id as varchar) as membership_id, first_name, last_name, email,
      birthday_date as birthday, above_18, mobile_normalised as mobile from checked)"""


def _sales_tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return {"members": _member_table(spark, folder), "items": items(spark, folder),
            "transactions": transactions(spark, folder), "transaction_items": lines(spark, folder)}


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for other in frames[1:]:
        out = out.unionByName(other)
    return out


_DUCK_TABLES = {"members": "member_table", "items": "items", "transactions": "transactions", "transaction_items": "lines"}

_NULL_SQL = " union all ".join(
    f"select '{t}' as table_name, '{c}' as column_name, count(*) filter ({c} is null) as violations from {_DUCK_TABLES[t]}"
    for t, columns in integrity.REQUIRED_COLUMNS.items() for c in columns
)


@_q.add(duck(f"with {_MEMBER_TABLE.strip()} select * from ({_NULL_SQL}) n where violations > 0",
             "checked", "items", "transactions", "lines"))
def not_null_violations(spark: SparkSession, folder: str) -> DataFrame:
    given = _sales_tables(spark, folder)
    return _union([integrity.null_counts(given[t], t, c) for t, c in integrity.REQUIRED_COLUMNS.items()])


_PRIMARY_KEYS = {"members": ["membership_id"], "items": ["item_id"], "transactions": ["transaction_id"],
                 "transaction_items": ["transaction_id", "item_id"]}

_PK_SQL = " union all ".join(
    f"select '{t}' as table_name, concat_ws('/', {', '.join(k)}) as key, count(*) as copies from {_DUCK_TABLES[t]} "
    f"group by {', '.join(k)} having count(*) > 1" for t, k in _PRIMARY_KEYS.items()
)


@_q.add(duck(f"with {_MEMBER_TABLE.strip()} {_PK_SQL}", "checked", "items", "transactions", "lines"))
def pk_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    given = _sales_tables(spark, folder)
    return _union([
        integrity.duplicate_keys(given[t], key).select(
            F.lit(t).alias("table_name"), F.concat_ws("/", *[F.col(k).cast("string") for k in key]).alias("key"), "copies"
        ) for t, key in _PRIMARY_KEYS.items()
    ])


@_q.add(duck("""
    select item_name, manufacturer_name, count(*) as copies from items group by all having count(*) > 1""", "items"))
def unique_violations(spark: SparkSession, folder: str) -> DataFrame:
    return integrity.duplicate_keys(items(spark, folder), ["item_name", "manufacturer_name"])


_CHECK_SQL = {
    "members": {"mobile_is_8_digits": "regexp_full_match(mobile, '[0-9]{8}')",
                "above_18_matches_birthday": "above_18 = (birthday <= date '2003-01-01')"},
    "items": {"cost_non_negative": "cost >= 0", "weight_positive": "weight_kg > 0"},
    "transactions": {"total_price_non_negative": "total_items_price >= 0",
                     "total_weight_non_negative": "total_items_weight >= 0"},
    "transaction_items": {"quantity_positive": "quantity > 0", "unit_cost_non_negative": "unit_cost_at_purchase >= 0",
                          "unit_weight_positive": "unit_weight_at_purchase > 0"},
}

_CHECKS = " union all ".join(
    f"select '{t}' as table_name, '{name}' as check_name, count(*) filter (not ({test})) as violations from {_DUCK_TABLES[t]}"
    for t, tests in _CHECK_SQL.items() for name, test in tests.items()
)


@_q.add(duck(f"with {_MEMBER_TABLE.strip()} {_CHECKS}", "checked", "items", "transactions", "lines"))
def check_violations(spark: SparkSession, folder: str) -> DataFrame:
    given = _sales_tables(spark, folder)
    return _union([integrity.check_counts(given[t], t, c) for t, c in integrity.sales_checks().items()])


@_q.add(duck(f"""
    with {_MEMBER_TABLE.strip()}
    select membership_id, mobile, 'mobile_is_8_digits' as violated from member_table
    where not regexp_full_match(mobile, '[0-9]{{8}}')""", "checked"))
def check_violation_rows(spark: SparkSession, folder: str) -> DataFrame:
    checks = integrity.sales_checks()["members"]
    return integrity.violating_rows(_member_table(spark, folder), checks, ["membership_id", "mobile"])


@_q.add(duck("""
    select 'transactions.membership_id' as foreign_key, membership_id as orphan_key, count(*) as child_rows
    from transactions where membership_id not in (select cast(app_id as varchar) from accepted) group by all
    union all
    select 'transaction_items.transaction_id', cast(transaction_id as varchar), count(*) from lines
    where transaction_id not in (select transaction_id from transactions) group by all
    union all
    select 'transaction_items.item_id', cast(item_id as varchar), count(*) from lines
    where item_id not in (select item_id from items) group by all""", "accepted", "transactions", "lines", "items"))
def fk_orphans(spark: SparkSession, folder: str) -> DataFrame:
    headers, parts, sold = transactions(spark, folder), items(spark, folder), lines(spark, folder)
    onboarded = accepted(spark, folder).select(F.col("app_id").cast("string").alias("membership_id"))
    found = {
        "transactions.membership_id": integrity.orphans(headers, onboarded, "membership_id", "membership_id"),
        "transaction_items.transaction_id": integrity.orphans(sold, headers, "transaction_id", "transaction_id"),
        "transaction_items.item_id": integrity.orphans(sold, parts, "item_id", "item_id"),
    }
    return _union([
        f.select(F.lit(name).alias("foreign_key"), F.col("orphan_key").cast("string").alias("orphan_key"), "child_rows")
        for name, f in found.items()
    ])


@_q.add(duck("""
    select * from members where membership_id not in (select membership_id from transactions)""", "members", "transactions"))
def members_without_transactions(spark: SparkSession, folder: str) -> DataFrame:
    return integrity.without_children(members(spark, folder), transactions(spark, folder), "membership_id")


@_q.add(duck("""
    select * from members where membership_id not in
      (select membership_id from transactions where transaction_ts >= timestamp '2000-01-01')""", "members", "transactions"))
def members_without_transactions_since_2000(spark: SparkSession, folder: str) -> DataFrame:
    recent = transactions(spark, folder).where("transaction_ts >= timestamp_ntz '2000-01-01 00:00:00'")
    return integrity.without_children(members(spark, folder), recent, "membership_id")


@_q.add(duck("""
    select item_id, item_name, manufacturer_name, cost, weight_kg from items
    where item_id not in (select item_id from lines)""", "items", "lines"))
def items_never_sold(spark: SparkSession, folder: str) -> DataFrame:
    return integrity.without_children(items(spark, folder), lines(spark, folder), "item_id")


_EARLY = "transaction_ts < {} '1992-03-01 00:00:00'"


@_q.add(duck(f"""
    select item_id, item_name, manufacturer_name, cost, weight_kg from items where item_id not in
      (select item_id from lines join transactions using (transaction_id) where {_EARLY.format('timestamp')})""",
    "items", "lines", "transactions"))
def items_not_sold_before_march_1992(spark: SparkSession, folder: str) -> DataFrame:
    early = transactions(spark, folder).where(_EARLY.format("timestamp_ntz")).select("transaction_id")
    sold = lines(spark, folder).join(early, "transaction_id", "left_semi")
    return integrity.without_children(items(spark, folder), sold, "item_id")


@_q.add(duck("""
    select * from transactions where transaction_id not in (select transaction_id from lines)""", "transactions", "lines"))
def headers_without_lines(spark: SparkSession, folder: str) -> DataFrame:
    return integrity.without_children(transactions(spark, folder), lines(spark, folder), "transaction_id")


@_q.add(duck("""
    select item_id, count(*) as child_rows from lines
    where item_id in (select item_id from items where cost < 1000) group by item_id""", "items", "lines"))
def restrict_blocked_deletes(spark: SparkSession, folder: str) -> DataFrame:
    cheap = items(spark, folder).where("cost < 1000")
    return sales.blocked_deletes(cheap, lines(spark, folder), "item_id")


@_q.add(duck("""
    select transaction_id, item_id, line_number, quantity from lines where transaction_id not in
      (select transaction_id from transactions where transaction_ts < timestamp '1997-01-01')""", "lines", "transactions"))
def cascade_delete_lines(spark: SparkSession, folder: str) -> DataFrame:
    old = transactions(spark, folder).where("transaction_ts < timestamp_ntz '1997-01-01 00:00:00'")
    left = sales.cascade_delete(lines(spark, folder), old)
    return left.select("transaction_id", "item_id", "line_number", "quantity")


@_q.add(duck("""
    select t.transaction_id, coalesce(a.membership_id || '/' || a.app_id, t.membership_id) as membership_id,
      t.transaction_ts, t.total_items_price, t.total_items_weight
    from transactions t left join accepted a on cast(a.app_id as varchar) = t.membership_id""", "transactions", "accepted"))
def remap_member_ids(spark: SparkSession, folder: str) -> DataFrame:
    renamed = accepted(spark, folder).select(
        F.col("app_id").cast("string").alias("old_id"),
        F.concat_ws("/", "membership_id", F.col("app_id").cast("string")).alias("new_id"),
    )
    return sales.remap_members(transactions(spark, folder), renamed)
