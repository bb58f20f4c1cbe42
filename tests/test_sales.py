"""Rankings, totals and table maintenance of the sales mart."""

from decimal import Decimal as D

import pytest
from conftest import bag

from ledgerloom.operators import keys, sales

LINE = ("transaction_id long, item_id long, quantity int, unit_cost_at_purchase decimal(10,2), "
        "unit_weight_at_purchase decimal(8,3)")
HEADER = ("transaction_id long, membership_id string, transaction_ts timestamp_ntz, "
          "total_items_price decimal(12,2), total_items_weight decimal(10,3)")
ITEM = "item_id long, item_name string, manufacturer_name string, cost decimal(10,2), weight_kg decimal(8,3)"

# Seven published baskets: transaction 1, and the six of one member that sum to 5327.40.
BASKETS = {
    1: [(7, 3, "18.50", "0.340"), (18, 3, "74.50", "2.950")],
    36: [(7, 1, "18.50", "0.340"), (10, 2, "38.90", "0.395"), (13, 3, "159.00", "0.042"),
         (17, 3, "89.00", "0.240"), (18, 2, "74.50", "2.950")],
    65: [(7, 3, "18.50", "0.340"), (12, 3, "289.00", "3.400"), (15, 3, "29.90", "0.620"),
         (16, 3, "199.00", "12.500"), (18, 1, "74.50", "2.950")],
    85: [(7, 3, "18.50", "0.340"), (10, 3, "38.90", "0.395"), (15, 1, "29.90", "0.620"),
         (18, 1, "74.50", "2.950"), (19, 3, "179.00", "1.680")],
    92: [(3, 2, "64.50", "0.560"), (7, 1, "18.50", "0.340"), (10, 3, "38.90", "0.395"), (13, 3, "159.00", "0.042")],
    108: [(1, 3, "89.90", "0.058"), (2, 1, "219.00", "0.295"), (5, 1, "24.90", "1.420")],
    113: [(13, 2, "159.00", "0.042"), (17, 1, "89.00", "0.240"), (19, 1, "179.00", "1.680")],
}


def _lines(spark, baskets):
    rows = [(t, i, q, D(c), D(w)) for t, basket in baskets.items() for i, q, c, w in basket]
    return spark.createDataFrame(rows, LINE)


def _headers(spark, owners):
    from datetime import datetime

    rows = [(t, m, datetime(2026, 8, 1, 12), D("0.00"), D("0.000")) for t, m in owners.items()]
    return spark.createDataFrame(rows, HEADER)


@pytest.fixture(scope="module")
def golden(spark):
    owners = {t: ("Smith_c7677" if t == 1 else "Murphy_0851c") for t in BASKETS}
    lines = _lines(spark, BASKETS)
    members = spark.createDataFrame(
        [("Smith_c7677", "Patty", "Smith"), ("Murphy_0851c", "Amanda", "Murphy"), ("Lee_00000", "No", "Sale")],
        "membership_id string, first_name string, last_name string",
    )
    return members, sales.refresh_totals(_headers(spark, owners), lines), lines


def test_published_totals(golden):
    members, headers, lines = golden
    first = headers.where("transaction_id = 1").first()
    assert (first.total_items_price, first.total_items_weight) == (D("279.00"), D("9.870"))
    assert bag(sales.members_by_spending(members, headers)) == [
        ("Murphy_0851c", "Amanda", "Murphy", 6, D("5327.40")), ("Smith_c7677", "Patty", "Smith", 1, D("279.00"))
    ]
    assert sales.totals_mismatches(headers, lines).count() == 0


def test_members_without_purchases_rank_with_zero(golden):
    members, headers, _ = golden
    rows = {r.membership_id: (r.transaction_count, r.total_spent) for r in
            sales.all_members_by_spending(members, headers).collect()}
    assert rows["Lee_00000"] == (0, D("0.00")) and len(rows) == 3


def test_spending_ties_go_to_the_smaller_id(spark):
    members = spark.createDataFrame([("b", "B", ""), ("a", "A", ""), ("c", "C", "")],
                                    "membership_id string, first_name string, last_name string")
    headers = sales.refresh_totals(
        _headers(spark, {1: "b", 2: "a", 3: "c"}),
        _lines(spark, {1: [(1, 1, "5.00", "1")], 2: [(1, 1, "5.00", "1")], 3: [(1, 1, "9.00", "1")]}),
    )
    top = sales.members_by_spending(members, headers, top=2).collect()
    assert [r.membership_id for r in top] == ["c", "a"]


def test_item_rankings_by_baskets_and_by_units(spark):
    items = spark.createDataFrame([(i, f"item {i}", "M", D("1.00"), D("1.000")) for i in range(1, 5)], ITEM)
    lines = _lines(spark, {
        1: [(1, 1, "1", "1"), (2, 9, "1", "1")], 2: [(1, 1, "1", "1"), (1, 1, "2", "1")],
        3: [(3, 1, "1", "1")], 4: [(3, 1, "1", "1"), (4, 2, "1", "1")],
    })
    by_baskets = sales.items_by_purchases(items, lines).collect()
    assert [(r.item_id, r.times_bought, r.total_quantity) for r in by_baskets] == [(1, 2, 3), (3, 2, 2), (2, 1, 9)]
    by_units = sales.items_by_purchases(items, lines, rank_by="units").collect()
    assert [r.item_id for r in by_units] == [2, 1, 3]
    with pytest.raises(ValueError):
        sales.items_by_purchases(items, lines, rank_by="price")


def test_totals_follow_inserts_updates_deletes_and_moves(spark):
    headers = _headers(spark, {1: "a", 2: "a", 3: "b"})
    feed_schema = "op string, old_transaction_id long, new_transaction_id long"

    def step(state, baskets, *changes):
        out = sales.refresh_touched_totals(state, _lines(spark, baskets), spark.createDataFrame(changes, feed_schema))
        return out, {r.transaction_id: (str(r.total_items_price), str(r.total_items_weight)) for r in out.collect()}

    baskets = {1: [(1, 1, "10.00", "0.750"), (2, 2, "7.75", "0.750")]}
    headers, totals = step(headers, baskets, ("insert", None, 1), ("insert", None, 1))
    assert totals == {1: ("25.50", "2.250"), 2: ("0.00", "0.000"), 3: ("0.00", "0.000")}

    baskets[1][0] = (1, 3, "10.00", "0.750")
    headers, totals = step(headers, baskets, ("update", 1, 1))
    assert totals[1] == ("45.50", "3.750")

    baskets = {1: [baskets[1][0]], 2: [baskets[1][1]]}
    headers, totals = step(headers, baskets, ("update", 1, 2))
    assert totals == {1: ("30.00", "2.250"), 2: ("15.50", "1.500"), 3: ("0.00", "0.000")}

    headers, totals = step(headers, {2: baskets[2]}, ("delete", 1, None), ("delete", 99, None))
    assert totals == {1: ("0.00", "0.000"), 2: ("15.50", "1.500"), 3: ("0.00", "0.000")}


def test_untouched_headers_keep_even_a_wrong_total(spark):
    headers = _headers(spark, {1: "a", 2: "a"}).selectExpr(
        "transaction_id", "membership_id", "transaction_ts",
        "cast(999 as decimal(12,2)) as total_items_price", "total_items_weight")
    lines = _lines(spark, {1: [(1, 1, "5.00", "1")], 2: [(1, 1, "5.00", "1")]})
    feed = spark.createDataFrame([("insert", None, 2)], "op string, old_transaction_id long, new_transaction_id long")
    after = sales.refresh_touched_totals(headers, lines, feed)
    assert {r.transaction_id: str(r.total_items_price) for r in after.collect()} == {1: "999.00", 2: "5.00"}
    assert [r.transaction_id for r in sales.totals_mismatches(after, lines).collect()] == [1]


def test_snapshot_keeps_the_old_price(spark):
    items = spark.createDataFrame([(1, "x", "M", D("5.00"), D("1.000"))], ITEM)
    basket = spark.createDataFrame([(1, 1, 2)], "transaction_id long, item_id long, quantity int")
    lines = sales.snapshot_lines(basket, items)
    assert bag(lines) == [(1, 1, 2, D("5.00"), D("1.000"))]
    assert sales.price_drift(items, lines).count() == 0
    dearer = items.selectExpr("item_id", "item_name", "manufacturer_name", "cast(6 as decimal(10,2)) as cost", "weight_kg")
    assert bag(sales.price_drift(dearer, lines)) == [(1, D("6.00"), 1, D("5.00"), D("5.00"))]


def test_cascade_restrict_and_rename(spark):
    lines = _lines(spark, {1: [(1, 1, "1", "1")], 2: [(1, 1, "1", "1"), (2, 1, "1", "1")]})
    deleted = spark.createDataFrame([(2,)], "transaction_id long")
    assert [r.transaction_id for r in sales.cascade_delete(lines, deleted).collect()] == [1]
    to_delete = spark.createDataFrame([(1,), (3,)], "item_id long")
    assert bag(sales.blocked_deletes(to_delete, lines, "item_id")) == [(1, 2)]
    headers = _headers(spark, {1: "a", 2: "b"})
    renamed = spark.createDataFrame([("a", "z")], "old_id string, new_id string")
    moved = sales.remap_members(headers, renamed)
    assert moved.columns == headers.columns
    assert sorted(r.membership_id for r in moved.collect()) == ["b", "z"]


def test_monthly_revenue_uses_half_open_bounds(spark):
    rows = [(1, "a", "1996-01-31 23:59:59", "1.00"), (2, "a", "1996-02-01 00:00:00", "2.00"), (3, "a", "1996-03-01 00:00:00", "4.00")]
    headers = spark.createDataFrame(rows, "transaction_id long, membership_id string, ts string, p string").selectExpr(
        "transaction_id", "cast(ts as timestamp_ntz) as transaction_ts", "cast(p as decimal(12,2)) as total_items_price")
    assert bag(sales.monthly_revenue(headers, "1996-01-01", "1996-03-01")) == [
        ("1996-01", 1, D("1.00")), ("1996-02", 1, D("2.00"))
    ]


def test_surrogate_ids_are_dense_and_ordered(spark):
    names = spark.range(5000).selectExpr("concat('n', lpad(cast((id * 7919) % 5000 as string), 5, '0')) as name").repartition(13)
    rows = keys.assign_surrogate_ids(names, ["name"], "id", start_after=100).orderBy("name").collect()
    assert [r.id for r in rows] == list(range(101, 5101))


def test_ids_continue_after_the_highest(spark):
    new = spark.createDataFrame([("b",), ("a",)], "name string")
    existing = spark.createDataFrame([(41,), (7,)], "id long")
    assert bag(keys.append_with_ids(existing, new, ["name"], "id")) == [("a", 42), ("b", 43)]
    assert bag(keys.append_with_ids(existing.limit(0), new, ["name"], "id")) == [("a", 1), ("b", 2)]


def test_manufacturers_split_out_and_back(spark):
    items = spark.createDataFrame([(1, "x", "Basalt", D("5.00"), D("1.000")), (2, "y", "Aurora", D("5.00"), D("1.000")),
                                   (3, "z", "Basalt", D("5.00"), D("1.000"))], ITEM)
    dimension = sales.manufacturer_dimension(items)
    assert bag(dimension) == [("Aurora", 1), ("Basalt", 2)]
    swapped = sales.items_with_manufacturer_id(items, dimension)
    assert {r.item_id: r.manufacturer_id for r in swapped.collect()} == {1: 2, 2: 1, 3: 2}
    assert "manufacturer_name" not in swapped.columns


def test_items_without_manufacturer_keep_none(spark):
    items = spark.createDataFrame([(1, "a", "Zed", D("1"), D("1")), (2, "b", None, D("1"), D("1")), (3, "c", "Abe", D("1"), D("1"))], ITEM)
    dimension = sales.manufacturer_dimension(items)
    assert bag(dimension.select("manufacturer_name", "manufacturer_id")) == [("Abe", 1), ("Zed", 2)]
    swapped = sales.items_with_manufacturer_id(items, dimension)
    assert {r.item_id: r.manufacturer_id for r in swapped.collect()} == {1: 2, 2: None, 3: 1}
