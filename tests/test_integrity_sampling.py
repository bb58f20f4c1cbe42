"""Constraint reports, keep-first deduplication and weighted sampling."""

from collections import Counter
from datetime import date

from conftest import bag
from pyspark.sql import functions as F

from ledgerloom.operators import integrity, sampling
from ledgerloom.operators.applications import Rule


def test_null_counts_list_only_columns_with_nulls(spark):
    frame = spark.createDataFrame([(1, None, "x"), (None, None, "y")], "a int, b int, c string")
    assert bag(integrity.null_counts(frame, "t", ["a", "b", "c"])) == [("t", "a", 1), ("t", "b", 2)]


def test_duplicate_keys(spark):
    frame = spark.createDataFrame([(1, 1), (1, 1), (1, 2), (None, 1), (None, 1)], "a int, b int")
    assert bag(integrity.duplicate_keys(frame, ["a", "b"])) == [(1, 1, 2), (None, 1, 2)]


def test_orphans_ignore_null_keys_and_count_rows(spark):
    children = spark.createDataFrame([(1,), (1,), (2,), (None,)], "pid int")
    parents = spark.createDataFrame([(2,)], "id int")
    assert bag(integrity.orphans(children, parents, "pid", "id")) == [(1, 2)]
    assert bag(integrity.without_children(parents.withColumnRenamed("id", "pid"), children, "pid")) == []


def test_checks_report_rows_and_counts_and_pass_on_null(spark):
    frame = spark.createDataFrame([(1, 5, 5), (2, -1, 5), (3, -1, -1), (4, None, 1)], "id int, cost int, weight int")
    checks = [Rule("cost_ok", F.col("cost") >= 0), Rule("weight_ok", F.col("weight") > 0)]
    assert bag(integrity.violating_rows(frame, checks, ["id"])) == [(2, "cost_ok"), (3, "cost_ok;weight_ok")]
    assert bag(integrity.check_counts(frame, "t", checks)) == [("t", "cost_ok", 2), ("t", "weight_ok", 1)]


def test_member_checks(spark):
    rows = [("a", "12345678", True, date(2003, 1, 1)), ("b", "1234567", False, date(2003, 1, 2)),
            ("c", "12345678", True, date(2003, 1, 2)), ("d", "12345678\n", False, date(2010, 1, 1))]
    members = spark.createDataFrame(rows, "membership_id string, mobile string, above_18 boolean, birthday date")
    checks = integrity.sales_checks()["members"]
    assert bag(integrity.violating_rows(members, checks, ["membership_id"])) == [
        ("b", "mobile_is_8_digits"), ("c", "above_18_matches_birthday"), ("d", "mobile_is_8_digits")
    ]


def test_latest_adult_birthday_follows_the_reference(spark):
    one = spark.range(1)
    got = one.select(integrity.latest_adult_birthday(), integrity.latest_adult_birthday(date(2026, 5, 31))).first()
    assert tuple(got) == (date(2003, 1, 1), date(2007, 5, 31))


def test_seed_cuts_first_and_does_not_refill(spark):
    rows = spark.createDataFrame([(1, "a"), (2, "b"), (3, "a"), (4, "c"), (5, "d")], "pos int, membership_id string")
    assert bag(sampling.seed_members(rows, ["pos"], 4)) == [(1, "a"), (2, "b"), (4, "c")]
    assert bag(sampling.first_rows(rows, 2, ["pos"])) == [(1, "a"), (2, "b")]


def test_kept_and_dropped_rows_make_up_the_input(spark):
    rows = spark.range(2000).select(
        F.col("id").alias("pos"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 50)).alias("k")
    )
    kept, dropped = sampling.keep_first(rows, ["k"], ["pos"]), sampling.dropped_duplicates(rows, ["k"], ["pos"])
    assert kept.count() == 51
    assert bag(kept.unionByName(dropped)) == bag(rows)
    assert dict(map(reversed, bag(kept)))["hot"] == 0


def test_keep_first_limits_each_task_before_the_shuffle(spark):
    rows = spark.range(100).selectExpr("id as pos", "id % 3 as k")
    plan = sampling.keep_first(rows, ["k"], ["pos"])._jdf.queryExecution().executedPlan().toString()
    shuffle = plan.index("Exchange hashpartitioning")
    assert "WindowGroupLimit" in plan[shuffle:] and "Partial" in plan[shuffle:]


def test_weighted_sample_is_distinct_replayable_and_complete(spark):
    rows = spark.range(1000).selectExpr("id % 7 as g", "id as item", "1.0 + id % 5 as w")
    first, again = (bag(sampling.weighted_sample(rows, ["g"], "item", "w", 5, seed=3)) for _ in range(2))
    assert first == again
    assert Counter(r[0] for r in first) == {g: 5 for g in range(7)}
    assert len({r[1] for r in first}) == 35
    other = bag(sampling.weighted_sample(rows, ["g"], "item", "w", 5, seed=4))
    assert other != first


def test_weighted_sample_small_groups_and_zero_weights(spark):
    rows = spark.createDataFrame([(1, 1, 1.0), (1, 2, 0.0), (1, 3, None), (2, 4, 2.0)], "g int, item int, w double")
    assert sorted((r[0], r[1]) for r in bag(sampling.weighted_sample(rows, ["g"], "item", "w", 3))) == [(1, 1), (2, 4)]


def test_weights_decide_how_often_an_item_is_drawn(spark):
    # One draw from weights 1, 2 and 5 in each of 8000 groups.
    rows = spark.range(8000).selectExpr("id as g", "explode(array(1, 2, 5)) as item").withColumn("w", F.col("item").cast("double"))
    drawn = Counter(r.item for r in sampling.weighted_sample(rows, ["g"], "item", "w", 1, seed=1).collect())
    for item, expected in {1: 1000, 2: 2000, 5: 5000}.items():
        assert abs(drawn[item] - expected) < 0.1 * expected + 30


def test_uniform_draws_lie_inside_the_unit_interval(spark):
    draws = spark.range(20000).select(sampling.seeded_uniform(1, "id").alias("u")).agg(F.min("u"), F.max("u"), F.avg("u")).first()
    assert 0 < draws[0] < 0.001 and 0.999 < draws[1] < 1 and abs(draws[2] - 0.5) < 0.01


def test_position_differences(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y"), (3, "z")], "place int, id string")
    b = spark.createDataFrame([(1, "x"), (2, "z")], "place int, id string")
    assert bag(sampling.position_differences(a, a, "place")) == []
    assert bag(sampling.position_differences(a, b, "place")) == [(2, True, True), (3, True, False)]
