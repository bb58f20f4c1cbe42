"""Stored tables: buckets without exchanges, months by a calendar, days by their names."""

import random
import uuid
from decimal import Decimal as D

import pytest
from conftest import bag
from pyspark.sql import functions as F

from ledgerloom.operators import sales
from ledgerloom.sources import mart, tables


def _tables(spark, hot=False):
    rng = random.Random(1)
    baskets = [(n, "m0" if hot and n % 3 else f"m{rng.randrange(60)}", "2024-01-01 10:00:00", D(n) / 4, D("0.000")) for n in range(900)]
    lines = [(rng.randrange(900), n, rng.randrange(1, 5), D(rng.randrange(1, 999)) / 100, D("0.250")) for n in range(3000)]
    return (
        spark.createDataFrame([(f"m{n}", "A", "B") for n in range(60)], "membership_id string, first_name string, last_name string"),
        spark.createDataFrame(baskets, "transaction_id long, membership_id string, transaction_ts string, total_items_price decimal(12,2), "
                                       "total_items_weight decimal(10,3)"),
        spark.createDataFrame(lines, "transaction_id long, item_id int, quantity int, unit_cost_at_purchase decimal(10,2), "
                                     "unit_weight_at_purchase decimal(8,3)"),
    )


@pytest.fixture
def stored(spark):
    made = []

    def store(hot=False, buckets=8):
        found = mart.store_mart(f"t_{uuid.uuid4().hex}", *_tables(spark, hot), buckets=buckets)
        made.append(found)
        return found

    # Small sides would be broadcast; at scale they are not.
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield store
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    for found in made:
        mart.drop_mart(spark, found)


def _plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_bucketed_joins_move_nothing(spark, stored):
    members, transactions, lines = _tables(spark)
    m = stored()
    totals = sales.refresh_totals(mart.bucketed(spark, m.headers), mart.bucketed(spark, m.lines))
    assert "Exchange" not in _plan(totals) and "SortMergeJoin" in _plan(totals)
    plain = sales.refresh_totals(transactions, lines)
    assert "Exchange" in _plan(plain) and bag(totals.select(plain.columns)) == bag(plain)
    best = sales.members_by_spending(mart.bucketed(spark, m.members), mart.bucketed(spark, m.purchases))
    assert "Exchange" not in _plan(best) and "TakeOrdered" in _plan(best)
    assert best.collect() == sales.members_by_spending(members, transactions).collect()


def test_a_hot_member_is_read_the_usual_way(spark, stored):
    members, transactions, _ = _tables(spark, hot=True)
    m = stored(hot=True)
    best = sales.members_by_spending(mart.bucketed(spark, m.members), mart.bucketed(spark, m.purchases))
    assert "Exchange" in _plan(best)
    assert best.collect() == sales.members_by_spending(members, transactions).collect()


def test_empty_tables(spark, stored):
    name = f"t_{uuid.uuid4().hex}_headers"
    mart.store_bucketed(_tables(spark)[1].limit(0), name, "transaction_id", 4)
    assert mart.bucketed(spark, name).count() == 0
    spark.sql(f"DROP TABLE {name}")


def test_months_are_picked_at_run_time(spark, tmp_path):
    root = str(tmp_path / "by-month")
    rows = spark.range(400).select(F.col("id").alias("transaction_id"), F.expr("timestamp_ntz'1995-01-01' + make_interval(0, 0, 0, cast(id as int) * 5)").alias("transaction_ts"))
    tables.write_by_month(rows, root)
    calendar = tables.calendar_months(spark, "1994-01", "2001-12")
    assert calendar.count() == 96 and calendar.where("month = '1996-08'").first().quarter == "1996-Q3"
    calendar.write.parquet(str(tmp_path / "calendar"))
    found = tables.read_months_of(spark, root, spark.read.parquet(str(tmp_path / "calendar")), F.col("quarter") == "1996-Q3")
    assert "dynamicpruning" in _plan(found)
    expected = rows.where("transaction_ts >= '1996-07-01' and transaction_ts < '1996-10-01'")
    assert bag(found.select(*rows.columns)) == bag(expected) and {r.month for r in found.collect()} == {"1996-07", "1996-08", "1996-09"}


def test_days_are_found_by_name_without_a_listing(spark, tmp_path):
    root = tmp_path / "days"
    for n in range(3000):
        (root / f"dt={tables.date(2016, 1, 1) + tables.timedelta(n)}").mkdir(parents=True)
    rows = spark.range(10).select("id", F.expr("date'2018-02-25' + cast(id as int)").alias("dt")).where("id <> 3")
    tables.write_by_day(rows, str(root))
    # A listing of the table would fail on this folder.
    (root / "dt=2017-01-01" / "stray=1").mkdir()
    (root / "dt=2017-01-01" / "stray=1" / "part-0.parquet").write_text("not a table")
    found = tables.read_days(spark, str(root), "2018-02-26", "2018-03-04")
    assert bag(found) == bag(rows.where("id between 1 and 7")) and dict(found.dtypes)["dt"] == "date"
    # The 28th was never written but has an empty folder.
    assert len(tables.day_folders(spark, str(root), "2018-02-26", "2018-03-04")) == 7
    assert len(tables.day_folders(spark, str(root), "2030-01-01", "2030-01-31")) == 0
    assert tables.read_days(spark, str(root), "2030-01-01", "2030-01-31", "id long").count() == 0
    assert tables.read_days(spark, str(tmp_path / "none"), "2030-01-01", "2030-01-31", "id long").columns == ["id", "dt"]
    assert tables.read_days(spark, str(root), "2018-03-04", "2018-03-01", "id long").count() == 0
