"""Mergeable summaries against what they were made from."""

import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import summaries

EVENT = "dt date, source string, image_id string, status string, duration_ms long, bytes_in long"


def events(spark, rows):
    return spark.createDataFrame(rows, EVENT)


@pytest.fixture(scope="module")
def many(spark):
    rng = random.Random(8)
    rows = []
    for n in range(20_000):
        day = 1 + (0 if n % 3 == 0 else rng.randrange(20))  # one day holds a third of the rows
        rows.append((date(2024, 1, day), rng.choice(["api", "kafka"]), f"i{rng.randrange(3000)}",
                     rng.choice(["DONE", "DONE", "ERROR"]), int(rng.lognormvariate(6, 2)), rng.randrange(1000)))
    return rows


def test_rolled_up_twice_equals_the_rows(spark, many):
    daily = summaries.daily_summaries(events(spark, many).repartition(7), k=200)
    half = summaries.rolled_up(daily, {"dt": F.col("dt"), "source": F.lit("all")})
    told = summaries.summary_metrics(summaries.rolled_up(half, {"source": F.col("source")})).first()
    assert (told.images, told.failed, told.bytes_in) == (20_000, sum(r[3] == "ERROR" for r in many), sum(r[5] for r in many))
    distinct = len({r[2] for r in many})
    assert abs(told.distinct_images - distinct) <= 4 * summaries.distinct_error() * distinct
    durations = sorted(r[4] for r in many)
    for name, share in summaries.LATENCY_PERCENTILES.items():
        value, slack = told[name], 2 * summaries.rank_error(200) * len(durations) + 1
        assert sum(d < value for d in durations) <= share * len(durations) + slack
        assert sum(d <= value for d in durations) >= share * len(durations) - slack


def test_groups_without_durations_and_empty_tables(spark):
    rows = events(spark, [(date(2024, 1, 1), "api", None, None, None, None), (None, None, "a", "ERROR", 5, 2), (None, None, "a", "DONE", 7, None)])
    found = {r.dt: r for r in summaries.summary_metrics(summaries.daily_summaries(rows)).collect()}
    first, other = found[date(2024, 1, 1)], found[None]
    assert (first.images, first.failed, first.bytes_in, first.distinct_images) == (1, 0, 0, 0)
    assert all(first[n] is None for n in summaries.LATENCY_PERCENTILES)
    assert (other.images, other.failed, other.bytes_in, other.distinct_images) == (2, 1, 2, 1)
    assert all(other[n] in (5, 7) for n in summaries.LATENCY_PERCENTILES)
    assert summaries.summary_metrics(summaries.daily_summaries(rows.limit(0))).count() == 0


def _people(spark, low, high, side, batch):
    return spark.range(low, high).select(F.concat(F.lit("u"), "id").alias("email"), F.lit(side).alias("side"), F.lit(batch).alias("batch"))


def test_batches_merge_to_the_whole(spark):
    batches = [("accepted", 0, 30_000), ("accepted", 20_000, 50_000), ("rejected", 45_000, 90_000)]
    rows = [_people(spark, low, high, side, n) for n, (side, low, high) in enumerate(batches)]
    parts = [summaries.identity_sketches(r, ["batch", "side"], {"email": F.col("email")}) for r in rows]
    stored = parts[0].union(parts[1]).union(parts[2])
    merged = summaries.merged_identities(stored, ["side"], ["email"])
    assert {r.side: (r["rows"], r.email_rows) for r in merged.collect()} == {"accepted": (60_000, 60_000), "rejected": (45_000, 45_000)}
    got = summaries.overlap_estimate(merged, "side", ["accepted", "rejected"], "email").first()
    exact = {"accepted": 50_000, "rejected": 45_000, "either": 90_000, "both": 5_000}
    assert all(abs(got[n] - v) <= 4 * summaries.distinct_error() * exact["either"] for n, v in exact.items())
    whole = summaries.merged_identities(stored, [], ["email"]).select(F.hll_sketch_estimate("email_distinct").alias("n")).first().n
    assert abs(whole - 90_000) <= 4 * summaries.distinct_error() * 90_000


def test_small_sets_are_exact_and_missing_sides_empty(spark):
    rows = _people(spark, 0, 40, "accepted", 1).union(_people(spark, 30, 90, "rejected", 2))
    values = {"email": F.col("email")}
    both = summaries.overlap_estimate(summaries.identity_sketches(rows, ["side"], values), "side", ["accepted", "rejected"], "email")
    assert tuple(both.first()) == (40, 60, 90, 10)
    one = summaries.overlap_estimate(summaries.identity_sketches(rows.where("batch = 1"), ["side"], values), "side", ["accepted", "rejected"], "email")
    assert tuple(one.first()) == (40, 0, 40, 0)
    none = summaries.overlap_estimate(summaries.identity_sketches(rows.limit(0), ["side"], values), "side", ["accepted", "rejected"], "email")
    assert tuple(none.first()) == (0, 0, 0, 0)
