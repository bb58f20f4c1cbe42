"""Kept runs compared by checksums."""

import random

import pytest
from conftest import bag

from ledgerloom.operators.quality import replay_difference
from ledgerloom.sources import replay

ROW = "name string, n int, tags array<string>, more map<string,string>"


def _frame(spark, rows):
    return spark.createDataFrame(rows, ROW)


def _rows(seed):
    rng = random.Random(seed)
    return [(rng.choice(["a", "b", None]), rng.choice([1, 2, None]), rng.choice([[], ["x"], None]), None) for _ in range(60)] + [
        (f"r{n}", n, [str(n)], None) for n in range(300)]


def _flat(spark, rows):
    return _frame(spark, rows).drop("more")


def test_equal_runs_are_told_by_checksums_alone(spark, tmp_path):
    rows = _rows(1)
    first, second = str(tmp_path / "a"), str(tmp_path / "b")
    replay.keep_run(_flat(spark, rows).repartition(5), first, buckets=16)
    replay.keep_run(_flat(spark, rows[::-1]).repartition(3), second, buckets=16)
    assert replay.differing_buckets(spark, first, second) == []
    difference = replay.kept_difference(spark, first, second)
    assert difference.count() == 0 and difference.inputFiles() == []


@pytest.mark.parametrize("seed", range(3))
def test_difference_equals_the_comparison_of_all_rows(spark, tmp_path, seed):
    rows = _rows(seed)
    changed = rows[3:] + [rows[50], rows[50], ("new", None, None, None), (None, None, ["new"], None)]
    first, second = str(tmp_path / "a"), str(tmp_path / "b")
    a, b = _flat(spark, rows), _flat(spark, changed)
    replay.keep_run(a, first, buckets=64)
    replay.keep_run(b, second, buckets=64)
    found = replay.kept_difference(spark, first, second)
    assert found.columns == replay_difference(a, b).columns and bag(found) == bag(replay_difference(a, b))
    buckets = replay.differing_buckets(spark, first, second)
    assert 0 < len(buckets) <= 8
    plan = found._jdf.queryExecution().executedPlan().toString()
    filters = [l for l in plan.splitlines() if "PartitionFilters" in l]
    assert len(filters) >= 2 and all("bucket" in l.split("PartitionFilters:")[1].split("PushedFilters")[0] for l in filters)


def test_nulls_and_places_of_values_count(spark):
    schema = "a string, b string"
    sums = [bag(replay.checksums(spark.createDataFrame(rows, schema), 1)) for rows in (
        [("x", None)], [(None, "x")], [("x", "")], [("x", None), ("x", None)], [], [("x", None)] * 3)]
    assert len({str(s) for s in sums}) == 6
    maps = replay.checksums(_frame(spark, [("x", 1, [], {"k": "v"})]), 4)
    assert maps.count() == 1


def test_empty_runs_and_refusals(spark, tmp_path):
    full, empty, other = (str(tmp_path / n) for n in "abc")
    rows = _flat(spark, _rows(1)[:5])
    replay.keep_run(rows, full, buckets=4)
    replay.keep_run(rows.limit(0), empty, buckets=4)
    assert sum(r.copies for r in replay.kept_difference(spark, full, empty).collect()) == 5
    assert replay.kept_difference(spark, empty, empty).count() == 0
    replay.keep_run(rows, other, buckets=8)
    with pytest.raises(ValueError, match="different numbers"):
        replay.differing_buckets(spark, full, other)
    with pytest.raises(ValueError, match="bucket"):
        replay.keep_run(rows.withColumnRenamed("n", "Bucket"), other)
