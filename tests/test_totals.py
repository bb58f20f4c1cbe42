"""Totals kept by signed changes, against totals of all lines."""

import random
from decimal import Decimal as D

import pytest

from ledgerloom.sources import totals as kept

LINE = "transaction_id long, quantity int, unit_cost_at_purchase decimal(10,2), unit_weight_at_purchase decimal(8,3)"
FEED = f"op string, before {kept.LINE_IMAGE}, after {kept.LINE_IMAGE}"


def plain(lines, touched=()):
    out = {t: [D("0.00"), D("0.000"), 0] for t in touched}
    for t, quantity, cost, weight in lines:
        row = out.setdefault(t, [D("0.00"), D("0.000"), 0])
        row[0] += quantity * cost
        row[1] += quantity * weight
        row[2] += 1
    return {t: tuple(r) for t, r in out.items()}


def found(frame):
    return {r.transaction_id: (r.price, r.weight, r.line_count) for r in frame.collect()}


def line(rng):
    return (rng.randrange(8), rng.randrange(1, 9), D(rng.randrange(1, 9999)) / 100, D(rng.randrange(1, 9999)) / 1000)


def changed(rng, lines):
    """A random feed over ``lines``, which are changed on the way."""
    feed = []
    for _ in range(12):
        op = rng.choice(["insert", "update", "delete"])
        old = lines.pop(rng.randrange(len(lines))) if op != "insert" and lines else None
        new = line(rng) if op != "delete" else None
        if new:
            lines.append(new)
        feed.append((op, old, new))
    return feed


def test_random_feeds_in_any_order_and_again(spark, tmp_path):
    rng, root = random.Random(4), str(tmp_path / "t")
    lines = [line(rng) for _ in range(30)]
    touched = {l[0] for l in lines}
    kept.create_totals(spark.createDataFrame(lines, LINE), root)
    assert found(kept.read_totals(spark, root)) == plain(lines)
    feeds = {n: spark.createDataFrame(changed(rng, lines), FEED) for n in range(1, 6)}
    for n in (2, 1, 2, 3):
        assert kept.apply_feed(spark, root, n, feeds[n])
    assert kept.fold_totals(spark, root) == 3
    assert not kept.apply_feed(spark, root, 2, feeds[2])
    for n in (5, 4, 5):
        assert kept.apply_feed(spark, root, n, feeds[n])
    for _ in range(2):
        now = found(kept.read_totals(spark, root))
        assert {t: v for t, v in now.items() if v[2]} == plain(lines)
        assert all(now[t] == (0, 0, 0) for t in now if not now[t][2]) and touched <= set(now)
        assert kept.broken_totals(kept.read_totals(spark, root)).count() == 0
        assert kept.fold_totals(spark, root) == 5
    assert sorted(p.name for p in (tmp_path / "t" / "base").iterdir()) == ["feed=3", "feed=5"]


def test_only_feeds_are_read(spark, tmp_path):
    root, table = str(tmp_path / "t"), str(tmp_path / "lines")
    spark.createDataFrame([(1, 2, D("5.00"), D("1.000")), (2, 1, D("7.00"), D("0.500"))], LINE).write.parquet(table)
    kept.create_totals(spark.read.parquet(table), root)
    feed = spark.createDataFrame([("update", (1, 2, D("5.00"), D("1.000")), (2, 2, D("5.00"), D("1.000")))], FEED)
    kept.apply_feed(spark, root, 1, feed)
    totals = kept.read_totals(spark, root)
    assert found(totals) == {1: (0, 0, 0), 2: (D("17.00"), D("2.500"), 2)}
    assert all("/t/" in f for f in totals.inputFiles()) and "lines" not in totals._jdf.queryExecution().executedPlan().toString().replace("line_count", "")
    assert found(kept.touched_totals(spark, root, 1)) == found(totals)


def test_feeds_that_cannot_be(spark, tmp_path):
    root, none = str(tmp_path / "t"), spark.createDataFrame([], FEED)
    with pytest.raises(FileNotFoundError):
        kept.read_totals(spark, root)
    kept.create_totals(spark.createDataFrame([(1, 2, D("5.00"), D("1.000"))], LINE), root)
    assert kept.touched_totals(spark, root, 1).count() == 0
    # A delete of a line that never was, and images that are null or belong to no transaction.
    bad = spark.createDataFrame([("delete", (9, 1, D("1.00"), D("1.000")), None), ("insert", None, None), ("insert", None, (None, 1, None, None)),
                                 ("insert", None, (1, None, None, None))], FEED)
    kept.apply_feed(spark, root, 1, bad)
    assert found(kept.broken_totals(kept.read_totals(spark, root))) == {9: (D("-1.00"), D("-1.000"), -1)}
    assert found(kept.read_totals(spark, root))[1] == (D("10.00"), D("2.000"), 2)
    kept.apply_feed(spark, root, 3, none)
    with pytest.raises(ValueError, match="gaps"):
        kept.fold_totals(spark, root)
    kept.apply_feed(spark, root, 2, none)
    assert kept.fold_totals(spark, root) == 3
    with pytest.raises(ValueError, match="base"):
        kept.touched_totals(spark, root, 2)
