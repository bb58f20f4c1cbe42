"""Shards: equal bytes, gapless slots, every row once."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from conftest import SF

from corpus import awkward, none
from ledgerloom.llm import sharding as sd
from ledgerloom.llm.common import table
from ledgerloom.llm.queries_layout import op10_histogram_shards


def size(text):
    return len((text or "").encode()) + 8


def check(docs, rows, shards, shard="shard", slot="slot"):
    assert Counter((r.doc_id, r.text) for r in docs) == Counter((r.doc_id, r.text) for r in rows)
    slots = defaultdict(list)
    for r in rows:
        slots[r[shard]].append(r[slot])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) <= set(range(shards))


@pytest.mark.parametrize("part_bytes", [1 << 30, 4096])
def test_documents(spark, part_bytes):
    docs = table(spark, SF, "documents").select("doc_id", "text")
    rows = sd.sharded(docs, shards=7, part_bytes=part_bytes).collect()
    check(docs.collect(), rows, 7)
    held, largest = Counter(), max(size(r.text) for r in rows)
    for r in rows:
        held[r.shard] += size(r.text)
    assert all(abs(b - sum(held.values()) / 7) <= largest for b in held.values())


@pytest.mark.parametrize("probes", [1, 3, 64])
def test_splitters_are_exact(spark, probes):
    random = np.random.default_rng(2)
    keys = np.concatenate([random.integers(0, (1 << 63) - 1, 3000), random.integers(5 << 40, (5 << 40) + 900, 2000), [77] * 400])
    sizes = random.integers(1, 40, len(keys))
    rows = spark.createDataFrame(list(zip(keys.tolist(), sizes.tolist())), "place long, size long")
    total = int(sizes.sum())
    cuts, below = sd.splitters(rows, 10, total, 0.001, probes)
    order = np.argsort(keys, kind="stable")
    for i, (cut, number) in enumerate(zip(cuts, below), 1):
        assert number == int((keys < cut).sum())
        held = [int(sizes[keys < k].sum()) for k in {cut, *keys.tolist()}]
        missed = abs(int(sizes[keys < cut].sum()) - total * i / 10)
        assert missed <= 0.001 * total / 10 or missed == pytest.approx(min(abs(h - total * i / 10) for h in [*held, total]))
    assert cuts == sorted(cuts) and len(order)


def test_a_third_of_the_rows_with_one_text(spark):
    docs = spark.range(3000).selectExpr("id as doc_id", "if(id % 3 = 0, 'the same text', concat('text ', id)) as text")
    rows = sd.sharded(docs, shards=10).collect()
    held = Counter()
    for r in rows:
        held[r.shard] += size(r.text)
    assert max(held.values()) < 1.02 * min(held.values())


@pytest.mark.parametrize("part_bytes", [1 << 30, 2048])
def test_a_third_of_the_rows_with_one_id_and_text(spark, part_bytes):
    """Rows that repeat id and text, some of them with other columns that differ."""
    docs = spark.range(9000).selectExpr("if(id % 3 = 0, 1, id) as doc_id", "if(id % 3 = 0, 'one two three', concat('text ', id)) as text",
                                        "if(id % 6 = 0, null, map('n', id)) as more", "id as number")
    rows = sd.sharded(docs, shards=24, part_bytes=part_bytes).collect()
    check(docs.collect(), rows, 24)
    assert sorted(r.number for r in rows) == list(range(9000))
    held = Counter()
    for r in rows:
        held[r.shard] += size(r.text)
    assert len(held) == 24 and max(held.values()) <= 1.02 * min(held.values())


def test_all_rows_equal(spark):
    docs = spark.range(2400).selectExpr("7 as doc_id", "'x' as text")
    held = Counter(r.shard for r in sd.sharded(docs).collect())
    assert len(held) == 24 and max(held.values()) <= 102 and min(held.values()) >= 98


def test_query(spark):
    texts = {r.doc_id: r.text for r in table(spark, SF, "documents").collect()}
    rows = op10_histogram_shards(spark, SF).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    assert all((r.size, r.text_crc32) == (size(texts[r.doc_id]), zlib.crc32(texts[r.doc_id].encode())) for r in rows)
    slots, held = defaultdict(list), Counter()
    for r in rows:
        slots[r.shard].append(r.slot)
        held[r.shard] += r.size
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) <= set(range(24))
    exact = sum(held.values()) / 24
    assert all(abs(held[n] - exact) <= max(r.size for r in rows) for n in range(24))
    assert {(r.law, r.grown_shard) for r in rows} == {("bytes", None)}


def test_awkward_rows(spark):
    docs = awkward(spark).drop("slot")
    found = sd.sharded(docs, shards=3)
    assert found.columns == [*docs.columns, "shard_", "slot"]
    check(docs.collect(), found.collect(), 3, "shard_")
    assert sd.sharded(none(spark)).count() == 0
    one = docs.limit(1)
    assert sd.sharded(one).count() == 1


def test_files(spark, tmp_path):
    path = str(tmp_path / "shards")
    sd.write_shards(sd.sharded(table(spark, SF, "documents").select("doc_id", "text"), shards=4), path)
    assert spark.read.parquet(path).groupBy("shard").count().count() == 4


def test_parts_are_found_once_for_each_row(spark):
    docs = table(spark, SF, "documents").select("doc_id", "text")
    plan = sd.sharded(docs, shards=7)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1
