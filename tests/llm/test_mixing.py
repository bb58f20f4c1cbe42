"""Targets, samples and copies against a plain walk through the order."""

from collections import Counter, defaultdict

import pytest
from conftest import SF
from hypothesis import given, settings, strategies as st

from corpus import awkward, none
from ledgerloom.llm import mixing as mx
from ledgerloom.llm.common import table


def plain_targets(sizes):
    """Shares by weight; what is above twice a source's size goes to the others until nothing is."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    total, target, open_ = 1.5 * sum(sizes.values()), {}, set(names)
    while open_:
        left = total - sum(target.values())
        share = {s: left * weight[s] / sum(weight[o] for o in open_) for s in open_}
        above = {s for s in open_ if share[s] > 2 * sizes[s] + 1e-9}
        if not above:
            return target | share
        target |= {s: 2 * sizes[s] for s in above}
        open_ -= above
    return target


@settings(deadline=None, max_examples=25)
@given(st.dictionaries(st.one_of(st.none(), st.sampled_from(["a", "b", "B", "é", "", "zz", "src10", "src2"])),
                       st.integers(0, 1000), min_size=1))
def test_targets(spark, sizes):
    frame = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, size long")
    found = {r.source: r.target for r in mx.source_targets(frame).collect()}
    expected = plain_targets(sizes)
    assert found.keys() == expected.keys()
    assert all(found[s] == pytest.approx(expected[s], abs=1e-6) for s in found)


def test_cuts_follow_the_order(spark):
    import random

    rng = random.Random(4)
    rows = [(s, need, rng.randint(0, 50), p) for s, need in (("a", 900.0), (None, 1.0), ("b", 10_000.0), ("c", 333.5), ("d", 0.0))
            for p in [rng.randint(0, (1 << 52) - 1) for _ in range(150)] + [7 << 38] * 3 + [(7 << 38) + i for i in range(40)]]
    found = {r.source: r.cut for r in mx.order_cuts(spark.createDataFrame(rows, "source string, need double, size long, place long")).collect()}
    for source in ("a", None, "b", "c"):
        own = [r for r in rows if r[0] == source]
        words, taken = 0, set()
        for place in sorted({r[3] for r in own}):
            more = sum(r[2] for r in own if r[3] == place)
            if words + more / 2 > own[0][1]:
                break
            words, taken = words + more, taken | {place}
        cut = found.get(source)
        assert {r[3] for r in own if cut is not None and r[3] <= cut} - taken <= {r[3] for r in own if r[2] == 0}
        assert taken <= {r[3] for r in own if cut is not None and r[3] <= cut}


def test_documents(spark):
    docs = table(spark, SF, "documents")
    rows = mx.mixed(docs).collect()
    assert len(rows) == docs.count()
    largest, taken, target = defaultdict(int), defaultdict(int), {}
    for r in rows:
        assert r.taken in (0, r.size, 2 * r.size) and r.taken >= int(r.target / r.source_size) * r.size
        largest[r.source] = max(largest[r.source], r.size)
        taken[r.source] += r.taken
        target[r.source] = r.target
    assert all(abs(taken[s] - target[s]) <= largest[s] / 2 + 1e-6 for s in target)
    assert sorted(rows) == sorted(mx.mixed(docs.repartition(5)).collect())
    copies = Counter(r.doc_id for r in mx.mixture(docs).collect())
    assert copies == Counter({r.doc_id: r.copies for r in rows if r.copies})


def test_inclusion_follows_the_odds(spark):
    docs = spark.range(4000).selectExpr(
        "id as doc_id", "'one two' as text", "case when id < 2000 then 'a' else 'b' end as source", "if(id % 2 = 0, 4.0, 1.0) as w")
    rows = mx.mixed(docs, preference="w", weights=(1.0,), share=0.5, most=1.0).collect()
    share = Counter(r.doc_id % 2 for r in rows if r.copies)
    assert sum(share.values()) == 2000 and share[0] > 1.7 * share[1]


@pytest.mark.parametrize("repeat", ["1 as doc_id, 'one two three four' as text", "1 as doc_id, concat('a b c ', id) as text",
                                    "cast(null as bigint) as doc_id, concat('a b c ', id) as text"])
def test_a_third_of_a_source_with_one_id(spark, repeat):
    """Rows of one id, with one text or different ones, are included each by itself."""
    docs = spark.range(0, 1000, 1, 5).selectExpr("*", "'a' as source", "if(id % 2 = 0, null, map('n', id)) as more").selectExpr(*repeat.split(", ", 1), "source", "more").unionByName(
        spark.range(1000, 3000).selectExpr("id as doc_id", "concat('x y z ', id) as text", "'a' as source", "map('n', id) as more"))
    for share, most in ((0.35, 2.0), (1.6, 2.0)):
        found = mx.mixed(docs, weights=(1.0,), share=share, most=most)
        rows = found.collect()
        assert len(rows) == 3000 and abs(sum(r.taken for r in rows) - rows[0].target) <= 2
        ones = [r.copies for r in rows if r.doc_id == 1 or r.doc_id is None]
        assert abs(sum(ones) - share * 1000) < 100
        kept = mx.mixture(docs, weights=(1.0,), share=share, most=most)
        assert kept.dtypes == docs.dtypes
        copies = Counter((r.doc_id, r.text) for r in kept.select("doc_id", "text").collect())
        assert sum(copies.values()) == sum(r.copies for r in rows)
        again = Counter((r.doc_id, r.text) for r in mx.mixture(docs.repartition(3), weights=(1.0,), share=share, most=most).select("doc_id", "text").collect())
        assert again == copies


def test_awkward_rows(spark):
    found = mx.mixed(awkward(spark)).collect()
    assert len(found) == 14 and {r.source for r in found} == {"a", "b", "c", None, "", "é"}
    assert {r.doc_id: r.size for r in found}[8] == 0 and all(r.taken <= 2 * r.size for r in found)
    docs = awkward(spark)
    assert mx.mixture(docs).schema == docs.schema
    assert mx.mixed(none(spark)).count() == 0 and mx.mixture(none(spark)).count() == 0
