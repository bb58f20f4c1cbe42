"""Fingerprints: order, insertion, deletion, likeness, and the next document."""

import hashlib

import pytest
from corpus import awkward, none
from ledgerloom.llm import multiset_hash as mh
from pyspark.sql import functions as F


def prints(spark, *texts):
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    return [r.fingerprint for r in mh.with_fingerprint(rows).orderBy("doc_id").collect()]


def test_equal_multisets_of_paragraphs(spark):
    a, b, c, d, e, f = prints(spark, "one\ntwo\ntwo", "two\none\ntwo", "one\ntwo", "one\ntwo\ntwo\n", "", None)
    assert a == b and len({a, c, d, e}) == 4 and e == f and len(a) == 8 * (mh.EXACT + mh.LIKE)


def test_insertion_and_deletion(spark):
    row = spark.createDataFrame([("first. Second part\nx\nthird", "x\nmore here", "first. Second part\nx\nthird\nx\nmore here")], "a string, b string, ab string")
    a, b, ab = (mh.lanes_of(F.col(c)) for c in ("a", "b", "ab"))
    r = row.select(a.alias("own"), ab.alias("both"), mh.combined(a, b).alias("in_"), mh.without(ab, b).alias("out"),
                   mh.lanes_from(mh.fingerprint_text(a)).alias("read")).first()
    assert r.in_ == r.both and r.out == r.own == r.read


def test_likeness(spark):
    words = [f"Sentence number {i} says something of its own" for i in range(200)]
    whole, half, other = ". ".join(words), ". ".join(words[:100] + [w[::-1] for w in words[100:]]), ". ".join(w.upper() for w in words)
    rows = spark.createDataFrame([(whole, half, other)], "a string, b string, c string")
    a, b, c = (mh.lanes_of(F.col(x)) for x in "abc")
    r = rows.select(mh.likeness(a, a).alias("same"), mh.likeness(a, b).alias("half"), mh.likeness(a, c).alias("none"),
                    mh.likeness(mh.lanes_of(F.lit("")), a).alias("empty")).first()
    assert r.same == 1.0 and abs(r.half - 0.5) < 0.3 and r.none < 0.4 and r.empty == 0.0


@pytest.mark.parametrize("small", [mh.SMALL_RANGE_BYTES, 400])
@pytest.mark.parametrize("often", [mh.REPEATS, 1])
def test_next_document_over_ranges(spark, monkeypatch, small, often):
    monkeypatch.setattr(mh, "SMALL_RANGE_BYTES", small)
    monkeypatch.setattr(mh, "REPEATS", often)
    texts = [(i * 3, f"text {i} " * (i % 7)) for i in range(200)] + [(30, "again")] * 90 + [(None, "no id")] * 3 + [(31, None)]
    rows = spark.createDataFrame([(i, t, "x", 1) for i, t in texts], "doc_id long, text string, n string, range int")
    found = mh.edited_fingerprints(rows).collect()
    assert len(found) == len(texts)
    pairs = mh.with_next(rows).collect()
    order = sorted({(r.doc_id is None, r.doc_id or 0) for r in pairs})
    follows = {}
    for r in pairs:
        follows.setdefault(r.doc_id, []).append((r.text, r.next_text))
    for at, (missing, i) in enumerate(order):
        own = follows[None if missing else i]
        later = order[(at + 1) % len(order)]
        after = {t for t, _ in follows[None if later[0] else later[1]]}
        # The rows of an id form a chain: each text is followed by one of the id's, but one by the next id's.
        starts, ends = sorted(t for t, _ in own), [n for _, n in own]
        for t in starts:
            if t in ends:
                ends.remove(t)
        assert len(ends) == 1 and ends[0] in after


def test_edited_texts(spark):
    rows = spark.createDataFrame([(1, "abcdé"), (5, "\U0001F600y"), (3, "0123456789"), (9, "")], "doc_id int, text string")
    found = {r.doc_id: r for r in mh.edited_fingerprints(rows).collect()}
    assert [found[i].edited for i in (1, 3, 5, 9)] == ["abc01", "01234\U0001F600y", "\U0001F600", ""]
    assert [found[i].n_chars for i in (1, 3, 5, 9)] == [5, 10, 2, 0]
    assert found[9].near_edited == 1.0 and hashlib.sha256(found[1].edited.encode()).hexdigest()


def test_awkward_rows_and_no_python(spark):
    rows = awkward(spark)
    found = mh.edited_fingerprints(rows)
    assert found.count() == rows.count()
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in found.collect())
    assert mh.edited_fingerprints(none(spark)).count() == 0
    assert mh.with_fingerprint(rows.withColumn("fingerprint", F.lit(1))).columns[-1] == "fingerprint_"
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    alone = mh.edited_fingerprints(spark.createDataFrame([(1, "only one here")], "doc_id long, text string")).first()
    assert alone.edited == "only on" + "only o" and alone.near_next == 1.0
