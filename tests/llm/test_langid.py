"""Held-out accuracy, calibration and rejection."""

import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from corpus import awkward, none
from ledgerloom.llm import langid as li
from ledgerloom.llm.common import fold, table
from ledgerloom.llm.queries_text import op6_language_id

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    labels = {r.doc_id: r.lang for r in table(spark, SF, "documents").collect()}
    rows = op6_language_id(spark, SF).collect()
    assert len(rows) == len(labels) and all(0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out]
    right = np.mean([r.lang_pred == labels[r.doc_id] for r in held])
    assert right >= 0.95 and abs(np.mean([r.score for r in held]) - right) < 0.05
    assert np.mean([r.rejected for r in rows]) < 0.01
    assert sorted(rows) == sorted(op6_language_id(spark, SF).collect())


def test_only_the_text_decides(spark):
    docs = table(spark, SF, "documents")
    model = li.train(docs.where(fold(F.col("doc_id"), 5) != 0))
    some = docs.limit(50)
    plain = {r.doc_id: r.identified for r in li.identified(some, model).collect()}
    changed = some.withColumn("lang", F.lit("xx")).withColumn("source", F.lit(None).cast("string"))
    assert plain == {r.doc_id: r.identified for r in li.identified(changed, model).collect()}


def test_blocks_do_not_change_the_counts(monkeypatch):
    text = "Größe und Maß, 3 Äpfel! " * 200
    whole = li.subword_counts(text)
    monkeypatch.setattr(li, "_BLOCK", 50)
    split = li.subword_counts(text)
    # Only the gap between blocks is counted twice, as the end of one and the start of the next.
    assert np.abs(whole - split).sum() <= 0 and whole.sum() > 0


def test_subwords_stay_inside_words():
    assert li.subword_counts("ab").sum() == 2 + 3 + 2 + 1  # a b | _a ab b_ | _ab ab_ | _ab_
    assert li.subword_counts("1 2 !").sum() == 0 and (li.subword_counts("A b") == li.subword_counts("a, B")).all()


def test_bounded_sample(spark):
    docs = spark.range(500).selectExpr("concat('wort ', id) as text", "if(id % 5 = 0, 'aa', 'bb') as lang")
    repeated = docs.union(docs).union(docs)
    assert li.train(docs, per_language=20).table.tolist() == li.train(repeated.repartition(3), per_language=20).table.tolist()


def test_copies_do_not_shrink_the_sample(spark):
    docs = spark.range(60).selectExpr("concat('wort ', id) as text", "if(id % 2 = 0, 'aa', 'bb') as lang")
    copies = spark.range(5000).selectExpr("'wort 0' as text", "'aa' as lang")
    assert li.train(docs, per_language=20).table.tolist() == li.train(docs.union(copies), per_language=20).table.tolist()


def test_awkward_rows(spark):
    docs = awkward(spark)
    model = li.train(docs)
    assert model.languages == ("de", "en")
    found = {r.doc_id: r.identified for r in li.identified(docs, model).collect()}
    assert all(found[i] == ("und", 0.0, True) for i in (1, 2, 8, 9, 11))
    assert found[5].lang == "de" and found[3].lang in model.languages
    empty = li.train(none(spark))
    assert empty.languages == () and li.identified(none(spark), empty).count() == 0
    assert {r.identified.lang for r in li.identified(docs, empty).collect()} == {"und"}


def test_features_are_packed_text_by_text():
    texts = [f"Wort {n} von vielen" for n in range(250)]
    list(li._featurizer(iter([pa.array(texts[:1])])))  # what is imported on first use does not count
    tracemalloc.start()
    try:
        (packed,) = li._featurizer(iter([pa.array(texts)]))
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    # The counts of all buckets of 250 texts would be 64 MB.
    assert most < 16 << 20
    for text, row in zip(texts, packed.to_pylist()):
        buckets, often = np.frombuffer(row, "<i4").reshape(2, -1)
        counts = li.subword_counts(text)
        assert buckets.tolist() == np.flatnonzero(counts).tolist() and often.tolist() == counts[buckets].tolist()
