"""Benchmark passages: planted copies and paraphrases are found, other documents are left alone."""

import random

import numpy as np
import pytest
from conftest import SF

from corpus import awkward, none
from ledgerloom.llm import decontam as dc
from ledgerloom.llm.common import table

ITEMS = "item_id long, text string"


@pytest.fixture(scope="module")
def planted(spark):
    rng = random.Random(6)
    words = [a + b + c for a in ("ka", "mo", "ti", "re", "su", "ne", "bo", "fi", "gra", "lu")
             for b in ("lan", "dor", "vik", "sum", "p", "tes", "mir", "nok") for c in ("en", "a", "or", "is", "ul", "ing", "ato", "e")]

    def prose(n):
        return " ".join(rng.choice(words) + rng.choice(["", "", "", ",", "."]) for _ in range(n))

    items = [(i, prose(rng.randint(18, 90)) + ". Answer: " + prose(8)) for i in range(12)]
    items += [(90, ""), (91, None), (None, "no id here at all")]
    docs, expected = [], set()
    for n in range(300):
        text, kind, item = prose(rng.randint(0, 400)), n % 10, items[n % 12]
        if kind in (0, 1, 2):
            at = rng.randint(0, len(text))
            at = text.find(" ", at) if text.find(" ", at) >= 0 else len(text)
            body = item[1].split()
            if kind == 1:  # every seventh word goes, with changed case and signs
                body = [w.upper() + "!" for i, w in enumerate(body[:-9]) if i % 7] + body[-9:]
            if kind == 2:  # the answer is missing and a fifth of the words: no hit
                body = [w for i, w in enumerate(body[:-9]) if i % 5]
            else:
                expected.add((n, item[0]))
            text = text[:at] + " " + " ".join(body) + " " + text[at:]
        docs.append((n, text))
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, ITEMS), expected


def test_copies_and_paraphrases(planted):
    docs, items, expected = planted
    rows = dc.benchmark_hits(docs, items).collect()
    assert {(r.doc_id, r.item_id) for r in rows} == expected and len(rows) == len(expected)


def test_a_large_benchmark_is_searched_in_blocks(planted):
    docs, items, expected = planted
    rows = dc.benchmark_hits(docs, items, benchmark_bytes=900).collect()
    assert {(r.doc_id, r.item_id) for r in rows} == expected


def test_given_documents(spark):
    docs, items = table(spark, SF, "documents"), table(spark, SF, "benchmark")
    found = {(r.doc_id, r.item_id) for r in dc.benchmark_hits(docs, items).collect()}
    plain = {r.item_id: b" " + b" ".join(dc.normal_words(r.text)) + b" " for r in items.collect()}
    texts = {r.doc_id: b" " + b" ".join(dc.normal_words(r.text)) + b" " for r in docs.collect()}
    assert found == {(d, i) for d, t in texts.items() for i, p in plain.items() if p in t} and found
    left = dc.without_benchmark(docs, items)
    assert {r.doc_id for r in left.collect()} == set(texts) - {d for d, _ in found} and left.schema == docs.schema


def test_sums():
    rng = np.random.default_rng(1)
    table_, rows = rng.normal(size=(50, 3)), rng.integers(0, 50, 400)
    block = np.sort(rng.integers(0, 90, 400))
    expected = np.zeros((95, 3))
    np.add.at(expected, block, table_[rows])
    assert np.allclose(dc._sums(table_, rows, block, 95), expected)
    total, by_term = np.zeros((7, 3)), np.zeros((7, 3))
    terms = rng.integers(0, 5, 400)
    dc._add_by_term(total, table_, rows, terms)
    np.add.at(by_term, terms, table_[rows])
    assert np.allclose(total, by_term)
    empty = np.zeros(0, np.int64)
    assert dc._sums(table_, empty, empty, 2).sum() == 0


def test_common_order():
    rng = random.Random(3)
    for _ in range(200):
        a, b = ([rng.randint(0, 4) for _ in range(rng.randint(1, 20))] for _ in range(2))
        table_ = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table_[i + 1][j + 1] = table_[i][j] + 1 if x == y else max(table_[i][j + 1], table_[i + 1][j])
        assert dc._common_order(dc._masks(np.array(a)), len(a), b) == table_[-1][-1]


def test_answers():
    assert dc.answer_words("What is it? Answer: Forty two.") == [b"forty", b"two"]
    assert dc.answer_words("First one. Then the last one.") == [b"then", b"the", b"last", b"one"]
    assert dc.answer_words("a b c d e f") == [b"e", b"f"] and dc.answer_words("") == []


def test_the_sketch_finds_the_leading_space(planted, spark):
    """One-pass SVD against the exact one of all passages: nearly the same variance is kept."""
    from pyspark.sql import functions as F

    docs, items, _ = planted
    some = dc.read_items([(r.item_id, r.text) for r in items.collect()])
    rows = docs.select(F.lit(0).cast("long").alias("row_key"), "doc_id", "text")
    found = dc.stored(rows.mapInArrow(dc._term_finder(some.terms), "row_key long, doc_id long, n_words int, places array<int>, terms array<int>"), "t")
    weights, table_ = dc.latent_space(found, some, 300, rank=40)
    passages = []
    for r in found.collect():
        blocks = max(1, -(-r.n_words // dc.BLOCK_WORDS))
        for k in range(max(1, blocks - 1)):
            v = np.zeros(len(some.terms))
            for p, t in zip(r.places, r.terms):
                if k * dc.BLOCK_WORDS <= p < (k + 2) * dc.BLOCK_WORDS:
                    v[t] += weights[t]
            mass = np.sqrt(sum(weights[t] ** 2 for p, t in zip(r.places, r.terms) if k * dc.BLOCK_WORDS <= p < (k + 2) * dc.BLOCK_WORDS))
            if mass:
                passages.append(v / mass)
    own, _ = dc._item_rows(some, weights, 0)
    scale = np.sqrt(dc.ITEM_MASS * max(1.0, len(passages) / len(own)))
    for words, values in own:
        v = np.zeros(len(some.terms))
        np.add.at(v, words, values)
        passages.append(scale * v)
    matrix = np.array(passages)
    basis = table_ / weights[:, None]
    assert np.allclose(basis.T @ basis, np.eye(basis.shape[1]), atol=1e-6)
    best = (np.linalg.svd(matrix, compute_uv=False)[:40] ** 2).sum()
    assert (np.linalg.norm(matrix @ basis) ** 2) > 0.75 * best


def test_awkward_rows(spark, planted):
    docs = awkward(spark)
    assert dc.without_benchmark(docs, planted[1]).schema == docs.schema
    assert dc.benchmark_hits(none(spark), planted[1]).count() == 0
    assert dc.without_benchmark(docs, spark.createDataFrame([], ITEMS)).count() == 14
    own = spark.createDataFrame([(1, "the same text twice over")], ITEMS)
    assert {r.doc_id for r in dc.benchmark_hits(docs, own).collect()} == {6, 7}
    assert dc.without_benchmark(docs, own).count() == 12


def test_each_region_is_judged_by_itself(spark):
    """A longer quote without the answer does not hide a shorter one with it."""
    rng = random.Random(3)
    words = [f"{a}{b}" for a in ("ka", "mo", "ti", "re", "su", "ne") for b in ("lan", "dor", "vik", "sum", "tes", "mir", "nok")]
    body, answer = rng.sample(words, 32), ["graen", "luor", "fipis", "bolul", "nesato", "tivike", "modora", "kasumen"]
    filler = " ".join(f"w{n}" for n in range(400))
    item = " ".join(body) + ". Answer: " + " ".join(answer)
    quote = " ".join(body)  # 32 of 40 words, none of the answer
    paraphrase = " ".join(w for n, w in enumerate(body) if n % 8 not in (1, 4, 6)) + " " + " ".join(answer)  # 28 of 40 words
    docs = [(1, f"{quote} {filler} {paraphrase}"), (2, f"{paraphrase} {filler} {quote}"), (3, f"{quote} {filler}")]
    docs += [(n, filler) for n in range(4, 100)]  # all words of the item are about as rare
    found = dc.benchmark_hits(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(7, item)], ITEMS)).collect()
    assert {r.doc_id for r in found} == {1, 2}
    assert all(r.answer_share == 1 and 0.6 <= r.order_share < 0.8 for r in found)


def test_short_copies_of_a_large_benchmark(spark):
    """Copies of 15 to 20 words among thousands of items, in long documents, are all found."""
    rng = random.Random(11)
    words = [f"{a}{b}{c}" for a in ("ka", "mo", "ti", "re", "su", "ne", "bo", "fi") for b in ("lan", "dor", "vik", "sum", "p", "tes", "mir", "nok")
             for c in ("en", "a", "or", "is", "ul", "ing", "ato", "e", "is", "um", "ax")]
    words = [w + end for end in ("", "x", "y") for w in words]
    shares = [1 / (n + 3) for n in range(len(words))]  # as in texts, few words are most of the text
    items = [(i, " ".join(rng.choices(words, shares, k=rng.randint(15, 59) if i % 4 else rng.randint(15, 20)))) for i in range(2400)]
    docs, planted = [], set()
    for n, (i, text) in enumerate(items[::4]):
        before, after = (" ".join(rng.choices(words, shares, k=rng.randint(100, 200))) for _ in range(2))
        docs.append((n, f"{before} {text} {after}"))
        planted.add((n, i))
    found = dc.benchmark_hits(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, ITEMS)).collect()
    found = {(r.doc_id, r.item_id) for r in found}
    assert found <= planted and len(found) >= 0.99 * len(planted), (len(found), len(planted))


def test_shared_words_bound_the_common_order(monkeypatch):
    """The bound equals a count with multiplicities, in its dense and its sparse form, and never falls below the subsequence."""
    rng = random.Random(6)
    words = [tuple(rng.randrange(12) for _ in range(rng.randrange(1, 20))) for _ in range(9)]
    items = dc.Items(tuple(range(9)), tuple(np.array(w, np.int32) for w in words), tuple(np.array(w[-2:], np.int32) for w in words),
                           {bytes([t]): t for t in range(12)})
    terms = np.array([rng.randrange(12) for _ in range(400)], np.int32)
    left = np.array([rng.randrange(380) for _ in range(200)])
    right = left + np.array([rng.randrange(20) for _ in range(200)])
    item = np.array([rng.randrange(9) for _ in range(200)])
    for limit in (1 << 24, 0):
        monkeypatch.setattr(dc, "_DENSE", limit)
        for pairs in (1 << 18, 7):
            monkeypatch.setattr(dc, "_REGION_WORDS", pairs)
            bound = dc.SharedWords(items)
            for least in range(1, 12):
                found = bound.reach(terms, left, right, item, np.full(200, least))
                for a, b, i, hit in zip(left, right, item, found):
                    region = terms[a:b].tolist()
                    shared = sum(min(region.count(t), words[i].count(t)) for t in set(region))
                    assert hit == (shared >= least)
                    assert hit or dc._common_order(dc._masks(items.words[i]), len(words[i]), region) < least


def test_no_rows_need_no_python(spark):
    docs = table(spark, SF, "documents")
    hits = dc.benchmark_hits(docs, spark.createDataFrame([(1, "")], ITEMS).where("item_id > 1"))
    assert "ExistingRDD" not in hits._jdf.queryExecution().executedPlan().toString()
    assert hits.collect() == [] and hits.schema.simpleString() == (
        "struct<row_key:bigint,doc_id:bigint,item_id:bigint,cosine:double,order_share:double,answer_share:double>")
    assert all(f.nullable for f in hits.schema)
