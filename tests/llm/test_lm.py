"""Language-model scores: exact base counts, a proper distribution, better than the base on unseen text."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpus import awkward, none
from ledgerloom.llm import lm
from ledgerloom.llm.common import fold, table
from ledgerloom.llm.queries_models import op9_context_mixing

SF = "/root/testdata/sf0.01"


def tokens(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", lowered), None]


def check_base(docs, rows):
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in docs}
    counts = Counter(t for i, x in docs.items() if not held[i] for t in tokens(x))
    total, weight = sum(counts.values()), math.log10(sum(counts.values()) + len(counts) + 1)
    assert len(rows) == len(docs)
    for r in rows:
        own = tokens(docs[r.doc_id])
        assert (r.held_out, r.n_tokens, r.train_tokens) == (held[r.doc_id], len(own), total)
        assert r.n_known == sum(counts[t] > 0 for t in own)
        assert r.base_score == pytest.approx(sum(math.log10(counts[t] + 1) - weight for t in own), rel=1e-9)
        assert r.score < 0 and r.bits_per_byte > 0


def test_query(spark):
    docs = {r.doc_id: r.text for r in table(spark, SF, "documents").collect()}
    rows = op9_context_mixing(spark, SF).collect()
    check_base(docs, rows)
    assert sum(r.bits_per_byte < 3 for r in rows) > 0.9 * len(rows)
    again = {r.doc_id: r.score for r in op9_context_mixing(spark, SF).collect()}
    assert all(r.score == pytest.approx(again[r.doc_id], rel=1e-3) for r in rows)


def test_better_than_the_base_on_unseen_documents(spark):
    held = op9_context_mixing(spark, "/root/testdata/sf0.1").where("held_out").agg(F.sum("score").alias("s"), F.sum("base_score").alias("b")).first()
    assert held.s > 0.98 * held.b


def test_words_beyond_the_head_are_joined(spark):
    docs = table(spark, SF, "documents").limit(150).withColumn("held_out", fold(F.col("doc_id"), 7) == 2)
    docs = spark.createDataFrame(docs.collect(), docs.schema)
    rows = lm.scored(docs, docs.where(~F.col("held_out")), head_words=40).collect()
    check_base({r.doc_id: r.text for r in docs.collect()}, rows)


def test_a_foreign_text_costs_more(spark):
    docs = table(spark, SF, "documents").select("doc_id", "text").withColumn("held_out", F.lit(False))
    text = docs.orderBy(F.length("text").desc()).first().text[:2000]
    import random

    letters = list(text)
    random.Random(1).shuffle(letters)
    asked = spark.createDataFrame([(1, text, True), (2, "".join(letters), True)], "doc_id long, text string, held_out boolean")
    bits = {r.doc_id: r.bits_per_byte for r in lm.scored(asked, docs).collect()}
    assert bits[1] < 0.8 * bits[2]


def test_probabilities_of_next_bytes_add_up(spark):
    docs = table(spark, SF, "documents").limit(200)
    words = lm.stored(lm.word_counts(docs, lm.text_classes(docs)), "words")
    model = lm.fit(words)
    # All continuations of a prefix by one byte share its probability.
    for prefix in (b"", b"th", b"zq"):
        data = [prefix + bytes([b]) for b in range(256) if b != 32] + [prefix]
        spelt = lm.spell(data, np.zeros(len(data), np.int64), model.code)
        chances, shared = 0.0, sum(model.code.lengths[list(prefix)]) if prefix else 0
        logs = np.log(model.chances(spelt))
        for word, first in zip(data, spelt.first):
            last = word[-1] if len(word) > len(prefix) else 32
            chances += np.exp(logs[first + shared:first + shared + model.code.lengths[last]].sum())
        assert chances == pytest.approx(1, abs=1e-3)


@pytest.mark.parametrize("counts", [np.zeros(256), np.arange(256) ** 3, np.eye(256)[65] * 10**9])
def test_byte_code_is_a_code(counts):
    code = lm.byte_code(counts)
    paths = {tuple(zip(code.nodes[b, :n], code.bits[b, :n])) for b, n in enumerate(code.lengths)}
    assert len(paths) == 256 and sum(2.0 ** -n for n in code.lengths) == pytest.approx(1)


def test_every_token_teaches_every_predictor(spark):
    """Words beyond any fixed number count, with their counts, and the tables grow with them."""
    def some(n):
        columns = ["concat(substring(md5(cast(id as string)), 1, 7), '') as word", "id % 3 + 1 as n0"]
        return lm.stored(spark.range(n).selectExpr(*columns, *[f"0L as n{c}" for c in range(1, lm.CLASSES)]), "words")

    code = lm.byte_code(np.ones(256))
    few, many = some(500), some(60_000)
    small, large = lm.table_sizes(few, code), lm.table_sizes(many, code)
    assert all(s <= l for s, l in zip(small, large)) and large[-1] >= small[-1] + 3
    code = lm.replace(code, sizes=large)
    tables = lm.bit_tables(many, code)
    decisions = sum(r.n0 * (code.lengths[list(r.word.encode())].sum() + code.lengths[32]) for r in many.collect())
    assert tables.sum(dtype=np.float64) == decisions * lm.PREDICTORS
    # Few words share a slot by chance: most of the last table is free.
    assert 0.2 < tables[-(1 << large[-1]):].any(1).mean() < 0.7


def test_copies_of_a_starting_text_stay_in_the_tasks(spark, monkeypatch):
    docs = spark.range(900).selectExpr("if(id < 20, concat('text number ', id), 'one text many times') as text")
    sizes, collect = [], type(docs).collect

    def counted(frame):
        rows = collect(frame)
        sizes.append(len(rows))
        return rows

    monkeypatch.setattr(type(docs), "collect", counted)
    centres = lm.text_classes(docs)
    assert centres.any(1).sum() > 1 and sizes and max(sizes) <= 64


def test_awkward_rows(spark):
    docs = awkward(spark).withColumn("held_out", F.col("doc_id").isNull() | (F.col("doc_id") > 9))
    rows = lm.scored(docs, docs.where(~F.col("held_out"))).collect()
    assert len(rows) == 14
    empty = [r for r in rows if r.doc_id in (1, 2, 8, 11)]
    assert all(r.n_tokens == 1 for r in empty) and len({(r.score, r.base_score) for r in empty}) == 1
    assert len({r.score for r in rows if r.doc_id == 10}) == 1
    nothing = none(spark).withColumn("held_out", F.lit(True))
    assert lm.scored(nothing, nothing).count() == 0
    unlearned = lm.scored(docs, nothing).collect()
    assert all(r.train_tokens == 0 and r.base_score == 0 and r.bits_per_byte == pytest.approx(8, abs=3.1) for r in unlearned)


def test_tables_stay_in_the_tasks(spark, monkeypatch):
    """Lots get the counts of whole tables, which the driver never holds."""
    columns = ["concat(substring(md5(cast(id as string)), 1, 6), '') as word", "id % 3 + 1 as n0"]
    words = lm.stored(spark.range(8_000).selectExpr(*columns, *[f"0L as n{c}" for c in range(1, lm.CLASSES)]), "words")
    code = lm.replace(lm.byte_code(np.ones(256)), sizes=(16, 17, 18, 18, 18))
    monkeypatch.setattr(lm, "_SPELT", 1 << 12)
    monkeypatch.setattr(lm, "_SLICE", 1 << 14)
    tables = lm.bit_tables(words, code)
    rows = lm._by_lot(lm.decision_counts(words, code)).toArrow().to_batches()
    found = 0
    for lot in lm._lots(rows, code):
        slots = lm.spell(lot.words, lot.kinds, code).slots
        assert (lot.seen == np.moveaxis(tables[slots], 2, 0)).all()
        found += len(lot.words)
    assert found == words.count()

    def refused(*_):
        raise AssertionError("whole tables in the driver")

    monkeypatch.setattr(lm, "bit_tables", refused)
    docs = table(spark, SF, "documents").limit(50).withColumn("held_out", fold(F.col("doc_id"), 7) == 2)
    assert lm.scored(docs).count() == 50


def test_words_share_their_decisions(spark):
    """What words begin with alike is held and sent once, in one batch for each lot."""
    words = sorted(f"{a}{b}" for a in ("international", "interest", "internet") for b in range(1000))
    counts = np.ones(len(words), np.int64)
    code = lm.byte_code(np.ones(256))
    data = [w.encode() for w in words for _ in range(2)]
    kinds = np.tile([0, 5], len(words))
    spelt = lm.spell(data, kinds, code)
    text = lm._Text(data, kinds)
    at, branch = text.branches()
    assert len(at) < 0.4 * len(text.letters)
    assert (text.letters[at][branch] == text.letters).all() and (text.four[at][branch] == text.four).all()
    # Counted over shared decisions they are what all decisions of all words give.
    times = np.bincount(branch, minlength=len(at))
    for own, shared in zip(spelt.slots, lm._shared(text, at, code)):
        assert len(shared.bits) < 0.5 * len(spelt.bits)
        slots, place = np.unique(own, return_inverse=True)
        zeros, ones = shared.counts(times)
        assert (shared.slots == slots).all()
        assert (ones == np.bincount(place, spelt.bits)).all() and (zeros == np.bincount(place, 1 - spelt.bits)).all()
    columns = [counts if c in (0, 5) else counts * 0 for c in range(lm.CLASSES)]
    rows = lm.pa.RecordBatch.from_arrays([lm.pa.array(words), *map(lm.pa.array, columns)], lm._TEXT)
    fill = lm._table_filler(code, 1 << 12, True)
    sent = spark.sparkContext.parallelize([0], 1).mapPartitions(lambda _: [b.num_rows for b in fill(iter([rows]))]).collect()
    assert len(sent) == 1 and sent[0] > 80


def test_words_of_a_lot_are_neighbours_among_all_words(spark, monkeypatch):
    """Words are in order over all partitions, so few begin in more than one lot."""
    class Stop(Exception):
        pass

    def stop(words):
        stored_words.append(words)
        raise Stop

    stored_words, keys = [], ("spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.shuffle.partitions")
    before = [spark.conf.get(k) for k in keys]
    monkeypatch.setattr(lm, "fit", stop)
    docs = table(spark, SF, "documents").limit(100).withColumn("held_out", fold(F.col("doc_id"), 7) == 2)
    try:
        for key, value in zip(keys, ("false", "4")):
            spark.conf.set(key, value)
        with pytest.raises(Stop):
            lm.scored(docs)
    finally:
        for key, value in zip(keys, before):
            spark.conf.set(key, value)
    (words,) = stored_words
    parts = words.groupBy(F.input_file_name().alias("f")).agg(F.min("word").alias("low"), F.max("word").alias("high")).orderBy("low").collect()
    assert len(parts) > 1 and all(a.high < b.low for a, b in zip(parts, parts[1:]))
    assert words.count() == words.select("word").distinct().count()


def test_letters_of_many_texts_at_once():
    texts = ["", None, "a", "AB", "ab", "Ünï \U0001F600", " \t", "q" * (lm._BLOCK + 3), "the Same TEXT", "", *(f"w{i} Ab" for i in range(150)), ""]
    for some in (texts, texts[::-1], texts[8:90], [None], []):
        rows = [r for block in lm.letter_rows(lm.pa.array(some, lm.pa.string())) for r in block]
        assert len(rows) == len(some)
        for text, row in zip(some, rows):
            pairs = Counter(zip(*(lambda b: (b, b[1:]))((text or "").encode().lower())))
            expected = np.zeros(512)
            for (a, b), n in pairs.items():
                expected[((a * 257 + b) * 0x9E3779B1 & 0xFFFFFFFF) >> 23] += n
            assert (row == np.sqrt(expected / max(1, expected.sum()))).all()


@pytest.mark.parametrize("held", [1, 10**6])
def test_words_of_many_batches_are_added_up(monkeypatch, held):
    monkeypatch.setattr(lm, "COUNTED_WORDS", held)
    texts, learn = ["a B a", " b\tc", None, "", "c c", "A"], [True, True, True, False, False, True]
    batch = lm.pa.RecordBatch.from_arrays([lm.pa.array(texts), lm.pa.array(learn), lm.pa.array([True] * 6)], ["text", "learn", "ask"])
    found = Counter()
    for part in lm._word_counter(np.zeros((lm.CLASSES, lm._LETTERS)))(iter([batch.slice(0, 2), batch.slice(2, 1), batch.slice(3)])):
        for row in part.to_pylist():
            found[row["word"]] += row["n0"]
            assert not any(row[f"n{c}"] for c in range(1, lm.CLASSES)) and row["asked"] in (0, 1)
    assert found == {"a": 3, "b": 2, "c": 1, "": 4}
