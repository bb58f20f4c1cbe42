"""Fingerprints and components against a plain count over all pairs."""

import re

import numpy as np
import pytest
import xxhash
from conftest import SF
from hypothesis import given, settings, strategies as st

from corpus import awkward, none
from ledgerloom.llm import simhash as sh
from ledgerloom.llm.common import lowered_words, table
from ledgerloom.llm.components import components


def plain_fingerprint(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    ones = [sum(xxhash.xxh64_intdigest(s.encode(), 42) >> b & 1 for s in shingles) for b in range(64)]
    return sum(1 << b for b in range(64) if 2 * ones[b] > len(shingles))


def roots(nodes, near):
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in near:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def near_pairs(values, distance=3):
    array = np.array(values, np.uint64)
    return [(values[i], values[j]) for i in range(len(values)) for j in range(i)
            if int(np.bitwise_count(array[i] ^ array[j])) <= distance]


@settings(deadline=None, max_examples=150)
@given(st.text(alphabet="aAbZ \t\n\x0b\x1c é.", max_size=60))
def test_fingerprint(text):
    assert sh.fingerprint(text.encode()) == plain_fingerprint(text)


def test_blocks_do_not_change_the_fingerprint(monkeypatch):
    text = " ".join(f"w{i}" for i in range(500))
    whole = sh.fingerprint(text.encode())
    monkeypatch.setattr(sh, "lowered_words", lambda t: lowered_words(t, 37))
    assert sh.fingerprint(text.encode()) == whole == plain_fingerprint(text)


def test_spark_hashes_shingles_alike(spark):
    words = ["", "a", "abc def ghi", "é" * 40]
    found = spark.createDataFrame([(w,) for w in words], "w string").selectExpr("xxhash64(w) as h").collect()
    assert [r.h % (1 << 64) for r in found] == [xxhash.xxh64_intdigest(w.encode(), 42) for w in words]


def test_components_of_documents(spark):
    docs = table(spark, SF, "documents")
    rows = {r.doc_id: r.text for r in docs.collect()}
    prints = {i: plain_fingerprint(t) for i, t in rows.items()}
    values = sorted(set(prints.values()))
    root = roots(values, near_pairs(values))
    least = {}
    for i, p in prints.items():
        least[root[p]] = min(least.get(root[p], i), i)
    found = {r.doc_id: (r.fp % (1 << 64), r.component_id) for r in sh.near_duplicates(docs).collect()}
    assert found == {i: (p, least[root[p]]) for i, p in prints.items()}
    assert len(set(root.values())) < len(rows)


@pytest.mark.parametrize("piece", [2, 5, 1024])
def test_pieces_lose_no_link(spark, piece):
    random = np.random.default_rng(3)
    base = random.integers(0, 1 << 63, 12).astype(np.uint64)
    values = set(base.tolist())
    for b in base:
        for _ in range(25):  # chains and dense groups around each base value
            b ^= np.uint64(1) << np.uint64(random.integers(0, 64))
            values.add(int(b))
    values = sorted(values)
    signed = np.array(values, np.uint64).view(np.int64).tolist()
    links = sh.fingerprint_links(spark.createDataFrame([(v,) for v in signed], "fp long"), piece=piece)
    found = {r.node % (1 << 64): r.root for r in components(links).collect()}
    expected = roots(values, near_pairs(values))
    groups = {}
    for v in values:
        groups.setdefault(expected[v], set()).add(found.get(v, v if v < 1 << 63 else v - (1 << 64)))
    assert all(len(g) == 1 for g in groups.values()) and len(set.union(*groups.values())) == len(groups)


@pytest.mark.parametrize("distance", [0, 1, 2, 3, 5, 7])
def test_every_pair_at_the_distance_shares_a_list(distance):
    lists = sh._positions(distance)
    from itertools import combinations

    for differing in combinations(range(8), distance):
        assert any(not set(p) & set(differing) for p in lists)


def test_components_of_a_long_chain(spark):
    chain = spark.range(600).selectExpr("id as x", "id + 1 as y")
    found = {r.node: r.root for r in components(chain).collect()}
    assert found == {i: 0 for i in range(601)}


def test_awkward_rows(spark):
    found = [(r.doc_id, r.fp, r.component_id) for r in sh.near_duplicates(awkward(spark)).collect()]
    assert len(found) == 14
    by_id = {i: (f, c) for i, f, c in found}
    assert all(by_id[i] == (0, 1) for i in (1, 2, 8, 11))
    assert by_id[6][1] == by_id[7][1] == 6 and by_id[10][1] == 10 and by_id[None][1] is None
    assert sh.near_duplicates(none(spark)).count() == 0
