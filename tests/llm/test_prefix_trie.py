"""The prefix trie against plain dictionaries, in one block and in many."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from ledgerloom.llm import prefix_trie as pt

SCHEMA = "conv_id long, turn long, role string, text string, sequence string, part int, n string"


def turns(spark, *rows):
    return spark.createDataFrame([(*r, "x", 1, "y") for r in rows], SCHEMA)


def plain(conversations):
    """Nodes of (conv_id, list of (role, text)) pairs, prefix by prefix."""
    members = {}
    for conv_id, told in conversations:
        for depth in range(len(told) + 1):
            members.setdefault(tuple(told[:depth]), []).append((conv_id, len(told) == depth))
    out = []
    for prefix, found in members.items():
        below = [p for p in members if p[:len(prefix)] == prefix]
        ends = ",".join(str(i) for i in sorted(i for i, last in found if last))
        out.append((
            min(i for i, _ in found), len(prefix), min(i for i, _ in members[prefix[:-1]]) if prefix else None, len(found),
            sum(len(p) == len(prefix) + 1 for p in below), sum(all(q[:len(p)] != p or q == p for q in members) for p in below),
            sum((len(members[p]) - 1) * len(p[-1][1]) for p in below if p), hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return sorted(out, key=repr)


def rebuilt(rows):
    own = {}
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            own.setdefault(conv_id, []).append((-(1 << 63) if turn is None else turn, role or "", text or ""))
    own = {c: [(r, t) for _, r, t in sorted(x)] for c, x in own.items()}
    heads = {c: zlib.crc32(str(c).encode()) % 6 for c in own}
    return [(c, own.get(c - int(np.fmod(c, 100)), [])[:heads[c]] + x[heads[c]:]) for c, x in own.items()]


def found(frame):
    return sorted((tuple(r) for r in frame.collect()), key=repr)


def trie(spark, rows):
    return found(pt.prefix_trie(pt.with_shared_heads(pt.sequences(turns(spark, *rows)))))


def random_rows(seed, conversations, words, longest):
    pick = random.Random(seed)
    return [
        (c, t, pick.choice(["user", "assistant"]), pick.choice(words))
        for c in range(0, conversations * 7, 7) for t in range(pick.randrange(1, longest))
    ]


@pytest.mark.parametrize("block", [pt.SMALL_BLOCK_BYTES, 600, 1])
def test_random_conversations(spark, monkeypatch, block):
    monkeypatch.setattr(pt, "SMALL_BLOCK_BYTES", block)
    for seed, words, longest in ((1, ["a", "b"], 12), (2, ["", "xy", "é\U0001F600", "long text"], 5), (3, ["same"], 40)):
        rows = random_rows(seed, 150, words, longest)
        assert trie(spark, rows) == plain(rebuilt(rows))


@pytest.mark.parametrize("block", [pt.SMALL_BLOCK_BYTES, 40])
def test_copies_and_nested_prefixes(spark, monkeypatch, block):
    """Equal conversations are one sequence; each is the start of the next longer one."""
    monkeypatch.setattr(pt, "SMALL_BLOCK_BYTES", block)
    monkeypatch.setattr(pt, "PIECE", 3)
    rows = [(c, t, "user", f"turn {t}") for c in range(120) for t in range(c % 9 + 1)]
    rows += [(1000 + c, t, "user", "copy") for c in range(300) for t in range(2)]
    assert trie(spark, rows) == plain(rebuilt(rows))


def test_awkward_rows(spark):
    rows = [
        (1, None, None, None), (1, None, "", ""), (1, 0, "user", "x"), (1, 0, "user", "x"), (2, 5, "user", None), (2, 4, None, "first"),
        (-150, 0, "user", "below zero"), (-100, 0, "user", "head"), (-100, 1, "user", "two"), (7, 0, "a", "word " * 200_000),
        (100, 0, "a:", "b"), (200, 0, "a", ":b"), (None, 0, "user", "nobody's"),
    ]
    assert trie(spark, rows) == plain(rebuilt(rows))
    assert trie(spark, []) == []
    only = [(c, 0, "user", "x") for c in (1, 2) if zlib.crc32(str(c).encode()) % 6]  # the head's turns are missing
    assert only and trie(spark, only) == plain(rebuilt(only))
    assert [r[1:6] for r in trie(spark, only)] == [(0, None, len(only), 0, 1)]


def test_very_many_turns(spark):
    rows = [(c, t, "user", str(t)) for c in (0, 100) for t in range(30_000 + c)]
    nodes = {(r[1], r[0]): r for r in trie(spark, rows)}
    assert len(nodes) == 1 + 30_100 and nodes[30_100, 100][3:6] == (1, 0, 1)
    assert nodes[15, 0][3:6] == (2, 1, 1) and nodes[0, 0][6] == sum(len(str(t)) for t in range(30_000))


def test_extents():
    values = np.array([3, 1, 4, 1, 5, 9, 2, 6], np.int64)
    table = pt.RangeMinimum(values)
    at, depth = (x.ravel() for x in np.meshgrid(np.arange(8), np.arange(11)))
    right = [next((j for j in range(a, 8) if values[j] < d), 8) for a, d in zip(at, depth)]
    left = [next((j for j in range(a, -1, -1) if values[j] < d), -1) for a, d in zip(at, depth)]
    assert table.right_extent(at, depth).tolist() == right and table.left_extent(at, depth).tolist() == left
    spans = [(a, b) for a in range(8) for b in range(a + 1, 9)]
    low, high = np.array(spans).T
    assert table.least(low, high).tolist() == [values[a:b].min() for a, b in spans]
    counts = pt.EqualCounts(values)
    assert counts.count(np.ones(len(spans), np.int64), low, high).tolist() == [int((values[a:b] == 1).sum()) for a, b in spans]
