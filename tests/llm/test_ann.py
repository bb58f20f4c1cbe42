"""Recall against brute force, exact scores, copies and unusable vectors."""

import numpy as np
import pytest

from corpus import awkward
from ledgerloom.llm import ann
from ledgerloom.llm.common import table
from ledgerloom.llm.queries_models import op8_nn_descent

SCHEMA = "vec_id long, embedding array<float>"


def usable(vectors):
    rows = {}
    for i, v in vectors:
        a = np.array([np.nan if x is None else x for x in v], float) if v is not None else np.zeros(0)
        if i is not None and len(a) and np.isfinite(a).all() and a.any():
            rows[i] = a
    return rows


def nearest(rows, query, k):
    ids = np.array([i for i in rows if i != query])
    if not len(ids):
        return []
    matrix = np.stack([rows[i] for i in ids])
    near = matrix @ rows[query] / (np.linalg.norm(matrix, axis=1) * np.linalg.norm(rows[query]))
    order = np.lexsort((ids, -np.round(near, 12)))[:k]
    return [(int(ids[o]), float(near[o])) for o in order]


def by_query(found):
    out = {}
    for r in sorted(found, key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


def recall(found, rows, k):
    hit = total = 0
    for q, got in found.items():
        expected = nearest(rows, q, k)
        floor = expected[-1][1] - 1e-9
        hit += sum(s >= floor for _, s in got)
        total += len(expected)
    return hit / total


def test_given_vectors(spark):
    folder = "/root/testdata/sf0.1"
    rows = usable([(r.vec_id, r.embedding) for r in table(spark, folder, "embeddings").collect()])
    found = by_query(op8_nn_descent(spark, folder).collect())
    assert set(found) == {i for i in rows if i % 50 == 0} and all(len(g) == 5 for g in found.values())
    for q, got in found.items():
        for i, s in got:
            exact = rows[i] @ rows[q] / (np.linalg.norm(rows[i]) * np.linalg.norm(rows[q]))
            assert i != q and s == pytest.approx(exact, abs=1e-12)
        assert got == sorted(got, key=lambda g: (-g[1], g[0]))
    assert recall(found, rows, 5) >= 0.9


def test_queries_from_outside(spark):
    random = np.random.default_rng(1)
    centres = random.normal(size=(20, 12))
    data = [(int(i), (centres[i % 20] + random.normal(size=12) * 0.3).tolist()) for i in range(3000)]
    asked = [(10_000 + i, (centres[i] + random.normal(size=12) * 0.3).tolist()) for i in range(20)]
    index = ann.build_index(spark.createDataFrame(data, SCHEMA))
    found = by_query(ann.search(index, spark.createDataFrame(asked, SCHEMA)).collect())
    rows = usable(data)
    hit = sum(len({i for i, _ in found[q]} & {i for i, _ in nearest({**rows, q: np.array(v)}, q, 5)}) for q, v in asked)
    assert hit >= 90


def test_copies_and_unusable_vectors(spark):
    inf, nan = float("inf"), float("nan")
    vectors = [(i, [1.0, 2.0, 0.0]) for i in range(0, 900)]  # one vector holds most rows
    vectors += [(1000 + i, [float(i + 1), 1.0, 0.5]) for i in range(4)]
    vectors += [(50, [1.0, 2.0, 0.0]), (2000, None), (2050, [0.0, 0.0, 0.0]), (2100, [1.0, None, 0.0]), (2150, [nan, 1.0, 1.0]),
                (2200, [inf, 0.0, 0.0]), (2250, []), (2300, [1.0, 2.0]), (None, [1.0, 1.0, 1.0]), (2350, [1e-30, 0.0, 0.0])]
    frame = spark.createDataFrame(vectors, SCHEMA)
    index = ann.build_index(frame)
    found = by_query(ann.search(index, frame.where("vec_id % 50 = 0")).collect())
    assert set(found) == {*range(0, 900, 50), 1000, 2350}
    assert [i for i, _ in found[0]] == [1, 2, 3, 4, 5] and [i for i, _ in found[100]] == [0, 1, 2, 3, 4]
    rows = usable([v for v in vectors if v[0] != 2300])
    assert [i for i, _ in found[1000]] == [i for i, _ in nearest(rows, 1000, 5)]
    assert [i for i, _ in found[2350]] == [i for i, _ in nearest(rows, 2350, 5)]


def test_few_vectors_and_none(spark):
    few = spark.createDataFrame([(0, [1.0, 0.0]), (1, [1.0, 1.0]), (2, [0.0, 1.0])], SCHEMA)
    found = by_query(ann.search(ann.build_index(few), few.where("vec_id = 0")).collect())
    assert [i for i, _ in found[0]] == [1, 2]
    for some in (few.limit(0), few.where("vec_id = 0")):
        assert ann.search(ann.build_index(some), some).count() == 0
