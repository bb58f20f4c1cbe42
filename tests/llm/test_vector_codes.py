"""Vector codes against a plain k-means in whole numbers."""

import hashlib

import numpy as np
import pytest
from ledgerloom.llm import vector_codes as vc

SCHEMA = "vec_id long, embedding array<float>, label int, state string, vector string, error int"


def vectors(spark, rows):
    return spark.createDataFrame([(i, e, l, "x", "y", 1) for i, e, l in rows], SCHEMA)


def plain(rows, parts, entries, rounds):
    kept = [(i, [float(np.float32(x)) for x in e], l) for i, e, l in rows
            if e is not None and all(x is not None and np.isfinite(np.float32(x)) for x in e)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    x = np.floor(np.array([e for _, e, _ in kept]) * vc.SCALE).astype(np.int64).reshape(len(kept), parts, -1)
    books = x[:entries].transpose(1, 0, 2).copy()

    def nearest(p):
        squared = ((x[:, p, None, :] - books[p][None]) ** 2).sum(2)
        return squared.argmin(1), squared.min(1)

    for _ in range(rounds):
        for p in range(parts):
            entry, _ = nearest(p)
            for k in set(entry.tolist()):
                books[p, k] = [int(s) // int((entry == k).sum()) for s in x[entry == k, p].sum(0)]
    final = [nearest(p) for p in range(parts)]
    return sorted(((kept[r][0], kept[r][2], [int(f[0][r]) for f in final], int(sum(f[1][r] for f in final))) for r in range(len(kept))), key=repr), books


@pytest.mark.parametrize("entries,rounds", [(16, 4), (5, 7), (256, 2)])
def test_agrees_with_plain_rounds(spark, entries, rounds):
    rng = np.random.default_rng(entries)
    centres = rng.normal(size=(12, 8))
    rows = [(i, [float(v) for v in centres[i % 12] + 0.1 * rng.normal(size=8)], i % 3) for i in range(700)]
    rows += [(700 + i, rows[5][1], 9) for i in range(350)] + [(700, rows[6][1], 9), (None, rows[7][1], None)]
    theirs, books = plain(rows, 4, entries, rounds)
    coded, found = vc.compressed(vectors(spark, rows), entries=entries, rounds=rounds)
    assert np.array_equal(found, books)
    assert sorted(((r.vec_id, r.label, list(r.codes), r.error) for r in coded.collect()), key=repr) == theirs
    totals = {}
    for _, label, _, error in theirs:
        totals[label] = totals.get(label, 0) + error
    assert {r.label: r.label_error for r in vc.with_label_errors(coded).collect()} == totals
    assert vc.books_sha256(found) == hashlib.sha256(",".join(str(v) for v in books.ravel()).encode()).hexdigest()


def test_ties_and_coarse_grid(spark):
    """Many equal distances: whole-number grids of two values."""
    rows = [(i, [float((i >> b) % 2) / 1024 for b in range(4)], None) for i in range(400)]
    theirs, books = plain(rows, 4, 7, 4)
    coded, found = vc.compressed(vectors(spark, rows), entries=7)
    assert np.array_equal(found, books)
    assert sorted(((r.vec_id, r.label, list(r.codes), r.error) for r in coded.collect()), key=repr) == theirs


def test_large_components_use_whole_numbers(spark):
    rows = [(i, [float((i * 7919) % 4001 - 2000), -5e4 * (i % 3), 1e-3 * i, 5e4], i % 2) for i in range(300)]
    theirs, books = plain(rows, 2, 16, 4)
    coded, found = vc.compressed(vectors(spark, rows), entries=16, parts=2)
    assert np.array_equal(found, books)
    assert sorted(((r.vec_id, r.label, list(r.codes), r.error) for r in coded.collect()), key=repr) == theirs


def test_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    bad = [(1, None, 1), (2, [1.0, None, 0.0, 0.0], 1), (3, [nan, 0.0, 0.0, 0.0], 1), (4, [0.0, 0.0, inf, 0.0], 1), (5, [], 1), (6, [0.5], 1)]
    good = [(None, [0.1, -0.2, 0.3, -1.0], None), (9, [0.0, 0.0, 0.0, 0.0], 2), (9, [0.0, 0.0, 0.0, 0.0], 2), (8, [-0.0004, 1.0, 1.0, 1.0], None)]
    coded, books = vc.compressed(vectors(spark, bad + good))
    theirs, plain_books = plain(good, 4, 256, 4)
    assert sorted(((r.vec_id, r.label, list(r.codes), r.error) for r in coded.collect()), key=repr) == theirs
    assert np.array_equal(books, plain_books)
    for rows in ([], bad[:4], [(1, [], 1)]):
        empty, books = vc.compressed(vectors(spark, rows))
        assert vc.with_label_errors(empty).count() == 0 and books.size == 0
    with pytest.raises(ValueError, match="equal parts"):
        vc.compressed(vectors(spark, [(1, [1.0, 2.0, 3.0], 1)]))
    with pytest.raises(ValueError, match="beyond a long"):
        vc.compressed(vectors(spark, [(1, [1e30, 0.0, 0.0, 0.0], 1)]))


def test_bounds_spare_scans():
    """After small moves most rows keep their entry without a scan, and none is assigned wrongly."""
    rng = np.random.default_rng(0)
    centres = rng.integers(-4000, 4000, (40, 6)).astype(float)
    x = np.floor(centres[rng.integers(0, 40, 5000)] + rng.normal(scale=60, size=(5000, 6)))
    history, state, scanned = [centres.copy()], np.zeros(5000, vc._STATE), []
    vc._rescan(x, history[0], state, np.arange(5000), 0)
    for step in range(1, 9):
        # Entries wander out and back, so accumulated drifts would grow while the net ways stay short.
        history.append(np.floor(centres + (-1) ** step * 150 * rng.random((40, 6))))
        scanned.append(vc.reassign(x, history, vc.Displacements(history), state))
        assert np.array_equal(state["entry"], vc.scan(x, history[-1]).argmin(1))
    assert max(scanned) < 500


def test_decoded_vectors(spark):
    rows = [(i, [i / 64, 0.5, -i / 128, 0.25], 0) for i in range(64)]
    coded, books = vc.compressed(vectors(spark, rows))
    near = {r.vec_id: r.v for r in coded.select("vec_id", vc.decoded(coded["codes"], books).alias("v")).collect()}
    assert all(abs(a - b) < 2 / vc.SCALE for i, e, _ in rows for a, b in zip(near[i], e))
