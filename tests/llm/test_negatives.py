"""Hard negatives against a plain search."""

import math

import numpy as np
import pytest

from tillsense.llm import hard_negatives as H


def brute(rows):
    use = []
    for i, v, label in rows:
        if label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        label = (label + 1) % 10 if i is not None and i % 7 == 0 else label
        use.append((i, [math.floor(256.0 * x) for x in v], label))
    out = []
    low = lambda i: -1 if i is None else i
    for n, (anchor, a, label) in enumerate(use):
        if anchor is None or anchor % 100:
            continue
        scored = [(sum(p * q for p, q in zip(a, v, strict=True)), i, other) for m, (i, v, other) in enumerate(use) if m != n and len(v) == len(a)]
        scored.sort(key=lambda x: (-x[0], low(x[1])))
        for p, pid, _ in [x for x in scored if x[2] == label][:5]:
            hits = [(s, i) for s, i, other in scored if other != label and 30 * p <= 100 * s <= 90 * p][:10]
            out += [(anchor, pid, rank, i, p, s) for rank, (s, i) in enumerate(hits, 1)]
    return sorted(out, key=str)


def got(spark, rows):
    df = spark.createDataFrame([(i, v, label, "x") for i, v, label in rows], "vec_id long, embedding array<float>, label int, row string").repartition(3)
    return sorted(((r["anchor_id"], r["positive_id"], r["rank"], r["negative_id"], r["positive_score"], r["negative_score"]) for r in H.hard_negatives(df).collect()), key=str)


def as_float(x):
    return float(np.float32(x))


@pytest.mark.parametrize("clustered", [False, True])
def test_negatives_equal_a_plain_search(spark, clustered):
    r = np.random.default_rng(5)
    centres = r.standard_normal((6, 16))
    rows = []
    for i in range(900):
        v = r.standard_normal(16) * (0.3 if clustered else 1) + (centres[i % 6] * 2 if clustered else 0)
        rows.append((i, [as_float(x) for x in v / np.linalg.norm(v)], int(r.integers(0, 10)) if not clustered else i % 6))
    assert got(spark, rows) == brute(rows)


def test_negatives_of_odd_rows(spark):
    r = np.random.default_rng(6)
    unit = [[as_float(x) for x in v / np.linalg.norm(v)] for v in r.standard_normal((60, 8))]
    rows = [(i * 50, v, i % 3) for i, v in enumerate(unit)]
    rows += [(100, unit[3], 1), (100, unit[3], 1), (None, unit[4], 1), (None, None, 1), (200, unit[5], None), (300, None, 2)]
    rows += [(400, [float("nan")] * 8, 1), (500, [None, *unit[6][1:]], 1), (600, [float("inf")] * 8, 1), (700, [0.0] * 8, 1), (800, [1.0, 2.0], 1), (900, [], 1), (1000, [], 2)]
    rows += [(1, [3000.0] * 8, 1), (2, [2e6] * 8, 2)]
    assert got(spark, rows) == brute(rows)
    assert got(spark, []) == []


def test_threshold_pairs_are_all_pairs_above():
    r = np.random.default_rng(7)
    decay = np.exp(-np.arange(32) / 6)
    a, y = np.floor(256 * r.standard_normal((300, 32)) * decay).astype(np.int64), np.floor(256 * r.standard_normal((5000, 32)) * decay).astype(np.int64)
    exact = a @ y.T
    for t in (np.quantile(exact, 0.9999), np.quantile(exact, 0.9), -(2**62)):
        bound = np.full(300, int(t)) + (np.arange(300) if t > 0 else 0)
        found = np.full(exact.shape, -(2**62))
        for i, j, s in H.threshold_pairs(a, bound, y):
            assert (found[i, j] == -(2**62)).all()
            found[i, j] = s
        assert (found[exact >= bound[:, None]] == exact[exact >= bound[:, None]]).all() and (found[exact < bound[:, None]] == -(2**62)).all()


def test_rows_are_not_posted_where_suffix_norms_cover_them():
    v = np.array([[10.0, 5.0, 1.0, 1.0], [1.0, 0.0, 0.0, 0.0]])
    norms = H.suffix_norms(v, [0, 1, 2, 3, 4])
    assert H.posted(norms, np.full(5, 1.0), 2.0).tolist() == [2, 0]
    assert H.posted(norms, np.full(5, 1.0), -5.0).tolist() == [4, 4]


def test_packed_vectors_come_back():
    v = [np.array([1, -3]), np.array([2**20, 5]), np.array([-(2**40), 7])]
    assert [len(b) for b in H.pack(v)] == [4, 8, 16]
    assert (H.unpack(H.pack(v), 2) == np.stack(v)).all()
