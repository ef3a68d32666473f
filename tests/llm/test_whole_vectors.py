"""Centroid clustering and whitening against plain versions in exact or high precision."""

import hashlib
import math
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillsight.llm import centroids, whitening
from tillsight.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
KINDS = "vec_id bigint, embedding array<float>, label bigint, cluster string, x string, n string"


def _frame(spark, vectors, ids=None):
    ids = range(len(vectors)) if ids is None else ids
    return spark.createDataFrame([(i, v, 1, "c", "x", "n") for i, v in zip(ids, vectors)], KINDS)


def _odd(spark, dims):
    good = np.random.default_rng(1).normal(size=(30, dims)).astype("float32").tolist()
    bad = [None, [float("nan")] * dims, [float("inf")] * dims, [None] * dims, [1.0] * (dims - 1)]
    return good, _frame(spark, good + good[:4] + bad + [[0.0] * dims], [None, *range(29), 3, 3, 4, 99, 5, 6, 7, 8, 9, 10])


def _plain_clusters(rows, k, rounds, seed):
    """Lloyd's steps in Python integers."""
    x = [[math.floor(centroids.SCALE * c) for c in v] for _, v in rows]
    digest = [hashlib.sha256(f"{seed}:{i}".encode()).hexdigest() for i, _ in rows]
    points = [x[i] for i in sorted(range(len(x)), key=lambda i: (digest[i], x[i]))[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, p)), c) for c, p in enumerate(points))

    for _ in range(rounds):
        of = [nearest(v)[1] for v in x]
        for c in range(len(points)):
            mine = [v for v, o in zip(x, of) if o == c]
            if mine:
                points[c] = [sum(col) // len(mine) for col in zip(*mine)]
    return [nearest(v) for v in x], points


def test_clusters_match_plain_lloyd(spark):
    rng = np.random.default_rng(2)
    rows = [(i, v) for i, v in enumerate(rng.normal(size=(150, 64)).astype("float32").tolist())]
    rows += [(200 + i, rows[i][1]) for i in range(5)]
    found = {r.vec_id: r for r in centroids.clusters(_frame(spark, [v for _, v in rows], [i for i, _ in rows])).collect()}
    plain, points = _plain_clusters(rows, 8, 10, 3)
    assert len(found) == len(rows)
    for (i, _), (d, c) in zip(rows, plain):
        r = found[i]
        assert (r.cluster, r.distance, r.inertia) == (c, d, sum(d for d, _ in plain))
        assert r.cluster_inertia == sum(d for d, o in plain if o == c)
        assert r.centroid_sha256 == hashlib.sha256(",".join(map(str, points[c])).encode()).hexdigest()


def test_search_finds_the_nearest_and_skips_others():
    rng = np.random.default_rng(3)
    points = (rng.integers(-50, 50, (200, 1)) * 40 + rng.integers(-60, 60, (200, 64))).tolist()
    points[7] = points[3]
    x = np.array(points)[rng.integers(0, 200, 500)] + rng.integers(-3, 4, (500, 64))
    number, distance, measured = centroids.Centroids(points).nearest(x)
    all_ = ((x[:, None, :] - np.array(points)[None]) ** 2).sum(axis=2)
    assert (number == all_.argmin(axis=1)).all() and (distance == all_.min(axis=1)).all()
    assert measured < 0.2 * all_.size


def test_search_with_ties_and_integers_beyond_64_bits():
    points = [[0, 2], [2, 0], [10**12, 0], [0, 10**12]]
    x = np.array([[1, 1], [0, 0], [10**12, 10**12], [9, -9]])
    number, distance, _ = centroids.Centroids(points).nearest(x.astype(object))
    assert number.tolist() == [0, 0, 2, 1]
    assert distance.tolist()[2] == 10**24


@pytest.mark.parametrize("n", [0, 1, 3])
def test_fewer_vectors_than_centroids(spark, n):
    found = centroids.clusters(_frame(spark, [[float(i)] * 64 for i in range(n)])).collect()
    assert len(found) == n and all(r.distance == 0 and r.inertia == 0 for r in found)


def test_clusters_of_odd_rows(spark):
    good, rows = _odd(spark, 64)
    found = centroids.clusters(rows).collect()
    assert len(found) == len(good) + 4 + 1
    assert sum(r.vec_id is None for r in found) == 1 and sum(r.vec_id == 3 for r in found) == 3
    huge = centroids.clusters(_frame(spark, [[3e38] * 64, [-3e38] * 64] + good)).collect()
    assert len(huge) == 32 and all(r.inertia is None or r.inertia >= 0 for r in huge)


def _fine_eigen(a):
    """Eigenvectors by Jacobi rotations in extended precision."""
    a, x = a.astype(np.longdouble), np.eye(len(a), dtype=np.longdouble)
    for _ in range(30):
        for p in range(len(a)):
            for q in range(p + 1, len(a)):
                if abs(a[p, q]) > 1e-30 * abs(a).max():
                    t = np.arctan2(2 * a[p, q], a[q, q] - a[p, p]) / 2
                    g = np.eye(len(a), dtype=np.longdouble)
                    g[p, p] = g[q, q] = np.cos(t)
                    g[p, q], g[q, p] = np.sin(t), -np.sin(t)
                    a, x = g.T @ a @ g, x @ g
    order = np.argsort(-np.diag(a))
    return np.diag(a)[order], x[:, order]


@pytest.mark.parametrize("gap", [1.0, 1e-5, 1e-9, 1e-13, 0.0])
def test_refined_vectors_of_close_eigenvalues(gap):
    rng = np.random.default_rng(4)
    q, _ = np.linalg.qr(rng.normal(size=(12, 12)))
    values = np.array([5, 4, 4 - gap, 4 - 2 * gap, 3, 1, 1 - gap, 0.5, 0.1, 1e-3, 0, 0], np.longdouble)
    a = q.astype(np.longdouble) @ np.diag(values) @ q.T.astype(np.longdouble)
    a = (a + a.T) / 2
    found, x = whitening.eigen(a)
    assert np.abs(x.T @ x - np.eye(12)).max() < 1e-17
    assert np.abs(a @ x - x * found).max() < 1e-17
    assert np.abs(found - _fine_eigen(a)[0]).max() < 1e-16


def test_refinement_beats_its_single_precision_start():
    rng = np.random.default_rng(5)
    m = rng.normal(size=(200, 30))
    a = (m.T @ m).astype(np.longdouble)
    _, start = np.linalg.eigh((a / np.abs(a).max()).astype(np.float32))
    x = start.astype(np.longdouble)
    errors = []
    for _ in range(4):
        s = x.T @ a @ x
        errors.append(float(np.abs(s - np.diag(np.diag(s))).max() / np.abs(a).max()))
        x = whitening.refine_once(a, x)[0]
    assert errors[0] > 1e-9 and errors[2] < 1e-14 and errors[3] < 1e-17


def _plain_whitening(vectors):
    x = [[math.floor(whitening.SCALE * c) for c in v] for v in vectors]
    fit = sorted(set(map(tuple, x)))
    n, dims = len(fit), len(x[0])
    sums = [sum(v[d] for v in fit) for d in range(dims)]
    mean = [Fraction(s, n) for s in sums]
    v = np.array([[np.longdouble(float(sum((r[i] - mean[i]) * (r[j] - mean[j]) for r in fit) / n)) for j in range(dims)] for i in range(dims)])
    values, vectors = _fine_eigen(v)
    white = [[float(sum((a - float(m)) * u for a, m, u in zip(r, mean, vectors[:, k])) / np.sqrt(values[k])) for k in range(4)] for r in x]
    deviation = [sum((n * a - s) ** 2 for a, s in zip(r, sums)) for r in x]
    return n, deviation, np.array(white), values / values.sum()


def test_whitening_matches_exact_arithmetic(spark):
    rng = np.random.default_rng(6)
    vectors = (1000 + rng.normal(size=(60, 6)) * [3, 2, 1, 0.5, 0.2, 0.1]).astype("float32").tolist()
    vectors += vectors[:20]
    found = whitening.whiten(_frame(spark, vectors)).collect()
    n, deviation, white, explained = _plain_whitening(vectors)
    assert len(found) == 4 * len(vectors)
    for k in range(4):
        mine = {r.vec_id: r for r in found if r.component == k + 1}
        got = np.array([mine[i].whitened for i in range(len(vectors))])
        assert min(np.abs(got - white[:, k]).max(), np.abs(got + white[:, k]).max()) < 1e-9
        assert [mine[i].deviation for i in range(len(vectors))] == deviation
        assert {r.n for r in mine.values()} == {n}
        assert abs(mine[0].explained / float(explained[k]) - 1) < 1e-12
    assert {r.identity_error for r in found} < {found[0].identity_error, None} | {found[0].identity_error}
    assert found[0].identity_error < 1e-10


def test_products_are_exact_in_blocks_and_beyond_doubles():
    rng = np.random.default_rng(7)
    for top in (3, 1 << 20, 1 << 25, 1 << 40):
        z = rng.integers(-top, top, (300, 5))
        assert (whitening.products(z) == z.astype(object).T @ z.astype(object)).all()


def test_whitening_odd_rows(spark):
    good, rows = _odd(spark, 6)
    found = whitening.whiten(rows).collect()
    full = [r for r in found if r.n == 31]
    assert len(full) == 4 * (len(good) + 4 + 1) and len(found) == len(full) + 4  # one vector of five components
    assert all(r.whitened is None and r.explained is None for r in found if r.n == 1)
    assert max(r.identity_error for r in full) < 1e-10
    assert whitening.whiten(_frame(spark, [])).count() == 0
    assert whitening.whiten(_frame(spark, [[]])).count() == 0
    two = whitening.whiten(_frame(spark, [[1.0, 2.0], [3.0, 5.0], [3.0, 5.0]])).collect()
    assert len(two) == 6 and all((r.whitened is None) == (r.component == 2) for r in two)
    huge = whitening.whiten(_frame(spark, [[3e38, 1.0], [-3e38, 0.0], [0.0, 7.0]])).collect()
    assert len(huge) == 6 and all(r.whitened is None or math.isfinite(r.whitened) for r in huge)


def test_whitening_query_covers_the_table(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet")
    found = QUERIES["op13_whitening"](spark, SF)
    assert found.count() == 4 * rows.count()
    stats = found.groupBy("component").agg(F.var_pop("whitened").alias("v"), F.max("identity_error").alias("e")).collect()
    assert all(abs(r.v - 1) < 1e-6 and r.e < 1e-10 for r in stats)
