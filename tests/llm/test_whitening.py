"""Whitening against exact fractions and a plain eigenvalue solver, and on odd rows."""

import math
from fractions import Fraction

import numpy as np
import pytest

from corpusloom.llm import whitening
from corpusloom.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.01"


def whitened(spark, vectors, **more):
    docs = spark.createDataFrame([(k, v, 7) for k, v in enumerate(vectors)], "vec_id bigint, embedding array<double>, n int").repartition(2)
    return sorted(whitening.whiten(docs, **more).collect(), key=lambda r: (r.vec_id, r.component))


def whole(vectors):
    return [[math.floor(Fraction(c) * 64) + 1_000_000 for c in v] for v in vectors]


def plain_polynomial(matrix):
    """Faddeev-LeVerrier in fractions, the constant coefficient first."""
    d = len(matrix)
    m, out = [[Fraction(0)] * d for _ in range(d)], [Fraction(1)]
    for k in range(1, d + 1):
        m = [[sum(matrix[i][t] * m[t][j] for t in range(d)) + (out[-1] if i == j else 0) for j in range(d)] for i in range(d)]
        out.append(-sum(matrix[i][t] * m[t][i] for i in range(d) for t in range(d)) / k)
    return [int(c) for c in reversed(out)]


def test_polynomial(spark):
    draw = np.random.default_rng(3)
    for d in (1, 2, 3, 7):
        half = draw.integers(-1_000, 1_000, (d, max(1, d - 1)))  # one rank short
        matrix = (half @ half.T).tolist()
        assert whitening.characteristic_polynomial(spark, matrix) == plain_polynomial(matrix)
    assert whitening.characteristic_polynomial(spark, [[0, 0], [0, 9]]) == [0, -9, 1]


def test_roots():
    poly = [1]
    for root in (0, 0, 3, 3, 10**15, 10**15 + 1):
        poly = [a - root * b for a, b in zip([0, *poly], [*poly, 0])]
    assert [whitening.roots_beyond(poly, p) for p in (-1, 0, 2, 3, 10**15, 10**15 + 1)] == [6, 4, 4, 2, 1, 0]
    bits, roots = whitening.largest_roots(poly, 9, 3 * 10**15)
    assert [(root / (1 << bits), times) for root, times in roots] == [(10**15 + 1, 1), (10**15, 1), (3, 2)]


def test_close_eigenvalues_keep_double_precision():
    # Rotations of a diagonal whose two largest entries agree to 15 digits.
    big, d = 10**30, 3
    matrix = [[big, 10**14, 0], [10**14, big, 0], [0, 0, 5]]
    poly = plain_polynomial(matrix)
    bits, roots = whitening.largest_roots(poly, d, 3 * big)
    first = whitening.null_vectors(matrix, bits, *roots[0])[0]
    assert np.allclose(np.abs(first), [math.sqrt(0.5), math.sqrt(0.5), 0], atol=1e-15)


def test_query_against_a_plain_solver(spark):
    rows = QUERIES["op12_exact_whitening"](spark, FOLDER).collect()
    table = spark.read.parquet(f"{FOLDER}/embeddings.parquet").collect()
    x = np.array(whole([r.embedding for r in table]), dtype=float)
    n, mean = len(x), x.mean(axis=0)
    values, vectors = np.linalg.eigh(np.cov(x.T, bias=True))
    assert len(rows) == 32 * n and {r.n for r in rows} == {n}
    sums = [int(s) for s in x.sum(axis=0)]
    where = {r.vec_id: k for k, r in enumerate(table)}
    plain = (x - mean) @ vectors[:, ::-1][:, :32] / np.sqrt(values[::-1][:32])
    got = np.zeros((n, 32))
    for r in rows:
        got[where[r.vec_id], r.component - 1] = r.whitened
        assert abs(r.explained / (values[-r.component] / values.sum()) - 1) < 1e-10 and r.identity_error < 1e-10
        if r.component == 1:
            exact = sum((n * int(c) - s) ** 2 for c, s in zip(x[where[r.vec_id]], sums))
            assert r.deviation == exact and r.deviation_text == str(exact)
    signs = np.sign((plain * got).sum(axis=0))
    assert np.abs(got * signs - plain).max() < 1e-8
    assert np.abs(got.T @ got / n - np.eye(32)).max() < 1e-10


def test_shared_eigenvalue_and_short_rank(spark):
    square = [[1.0, 0.0, 2.0], [0.0, 1.0, 2.0], [-1.0, 0.0, 2.0], [0.0, -1.0, 2.0]]
    rows = whitened(spark, square)
    assert [r.component for r in rows] == [1, 2] * 4  # the third entry has no spread
    assert {r.deviation for r in rows} == {65_536} and {r.explained for r in rows} == {0.5}
    w = np.array([r.whitened for r in rows]).reshape(4, 2)
    assert np.allclose(w.T @ w / 4, np.eye(2)) and np.allclose((w**2).sum(axis=1), 2)


@pytest.mark.parametrize("vectors", [[], [[1.0, 2.0]], [[1.0, 2.0]] * 3, [None, [], [None], [float("nan")], [float("inf")]], [[]]])
def test_no_spread_no_rows(spark, vectors):
    assert whitened(spark, vectors) == []


def test_dropped_rows_do_not_count(spark):
    good = [[0.1, 0.5], [0.7, -0.2], [0.3, 0.3], [0.3, 0.3]]
    rows = whitened(spark, [*good, None, [None, 1.0], [float("nan"), 1.0], [1.0, float("-inf")], [1.0], [1.0, 2.0, 3.0]])
    assert {r.vec_id for r in rows} == {0, 1, 2, 3} and {r.n for r in rows} == {4}
    assert [r.whitened for r in rows if r.vec_id == 2] == [r.whitened for r in rows if r.vec_id == 3]


def test_huge_entries_stay_exact(spark):
    vectors = [[1e30, 3.0], [-1e30, 5.5], [0.25, 1e300]]
    rows = whitened(spark, vectors, components=1)
    x = whole(vectors)
    for r, v in zip(rows, x):
        exact = sum((3 * c - sum(u[k] for u in x)) ** 2 for k, c in enumerate(v))
        assert r.deviation is None and r.deviation_text == str(exact)
        assert math.isfinite(r.whitened) and r.identity_error < 1e-10


def test_limbs_add_up():
    for value in (0, 1, -1, 1 << 30, -(1 << 30), (1 << 200) + 12_345, -(1 << 200) - 12_345):
        assert sum(part << (whitening.LIMB * limb) for limb, part in whitening._limbs(value)) == value
