import math

import numpy as np
import pytest

from marginalia.llm import realroots, whitening
from marginalia.llm.queries import QUERIES


def check(rows, got, count, scale=1024, shift=100_000):
    """Against a dense eigendecomposition, with either sign."""
    used = [(i, v) for i, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    x = np.array([[math.floor(scale * c) + shift for c in v] for _, v in used], object)
    n, sums = len(x), x.sum(axis=0)
    gap = n * x - sums
    cov = ((gap.T @ gap) / n**3).astype(float)
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1], vectors[:, ::-1]
    want = (gap / n).astype(float) @ vectors[:, :count] / np.sqrt(values[:count])
    # The signs of a component are the same in all rows.
    found = {}
    for r in got:
        found.setdefault(r.component, {}).setdefault(r.vec_id, []).append(r)
    assert sorted(found) == list(range(1, count + 1))
    for c, by_id in found.items():
        ours = np.array([by_id[i][0].whitened for i, _ in used])
        sign = np.sign(ours @ want[:, c - 1])
        assert np.allclose(sign * ours, want[:, c - 1], atol=1e-9)
        assert by_id[used[0][0]][0].explained == pytest.approx(values[c - 1] / values.sum(), rel=1e-9)
    deviation = {i: int((g * g).sum()) for (i, _), g in zip(used, gap)}
    for r in got:
        assert r.n == n and int(r.deviation_exact) == deviation[r.vec_id] and r.identity_error < 1e-8
        assert r.deviation == (deviation[r.vec_id] if deviation[r.vec_id] < 1 << 63 else None)
    assert len({r.identity_error for r in got}) == 1


def test_equals_a_dense_decomposition(frame):
    rng = np.random.default_rng(2)
    mix = rng.normal(0, 0.3, (12, 12))
    rows = [(i, [float(x) for x in mix @ rng.normal(0, 1, 12)]) for i in range(400)]
    odd = [(1000, None), (1001, [math.nan] + [0.0] * 11), (1002, [None] + [0.0] * 11), (1003, [math.inf] * 12)]
    got = whitening.whiten(frame(rows + odd, "vec_id long, embedding array<double>"), 8).collect()
    assert len(got) == 400 * 8
    check(rows, got, 8)


def test_huge_and_few_entries(frame):
    rows = [(1, [1e6, 0.0, 2.0]), (2, [-1e6, 0.5, 1.0]), (3, [3e9, 1.0, 0.0]), (4, [5.0, -1.0, 7.0]), (5, [1.0, 2e9, 9.0])]
    got = whitening.whiten(frame(rows, "vec_id long, embedding array<double>"), 3).collect()
    check(rows, got, 3)


def test_defined_cases(frame, spark):
    schema = "vec_id long, embedding array<float>"
    assert whitening.whiten(spark.createDataFrame([], schema)).count() == 0
    assert whitening.whiten(frame([(1, [0.5, 0.25])], schema)).count() == 0
    assert whitening.whiten(frame([(1, [0.5]), (2, [0.5])], schema)).count() == 0
    assert whitening.whiten(frame([(1, []), (2, [])], schema)).count() == 0
    # A rank of one gives one component; short vectors end in zeros; repeated rows count each.
    rows = [(1, [0.5]), (1, [0.5]), (None, [0.25, 0.0])]
    got = whitening.whiten(frame(rows, schema).selectExpr("*", "1 as component", "2 as n", "3 as id")).collect()
    assert sorted((str(r.vec_id), r.component, r.n) for r in got) == [("1", 1, 3), ("1", 1, 3), ("None", 1, 3)]
    assert all(r.explained == 1.0 and r.identity_error < 1e-12 for r in got)


def test_equal_eigenvalues_give_an_orthonormal_basis(frame):
    rows = [(i, [float(s if j == k else 0) for j in range(4)]) for i, (k, s) in enumerate((k, s) for k in range(4) for s in (1, -1))]
    got = whitening.whiten(frame(rows, "vec_id long, embedding array<double>")).collect()
    assert len(got) == 32 and all(r.identity_error < 1e-12 and r.explained == pytest.approx(0.25) for r in got)


def determinant(m):
    if not len(m):
        return 1
    return sum((-1) ** j * m[0][j] * determinant([[*row[:j], *row[j + 1 :]] for row in m[1:]]) for j in range(len(m)))


def test_polynomial_and_roots_are_exact(spark):
    rng = np.random.default_rng(4)
    for d in (1, 2, 5, 9):
        half = rng.integers(-50, 50, (d, d + 1)).astype(object)
        matrix = half @ half.T
        symmetric = whitening.polynomial(spark, matrix)
        assert symmetric[0] == 1 and symmetric[1] == sum(matrix[i, i] for i in range(d))
        assert d > 6 or symmetric[d] == determinant(matrix.tolist())
        roots = realroots.top_roots(symmetric, d)
        assert [float(r.value) for r in roots] == pytest.approx(list(np.linalg.eigvalsh(matrix.astype(float))[::-1]))
    # Zero columns need no pivot; a triple root is one root.
    matrix = np.diag([3, 3, 3, 0, 0]).astype(object)
    (root,) = realroots.top_roots(whitening.polynomial(spark, matrix), 8)
    assert root.times == 3 and float(root.value) == pytest.approx(3)
    basis = np.array(realroots.null_vectors(matrix, root, 3), float)
    assert np.allclose(basis @ basis.T, np.eye(3)) and np.allclose(basis[:, 3:], 0)


def test_sums_larger_than_doubles_hold():
    big = np.array([[1 << 40, 3], [5, -(1 << 45)]], np.int64)
    assert (whitening.gram(big) == big.astype(object).T @ big.astype(object)).all()
    some = np.arange(-3000, 3000).reshape(-1, 4) << 12
    assert (whitening.gram(some) == some.astype(object).T @ some.astype(object)).all()


def test_query_on_given_vectors(spark, small):
    rows = [(r.vec_id, [float(x) for x in r.embedding]) for r in spark.read.parquet(f"{small}/embeddings.parquet").collect()]
    check(rows, QUERIES["op12_embedding_whitening"](spark, small).collect(), 8)
