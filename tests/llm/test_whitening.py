"""Whitening against numpy's eigenvectors of the whole covariance."""

import math
import os

import numpy as np
import pytest

from readloom.llm import queries, whitening

SF = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")


def frame(spark, vectors, ids=None):
    rows = [(i, v, 1, 0.5) for i, v in zip(ids or range(len(vectors)), vectors)]
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, n int, whitened double")


def exact(vectors):
    """Whole numbers, eigenvalues (falling), vectors, and whitened rows."""
    x = np.array([[math.floor(64 * c) + 1_000_000 for c in v] for v in vectors], dtype=object)
    n, far = len(x), len(x) * x - x.sum(axis=0)
    centred = far.astype(float) / n
    value, turn = np.linalg.eigh(centred.T @ centred / n)
    return far, value[::-1], turn[:, ::-1], centred


def assert_whitened(got, vectors, ids, wanted=32):
    far, value, turn, centred = exact(vectors)
    n, k = len(vectors), min(wanted, len(value), int((value > 1e-12 * value[0]).sum()))
    assert len(got) == n * k
    table = {(r.vec_id, r.component): r for r in got}
    made = np.array([[table[i, c + 1].whitened for c in range(k)] for i in ids])
    want = centred @ turn[:, :k] / np.sqrt(value[:k])
    made *= np.sign((made * want).sum(axis=0))
    assert np.abs(made - want).max() < 1e-9
    assert np.abs(np.cov(made.T, bias=True) - np.eye(k)).max() < 1e-9
    for i, row in zip(ids, far):
        r = table[i, 1]
        assert r.n == n and r.deviation == sum(int(v) ** 2 for v in row)
        assert 0 <= r.identity_error < 1e-9
    for c in range(k):
        assert table[ids[0], c + 1].explained == pytest.approx(value[c] / value.sum(), rel=1e-9)


@pytest.mark.parametrize("d", [1, 5, 40, 90])
def test_against_eigenvectors_of_the_covariance(spark, d):
    r = np.random.default_rng(d)
    vectors = (r.standard_normal((300, d)) * np.linspace(0.5, 3, d) + 7).tolist()
    assert_whitened(whitening.whiten(frame(spark, vectors)).collect(), vectors, range(300))


def test_filter_is_needed_and_certified():
    """A wide, nearly flat spectrum: more dimensions than the block has columns."""
    r = np.random.default_rng(1)
    turn = np.linalg.qr(r.standard_normal((200, 200)))[0]
    value = np.concatenate([[50, 20], np.linspace(2, 1, 198)])
    v = (turn * value) @ turn.T
    passes = []

    def multiply(q):
        passes.append(q.shape)
        return v @ q

    got, vectors, steps = whitening.components(multiply, 200)
    assert 1 < steps < 15 and len(passes) <= 1 + steps * (whitening.DEGREE + 1)
    assert np.allclose(got, value[:32], rtol=1e-12)
    assert np.linalg.norm(v @ vectors - vectors * got, axis=0).max() < 1e-12
    assert np.abs(np.abs((vectors * turn[:, :32]).sum(axis=0)) - 1).max() < 1e-12


def test_equal_eigenvalues_and_no_certificate():
    value = np.concatenate([np.full(60, 2.0), np.ones(60)])
    got, vectors, _ = whitening.components(lambda q: value[:, None] * q, 120)
    assert np.allclose(got, 2) and np.abs(vectors[60:]).max() < 1e-12
    with pytest.raises(whitening.NotCertified):
        r = np.random.default_rng(2)
        whitening.components(lambda q: value[:, None] * q + 1e-3 * r.standard_normal(q.shape), 120, rounds=3)


def test_filter_is_the_chebyshev_polynomial():
    value = np.linspace(0, 5, 11)
    got = whitening.filtered(lambda q: value[:, None] * q, np.eye(11), 0.0, 2.0, 5.0, 6)
    want = np.cosh(6 * np.arccosh((value + 0j) - 1)).real
    assert np.allclose(np.diag(got), want / want[-1], atol=1e-12)


def test_rows_left_out_and_odd_values(spark):
    r = np.random.default_rng(4)
    fine = r.standard_normal((60, 4)).tolist()
    odd = [None, [1.0, None, 2.0, 3.0], [1.0, float("nan"), 0.0, 0.0], [float("inf"), 0.0, 0.0, 0.0], [1.0, 2.0], []]
    assert_whitened(whitening.whiten(frame(spark, fine + odd)).collect(), fine, range(60))
    got = whitening.whiten(frame(spark, fine + odd, [*range(57), 56, None, None, *range(100, 106)])).collect()
    assert len(got) == 60 * 4 and sum(r.vec_id is None for r in got) == 8 and {r.n for r in got} == {60}


def test_equal_vectors_few_rows_and_no_rows(spark):
    assert whitening.whiten(frame(spark, [[1.0, 2.0]] * 5)).count() == 0
    assert whitening.whiten(frame(spark, [[1.0, 2.0]])).count() == 0
    assert whitening.whiten(frame(spark, [None, []])).count() == 0
    assert whitening.whiten(frame(spark, [])).columns == whitening.whiten(frame(spark, [[1.0, 2.0]])).columns
    # two vectors have variance in one direction only
    got = whitening.whiten(frame(spark, [[1.0, 2.0, 3.0], [2.0, 0.0, 3.0]])).collect()
    assert sorted(round(r.whitened, 12) for r in got) == [-1, 1] and {r.component for r in got} == {1}


def test_very_large_entries_stay_exact(spark):
    vectors = [[1e12 + i, float(i % 7), -1e300 if i == 3 else 1e12] for i in range(40)]
    got = {r.vec_id: r for r in whitening.whiten(frame(spark, vectors)).collect() if r.component == 1}
    held = [[max(min(c, 2.0 ** 46), -(2.0 ** 46)) for c in v] for v in vectors]
    far, *_ = exact(held)
    for i, row in enumerate(far):
        square = sum(int(v) ** 2 for v in row)
        assert got[i].deviation == (square if square < 2 ** 63 else None)


def test_query_on_the_whole_table(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding").collect()
    got = queries.QUERIES["op12_whitening"](spark, SF)
    assert dict(got.dtypes) == {"vec_id": "bigint", "component": "int", "n": "bigint", "deviation": "bigint", "whitened": "double",
                                "explained": "double", "identity_error": "double"}
    assert_whitened(got.collect(), [r.embedding for r in rows], [r.vec_id for r in rows])
