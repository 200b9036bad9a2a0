"""Whitening against a dense eigendecomposition, and odd inputs."""

import numpy as np
import pytest

from fareflow.llm import whitening
from tests.conftest import SF

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def dense(vectors):
    x = np.array([np.floor(64 * np.array(v, float)) for v in vectors])
    fit = np.unique(x, axis=0)
    centred = fit - fit.mean(0)
    e, v = np.linalg.eigh(centred.T @ centred / len(fit))
    return x, fit, e[::-1], v[:, ::-1]


def check(df, wanted=16):
    got = whitening.whitened(df, wanted).orderBy("vec_id", "component").collect()
    rows = {r.vec_id: list(r.embedding) for r in df.collect()}
    x, fit, e, v = dense([rows[i] for i in sorted(rows)])
    k = max((r.component for r in got), default=0)
    assert k == min(wanted, int(np.sum(e > 1e-10 * e[0])))
    w = np.array([r.whitened for r in got]).reshape(len(rows), k)
    centred = x - fit.mean(0)
    n, sums = len(fit), fit.sum(0)
    assert [r.deviation for r in got[::k]] == np.sum((n * x - sums)**2, axis=1).astype(int).tolist()
    assert {r.n for r in got} == {n}
    assert np.allclose([r.explained for r in got[:k]], e[:k] / e.sum(), rtol=1e-9)
    assert len({r.identity_error for r in got}) == 1 and got[0].identity_error < 1e-6
    return w, centred, e, v


def test_equals_dense_decomposition(spark):
    w, centred, e, v = check(spark.read.parquet(f"{SF}/embeddings.parquet"))
    want = centred @ v[:, :16] / np.sqrt(e[:16])
    assert np.abs(w * np.sign((w * want).sum(0)) - want).max() < 1e-8


def test_repeats_count_once_and_rank_is_kept(spark):
    chance = np.random.default_rng(1)
    base = chance.normal(size=(30, 3)) @ chance.normal(size=(3, 8)).round(1)
    rows = [(i, [float(c) for c in np.round(base[i % 30] * 4) / 4], 0) for i in range(90)]
    check(spark.createDataFrame(rows, SCHEMA))


def test_equal_eigenvalues_are_all_found(spark):
    """Corners of a simplex: the recurrence ends after one step and has to go on."""
    rows = [(i, [4.0 if i == j else 0.0 for j in range(9)], 0) for i in range(9)]
    w, centred, e, _ = check(spark.createDataFrame(rows, SCHEMA))
    assert w.shape == (9, 8) and np.allclose(w.T @ w / 9, np.eye(8))


def test_odd_rows(spark):
    good = [(1, [0.0, 1.0], 0), (2, [1.0, 0.0], 0), (2, [1.0, 0.0], 0), (None, [0.5, 0.25], 0)]
    odd = [(3, None, 0), (4, [], 0), (5, [1.0, None], 0), (6, [1.0, float("nan")], 0), (7, [float("inf"), 0.0], 0),
           (8, [1e30, 0.0], 0), (9, [1.0, 2.0, 3.0], 0)]
    got = whitening.whitened(spark.createDataFrame(good + odd, SCHEMA)).collect()
    assert sorted((str(r.vec_id), r.component) for r in got) == [("1", 1), ("1", 2), ("2", 1), ("2", 1), ("2", 2), ("2", 2),
                                                                 ("None", 1), ("None", 2)]
    assert {r.n for r in got} == {3}


@pytest.mark.parametrize("rows", [[], [(1, None, 0)], [(1, [1.0, 2.0], 0), (2, [1.0, 2.0], 0)]])
def test_nothing_to_whiten(spark, rows):
    got = whitening.whitened(spark.createDataFrame(rows, SCHEMA))
    assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert got.count() == 0


def test_large_numbers_stay_exact(spark):
    rows = [(i, [float(2**30 * (i % 3)), float(i)], 0) for i in range(6)]
    got = whitening.whitened(spark.createDataFrame(rows, SCHEMA))
    x = [[int(64 * c) for c in r[1]] for r in rows]
    sums = [sum(c) for c in zip(*x)]
    for r in got.collect():
        exact = sum((6 * c - s)**2 for c, s in zip(x[r.vec_id], sums))
        assert r.deviation == (exact if exact < 2**63 else None)


def test_clashing_names(spark):
    df = spark.read.parquet(f"{SF}/embeddings.parquet").limit(20).selectExpr("*", "1 AS x", "2 AS n", "3 AS component", "4 AS part")
    assert whitening.whitened(df).columns[0] == "vec_id"
