import math
from fractions import Fraction

import numpy as np
import pytest

from tessera.llm.queries import QUERIES
from tessera.llm.whitening import covariance, eigenvalues_below, exact_moments, largest_eigenpairs, whiten

SCHEMA = "vec_id long, embedding array<double>"


def brute(vectors):
    """x-vectors as whole numbers, exact covariance in doubles, falling eigenvalues and vectors."""
    x = [[math.floor(Fraction(c) * 64) + 1_000_000 for c in v] for v in vectors]
    n, d = len(x), len(x[0])
    s = [sum(v[j] for v in x) for j in range(d)]
    centred = [[n * v[j] - s[j] for j in range(d)] for v in x]
    cov = [[float(Fraction(sum(c[i] * c[j] for c in centred), n ** 3)) for j in range(d)] for i in range(d)]
    values, q = np.linalg.eigh(np.array(cov))
    return x, s, [sum(t * t for t in c) for c in centred], np.array(cov), values[::-1], q[:, ::-1]


def check(out, vectors, ids, k=32):
    x, s, dev, cov, values, q = brute(vectors)
    n = len(x)
    got = {}
    for r in out.collect():
        got[r.vec_id, r.component] = r
    rank = sum(v > 1e-10 * values[0] for v in values[:k])
    assert len(got) == n * rank
    gaps = np.abs(np.subtract.outer(values, values)) + np.eye(len(values)) * 1e300
    for c in range(rank):
        w = np.array([got[i, c + 1].whitened for i in ids])
        r = got[ids[0], c + 1]
        assert r.n == n and abs(r.explained - values[c] / np.trace(cov)) < 1e-9 and r.identity_error < 1e-8
        assert [got[i, c + 1].deviation for i in ids] == [v if v < 2 ** 63 else None for v in dev]
        if gaps[c].min() > 1e-6 * values[0]:
            own = (np.array(x, float) - np.array(s) / n) @ q[:, c] / math.sqrt(values[c])
            own *= np.sign(own @ w)
            assert np.abs(own - w).max() < 1e-6 * max(1, np.abs(own).max())


def test_against_brute_force(spark):
    rng = np.random.default_rng(3)
    v = (rng.standard_normal((150, 40)) * np.geomspace(3, 0.2, 40) @ np.linalg.qr(rng.standard_normal((40, 40)))[0] + 0.7).tolist()
    v += [v[0]] * 30
    df = spark.createDataFrame(list(enumerate(v)), SCHEMA).selectExpr("*", "'x' as component", "1 as n").repartition(6)
    out = whiten(df)
    assert out.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    check(out, v, list(range(len(v))))


def test_large_entries_are_exact(spark):
    v = [[1e9, 3.25], [1e9 + 1, -2.0], [-5e9, 0.015625], [2e9, 7.0], [1e10, 1.0]]
    check(whiten(spark.createDataFrame(list(enumerate(v)), SCHEMA)), v, list(range(5)))
    m = exact_moments(spark.createDataFrame(list(enumerate(v)), SCHEMA).select("embedding").toDF("v").repartition(3), 2)
    x = [[math.floor(Fraction(c) * 64) for c in r] for r in v]
    assert m[1, 1] == sum(r[0] ** 2 for r in x) and m[2, 1] == sum(r[0] * r[1] for r in x) and m[0, 0] == 5
    assert np.allclose(covariance(m), np.cov(np.array(x, float).T, bias=True), rtol=1e-12)


def test_edges(spark):
    rows = [(1, [1.0, 2.0]), (2, None), (3, [1.0, None]), (4, [float("nan"), 1.0]), (5, [float("inf"), 0.0]), (None, [0.5, 0.0]),
            (6, [0.0, 1.5]), (6, [0.0, 1.5]), (7, [1.0]), (8, []), (9, [1e300, 1.0])]
    out = whiten(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((r.vec_id or 0, r.component) for r in out) == sorted([(i, c) for i in (0, 1, 6, 6) for c in (1, 2)])
    assert {r.n for r in out} == {4}
    for none in ([], [(1, [1.0, 2.0])], [(1, [1.0]), (2, [1.0])], [(1, None)], [(1, [])]):
        got = whiten(spark.createDataFrame(none, SCHEMA))
        assert got.collect() == [] and got.columns[0] == "vec_id"
    tied = whiten(spark.createDataFrame([(1, [1.0]), (2, [2.0]), (3, [1.0, 2.0]), (4, [5.0, 1.0])], SCHEMA)).collect()
    assert {r.vec_id for r in tied} == {3, 4} and len(tied) == 2
    floats = whiten(spark.createDataFrame(rows, "`v.i` long, `my vec` array<float>"), "v.i", "my vec")
    assert floats.columns[0] == "v.i" and floats.count() == 8


@pytest.mark.parametrize("kind", ["spread", "close", "equal", "low rank", "one", "clusters", "wide"])
def test_eigenpairs(kind):
    rng = np.random.default_rng(5)
    n = {"one": 1, "wide": 200}.get(kind, 60)
    q = np.linalg.qr(rng.standard_normal((n, n)))[0]
    e = {"spread": np.geomspace(1e5, 1e-3, n), "close": 1 + 1e-9 * np.arange(n), "equal": np.ones(n),
         "low rank": np.where(np.arange(n) < 5, 3.0, 0), "one": np.array([2.5]), "clusters": np.repeat([9.0, 4, 1], n // 3),
         "wide": np.linspace(1, 2, n)}[kind]
    m = (q * e) @ q.T
    m = (m + m.T) / 2
    values, vectors = largest_eigenpairs(m, 32)
    want = np.sort(e)[::-1][:32]
    want = want[want > 1e-12 * e.max()]
    assert len(values) == len(want) and np.allclose(values, want, rtol=1e-9, atol=1e-11 * e.max())
    assert np.abs(vectors.T @ vectors - np.eye(len(values))).max() < 1e-12
    assert np.abs(m @ vectors - vectors * values).max() < 1e-11 * e.max()


def test_inertia():
    rng = np.random.default_rng(1)
    for n in (1, 2, 3, 10, 40):
        m = rng.standard_normal((n, n))
        m = m + m.T
        if n > 2:
            np.fill_diagonal(m, 0)
        e = np.linalg.eigvalsh(m)
        for s in (*((e[1:] + e[:-1]) / 2), e[0] - 1, e[-1] + 1):
            assert eigenvalues_below(m, s) == (e < s).sum()


def test_query(spark, sf001):
    rows = spark.read.parquet(f"{sf001}/embeddings.parquet").select("vec_id", "embedding").collect()
    check(QUERIES["op12_whitening"](spark, sf001), [r.embedding for r in rows], [r.vec_id for r in rows])
