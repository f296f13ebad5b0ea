import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import drift as D
from tessera.operators import metrics as M


def _frame(spark, vals, name="x"):
    return spark.createDataFrame([(float(v),) for v in vals], f"{name} double")


def brute_ks(a, b):
    a, b = np.sort(a), np.sort(b)
    xs = np.concatenate([a, b])
    fa = np.searchsorted(a, xs, side="right") / len(a)
    fb = np.searchsorted(b, xs, side="right") / len(b)
    return np.max(np.abs(fa - fb))


def test_ks_identical_disjoint_ties(spark):
    a = [1, 2, 2, 3, 3, 3]
    r = D.ks_drift(_frame(spark, a), _frame(spark, a), ["x"]).first()
    assert r["ks_statistic"] == 0.0 and r["p_value"] == 1.0 and not r["drift_detected"]
    r = D.ks_drift(_frame(spark, [1, 2, 3]), _frame(spark, [10, 11]), ["x"]).first()
    assert r["ks_statistic"] == 1.0


def test_ks_empty_side_gives_no_row(spark):
    ref = spark.createDataFrame([(1.0, None), (2.0, None)], "x double, y double")
    cur = spark.createDataFrame([(1.5, 3.0)], "x double, y double")
    rows = D.ks_drift(ref, cur, ["x", "y"]).collect()
    assert [r["feature"] for r in rows] == ["x"]


def test_ks_matches_brute_force_and_repartition(spark):
    rng = np.random.default_rng(11)
    a = np.round(rng.normal(0, 1, 3000), 2)
    b = np.round(rng.normal(0.1, 1.2, 2500), 2)
    ref, cur = _frame(spark, a), _frame(spark, b)
    r = D.ks_drift(ref, cur, ["x"]).first()
    assert r["ks_statistic"] == pytest.approx(brute_ks(a, b), abs=1e-15)
    r2 = D.ks_drift(ref.repartition(5), cur.repartition(3), ["x"]).first()
    assert r2["ks_statistic"] == r["ks_statistic"]


def test_pvalue_golden_order_of_magnitude(spark):
    """n=100,000, m=60,701, D=0.0174805 -> about 1.9e-10 (asymptotic series)."""
    df = spark.createDataFrame([(0.017480493418343013, 100000, 60701)], "d double, n long, m long")
    p = df.select(D.ks_pvalue(F.col("d"), F.col("n"), F.col("m"))).first()[0]
    assert 1.5e-10 < p < 2.5e-10


def _scored(spark, pairs):
    return spark.createDataFrame([(int(y), float(s)) for y, s in pairs], "label int, score double")


def test_auc_edge_cases(spark):
    assert M.roc_auc(_scored(spark, [(0, 0.1), (0, 0.2), (1, 0.8), (1, 0.9)])).first()["roc_auc"] == 1.0
    assert M.roc_auc(_scored(spark, [(1, 0.1), (1, 0.2), (0, 0.8), (0, 0.9)])).first()["roc_auc"] == 0.0
    assert M.roc_auc(_scored(spark, [(1, 0.5), (0, 0.5), (1, 0.5), (0, 0.5)])).first()["roc_auc"] == 0.5
    r = M.roc_auc(_scored(spark, [(1, 0.5), (1, 0.7)])).first()
    assert r["roc_auc"] is None and "Only one class" in r["error"]
    r = M.roc_auc(_scored(spark, [(1, 0.0), (0, -0.0)])).first()
    assert r["roc_auc"] == 0.5


def test_auc_matches_mann_whitney(spark):
    rng = np.random.default_rng(2)
    y = rng.integers(0, 2, 2000)
    s = np.round(rng.normal(y * 0.5, 1.0), 1)
    got = M.roc_auc(_scored(spark, zip(y, s))).first()["roc_auc"]
    pos, neg = s[y == 1], s[y == 0]
    want = ((pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()) / (len(pos) * len(neg))
    assert got == pytest.approx(want, abs=1e-12)


def test_classification_report_zero_division(spark):
    df = spark.createDataFrame([(0, 0), (1, 0), (0, 0)], "label int, prediction int")
    rep = {r["class"]: r for r in M.classification_report(df).collect()}
    assert rep["1"]["precision"] == 0.0 and rep["1"]["recall"] == 0.0 and rep["1"]["support"] == 1
    assert rep["accuracy"]["f1_score"] == pytest.approx(2 / 3)


def test_flip_rate_strict_threshold(spark):
    df = spark.createDataFrame([(0, 1 if i < 15 else 0) for i in range(100)], "a int, b int")
    r = M.flip_rate(df, "a", "b", 15.0).first()
    assert r["change_pct"] == 15.0 and r["passed"] is False


def test_p_values_of_published_large_samples(spark):
    """Statistic, effective size and p-value of a published two-sample test (100,000 and 60,701 rows)."""
    from tessera.operators.drift import ks_pvalue
    for d, want in ((0.07248990461127863, 4.767747510233309e-173), (0.04640825647868996, 3.926036568760343e-71),
                    (0.017480493418343013, 1.8628524086694412e-10)):
        got = spark.range(1).select(ks_pvalue(F.lit(d), F.lit(100_000), F.lit(60_701)).alias("p")).first()["p"]
        assert abs(got / want - 1) < 0.05
