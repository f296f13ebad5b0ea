import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import histogram as H
from tessera.operators import profile as P


def test_null_and_nan_are_missing(spark):
    df = spark.createDataFrame([(1.0, "a"), (float("nan"), None), (None, "b")], "x double, s string")
    got = {r["column"]: r["null_count"] for r in P.null_counts(df).collect()}
    assert got == {"x": 2, "s": 1}


def test_duplicates(spark):
    df = spark.createDataFrame([(1,), (1,), (1,), (2,)], "x int")
    assert P.duplicate_count(df).first()[0] == 2
    nulls = spark.createDataFrame([(None, None), (None, None), (1, None)], "a int, b string")
    assert P.duplicate_count(nulls).first()[0] == 1


def test_histogram_edges(spark):
    vals = [0.0, 1.0, 2.5, 9.999, 10.0, -0.1, 10.1]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    h = sorted((r["bin"], r["count"]) for r in H.histogram(df, "x", 0.0, 10.0, 4).collect())
    want, _ = np.histogram([v for v in vals if 0 <= v <= 10], bins=np.linspace(0, 10, 5))
    assert [c for _, c in h] == list(want)
    assert sum(c for _, c in h) == 5  # outside values dropped


def test_histogram_matches_numpy_on_floats(spark):
    rng = np.random.default_rng(3)
    vals = np.round(rng.uniform(5.31, 30.84, 4000), 2)
    df = spark.createDataFrame([(float(v),) for v in vals], "x double")
    h = sorted((r["bin"], r["count"]) for r in H.histogram(df, "x", 5.31, 30.84, 30).collect())
    want, _ = np.histogram(vals, bins=np.linspace(5.31, 30.84, 31))
    assert [c for _, c in h] == list(want)


@pytest.mark.parametrize("counts,peaks", [([2, 5, 5, 2], 0), ([1, 3, 1, 3, 1], 2), ([9, 1, 9], 0)])
def test_peaks(spark, counts, peaks):
    h = spark.createDataFrame(list(enumerate(counts)), "bin int, count long")
    assert H.count_peaks(h).first()["peaks"] == peaks


def test_exact_percentiles_match_numpy(spark):
    rng = np.random.default_rng(5)
    a = rng.integers(0, 50, 3000).astype(float)
    b = rng.normal(size=3000)
    df = spark.createDataFrame([(float(x), float(y)) for x, y in zip(a, b)], "a double, b double")
    qs = [0.001, 0.25, 0.5, 0.9, 0.999]
    got = {(r["feature"], r["q"]): r["value"] for r in P.percentiles(df, ["a", "b"], qs).collect()}
    for name, arr in (("a", a), ("b", b)):
        for q in qs:
            assert got[(name, q)] == pytest.approx(np.quantile(arr, q), rel=1e-12, abs=1e-12)


def test_describe_shape(spark, loans01):
    d = P.describe(loans01, ["loan_amnt", "dti"]).collect()
    assert {r["feature"] for r in d} == {"loan_amnt", "dti"}
    la = [r for r in d if r["feature"] == "loan_amnt"][0]
    assert la["count"] == 14997 and la["min"] <= la["p25"] <= la["p50"] <= la["p75"] <= la["max"]


def test_value_counts_normalized(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "s string")
    got = {r["s"]: (r["count"], r["share"]) for r in P.value_counts(df, "s", normalize=True).collect()}
    assert got == {"a": (2, pytest.approx(2 / 3)), "b": (1, pytest.approx(1 / 3))}
    kept = {r["s"]: r["count"] for r in P.value_counts(df, "s", dropna=False).collect()}
    assert kept[None] == 1


def test_threshold_ladder(spark):
    df = spark.createDataFrame([(0.005,), (0.05,), (3.0,)], "p double")
    thr, lab = P.recommend_missing_threshold(F.col("p"))
    got = [(r[0], r[1]) for r in df.select(thr, lab).collect()]
    assert got == [(0.01, "very strict"), (0.1, "strict"), (pytest.approx(3.3), "moderate")]
