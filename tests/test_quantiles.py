import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import profile as P
from tessera.operators import quantiles as Q
from tessera.operators import sampling as S

QS = [0.0, 0.01, 0.25, 0.5, 0.75, 0.999, 1.0]


def _columns():
    rng = np.random.default_rng(1)
    n = 4000
    return {"normal": rng.normal(size=n), "ties": np.where(rng.uniform(size=n) < 0.9, 0.0, rng.normal(size=n)),
            "two": rng.integers(0, 2, n).astype(float), "wide": np.exp(rng.normal(size=n) * 60), "const": np.full(n, -3.5),
            "neg": -np.abs(rng.normal(size=n)) * 1e-300, "gaps": np.where(rng.uniform(size=n) < 0.5, np.nan, rng.integers(0, 9, n))}


@pytest.mark.parametrize("accuracy, inside", [(10_000, 20_000), (40, 20)])
def test_percentiles_are_exact(spark, monkeypatch, accuracy, inside):
    """Coarse sketches and few values brought along only mean more rounds."""
    monkeypatch.setattr(Q, "ACCURACY", accuracy)
    monkeypatch.setattr(Q, "INSIDE", inside)
    monkeypatch.setattr(Q, "MARGIN_ROWS", 0)
    cols = _columns()
    df = spark.createDataFrame([tuple(None if math.isnan(v) and i % 2 else float(v) for v in r) for i, r in enumerate(zip(*cols.values()))],
                               ", ".join(f"{c} double" for c in cols)).withColumn("none", F.lit(None).cast("double")).repartition(5)
    got = {(r["feature"], r["q"]): r["value"] for r in P.percentiles(df, [*cols, "none"], QS).collect()}
    for c, v in cols.items():
        for q in QS:
            assert got[c, q] == pytest.approx(np.quantile(v[~np.isnan(v)], q), rel=1e-12), (c, q)
    assert not any(c == "none" for c, _ in got)


def test_plan_needs_no_checkpoint(spark, tmp_path):
    before = spark.sparkContext.getCheckpointDir()
    df = spark.range(0, 50_000).select((F.col("id") * 7919 % 50_000).cast("double").alias("x"))
    assert Q.exact_percentiles(df, {"x": F.col("x")}, [0.5])[0]["x", 0.5] == 24_999.5
    assert spark.sparkContext.getCheckpointDir() == before
    assert Q.kth_smallest(df.select((F.col("x") % 3).alias("x")), F.col("x"), 20_000) == 1.0
    assert Q.kth_smallest(df, F.col("x"), 50_000) is None and Q.kth_smallest(df.limit(0), F.col("x"), 0) is None


def test_empty_and_tiny(spark):
    df = spark.createDataFrame([(1.0, 1), (None, 2)], "x double, k int")
    assert [tuple(r) for r in P.percentiles(df, ["x"], [0.0, 0.5]).collect()] == [("x", 0.0, 1.0), ("x", 0.5, 1.0)]
    assert P.percentiles(df.limit(0), ["x"], [0.5]).collect() == []
    d = P.describe(df.limit(0), ["x"]).first()
    assert d["count"] == 0 and d["p50"] is None and d["mean"] is None
    g = P.grouped_percentiles(df, "k", [1, 2, None], ["x"], [0.5]).collect()
    assert [tuple(r) for r in g] == [(1, "x", 0.5, 1.0)]


@pytest.mark.parametrize("seed", range(4))
def test_duplicates_by_digest(spark, seed):
    rng = np.random.default_rng(seed)
    vals = [None, 0.0, -0.0, float("nan"), 1.5]
    rows = [(vals[rng.integers(5)], [None, "", "a"][rng.integers(3)], [None, 1][rng.integers(2)]) for _ in range(rng.integers(1, 60))]
    df = spark.createDataFrame(rows, "x double, s string, k int").repartition(3)
    want = len(rows) - df.groupBy("x", "s", "k").count().count()
    assert P.duplicate_count(df).first()[0] == want
    old, P.MAX_REPEATED = P.MAX_REPEATED, 0
    try:
        assert P.duplicate_count(df).first()[0] == want
    finally:
        P.MAX_REPEATED = old
    assert P.duplicate_count(df.limit(0)).first()[0] == 0


@pytest.mark.parametrize("share", [0.4])
def test_split_where_one_id_holds_a_third(spark, share):
    """Sizes are exact, rows are kept, and the split does not depend on the partitions."""
    def table(n, equal):
        hot = F.col("id") % 3 == 0
        return n.select(F.when(hot, F.lit(7)).otherwise(F.col("id")).alias("id"), (F.col("id") % 2).alias("y"),
                        F.when(hot, F.lit(0) if equal else F.col("id")).otherwise(1).alias("v"))

    for equal in (True, False):
        src = [table(spark.range(0, 9000, 1, p).orderBy(order), equal) for p, order in ((4, "id"), (7, F.desc("id")))]
        q = S.stratified_quotas(src[0], "y", share)
        want = {r["y"]: (r["train_rows"], r["test_rows"]) for r in q.collect()}
        out = [S.stratified_split(d, "y", share) for d in src]
        for o in out:
            assert o.columns == ["id", "y", "v", "is_test"]
            got = {r["y"]: (r["a"], r["b"]) for r in o.groupBy("y").agg(F.count_if(~F.col("is_test")).alias("a"), F.count_if("is_test").alias("b")).collect()}
            assert got == want
        count = [sorted(map(tuple, o.groupBy(*o.columns).count().collect())) for o in out]
        assert count[0] == count[1]
        assert sorted(map(tuple, out[0].drop("is_test").groupBy("id", "y", "v").count().collect())) == \
            sorted(map(tuple, src[0].groupBy("id", "y", "v").count().collect()))
    r = S.random_split(spark.range(0, 500).select(F.lit(None).cast("long").alias("id")), 0.3)
    assert r.filter("is_test").count() == 150 and r.count() == 500


@pytest.mark.parametrize("q", [0.001, 0.5, 0.999])
def test_a_rank_at_an_end_beside_one_outside(spark, q):
    """The sketch gives one value as both ends; one wanted rank is that value, the other lies before or after it."""
    for n in (1498, 1499, 1500, 1501):
        found, _ = Q.exact_percentiles(spark.range(n).select((F.col("id") * 2.0 + 10.0).alias("x")), {"x": F.col("x")}, [q])
        assert found["x", q] == pytest.approx(10.0 + 2.0 * q * (n - 1), abs=1e-9)
