import os
import tempfile

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tessera.operators import model as ML
from tessera.operators import robust as R
from tessera.plans import jobs as J
from tessera.sources import registry as REG
from tessera.sources.loans import ORDER_KEY

SF01 = "/root/testdata/sf0.01"


def _scratch():
    return tempfile.mkdtemp(prefix="tessera-test-", dir="/tmp")


def newton_weighted_lr(x, y, w, c):
    """Minimise c * sum w_i logloss_i + |beta|^2 / 2, the intercept (first) penalised as well."""
    n, d = x.shape
    xa = np.hstack([np.ones((n, 1)), x])
    beta = np.zeros(d + 1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-xa @ beta))
        g = c * xa.T @ (w * (p - y)) + beta
        h = c * (xa * (w * p * (1 - p))[:, None]).T @ xa + np.eye(d + 1)
        step = np.linalg.solve(h, g)
        beta -= step
        if np.abs(step).max() < 1e-13:
            break
    return beta


@pytest.mark.parametrize("cval", [1e-4, 0.1, 100.0])
def test_lr_matches_newton_solve(spark, cval):
    """Numbers and categories, a NULL category and missing numbers; the intercept is penalised."""
    rng = np.random.default_rng(0)
    n = 1500
    x = rng.normal(size=(n, 3))
    g = rng.integers(0, 4, n)
    y = (rng.uniform(size=n) < 1 / (1 + np.exp(-(x @ [1.0, -0.5, 0.2] - 1.0 + 0.7 * (g == 1))))).astype(int)
    names = ["r", "s", "t", None]
    rows = [(i, float(a), None if i % 50 == 0 else float(b), float(e), names[k], int(t))
            for i, ((a, b, e), k, t) in enumerate(zip(x, g, y))]
    df = spark.createDataFrame(rows, "id long, a double, b double, c double, g string, target int")
    model = ML.fit(df, c=cval, numeric=["a", "b", "c"], categorical=["g"])
    coef, icpt = ML.coefficients(model)
    x[::50, 1] = np.median(np.delete(x[:, 1], np.s_[::50]))
    z = (x - x.mean(axis=0)) / x.std(axis=0)
    hot = np.stack([g == 3, g == 0, g == 1, g == 2], 1).astype(float)  # Missing, r, s, t
    w = np.where(y == 1, n / (2 * y.sum()), n / (2 * (n - y.sum())))
    beta = newton_weighted_lr(np.hstack([z, hot]), y, w, cval)
    assert icpt == pytest.approx(beta[0], abs=1e-6)
    assert coef == pytest.approx(list(beta[1:]), abs=1e-6)
    out = ML.score(model, df).orderBy("id").collect()
    p = 1 / (1 + np.exp(-(np.hstack([z, hot]) @ beta[1:] + beta[0])))
    assert [r["score"] for r in out] == pytest.approx(list(p), abs=1e-6)


def test_separable_classes_converge(spark):
    df = spark.createDataFrame([(i, float(i), int(i >= 50)) for i in range(100)], "id long, a double, target int")
    model = ML.fit(df, c=1e6, numeric=["a"], categorical=[])
    z = (np.arange(100) - 49.5) / np.arange(100).std()
    beta = ML.coefficients(model)[0][0], ML.coefficients(model)[1]
    p = 1 / (1 + np.exp(-(z * beta[0] + beta[1])))
    y = (np.arange(100) >= 50).astype(float)
    assert abs(1e6 * z @ (p - y) + beta[0]) < 1e-3 * 1e6 and abs(beta[0]) > 10


def test_one_hot_unknown_and_null_are_zero(spark):
    train = spark.createDataFrame([(i, float(i % 7), "a" if i % 2 else "b", i % 2) for i in range(200)],
                                  "id long, v double, cat string, target int")
    model = ML.fit(train, 1.0, numeric=["v"], categorical=["cat"])
    test = spark.createDataFrame([(1, 1.0, "zzz", 0), (2, 1.0, None, 0)], "id long, v double, cat string, target int")
    vecs = model.transform(test).select(vector_to_array("cat__v").alias("v")).collect()
    # 'Missing' was never seen in training, so NULL -> 'Missing' -> unknown -> zeros, like an unseen level
    assert all(sum(r["v"]) == 0.0 for r in vecs)


def test_registry_last_write_wins_and_failures(spark):
    path = os.path.join(_scratch(), "registry")
    REG.register_model(spark, path, "v1", "file:/m/1", "r1", ["a"], ["b"])
    REG.register_model(spark, path, "v2", "file:/m/2", "r2", ["a"], ["b"])
    REG.register_model(spark, path, "v1", "file:/m/3", "r3", ["a"], ["b"])
    REG.record_failure(spark, path, "v2", "boom")
    REG.append_registry(spark, path, [dict(model_version_name="v3", run_id="r4", model_name=REG.MODEL_NAME, numeric_features=["a"],
                                           categorical_features=["b"], status="REGISTERED")])
    latest = {r["model_version_name"]: r for r in REG.validate(REG.latest(REG.read_registry(spark, path))).collect()}
    assert latest["v1"]["model_uri"] == "file:/m/3" and latest["v1"]["readiness"] == "READY"
    assert latest["v2"]["readiness"] == "TRAINING_FAILED"
    assert latest["v3"]["readiness"] == "INCOMPLETE"
    vers = sorted((r["run_id"], r["version"]) for r in REG.versions(REG.read_registry(spark, path)).collect())
    assert [v for _, v in vers] == [1, 2, 3, 4]
    assert REG.read_registry(spark, os.path.join(_scratch(), "none")).count() == 0


def test_perturb_edge_cases(spark):
    df = spark.createDataFrame([(i, 5.0, float(i) if i % 10 else None) for i in range(100)],
                               "id long, const double, x double")
    out = {r["id"]: r for r in R.perturb(df, ["const", "x"]).collect()}
    assert all(r["const"] == 5.0 for r in out.values())  # zero variance: unchanged
    assert out[0]["x"] is None and out[10]["x"] is None  # NULL stays NULL
    assert all(r["x"] is None or r["x"] >= 0.0 for r in out.values())  # clipped at 0


@pytest.fixture(scope="module")
def trained(spark):
    base = _scratch()
    reg, runs, models = (os.path.join(base, p) for p in ("registry", "runs", "models"))
    from tessera.sources.loans import loans
    df = loans(spark, SF01)
    r1 = J.train_model(spark, df, reg, runs, models, "V1_Default", c=1.0, max_iter=50)
    r2 = J.train_model(spark, df, reg, runs, models, "V2_Strong_Reg", c=0.1, max_iter=50)
    return df, reg, runs, r1, r2


def test_training_job(spark, trained):
    df, reg, runs, r1, r2 = trained
    assert r1["status"] == "success" and r2["status"] == "success"
    assert r1["test_rows"] == -(-(r1["train_rows"] + r1["test_rows"]) * 2 // 10)  # ceil(0.2 n)
    assert 0.4 < r1["roc_auc"] < 1.0
    keys = {r["key"] for r in REG.read_runs(spark, runs).filter(F.col("run_id") == r1["run_id"]).collect()}
    assert {"test_accuracy", "test_roc_auc", "train_set_size", "test_set_actual_size"} <= keys


def test_training_failure_is_recorded(spark, trained):
    df, reg, runs, *_ = trained
    out = J.train_model(spark, df.limit(10), reg, runs, "/tmp/unused-models", "V9_Tiny", min_records=1000)
    assert out["status"] == "failed"
    latest = {r["model_version_name"]: r["readiness"] for r in REG.validate(REG.latest(REG.read_registry(spark, reg))).collect()}
    assert latest["V9_Tiny"] == "TRAINING_FAILED" and latest["V1_Default"] == "READY"


def test_robustness_job(spark, trained):
    df, reg, runs, r1, _ = trained
    res = J.robustness_job(spark, df, ORDER_KEY, reg, runs, "V1_Default", chunks=2, chunk=3000).first()
    assert res["rows"] == 1000 and res["status"] == "completed"
    assert res["passed"] == (res["change_pct"] < 15.0)


def test_ab_job(spark, trained):
    df, reg, *_ = trained
    rep = {r["model_version_name"]: r for r in
           J.ab_job(spark, df, ORDER_KEY, reg, ["V1_Default", "V2_Strong_Reg", "Nope"], "t1", k=4, chunk=3000).collect()}
    assert rep["Nope"]["error"] == "Metadata not found"
    sizes = rep["V1_Default"]["test_data_size"] + rep["V2_Strong_Reg"]["test_data_size"]
    assert rep["Nope"]["test_data_size"] is None and 6000 < sizes < 10000  # two of three arms of 12,000 rows
    assert 0.4 < rep["V1_Default"]["roc_auc"] < 1.0


def test_drift_job(spark, trained):
    df, *_ = trained
    rep, status = J.drift_job(df, ORDER_KEY, chunk=3000)
    assert rep.count() == 8 and status.first()["overall_drift_status"] in ("DRIFT_DETECTED", "NO_DRIFT")
    _, skipped = J.drift_job(df, ORDER_KEY, chunk=50000)
    assert skipped.first()["overall_drift_status"] == "SKIPPED_TOO_SMALL"


def test_each_guard_has_its_own_status(spark, trained):
    df, reg, runs, *_ = trained
    few = df.limit(10)
    none = df.filter(F.col("loan_status") == "Default")
    holes = df.withColumn("dti", F.when(F.col("id") % 50 == 0, F.col("dti")))
    for data, want in ((none, J.STOPPED_EMPTY), (few, J.STOPPED_FEW), (holes, J.STOPPED_FEW_CLEAN)):
        out = J.train_model(spark, data, reg, runs, "/tmp/unused-models", "V8_Guard", min_records=1000)
        assert out["status"] == "failed" and out["training_status"] == want
        logged = {r["key"]: r["text"] for r in REG.read_runs(spark, runs).filter(F.col("run_id") == out["run_id"]).collect()}
        assert logged["training_status"] == want and logged["error_message"] == out["error"]


def test_robustness_without_training_rows(spark, trained):
    df, reg, runs, *_ = trained
    res = J.robustness_job(spark, df.filter(F.col("loan_status") == "Current"), ORDER_KEY, reg, runs, "V1_Default", chunks=1, chunk=100).first()
    assert res["status"] == J.ROBUSTNESS_EMPTY and res["passed"] is None


def test_a_broken_arm_leaves_the_others(spark, trained):
    df, reg, *_ = trained
    REG.register_model(spark, reg, "V7_Broken", "file:/no/such/model", "r7", ["dti"], ["grade"])
    rep = {r["model_version_name"]: r for r in J.ab_job(spark, df, ORDER_KEY, reg, ["V1_Default", "V7_Broken"], "t2", k=2, chunk=3000).collect()}
    assert rep["V7_Broken"]["error"] and rep["V7_Broken"]["roc_auc"] is None
    assert rep["V1_Default"]["error"] is None and 0.4 < rep["V1_Default"]["roc_auc"] < 1.0


def test_a_scorer_that_fails_while_running_leaves_the_others(spark):
    from tessera.operators.abtest import isolated_metrics
    d = spark.range(0, 400).select("id", (F.col("id") % 2).cast("int").alias("target"))
    good = lambda x: x.withColumn("score", F.rand(1))
    bad = lambda x: x.withColumn("score", F.raise_error(F.lit("broken scorer")).cast("double"))
    errors = {}
    rows = isolated_metrics(d, [good, bad], ["a", "b"], errors).collect()
    assert [r["arm"] for r in rows] == [0] and "broken scorer" in errors["b"]


def test_constants_are_those_of_the_imputed_values(spark):
    vals = [1.0, 2.0, 3.0, 10.0, None, float("nan")]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    median, mean, std = ML.fitted_constants(df, ["x"])["x"]
    full = np.array([1.0, 2.0, 3.0, 10.0, 2.5, 2.5])
    assert median == 2.5 and mean == pytest.approx(full.mean()) and std == pytest.approx(full.std())


def test_sweep_equals_single_fits(spark):
    rng = np.random.default_rng(3)
    rows = [(i, float(a), "u" if a > 0 else "v", int(a + rng.normal() > 0)) for i, a in enumerate(rng.normal(size=600))]
    df = spark.createDataFrame(rows, "id long, a double, g string, target int")
    models = ML.sweep(df, [1.0, 0.01], numeric=["a"], categorical=["g"])
    for c, m in models.items():
        want, icpt = ML.coefficients(ML.fit(df, c, numeric=["a"], categorical=["g"]))
        got, i2 = ML.coefficients(m)
        assert got == pytest.approx(want, abs=1e-6) and i2 == pytest.approx(icpt, abs=1e-6)


def test_fit_partitions_follow_the_size(spark):
    cores = spark.sparkContext.defaultParallelism
    assert ML.fit_partitions(spark, 100, 20) == cores
    assert ML.fit_partitions(spark, 10 ** 9, 20) >= 10 ** 9 * 20 * ML.ROW_BYTES_PER_COLUMN // ML.TARGET_PARTITION_BYTES
