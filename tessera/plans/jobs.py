"""End-to-end jobs: validation gate (E1), training + registration (E2), A/B evaluation (E3),
drift monitoring (E4) and robustness (E5). Each is a few DataFrame plans; only report rows,
fitted constants and registry rows of the requested models reach the driver."""

from __future__ import annotations

import time
from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.parse import numeric_if_text
from ..operators import checks as C
from ..operators import drift as D
from ..operators import metrics as M
from ..operators import model as ML
from ..operators import position as POS
from ..operators import robust as R
from ..operators.abtest import ab_report, isolated_metrics
from ..operators.sampling import exact_sample, stratified_quotas, stratified_split
from ..sources import registry as REG


# --- E1 ------------------------------------------------------------------------------------------

# The checks that read the shared scan.
SCAN_DEPENDENTS = ("Loan Status Distribution", "Interest Rate Sanity")


def validate_data(spark: SparkSession, df: DataFrame, order_by: Sequence[str]) -> DataFrame:
    """DQ6: the three-check suite, each check isolated. A failing shared scan gives a failed row for itself and one
    for each of the two checks that read its results."""
    def shared():
        scan = C.status_rate_scan(df)
        return C._explode_rows(scan, [C.status_distribution_row(scan), C.rate_sanity_row()])
    return C.run_suite(spark, [("Chunked Data Processing", shared, SCAN_DEPENDENTS),
                               ("Missing Loan Amount", lambda: C.missing_on_sample_check(df, order_by))])


def validate_path(spark: SparkSession, path: str, order_by: Sequence[str], fmt: str = "parquet") -> DataFrame:
    """SRC7: like ``validate_data`` but a missing or unreadable input yields a failed
    'File Existence' / 'Data Loading' row instead of an exception."""
    try:
        df = spark.read.format(fmt).load(path)
    except Exception as e:  # noqa: BLE001  (any load failure is reported, not raised)
        name = "File Existence" if "PATH_NOT_FOUND" in str(e) or "does not exist" in str(e) else "Data Loading"
        return C.failed_row(spark, name, f"{type(e).__name__}: {e}")
    return validate_data(spark, df, order_by)


# The training and robustness states that run records name.
STOPPED_EMPTY = "failed_no_data_after_filter"
STOPPED_FEW = "failed_insufficient_data"
STOPPED_FEW_CLEAN = "failed_insufficient_data_post_nan"
STOPPED_ERROR = "failed_exception"
ROBUSTNESS_EMPTY = "skipped_no_data"


class TrainingStopped(ValueError):
    """A guard stopped the training; ``status`` names it in the run record."""

    def __init__(self, status: str, message: str):
        super().__init__(message)
        self.status = status


# --- E2 ------------------------------------------------------------------------------------------

def train_model(spark: SparkSession, df: DataFrame, registry_path: str, runs_path: str, model_dir: str,
                version_name: str, c: float = 1.0, test_fraction: float = 0.2, sample_size: int | None = None,
                min_records: int = 1000, seed: int = 42, max_iter: int = 100, key: str = "id") -> dict:
    """Filter by status -> (optional exact sample) -> guard -> prepare -> guards -> stratified split
    -> fit -> evaluate -> save -> log metrics -> register. The sample is drawn before rows with
    missing features are dropped. A failure appends a TRAINING_FAILED registry row; each guard has
    a status of its own."""
    run_id = REG.new_run_id()
    timings: dict[str, float] = {}
    clock = [time.perf_counter()]

    def lap(step: str) -> None:
        now = time.perf_counter()
        timings[step] = round(now - clock[0], 3)
        clock[0] = now

    params: dict[str, object] = {"regularization_c": c, "test_set_prop": test_fraction, "min_records": min_records,
                                 "model_version_name": version_name, "sample_size": sample_size}
    d = None
    try:
        raw = df.filter(F.col("loan_status").isin(ML.TRAINING_STATUSES))
        if sample_size:
            raw = exact_sample(raw, sample_size, seed=seed, key=key)
        before = raw.select("loan_status").count()
        if not before:
            raise TrainingStopped(STOPPED_EMPTY, "no row has one of the training statuses")
        if before < min_records:
            raise TrainingStopped(STOPPED_FEW, f"{before} rows have a training status, {min_records} are needed")
        d = ML.prepare(raw, "binary")
        keep = [c for c in dict.fromkeys([key, "target", *ML.NUMERIC, *ML.CATEGORICAL]) if c in d.columns]
        # the split, every fit pass and the evaluation read the prepared rows: the one cached frame
        # (MEMORY_AND_DISK; lost blocks are recomputed from the deterministic lineage)
        d = d.select(*keep).repartition(ML.fit_partitions(spark, before, len(keep))).persist(StorageLevel.MEMORY_AND_DISK)
        n = d.count()
        lap("prepare")
        if n < min_records:
            raise TrainingStopped(STOPPED_FEW_CLEAN, f"{n} of {before} rows have all features, {min_records} are needed")
        quotas = stratified_quotas(d, "target", test_fraction).collect()  # one row per class
        sizes = {"train": sum(r["train_rows"] for r in quotas), "test": sum(r["test_rows"] for r in quotas)}
        split = stratified_split(d, "target", test_fraction, seed=seed, key=key)
        train = split.filter(~F.col("is_test"))
        test = split.filter(F.col("is_test"))
        lap("split")
        model = ML.fit(train, c, max_iter=max_iter, rows=sizes["train"], cached=True)
        lap("fit")
        scored = ML.score(model, test, keep=[key, "target"])
        acc = M.accuracy(scored, "target", "prediction").first()["accuracy"]
        auc_row = M.roc_auc(scored, "target", "score").first()
        report = M.classification_report(scored, "target", "prediction", {0: "Fully Paid", 1: "Charged Off"})
        lap("evaluate")
        uri = f"{model_dir.rstrip('/')}/{run_id}"
        model.write().overwrite().save(uri)
        numeric = [x for x in ML.NUMERIC if x in test.columns]
        categorical = [x for x in ML.CATEGORICAL if x in test.columns]
        schema, example = REG.input_signature(test, numeric + categorical, [key])
        params.update(train_set_size=sizes.get("train", 0), test_set_actual_size=sizes.get("test", 0),
                      numeric_features_used=", ".join(numeric), categorical_features_used=", ".join(categorical),
                      training_status="success")
        REG.log_run(spark, runs_path, run_id, {"test_accuracy": acc, "test_roc_auc": auc_row["roc_auc"]}, params,
                    commit=f"train-{run_id}")
        REG.register_model(spark, registry_path, version_name, uri, run_id, numeric, categorical, schema, example,
                           commit=f"train-{run_id}")
        lap("save_register")
        return {"run_id": run_id, "model_uri": uri, "accuracy": acc, "roc_auc": auc_row["roc_auc"],
                "train_rows": sizes.get("train", 0), "test_rows": sizes.get("test", 0), "report": report,
                "status": "success", "timings": timings}
    except Exception as e:  # noqa: BLE001  (recorded, then reported to the caller)
        status = e.status if isinstance(e, TrainingStopped) else STOPPED_ERROR
        params.update(training_status=status, error_message=str(e))
        REG.log_run(spark, runs_path, run_id, None, params, commit=f"train-{run_id}")
        REG.record_failure(spark, registry_path, version_name, str(e), run_id, commit=f"train-{run_id}")
        return {"run_id": run_id, "status": "failed", "training_status": status, "error": str(e)}
    finally:
        if d is not None:
            d.unpersist()


def _model_row(spark: SparkSession, registry_path: str, version_name: str):
    rows = (REG.validate(REG.latest(REG.read_registry(spark, registry_path)))
            .filter(F.col("model_version_name") == version_name).collect())
    return rows[0] if rows else None


# --- E5 ------------------------------------------------------------------------------------------

def robustness_job(spark: SparkSession, df: DataFrame, order_by: Sequence[str], registry_path: str,
                   runs_path: str, version_name: str, chunks: int = 2, chunk: int = 100000,
                   key: str = "id") -> DataFrame:
    """RB*: first ``chunks`` chunks of raw rows, then the status filter (SLC3), cleaned as in
    training; flip rate of the registered model under seeded noise; result logged to the run."""
    m = _model_row(spark, registry_path, version_name)
    if m is None:
        raise KeyError(f"Metadata for model version '{version_name}' not found")
    if m["readiness"] != "READY":
        return spark.createDataFrame([(0, 0, 0.0, None, f"skipped_{m['readiness'].lower()}")],
                                     "rows long, changed long, change_pct double, passed boolean, status string")
    model = PipelineModel.load(m["model_uri"])
    head = POS.head_slice(df, order_by, chunks, chunk)
    if not head.filter(F.col("loan_status").isin(ML.TRAINING_STATUSES)).limit(1).count():
        res = spark.createDataFrame([(0, 0, 0.0, None, ROBUSTNESS_EMPTY)],
                                    "rows long, changed long, change_pct double, passed boolean, status string")
        REG.append_run_rows(R.robustness_record(res, m["run_id"]), runs_path, commit=f"robustness-{m['run_id']}")
        return res
    clean = ML.prepare(head, "binary", numeric=list(m["numeric_features"]),
                       categorical=list(m["categorical_features"]))
    res = R.robustness(clean, lambda d: ML.score(model, d, keep=[key]), key=key)
    REG.append_run_rows(R.robustness_record(res, m["run_id"]), runs_path, commit=f"robustness-{m['run_id']}")
    return res


# --- E4 ------------------------------------------------------------------------------------------

def drift_job(df: DataFrame, order_by: Sequence[str], features: Sequence[str] = D.DRIFT_FEATURES,
              mode: str = "chunks", k: int = 2, chunk: int = 50000, fraction: float = 0.1,
              alpha: float = D.ALPHA) -> tuple[DataFrame, DataFrame]:
    """DR*: (per-feature report, one-row overall status). Text percent columns are parsed."""
    feats = [f for f in features if f in df.columns]
    src = df.select(*order_by, *[numeric_if_text(df, f) for f in feats])
    ref, cur, status = POS.slices(src, order_by, mode, k, chunk, fraction)
    rep = D.ks_drift(ref, cur, feats, alpha)
    return rep, D.drift_status(rep, status)


# --- E3 ------------------------------------------------------------------------------------------

def ab_job(spark: SparkSession, df: DataFrame, order_by: Sequence[str], registry_path: str,
           names: Sequence[str], test_id: str, k: int = 4, chunk: int = 50000, key: str = "id") -> DataFrame:
    """AB*: the last ``k`` chunks, labelled over every status; arm i scored by the i-th
    requested model (missing or unusable models give error rows)."""
    tail = POS.tail_slice(df, order_by, k, chunk)
    d = ML.prepare(tail, "all")
    reg = REG.latest(REG.read_registry(spark, registry_path))
    wanted = {r["model_version_name"]: r for r in reg.filter(F.col("model_version_name").isin(list(names))).collect()}
    scorers, errors = [], {}
    for n in names:
        r = wanted.get(n)
        model = None
        if r is not None and r["model_uri"]:
            try:
                model = PipelineModel.load(r["model_uri"])
            except Exception as e:  # noqa: BLE001  (this arm gets an error row, the others go on)
                errors[n] = f"{type(e).__name__}: {e}"
        scorers.append(None if model is None else lambda x, m=model: ML.score(m, x, keep=[key, "target", "arm"]))
    measured = isolated_metrics(d, scorers, names, errors, key)
    return ab_report(spark, measured, names, reg, test_id, errors)
