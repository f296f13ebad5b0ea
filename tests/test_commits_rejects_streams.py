"""Commits written again (SNK3, REG2), lines that do not parse (SRC1), failed scans (SRC7), streams that resume (ST1, ST2)."""

import datetime as dt
import tempfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators import checks as C
from tessera.plans.jobs import validate_data
from tessera.sources import registry as REG
from tessera.sources.loans import ORDER_KEY
from tessera.sources.tables import read_csv_checked
from tessera.streaming import monitors as S


def _dir():
    return tempfile.mkdtemp(dir="/tmp")


def test_retried_commit_leaves_one_copy(spark):
    path = _dir() + "/runs"
    for _ in range(2):
        REG.log_run(spark, path, "r1", {"auc": 0.5}, {"c": 1}, commit="train-r1")
    REG.log_run(spark, path, "r1", {"accuracy": 0.7})
    REG.log_run(spark, path, "r1", {"accuracy": 0.7})  # without a name each write is a commit
    keys = sorted(r["key"] for r in REG.read_runs(spark, path).collect())
    assert keys == ["accuracy", "accuracy", "auc", "c"]
    with pytest.raises(ValueError):
        REG.log_run(spark, path, "r1", {"auc": 0.5}, commit="a/b")


def test_last_write_wins_at_equal_times(spark):
    path = _dir() + "/registry"
    at = dt.datetime(2024, 1, 1)
    for run in ("z", "m", "a"):
        REG.append_registry(spark, path, [dict(model_version_name="v1", run_id=run, registered_at=at),
                                          dict(model_version_name="v2", run_id=run, registered_at=at)])
    got = {r["model_version_name"]: (r["run_id"], r["seq"]) for r in REG.latest(REG.read_registry(spark, path)).collect()}
    assert got == {"v1": ("a", 5), "v2": ("a", 6)}
    # a clock that runs back does not bring an older row to the front
    REG.append_registry(spark, path, [dict(model_version_name="v1", run_id="b", registered_at=at - dt.timedelta(days=1))])
    assert REG.latest(REG.read_registry(spark, path)).filter("model_version_name = 'v1'").first()["run_id"] == "b"


def test_csv_rejects(spark):
    path = _dir() + "/t.csv"
    with open(path, "w") as f:
        f.write("id,name,x\n1,a,1.5\n2,b\n3,,\nx,c,2.0\n4,d,NaN\n5,e,1.0,9\n6,f,about 3\n")
    schema = T.StructType().add("id", T.LongType()).add("name", T.StringType()).add("x", T.DoubleType())
    rows, rejects = read_csv_checked(spark, path, schema)
    assert sorted(map(tuple, rows.collect())) == [(1, "a", 1.5), (3, None, None), (4, "d", None)]
    assert sorted(r["line"] for r in rejects.collect()) == ["2,b", "5,e,1.0,9", "6,f,about 3", "x,c,2.0"]
    # counts and pruned reads see the same lines
    assert rows.count() == 3 and rejects.count() == 4
    assert sorted(r["id"] for r in rows.select("id").collect()) == [1, 3, 4]


def test_csv_without_lines(spark):
    path = _dir() + "/t.csv"
    open(path, "w").close()
    schema = T.StructType().add("id", T.LongType())
    rows, rejects = read_csv_checked(spark, path, schema, header=False)
    assert rows.count() == 0 and rejects.count() == 0


def test_failed_scan_fails_its_dependents(spark):
    df = spark.createDataFrame([(1, 1, "Fully Paid", 1.0)], "issue_d int, id int, loan_status string, loan_amnt double")
    rep = {r["check_name"]: r for r in validate_data(spark, df, ORDER_KEY).collect()}
    assert {n: r["passed"] for n, r in rep.items()} == {
        "Chunked Data Processing": False, "Loan Status Distribution": False, "Interest Rate Sanity": False,
        "Missing Loan Amount": True}
    assert "Chunked Data Processing" in rep["Interest Rate Sanity"]["details"]
    with pytest.raises(C.QualityGateError):
        C.require_passed(validate_data(spark, df, ORDER_KEY))


EVENTS = "ts timestamp_ntz, kind string, value double"


def _add(spark, path, rows):
    spark.createDataFrame(rows, EVENTS).coalesce(1).write.mode("append").parquet(path)


def test_stream_resumes_and_counts_once(spark):
    base = _dir()
    src, out = base + "/in", base + "/out"
    day = dt.datetime(2024, 1, 1)
    schema = spark.createDataFrame([], EVENTS).schema
    _add(spark, src, [(day, "a", 1.0), (day, "b", None)])

    def drain(job=None):
        agg = S.quality_accumulators(S.read_stream(spark, src, schema), "kind", "value")
        return S.drain_complete(agg, out, job)["rows_read"]

    assert drain() == 2
    _add(spark, src, [(day, "a", 5.0)])
    assert drain() == 1  # only what is new is read
    assert drain() == 0
    got = {r["status"]: tuple(r)[1:] for r in spark.read.parquet(out).collect()}
    assert got == {"a": (2, 1.0, 5.0, 0), "b": (1, None, None, 1)}
    assert drain("other") == 3  # a job of another name starts anew


def test_failed_batch_is_not_counted_twice(spark):
    base = _dir()
    src, out = base + "/in", base + "/out"
    schema = spark.createDataFrame([], EVENTS).schema
    _add(spark, src, [(dt.datetime(2024, 1, 1), "a", 10.0)] * 3)
    agg = S.window_bin_counts(S.read_stream(spark, src, schema), "ts", "value", 0.0, 100.0, 10)
    folder = S.job_folder(spark, "st2", out, None)
    write = S._batch_writer(out)

    def fails(batch, batch_id):
        write(batch, batch_id)
        raise RuntimeError("lost after the write")

    with pytest.raises(Exception, match="lost after the write"):
        S._drain(agg, "update", fails, folder)
    S.drain_updates(agg, out)
    rows = spark.read.parquet(out).filter("count is not null").collect()
    assert [(r["bin"], r["count"]) for r in rows] == [(1, 3)]


def test_closed_windows_are_final(spark):
    base = _dir()
    src, out = base + "/in", base + "/out"
    schema = spark.createDataFrame([], EVENTS).schema
    ref = spark.createDataFrame([(5.0,), (95.0,)], "value double")

    def at(d, h=0):
        return dt.datetime(2024, 1, d, h)

    def drain():
        closed, figures = S.closed_window_drift(spark, src, schema, "ts", "value", ref, 0.0, 100.0, 10, out)
        return {r["window_start"].day: (r["rows"], r["ks_binned"]) for r in closed.collect()}, figures

    _add(spark, src, [(at(1), "a", 5.0), (at(1, 5), "a", 7.0), (at(2), "a", 5.0)])
    assert drain()[0] == {}  # no window is past the watermark
    _add(spark, src, [(at(9), "a", 50.0)])
    closed, figures = drain()
    assert closed == {1: (2, 0.5), 2: (1, 0.5)} and figures == {"rows_read": 1, "late_groups": 0}
    _add(spark, src, [(at(1, 6), "a", 99.0), (at(9, 1), "a", 51.0)])
    again, figures = drain()
    assert again == closed and figures["late_groups"] == 1
    _add(spark, src, [(at(20), "a", 1.0)])
    assert drain()[0][9] == (2, 0.5)
