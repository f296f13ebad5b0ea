import json
import os
import tempfile

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tessera.operators import checks as C
from tessera.operators import metrics as M
from tessera.sources import registry as REG
from tessera.sources import sinks as SK
from tessera.sources.loans import LOAN_COLUMNS, loans
from tessera.sources.tables import LOAN_CSV_SCHEMA, read_csv, select_strict, select_tolerant

SF001 = "/root/testdata/sf0.001"


def test_csv_scan_with_schema(spark):
    """SRC1: the loan table written as CSV reads back with the explicit schema, row for row."""
    src = loans(spark, SF001)
    out = os.path.join(tempfile.mkdtemp(dir="/tmp"), "loans_csv")
    src.select(*[F.col(c).cast("string") if c == "issue_d" else F.col(c) for c in LOAN_COLUMNS]) \
        .write.option("header", True).csv(out)
    back = read_csv(spark, out, LOAN_CSV_SCHEMA)
    assert back.count() == src.count()
    assert back.schema == LOAN_CSV_SCHEMA
    a = {r["id"]: r["int_rate"] for r in src.select("id", "int_rate").collect()}
    b = {r["id"]: r["int_rate"] for r in back.select("id", "int_rate").collect()}
    assert a == b


def test_pruned_scans(spark):
    df = loans(spark, SF001)
    assert select_tolerant(df, ["id", "nope"]).columns == ["id"]
    with pytest.raises(PySparkException):
        select_strict(df, ["id", "nope"]).columns


def test_report_document_and_error_report(spark):
    rep = C.min_records_check(spark.range(3), 1)
    doc = json.loads(SK.report_document(rep, suite="s").first()["document"])
    assert doc["suite"] == "s" and doc["checks"][0]["passed"] is True
    err = SK.error_report(spark, ValueError("boom")).first()
    assert not err["passed"] and err["details"].startswith("SCRIPT_ERROR: ValueError")
    out = os.path.join(tempfile.mkdtemp(dir="/tmp"), "report")
    SK.write_report(rep, out)
    assert spark.read.json(out).count() == 1


def test_text_report(spark):
    df = spark.createDataFrame([(0, 0), (1, 1), (1, 0)], "label int, prediction int")
    txt = SK.text_report(M.classification_report(df))
    assert "precision" in txt and "weighted avg" in txt


def test_gate_inside_plan(spark):
    ok = C.min_records_check(spark.range(3), 1)
    assert C.assert_passed(ok).count() == 1
    bad = C.min_records_check(spark.range(3), 10)
    with pytest.raises(Exception):
        C.assert_passed(bad).collect()


def test_input_signature(spark):
    df = spark.createDataFrame([(i, float(i), "a") for i in range(10)], "id long, x double, c string")
    schema, example = REG.input_signature(df, ["x", "c"], ["id"])
    assert json.loads(schema)["fields"][0]["name"] == "x"
    assert len(json.loads(example)) == 5 and json.loads(example)[0]["x"] == 0.0
