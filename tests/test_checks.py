import pytest
from pyspark.sql import functions as F

from tessera.operators import checks as C
from tessera.plans.jobs import validate_data, validate_path
from tessera.sources.loans import ORDER_KEY


def test_range_check_empty_and_all_null(spark):
    empty = spark.createDataFrame([], "loan_amnt double")
    rows = C.loan_amount_check(empty).collect()
    assert len(rows) == 4 and not any(r["passed"] for r in rows)
    nulls = spark.createDataFrame([(None,), (None,)], "loan_amnt double")
    rows = {r["sub_check"]: r for r in C.loan_amount_check(nulls).collect()}
    assert rows["missing_values"]["metrics"]["percentage"] == 100.0
    assert rows["below_minimum"]["metrics"]["percentage"] is None
    assert not rows["below_minimum"]["passed"]


def test_fixture_expectations(loans01):
    """FIXTURES: below-minimum fails (2.38 %), rate sanity passes, 5 peaks in 30 bins."""
    amt = {r["sub_check"]: r for r in C.loan_amount_check(loans01).collect()}
    assert not amt["below_minimum"]["passed"]
    assert amt["below_minimum"]["metrics"]["percentage"] == pytest.approx(2.38, abs=0.01)
    rate = {r["sub_check"]: r for r in C.interest_rate_check(loans01).collect()}
    assert rate["distribution_pattern"]["metrics"]["peaks_detected"] == 5
    suite = {r["check_name"]: r for r in C.default_suite(loans01, ORDER_KEY).collect()}
    assert suite["Interest Rate Sanity"]["passed"]
    assert suite["Loan Status Distribution"]["passed"]
    assert suite["Missing Loan Amount"]["passed"]


def test_status_check_missing_required(spark):
    df = spark.createDataFrame([("Current", "10%"), ("Fully Paid", "12%")], "loan_status string, int_rate string")
    r = C.status_check(df).first()
    assert not r["passed"] and "not found: Charged Off" in r["details"]


def test_gate(spark, loans01):
    rep = validate_data(spark, loans01, ORDER_KEY)
    assert C.require_passed(rep)
    bad = spark.createDataFrame([("Current", None, 1.0)], "loan_status string, int_rate string, loan_amnt double")
    rep2 = validate_data(spark, bad.withColumn("issue_d", F.lit(1)).withColumn("id", F.lit(1)), ORDER_KEY)
    with pytest.raises(C.QualityGateError):
        C.require_passed(rep2)


def test_missing_file_becomes_failed_row(spark):
    rep = validate_path(spark, "/nonexistent/loans.parquet", ORDER_KEY).collect()
    assert len(rep) == 1 and rep[0]["check_name"] == "File Existence" and not rep[0]["passed"]


def test_suite_isolates_failures(spark):
    def boom():
        return spark.sql("SELECT no_such_col FROM range(1)")
    rep = C.run_suite(spark, [("Broken", boom), ("Ok", lambda: C.min_records_check(spark.range(5), 1))]).collect()
    assert [r["passed"] for r in rep] == [False, True]


def test_missing_column_fails(spark):
    df = spark.createDataFrame([(1, 1)], "issue_d int, id int")
    r = C.missing_on_sample_check(df, ORDER_KEY).first()
    assert not r["passed"] and "absent" in r["details"]
