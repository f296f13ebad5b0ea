"""Queries: data-quality checks, suite and guards (DQ1-DQ9). Report rows are flattened to
``(check_name, sub_check, passed, metric, value)`` for comparison."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import checks as C
from ..session import checkpoint_dir
from ..sources.loans import ORDER_KEY
from ..sources.tables import read_csv_checked, read_table
from .catalog import RATE_FRAC_SQL, RATE_PCT_SQL, loans_df, register, with_loans
from .jobs import validate_data


def flatten(report: DataFrame) -> DataFrame:
    """Report rows -> one row per metric (metrics map exploded, values rounded to 6 digits)."""
    return report.select("check_name", F.coalesce("sub_check", F.lit("")).alias("sub_check"), "passed",
                         F.explode("metrics").alias("metric", "value")).withColumn("value", F.round("value", 6))


def _range_sql(name, x, missing_limit, lo, hi, nlo, nhi, src="loans"):
    return f""", a AS (SELECT COUNT(*) AS n, COUNT({x}) AS nv, COUNT(*) - COUNT({x}) AS miss,
    COUNT(*) FILTER (WHERE {x} < {lo}) AS below, COUNT(*) FILTER (WHERE {x} > {hi}) AS above,
    COUNT(*) FILTER (WHERE {x} BETWEEN {nlo} AND {nhi}) AS within FROM {src}),
b AS (SELECT *, miss * 100.0 / n AS mp, below * 100.0 / nv AS bp, above * 100.0 / nv AS ap, within * 100.0 / nv AS wp FROM a),
rows AS (
  SELECT 'missing_values' AS sub_check, COALESCE(mp <= {missing_limit}, false) AS passed, 'count' AS metric, CAST(miss AS DOUBLE) AS value FROM b
  UNION ALL SELECT 'missing_values', COALESCE(mp <= {missing_limit}, false), 'percentage', mp FROM b
  UNION ALL SELECT 'missing_values', COALESCE(mp <= {missing_limit}, false), 'threshold', {missing_limit} FROM b
  UNION ALL SELECT 'below_minimum', COALESCE(bp <= 0.1, false), 'threshold', {lo} FROM b
  UNION ALL SELECT 'below_minimum', COALESCE(bp <= 0.1, false), 'count', below FROM b
  UNION ALL SELECT 'below_minimum', COALESCE(bp <= 0.1, false), 'percentage', bp FROM b
  UNION ALL SELECT 'above_maximum', COALESCE(ap <= 0.1, false), 'threshold', {hi} FROM b
  UNION ALL SELECT 'above_maximum', COALESCE(ap <= 0.1, false), 'count', above FROM b
  UNION ALL SELECT 'above_maximum', COALESCE(ap <= 0.1, false), 'percentage', ap FROM b
  UNION ALL SELECT 'within_normal_range', COALESCE(wp >= 98.0, false), 'range_low', {nlo} FROM b
  UNION ALL SELECT 'within_normal_range', COALESCE(wp >= 98.0, false), 'range_high', {nhi} FROM b
  UNION ALL SELECT 'within_normal_range', COALESCE(wp >= 98.0, false), 'count', within FROM b
  UNION ALL SELECT 'within_normal_range', COALESCE(wp >= 98.0, false), 'percentage', wp FROM b)"""


_DQ1_SQL = with_loans(_range_sql("loan_amount_distribution", "loan_amnt", 0.01, 1000.0, 40000.0, 1525.0, 40000.0)
                      + """
SELECT 'loan_amount_distribution' AS check_name, sub_check, passed, metric, ROUND(value, 6) AS value FROM rows""")


@register("dq1_loan_amount_check", _DQ1_SQL)
def dq1_loan_amount_check(spark, sf):
    return flatten(C.loan_amount_check(loans_df(spark, sf)))


def _dq2_sql():
    from .q_profile import hist_sql
    rate = RATE_PCT_SQL
    return with_loans(f""", r AS (SELECT {rate} AS v FROM loans)""" + _range_sql(
        "interest_rate_distribution", "v", 0.1, 5.31, 30.84, 5.32, 26.77, src="r") + f""",
h AS ({hist_sql('r', 'v', 5.31, 30.84, 30)}),
pk AS (SELECT COUNT(*) FILTER (WHERE count > pc AND count > nc) AS peaks FROM
  (SELECT count, LAG(count) OVER (ORDER BY bin) AS pc, LEAD(count) OVER (ORDER BY bin) AS nc FROM h))
SELECT 'interest_rate_distribution' AS check_name, sub_check, passed, metric, ROUND(value, 6) AS value FROM rows
UNION ALL SELECT 'interest_rate_distribution', 'distribution_pattern', peaks >= 3, 'peaks_detected', CAST(peaks AS DOUBLE) FROM pk
UNION ALL SELECT 'interest_rate_distribution', 'distribution_pattern', peaks >= 3, 'minimum_expected_peaks', 3.0 FROM pk""")


@register("dq2_interest_rate_check", _dq2_sql())
def dq2_interest_rate_check(spark, sf):
    return flatten(C.interest_rate_check(loans_df(spark, sf)))


_SCAN_SQL = f""", s AS (SELECT loan_status AS status, COUNT(*) AS cnt,
    MIN({RATE_FRAC_SQL}) AS mn, MAX({RATE_FRAC_SQL}) AS mx FROM loans GROUP BY loan_status),
t AS (SELECT SUM(cnt) FILTER (WHERE status IS NOT NULL) AS n, MIN(mn) AS min_rate, MAX(mx) AS max_rate FROM s),
ok3 AS (SELECT COALESCE((SELECT COUNT(*) FROM s WHERE status = 'Fully Paid') > 0
          AND (SELECT COUNT(*) FROM s WHERE status = 'Charged Off') > 0 AND (SELECT n FROM t) > 0, false) AS passed),
ok4 AS (SELECT COALESCE(min_rate >= 0.0531 * 0.9 AND max_rate <= 0.3084 * 1.1, false) AS passed, min_rate, max_rate FROM t)"""

_DQ3_ROWS = """SELECT 'Loan Status Distribution' AS check_name, '' AS sub_check, (SELECT passed FROM ok3) AS passed,
  status AS metric, ROUND(cnt / CAST((SELECT n FROM t) AS DOUBLE), 6) AS value FROM s WHERE status IS NOT NULL"""
_DQ4_ROWS = """SELECT 'Interest Rate Sanity' AS check_name, '' AS sub_check, passed, 'min_rate' AS metric,
  ROUND(min_rate, 6) AS value FROM ok4
UNION ALL SELECT 'Interest Rate Sanity', '', passed, 'max_rate', ROUND(max_rate, 6) FROM ok4"""
_DQ5_ROWS = """SELECT 'Missing Loan Amount' AS check_name, '' AS sub_check, mp < 1.0 AS passed,
  'missing_percentage' AS metric, ROUND(mp, 6) AS value FROM
  (SELECT AVG(CASE WHEN loan_amnt IS NULL THEN 1.0 ELSE 0.0 END) * 100.0 AS mp FROM
    (SELECT loan_amnt FROM loans ORDER BY issue_d, id LIMIT 10000))"""


@register("dq3_status_distribution", with_loans(_SCAN_SQL + "\n" + _DQ3_ROWS))
def dq3_status_distribution(spark, sf):
    return flatten(C.status_check(loans_df(spark, sf)))


@register("dq4_rate_sanity", with_loans(_SCAN_SQL + "\n" + _DQ4_ROWS))
def dq4_rate_sanity(spark, sf):
    return flatten(C.rate_sanity_check(loans_df(spark, sf)))


@register("dq5_missing_on_head_sample", with_loans("\n" + _DQ5_ROWS))
def dq5_missing_on_head_sample(spark, sf):
    return flatten(C.missing_on_sample_check(loans_df(spark, sf), ORDER_KEY))


@register("dq6_suite", with_loans(_SCAN_SQL + "\n" + _DQ3_ROWS + "\nUNION ALL\n" + _DQ4_ROWS + "\nUNION ALL\n" + _DQ5_ROWS))
def dq6_suite(spark, sf):
    return flatten(C.default_suite(loans_df(spark, sf), ORDER_KEY))


@register("dq6_suite_overall", with_loans(_SCAN_SQL + """, rep AS (
  SELECT passed FROM ok3 UNION ALL SELECT passed FROM ok4 UNION ALL
  SELECT mp < 1.0 FROM (SELECT AVG(CASE WHEN loan_amnt IS NULL THEN 1.0 ELSE 0.0 END) * 100.0 AS mp FROM
    (SELECT loan_amnt FROM loans ORDER BY issue_d, id LIMIT 10000)))
SELECT COALESCE(BOOL_AND(passed), false) AS all_passed, COUNT(*) AS checks, COUNT(*) FILTER (WHERE NOT passed) AS failed FROM rep"""))
def dq6_suite_overall(spark, sf):
    return C.overall(C.default_suite(loans_df(spark, sf), ORDER_KEY))


@register("src7_failed_scan", with_loans("""
SELECT check_name, false AS passed, missing FROM (SELECT COUNT(*) FILTER (WHERE loan_status IS NULL) AS missing FROM loans) a
  CROSS JOIN (VALUES ('Chunked Data Processing'), ('Loan Status Distribution'), ('Interest Rate Sanity')) v(check_name)
UNION ALL SELECT check_name, passed, (SELECT COUNT(*) FILTER (WHERE loan_status IS NULL) FROM loans) FROM (""" + _DQ5_ROWS + ")"))
def src7_failed_scan(spark, sf):
    """SRC7: the shared scan fails (no rate column); it and the two checks that need it are failed rows, the
    independent check still runs. ``missing`` counts the loans without a status, from the table that was scanned."""
    d = loans_df(spark, sf)
    report = validate_data(spark, d.drop("int_rate"), ORDER_KEY)
    missing = d.select(F.count_if(F.col("loan_status").isNull())).scalar()
    return report.select("check_name", "passed", missing.alias("missing"))


@register("src1_csv_rejects", """SELECT CASE WHEN o_orderkey % 89 = 0 OR o_orderkey % 97 = 0 THEN 'rejected' ELSE 'read' END AS part,
  COUNT(*) AS rows, CAST(SUM(o_orderkey) AS BIGINT) AS keys,
  MAX(CASE WHEN o_orderkey % 89 <> 0 AND o_orderkey % 97 <> 0 THEN o_totalprice END) AS most FROM orders GROUP BY 1""")
def src1_csv_rejects(spark, sf):
    """SRC1: orders written as CSV lines, of which those of two residues are broken (a price that is no number, a
    missing field), read back with the reject channel."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/csv-{uuid.uuid4().hex}"
    k = F.col("o_orderkey")
    key, status, price = (F.coalesce(c.cast("string"), F.lit("")) for c in (k, F.col("o_orderstatus"), F.col("o_totalprice")))
    line = (F.when(k % 97 == 0, F.concat_ws(",", key, status))
            .when(k % 89 == 0, F.concat_ws(",", key, status, F.concat(F.lit("about "), price)))
            .otherwise(F.concat_ws(",", key, status, price)))
    read_table(spark, sf, "orders").select(line.alias("value")).write.text(path)
    schema = T.StructType().add("key", T.LongType()).add("status", T.StringType()).add("price", T.DoubleType())
    rows, rejects = read_csv_checked(spark, path, schema, header=False)
    lost = rejects.select(F.split("line", ",")[0].cast("long").alias("key"), F.lit(None).cast("double").alias("price"))
    both = rows.select(F.lit("read").alias("part"), "key", "price").unionByName(lost.withColumn("part", F.lit("rejected")))
    return both.groupBy("part").agg(F.count(F.lit(1)).alias("rows"), F.sum("key").alias("keys"), F.max("price").alias("most"))


@register("dq8_min_records", with_loans("""SELECT 'Minimum Records' AS check_name, '' AS sub_check, COUNT(*) >= 1000 AS passed,
  'rows' AS metric, CAST(COUNT(*) AS DOUBLE) AS value FROM loans WHERE loan_status IN ('Fully Paid', 'Charged Off')
UNION ALL SELECT 'Minimum Records', '', COUNT(*) >= 1000, 'minimum', 1000.0 FROM loans WHERE loan_status IN ('Fully Paid', 'Charged Off')"""))
def dq8_min_records(spark, sf):
    d = loans_df(spark, sf).filter(F.col("loan_status").isin("Fully Paid", "Charged Off"))
    return flatten(C.min_records_check(d, 1000))


@register("dq9_allowed_values", with_loans("""SELECT 'Allowed Values' AS check_name, 'loan_status' AS sub_check, bad = 0 AS passed,
  'outside' AS metric, CAST(bad AS DOUBLE) AS value FROM a
UNION ALL SELECT 'Allowed Values', 'loan_status', bad = 0, 'percentage', ROUND(bad * 100.0 / nv, 6) FROM a""").replace(
    "SELECT 'Allowed Values' AS", """, a AS (SELECT COUNT(*) FILTER (WHERE loan_status IS NOT NULL AND loan_status NOT IN
  ('Fully Paid', 'Charged Off', 'Current', 'In Grace Period', 'Late (16-30 days)', 'Late (31-120 days)', 'Default')) AS bad,
  COUNT(loan_status) AS nv FROM loans)
SELECT 'Allowed Values' AS""", 1))
def dq9_allowed_values(spark, sf):
    return flatten(C.allowed_values_check(loans_df(spark, sf)))
