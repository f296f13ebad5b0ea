"""Queries on NULL and NaN keys, groups, labels and values, ties, and absent columns or sides, on
columns that Spark derives from the loan table."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import checks as C
from ..operators import drift as D
from ..operators import histogram as H
from ..operators import metrics as M
from ..operators import position as POS
from ..operators import profile as P
from ..operators import sampling as S
from ..sources.loans import ORDER_KEY
from .catalog import loans_df, r6, register, sql_prep, with_loans
from .q_eval import CUT, _SCORED, _auc_out, _ks_out, _KS_CHUNKS, _KS_SELECT, auc_sql, drift_input, scored
from .q_position import CHUNK
from .q_profile import _hist_bin_sql

_NULL_KEY = ", nk AS (SELECT id, CASE WHEN id % 10 <> 0 THEN issue_d END AS d FROM loans)"


def _null_key(spark, sf):
    return loans_df(spark, sf).select("id", F.when(F.col("id") % 10 != 0, F.col("issue_d")).alias("d"))


@register("slc1_head_null_key", with_loans(_NULL_KEY + f" SELECT id FROM nk ORDER BY d NULLS FIRST, id LIMIT {2 * CHUNK}"))
def slc1_head_null_key(spark, sf):
    """SLC1 when a tenth of the leading order keys are NULL (they come first)."""
    return POS.head_slice(_null_key(spark, sf), ["d", "id"], 2, CHUNK).select("id")


@register("slc2_tail_null_key", with_loans(_NULL_KEY + f""", ix AS (SELECT id, ROW_NUMBER() OVER (ORDER BY d NULLS FIRST, id) - 1 AS idx,
  COUNT(*) OVER () AS n FROM nk) SELECT id FROM ix WHERE FLOOR(idx / {CHUNK}) >= CEIL(n / {float(CHUNK)}) - 2"""))
def slc2_tail_null_key(spark, sf):
    return POS.tail_slice(_null_key(spark, sf), ["d", "id"], 2, CHUNK).select("id")


@register("slc1_head_inside_null_keys", with_loans(_NULL_KEY + " SELECT id FROM nk ORDER BY d NULLS FIRST, id LIMIT 100"))
def slc1_head_inside_null_keys(spark, sf):
    """The boundary of the slice lies among the NULL keys."""
    return POS.head_slice(_null_key(spark, sf), ["d", "id"], 1, 100).select("id")


@register("met2_roc_auc_null_group", sql_prep("", _SCORED + """, g AS (SELECT target, score,
  CASE WHEN id % 4 <> 0 THEN grade END AS grp FROM sc)""" + auc_sql("g", "grp")))
def met2_roc_auc_null_group(spark, sf):
    """MET2 when a quarter of the rows has no group: they are a group of their own."""
    s = scored(loans_df(spark, sf)).withColumn("grp", F.when(F.col("id") % 4 != 0, F.col("grade")))
    return _auc_out(M.roc_auc(s, "target", "score", ["grp"]), ["grp"])


@register("met2_roc_auc_tied_scores", sql_prep("", _SCORED + ", t AS (SELECT target, grade, FLOOR(score * 4.0) AS score FROM sc)"
                                               + auc_sql("t", "grade")))
def met2_roc_auc_tied_scores(spark, sf):
    """MET2 on a score with few values: ties of a positive and a negative count one half."""
    s = scored(loans_df(spark, sf)).withColumn("score", F.floor(F.col("score") * 4.0).cast("double"))
    return _auc_out(M.roc_auc(s, "target", "score", ["grade"]), ["grade"])


_NAN = ", nn AS (SELECT CASE WHEN id % 9 = 0 THEN NULL ELSE loan_amnt END AS x FROM loans)"


def _nan_amount(spark, sf):
    return loans_df(spark, sf).select(F.when(F.col("id") % 9 == 0, F.lit(float("nan"))).otherwise(F.col("loan_amnt")).alias("x"))


@register("agg14_range_counts_nan", with_loans(_NAN + """ SELECT COUNT(*) AS n_rows, COUNT(x) AS n_valid, COUNT(*) - COUNT(x) AS missing,
  COUNT(*) FILTER (WHERE x < 1000.0) AS below, COUNT(*) FILTER (WHERE x > 40000.0) AS above,
  COUNT(*) FILTER (WHERE x BETWEEN 1525.0 AND 40000.0) AS within FROM nn"""))
def agg14_range_counts_nan(spark, sf):
    """AGG14 with NaN in a ninth of the rows: NaN is missing, not above the range."""
    r = P.range_counts(_nan_amount(spark, sf), "x", 1000.0, 40000.0, 1525.0, 40000.0)
    return r.select("n_rows", "n_valid", "missing", "below", "above", "within")


@register("dq1_range_check_nan", with_loans(_NAN + """ SELECT COUNT(*) - COUNT(x) AS missing, COUNT(*) FILTER (WHERE x > 40000.0) AS above FROM nn"""))
def dq1_range_check_nan(spark, sf):
    rep = C.range_check(_nan_amount(spark, sf), F.col("x"), "nan", **C.AMOUNT_RULES)
    n = F.col("metrics")["count"].cast("long")
    return rep.agg(F.max(F.when(F.col("sub_check") == "missing_values", n)).alias("missing"),
                   F.max(F.when(F.col("sub_check") == "above_maximum", n)).alias("above"))


@register("agg23_histogram_null_group", with_loans(f""", t AS (SELECT CASE WHEN id % 4 <> 0 THEN grade END AS grp, dti FROM loans WHERE dti IS NOT NULL),
r AS (SELECT grp, MIN(dti) AS lo, MAX(dti) AS hi FROM t GROUP BY grp),
c AS (SELECT t.grp, {_hist_bin_sql('t.dti', 'r.lo', 'r.hi', 20)} AS bin, COUNT(*) AS cnt
  FROM t JOIN r ON t.grp IS NOT DISTINCT FROM r.grp GROUP BY 1, 2)
SELECT r.grp, CAST(g.bin AS INTEGER) AS bin, CAST(COALESCE(c.cnt, 0) AS BIGINT) AS count
FROM r CROSS JOIN range(20) g(bin) LEFT JOIN c ON c.grp IS NOT DISTINCT FROM r.grp AND c.bin = g.bin"""))
def agg23_histogram_null_group(spark, sf):
    """AGG23 when a quarter of the rows has no group."""
    d = loans_df(spark, sf).select(F.when(F.col("id") % 4 != 0, F.col("grade")).alias("grp"), "dti")
    return H.grouped_histogram(d, "dti", 20, ["grp"]).select("grp", "bin", "count")


@register("smp3_split_null_label", with_loans(""", t AS (SELECT id, CASE WHEN id % 5 <> 0 THEN id % 2 END AS y FROM loans),
c AS (SELECT y, COUNT(*) AS n FROM t GROUP BY y), q AS (SELECT y, n, CAST(CEIL(0.25 * n) AS BIGINT) AS k FROM c)
SELECT t.id, ROW_NUMBER() OVER (PARTITION BY t.y ORDER BY md5('42:' || CAST(t.id AS VARCHAR)), t.id) <= q.k AS is_test
FROM t JOIN q ON t.y IS NOT DISTINCT FROM q.y"""))
def smp3_split_null_label(spark, sf):
    """SMP3 with a fifth of the labels NULL, which form a class; a quarter of each class is marked."""
    d = loans_df(spark, sf).select("id", F.when(F.col("id") % 5 != 0, F.col("id") % 2).alias("y"))
    q = d.groupBy("y").agg(F.count(F.lit(1)).alias("class_rows")).withColumn(
        "test_rows", F.ceil(F.lit(0.25) * F.col("class_rows")).cast("bigint"))
    return S.hash_rank_split(d, q, "y", 42, "id", "is_test").select("id", "is_test")


@register("smp3_split_repeated_ids", with_loans(""", t AS (SELECT CASE WHEN id % 3 = 0 THEN 7 ELSE id END AS id, id % 2 AS y,
  CASE WHEN id % 3 = 0 THEN grade ELSE sub_grade END AS g FROM loans),
c AS (SELECT y, COUNT(*) AS n FROM t GROUP BY y), q AS (SELECT y, n, CAST(CEIL(0.4 * n) AS BIGINT) AS k FROM c),
m AS (SELECT t.id, t.y, t.g, ROW_NUMBER() OVER (PARTITION BY t.y ORDER BY md5('42:' || CAST(t.id AS VARCHAR)), t.id,
  md5('{"id":' || CAST(t.id AS VARCHAR) || ',"y":' || CAST(t.y AS VARCHAR) || ',"g":"' || t.g || '"}')) <= q.k AS is_test
FROM t JOIN q ON t.y = q.y)
SELECT id, y, g, is_test, COUNT(*) AS rows FROM m GROUP BY ALL"""))
def smp3_split_repeated_ids(spark, sf):
    """SMP3 where one id holds a third of the rows, most of them equal as a whole: sizes stay exact."""
    hot = F.col("id") % 3 == 0
    d = loans_df(spark, sf).select(F.when(hot, F.lit(7)).otherwise(F.col("id")).cast("long").alias("id"), (F.col("id") % 2).alias("y"),
                                   F.when(hot, F.col("grade")).otherwise(F.col("sub_grade")).alias("g"))
    q = d.groupBy("y").agg(F.count(F.lit(1)).alias("class_rows")).withColumn(
        "test_rows", F.ceil(F.lit(0.4) * F.col("class_rows")).cast("bigint"))
    s = S.hash_rank_split(d, q, "y", 42, "id", "is_test")
    return s.groupBy("id", "y", "g", "is_test").agg(F.count(F.lit(1)).alias("rows"))


@register("dr4_empty_side", _KS_CHUNKS.replace("ref AS (SELECT * FROM ix", "ref AS (SELECT * REPLACE (CAST(NULL AS DOUBLE) AS dti) FROM ix", 1)
          + _KS_SELECT)
def dr4_empty_side(spark, sf):
    """DR4: a feature without values on one side has no row in the report."""
    ref, cur, _ = POS.slices(drift_input(loans_df(spark, sf)), ORDER_KEY, "chunks", 2, CHUNK)
    return _ks_out(D.ks_drift(ref.withColumn("dti", F.lit(None).cast("double")), cur))


@register("prj4_missing_column", with_loans("""SELECT 'Missing Loan Amount' AS check_name, COUNT(*) < 0 AS passed,
  'column loan_amnt is absent' AS details FROM loans"""))
def prj4_missing_column(spark, sf):
    """PRJ4: the head-sample check on a table without the column gives a failed row."""
    return C.missing_on_sample_check(loans_df(spark, sf).drop("loan_amnt"), ORDER_KEY).select("check_name", "passed", "details")
