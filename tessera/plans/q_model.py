"""Queries: model inputs and fitted models (ML*), scalar helpers (SC10-SC16) and the report
document sink (SNK1). Fitting is iterative (``pyspark.ml``), so fit/score queries have no SQL
oracle and are checked by row count plus the numeric pytest against a Newton solve."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import functions as F

from ..functions.misc import join_names, linspace, split_names, status_text
from ..operators import metrics as M
from ..operators import model as ML
from ..operators.checks import default_suite
from ..operators.sampling import split_hash, stratified_quotas, stratified_split
from ..session import checkpoint_dir
from ..sources.loans import ORDER_KEY
from ..sources.sinks import report_document
from .catalog import loans_df, r6, register, sql_prep, with_loans

_BIN_NUMERIC = ["loan_amnt", "annual_inc", "dti", "revol_bal", "total_acc"]

_ML_CLEAN = """, mlc AS (SELECT * FROM prep WHERE loan_status IN ('Fully Paid', 'Charged Off')
  AND loan_amnt IS NOT NULL AND int_rate_frac IS NOT NULL AND installment IS NOT NULL AND annual_inc IS NOT NULL
  AND dti IS NOT NULL AND delinq_2yrs IS NOT NULL AND inq_last_6mths IS NOT NULL AND open_acc IS NOT NULL
  AND pub_rec IS NOT NULL AND revol_bal IS NOT NULL AND revol_util_frac IS NOT NULL AND total_acc IS NOT NULL
  AND emp_length_numeric IS NOT NULL)"""


def ml_clean(spark, sf):
    return ML.prepare(loans_df(spark, sf), "binary")


@register("ml7_class_weights", sql_prep("""SELECT target, ROUND(CAST(SUM(c) OVER () AS DOUBLE) / (2 * c), 6) AS class_weight, c AS rows
FROM (SELECT target, COUNT(*) AS c FROM mlc GROUP BY target)""", _ML_CLEAN))
def ml7_class_weights(spark, sf):
    d = ML.with_class_weights(ml_clean(spark, sf))
    return d.groupBy("target").agg(r6(F.first("class_weight")).alias("class_weight"), F.count(F.lit(1)).alias("rows"))


def _constants_sql():
    parts = []
    for c in _BIN_NUMERIC:
        parts.append(f"SELECT '{c}' AS feature, ROUND(QUANTILE_CONT({c}, 0.5), 6) AS median, ROUND(AVG({c}), 6) AS mean, "
                     f"ROUND(STDDEV_POP({c}), 6) AS std_pop FROM mlc")
    return sql_prep("\n" + "\nUNION ALL\n".join(parts), _ML_CLEAN)


@register("ml1_ml2_fitted_constants", _constants_sql())
def ml1_ml2_fitted_constants(spark, sf):
    """ML1 + ML2: exact medians (imputation) and mean / population std (scaling) on the
    training rows, by the function that ``model.fit`` uses (a few scalars per feature)."""
    consts = ML.fitted_constants(ml_clean(spark, sf), _BIN_NUMERIC)
    return spark.createDataFrame([(f, *(round(v, 6) for v in t)) for f, t in consts.items()],
                                 "feature string, median double, mean double, std_pop double")


@register("ml9_fit_and_score")
def ml9_fit_and_score(spark, sf):
    """ML1-ML9: stratified split, pipeline fit (C = 1.0), scores of the test rows. The scores, four columns of
    the test rows, are written to ``spark.checkpoint.dir`` while the loans are cached."""
    train, test, n, release = _split_rows(spark, sf)
    try:
        checkpoint_dir(spark)
        return ML.score(ML.fit(train, 1.0, rows=n, cached=True), test).checkpoint(eager=True)
    finally:
        release()


def _split_rows(spark, sf):
    """Training rows, test rows, the number of training rows, and what releases the cached frame. The loans
    are derived once: the first pass fills the cache, in the partitions that the join leaves (sized by
    adaptive execution), and everything else is to be read before the release."""
    d = ml_clean(spark, sf).withColumn("_hash", split_hash(42)).persist(StorageLevel.MEMORY_AND_DISK)
    n = sum(r["train_rows"] for r in stratified_quotas(d, "target", 0.2).collect())  # one row per class
    sp = stratified_split(d, "target", 0.2, seed=42, hashed="_hash").drop("_hash")
    return sp.filter(~F.col("is_test")), sp.filter(F.col("is_test")), n, d.unpersist


@register("ml10_regularisation_sweep")
def ml10_regularisation_sweep(spark, sf):
    """ML10: one model per C over one training split; exact AUC and accuracy per model, from scores that are
    computed once and kept in ``spark.checkpoint.dir``."""
    train, test, n, release = _split_rows(spark, sf)
    rows = []
    try:
        checkpoint_dir(spark)
        for c, model in ML.sweep(train, [1.0, 0.1], rows=n, cached=True).items():
            s = ML.score(model, test, keep=["target"]).checkpoint(eager=True)
            acc = M.accuracy(s, "target", "prediction").first()
            rows.append((c, acc["accuracy"], acc["rows"], M.roc_auc(s, "target", "score").first()["roc_auc"]))
    finally:
        release()
    return spark.createDataFrame(rows, "regularization_c double, accuracy double, rows long, roc_auc double")


@register("sc_scalar_helpers", with_loans("""SELECT id,
  CASE WHEN loan_amnt IS NOT NULL AND loan_amnt >= 1000.0 THEN 'PASSED' ELSE 'FAILED' END AS amount_status,
  GREATEST(installment, CAST(100.0 AS DOUBLE)) AS installment_floor, LEAST(installment, CAST(100.0 AS DOUBLE)) AS installment_cap,
  CASE WHEN dti < 10 THEN 'low' WHEN dti < 25 THEN 'mid' ELSE 'high' END AS dti_band,
  concat_ws(', ', grade, sub_grade, addr_state) AS names,
  list_transform(string_split(concat_ws(',', ' ' || grade, ' ' || purpose), ','), lambda s: trim(s))[2] AS second_name
FROM loans"""))
def sc_scalar_helpers(spark, sf):
    """SC10 (CASE ladder), SC11 (least / greatest), SC13 (status text), SC15 (join / split
    names) on every loan row."""
    df = loans_df(spark, sf)
    band = F.when(F.col("dti") < 10, "low").when(F.col("dti") < 25, "mid").otherwise("high")
    names = F.array(F.col("grade"), F.col("sub_grade"), F.col("addr_state"))
    split_back = split_names(F.concat_ws(",", F.concat(F.lit(" "), "grade"), F.concat(F.lit(" "), "purpose")))
    return df.select("id", status_text(F.col("loan_amnt") >= 1000.0).alias("amount_status"),
                     F.greatest("installment", F.lit(100.0)).alias("installment_floor"),
                     F.least("installment", F.lit(100.0)).alias("installment_cap"),
                     band.alias("dti_band"), join_names(names).alias("names"),
                     F.element_at(split_back, 2).alias("second_name"))


@register("sc16_histogram_edges", with_loans("""SELECT e.i AS i, ROUND(r.lo + e.i * ((r.hi - r.lo) / 30.0), 6) AS edge
FROM (SELECT MIN(loan_amnt) AS lo, MAX(loan_amnt) AS hi FROM loans) r CROSS JOIN range(31) e(i)"""))
def sc16_histogram_edges(spark, sf):
    """SC16: evenly spaced edges over the data range (the range from one aggregation)."""
    df = loans_df(spark, sf)
    r = df.agg(F.min("loan_amnt").alias("lo"), F.max("loan_amnt").alias("hi"))
    return r.select(F.posexplode(linspace(F.col("lo"), F.col("hi"), 30)).alias("i", "edge")) \
        .select(F.col("i").cast("bigint").alias("i"), r6("edge").alias("edge"))


@register("snk1_report_document")
def snk1_report_document(spark, sf):
    """SNK1: the suite report as one JSON document (JSON text formatting differs between
    engines, so this is a rows-only check)."""
    rep = default_suite(loans_df(spark, sf), ORDER_KEY)
    return report_document(rep, source="loans", suite="loan_quality")
