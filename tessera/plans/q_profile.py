"""Queries: sources, cleaning functions, projections/filters and profiling (SRC*, SC*, PRJ*,
FLT*, AGG*, TH*, WIN1, JN3)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.hashing import md5_mod
from ..functions.misc import clip
from ..operators import histogram as H
from ..operators import profile as P
from ..operators.checks import REQUIRED_STATUSES
from ..sources.loans import ORDER_KEY
from ..sources.tables import filtered_head, head_rows, select_strict, select_tolerant
from .catalog import RATE_FRAC_SQL, loans_df, prepared, r6, register, sql_prep, with_loans

NUMERIC = ["loan_amnt", "installment", "annual_inc", "dti", "delinq_2yrs", "inq_last_6mths",
           "open_acc", "pub_rec", "revol_bal", "total_acc"]
CATEGORICAL = ["term", "grade", "sub_grade", "home_ownership", "verification_status", "purpose",
               "addr_state"]


# --- sources ------------------------------------------------------------------------------------

@register("src1_loans_table", with_loans("SELECT * FROM loans"))
def src1_loans_table(spark, sf):
    return loans_df(spark, sf)


@register("src2_head_sample", with_loans(
    "SELECT id, loan_amnt FROM loans ORDER BY issue_d, id LIMIT 10000"))
def src2_head_sample(spark, sf):
    return head_rows(loans_df(spark, sf), 10000, ORDER_KEY).select("id", "loan_amnt")


@register("src3_pruned_scan_strict", with_loans("SELECT loan_status, int_rate FROM loans"))
def src3_pruned_scan_strict(spark, sf):
    return select_strict(loans_df(spark, sf), ["loan_status", "int_rate"])


@register("src4_pruned_scan_tolerant", with_loans("SELECT id, loan_status, emp_length FROM loans"))
def src4_pruned_scan_tolerant(spark, sf):
    return select_tolerant(loans_df(spark, sf), ["id", "loan_status", "no_such_column", "emp_length"])


@register("src5_filtered_head", with_loans(
    "SELECT id, loan_status FROM loans WHERE loan_status IN ('Fully Paid', 'Charged Off') "
    "ORDER BY issue_d, id LIMIT 5000"))
def src5_filtered_head(spark, sf):
    return filtered_head(loans_df(spark, sf), "loan_status", ["Fully Paid", "Charged Off"], 5000,
                         ORDER_KEY).select("id", "loan_status")


@register("src6_chunk_accumulators", with_loans(f""", s AS (
  SELECT loan_status AS status, COUNT(*) AS cnt, MIN({RATE_FRAC_SQL}) AS mn, MAX({RATE_FRAC_SQL}) AS mx
  FROM loans GROUP BY loan_status)
SELECT status, cnt, (SELECT MIN(mn) FROM s) AS min_rate, (SELECT MAX(mx) FROM s) AS max_rate
FROM s WHERE status IS NOT NULL"""))
def src6_chunk_accumulators(spark, sf):
    from ..operators.checks import status_rate_scan
    scan = status_rate_scan(loans_df(spark, sf))
    return scan.select(F.explode("counts").alias("status", "cnt"), "min_rate", "max_rate")


# --- scalar functions and projections -------------------------------------------------------------

@register("sc1_emp_length", sql_prep("SELECT id, emp_length, emp_length_numeric FROM prep"))
def sc1_emp_length(spark, sf):
    return prepared(loans_df(spark, sf)).select("id", "emp_length", "emp_length_numeric")


@register("sc2_percent_strict", sql_prep("SELECT id, int_rate, int_rate_frac FROM prep"))
def sc2_percent_strict(spark, sf):
    return prepared(loans_df(spark, sf)).select("id", "int_rate", "int_rate_frac")


@register("sc3_percent_lenient", sql_prep("SELECT id, revol_util, revol_util_frac FROM prep"))
def sc3_percent_lenient(spark, sf):
    return prepared(loans_df(spark, sf)).select("id", "revol_util", "revol_util_frac")


@register("sc4_percent_number_if_text", sql_prep(
    "SELECT id, TRY_CAST(trim(rtrim(int_rate, '%')) AS DOUBLE) AS int_rate, loan_amnt FROM prep"))
def sc4_percent_number_if_text(spark, sf):
    from ..functions.parse import numeric_if_text
    df = loans_df(spark, sf)
    return df.select("id", numeric_if_text(df, "int_rate"), numeric_if_text(df, "loan_amnt"))


_ARM_SQL = """(((((CAST('0x' || substr(md5(CAST(id AS VARCHAR)), 1, 8) AS BIGINT) % {n}) * 4294967296
  + CAST('0x' || substr(md5(CAST(id AS VARCHAR)), 9, 8) AS BIGINT)) % {n} * 4294967296
  + CAST('0x' || substr(md5(CAST(id AS VARCHAR)), 17, 8) AS BIGINT)) % {n} * 4294967296
  + CAST('0x' || substr(md5(CAST(id AS VARCHAR)), 25, 8) AS BIGINT)) % {n})"""


def arm_sql(n: int) -> str:
    return "CAST(" + _ARM_SQL.format(n=n) + " AS INTEGER)"


@register("sc9_md5_arm", with_loans(f"SELECT id, {arm_sql(2)} AS arm2, {arm_sql(3)} AS arm3 FROM loans"))
def sc9_md5_arm(spark, sf):
    return loans_df(spark, sf).select("id", md5_mod("id", 2).alias("arm2"), md5_mod("id", 3).alias("arm3"))


@register("prj3_binary_target", sql_prep("SELECT id, loan_status, target FROM prep"))
def prj3_binary_target(spark, sf):
    return prepared(loans_df(spark, sf)).select("id", "loan_status", "target")


_CLEAN_SQL = sql_prep("""SELECT id, target, emp_length_numeric, int_rate_frac, revol_util_frac,
  COALESCE(term, 'Missing') AS term, COALESCE(grade, 'Missing') AS grade,
  COALESCE(verification_status, 'Missing') AS verification_status, COALESCE(addr_state, 'Missing') AS addr_state
FROM prep
WHERE loan_status IN ('Fully Paid', 'Charged Off')
  AND loan_amnt IS NOT NULL AND annual_inc IS NOT NULL AND emp_length_numeric IS NOT NULL
  AND int_rate_frac IS NOT NULL AND revol_util_frac IS NOT NULL AND total_acc IS NOT NULL""")


@register("flt_clean_training_rows", _CLEAN_SQL)
def flt_clean_training_rows(spark, sf):
    """FLT1 (status set), FLT6 (drop rows with a null key numeric), FLT7 (fill categoricals)."""
    d = prepared(loans_df(spark, sf)).filter(F.col("loan_status").isin("Fully Paid", "Charged Off"))
    d = d.dropna(how="any", subset=["loan_amnt", "annual_inc", "emp_length_numeric", "int_rate_frac",
                                    "revol_util_frac", "total_acc"])
    d = d.fillna("Missing", subset=["term", "grade", "verification_status", "addr_state"])
    return d.select("id", "target", "emp_length_numeric", "int_rate_frac", "revol_util_frac", "term",
                    "grade", "verification_status", "addr_state")


@register("flt4_null_subsets", with_loans("""SELECT int_rate IS NULL AS rate_missing, COUNT(*) AS rows,
  COUNT(loan_amnt) AS amount_present FROM loans GROUP BY 1"""))
def flt4_null_subsets(spark, sf):
    df = loans_df(spark, sf)
    return df.groupBy(F.col("int_rate").isNull().alias("rate_missing")).agg(
        F.count(F.lit(1)).alias("rows"), F.count("loan_amnt").alias("amount_present"))


@register("flt8_any_null", with_loans("""SELECT BOOL_OR(verification_status IS NULL) AS verification_has_null,
  BOOL_OR(term IS NULL) AS term_has_null FROM loans"""))
def flt8_any_null(spark, sf):
    df = loans_df(spark, sf)
    return df.agg(F.bool_or(F.col("verification_status").isNull()).alias("verification_has_null"),
                  F.bool_or(F.col("term").isNull()).alias("term_has_null"))


@register("flt9_clip", with_loans("""SELECT id,
  CASE WHEN dti IS NOT NULL THEN GREATEST(LEAST(dti - 20.0, 15.0), 0.0) END AS dti_clipped,
  CASE WHEN annual_inc IS NOT NULL THEN GREATEST(annual_inc - 20000.0, 0.0) END AS inc_clipped
FROM loans"""))
def flt9_clip(spark, sf):
    df = loans_df(spark, sf)
    return df.select("id", clip(F.col("dti") - 20.0, 0.0, 15.0).alias("dti_clipped"),
                     clip(F.col("annual_inc") - 20000.0, 0.0).alias("inc_clipped"))


# --- profiling --------------------------------------------------------------------------------------

@register("agg1_shape", with_loans("SELECT COUNT(*) AS n_rows, 23 AS n_cols FROM loans"))
def agg1_shape(spark, sf):
    return P.shape(loans_df(spark, sf))


_ALL_COLS = ["id", "issue_d", "loan_status", "loan_amnt", "int_rate", "installment", "annual_inc", "dti",
             "delinq_2yrs", "inq_last_6mths", "open_acc", "pub_rec", "revol_bal", "revol_util", "total_acc",
             "emp_length", "term", "grade", "sub_grade", "home_ownership", "verification_status", "purpose",
             "addr_state"]


def _null_sql(cols):
    parts = [f"SELECT '{c}' AS column, CAST(SUM(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS null_count, "
             f"ROUND(SUM(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) * 100.0 / COUNT(*), 6) AS null_pct FROM loans"
             for c in cols]
    return with_loans("\n" + "\nUNION ALL\n".join(parts))




@register("agg3_null_counts", _null_sql(_ALL_COLS))
def agg3_null_counts(spark, sf):
    n = P.null_counts(loans_df(spark, sf))
    return n.select("column", F.col("null_count").cast("bigint").alias("null_count"), r6("null_pct").alias("null_pct"))


@register("agg4_null_mean_pct", with_loans(
    "SELECT ROUND(AVG(CASE WHEN loan_amnt IS NULL THEN 1.0 ELSE 0.0 END) * 100.0, 6) AS missing_pct FROM loans"))
def agg4_null_mean_pct(spark, sf):
    df = loans_df(spark, sf)
    return df.agg(r6(F.avg(F.col("loan_amnt").isNull().cast("double")) * 100.0).alias("missing_pct"))




_DUP_COLS = ["term", "grade", "home_ownership", "purpose", "verification_status"]


@register("agg5_duplicates", with_loans(f"""SELECT CAST(COALESCE(SUM(c - 1), 0) AS BIGINT) AS duplicate_rows
FROM (SELECT COUNT(*) AS c FROM loans GROUP BY {', '.join(_DUP_COLS)})"""))
def agg5_duplicates(spark, sf):
    return P.duplicate_count(loans_df(spark, sf).select(*_DUP_COLS))


@register("agg5_duplicates_all_columns", with_loans(f"""SELECT CAST(COALESCE(SUM(c - 1), 0) AS BIGINT) AS duplicate_rows
FROM (SELECT COUNT(*) AS c FROM loans GROUP BY {', '.join(_ALL_COLS)})"""))
def agg5_duplicates_all_columns(spark, sf):
    return P.duplicate_count(loans_df(spark, sf))


_TYPES = {"id": "bigint", "issue_d": "timestamp_ntz", "loan_status": "string", "int_rate": "string",
          "revol_util": "string", "emp_length": "string", "term": "string", "grade": "string",
          "sub_grade": "string", "home_ownership": "string", "verification_status": "string",
          "purpose": "string", "addr_state": "string"}


def _info_sql():
    parts = [f"SELECT '{c}' AS column, '{_TYPES.get(c, 'double')}' AS dtype, COUNT({c}) AS non_null FROM loans"
             for c in _ALL_COLS]
    return with_loans("\n" + "\nUNION ALL\n".join(parts))


@register("agg6_column_info", _info_sql())
def agg6_column_info(spark, sf):
    return P.column_info(loans_df(spark, sf))


def _describe_sql(cols):
    parts = []
    for c in cols:
        parts.append(f"""SELECT '{c}' AS feature, ROUND(CAST(COUNT({c}) AS DOUBLE), 6) AS count, ROUND(AVG({c}), 6) AS mean,
  ROUND(STDDEV_SAMP({c}), 6) AS std, ROUND(MIN({c}), 6) AS min, ROUND(QUANTILE_CONT({c}, 0.25), 6) AS p25,
  ROUND(QUANTILE_CONT({c}, 0.5), 6) AS p50, ROUND(QUANTILE_CONT({c}, 0.75), 6) AS p75, ROUND(MAX({c}), 6) AS max
FROM prep""")
    return sql_prep("\n" + "\nUNION ALL\n".join(parts))


_DESCRIBE = ["loan_amnt", "rate_pct", "annual_inc", "dti", "revol_bal", "total_acc"]


@register("agg7_describe", _describe_sql(_DESCRIBE))
def agg7_describe(spark, sf):
    d = P.describe(prepared(loans_df(spark, sf)), _DESCRIBE)
    return d.select("feature", *[r6(c).alias(c) for c in ("count", "mean", "std", "min", "p25", "p50", "p75", "max")])


@register("agg8_value_counts", with_loans(
    "SELECT loan_status, COUNT(*) AS count FROM loans WHERE loan_status IS NOT NULL GROUP BY loan_status"))
def agg8_value_counts(spark, sf):
    return P.value_counts(loans_df(spark, sf), "loan_status")


@register("agg9_value_counts_with_nulls", with_loans(
    "SELECT verification_status, COUNT(*) AS count FROM loans GROUP BY verification_status"))
def agg9_value_counts_with_nulls(spark, sf):
    return P.ranked_value_counts(loans_df(spark, sf), "verification_status")


@register("agg10_normalized_counts", with_loans("""SELECT loan_status, COUNT(*) AS count,
  ROUND(COUNT(*) / (SELECT CAST(COUNT(*) AS DOUBLE) FROM loans WHERE loan_status IS NOT NULL), 6) AS share
FROM loans WHERE loan_status IS NOT NULL GROUP BY loan_status"""))
def agg10_normalized_counts(spark, sf):
    v = P.value_counts(loans_df(spark, sf), "loan_status", normalize=True)
    return v.select("loan_status", "count", r6("share").alias("share"))


@register("agg11_merged_partial_counts", with_loans("""SELECT status, CAST(SUM(c) AS BIGINT) AS count FROM (
  SELECT loan_status AS status, COUNT(*) AS c FROM loans WHERE grade IN ('A', 'B', 'C') AND loan_status IS NOT NULL GROUP BY 1
  UNION ALL
  SELECT loan_status AS status, COUNT(*) AS c FROM loans
  WHERE (grade NOT IN ('A', 'B', 'C') OR grade IS NULL) AND loan_status IS NOT NULL GROUP BY 1)
GROUP BY status"""))
def agg11_merged_partial_counts(spark, sf):
    """AGG11: counts of two disjoint parts (grades A-C and the rest: together the whole table,
    every row used once) aligned by value and added."""
    df = loans_df(spark, sf)
    top = F.col("grade").isin("A", "B", "C")
    parts = [P.value_counts(df.filter(cond), "loan_status").withColumnRenamed("loan_status", "status")
             for cond in (top, ~top | F.col("grade").isNull())]
    return parts[0].unionByName(parts[1]).groupBy("status").agg(F.sum("count").cast("bigint").alias("count"))


@register("agg12_rate_min_max", sql_prep(
    "SELECT MIN(int_rate_frac) AS min_value, MAX(int_rate_frac) AS max_value FROM prep"))
def agg12_rate_min_max(spark, sf):
    return P.min_max(prepared(loans_df(spark, sf)), "int_rate_frac")


_QS = [0.001, 0.01, 0.05, 0.1, 0.25, 0.5, 0.75, 0.9, 0.95, 0.99, 0.999]


def _pct_sql(cols):
    parts = []
    for c in cols:
        for q in _QS:
            parts.append(f"SELECT '{c}' AS feature, {q} AS q, ROUND(QUANTILE_CONT({c}, {q}), 6) AS value "
                         f"FROM prep WHERE {c} IS NOT NULL")
    return sql_prep("\n" + "\nUNION ALL\n".join(parts))


@register("agg13_exact_percentiles", _pct_sql(["loan_amnt", "rate_pct"]))
def agg13_exact_percentiles(spark, sf):
    p = P.percentiles(prepared(loans_df(spark, sf)), ["loan_amnt", "rate_pct"], _QS)
    return p.select("feature", "q", r6("value").alias("value"))


@register("agg14_range_counts", with_loans("""SELECT COUNT(*) AS n_rows, COUNT(loan_amnt) AS n_valid,
  COUNT(*) - COUNT(loan_amnt) AS missing,
  COUNT(*) FILTER (WHERE loan_amnt < 1000.0) AS below, COUNT(*) FILTER (WHERE loan_amnt > 40000.0) AS above,
  COUNT(*) FILTER (WHERE loan_amnt BETWEEN 1525.0 AND 40000.0) AS within,
  ROUND((COUNT(*) - COUNT(loan_amnt)) * 100.0 / COUNT(*), 6) AS missing_pct,
  ROUND(COUNT(*) FILTER (WHERE loan_amnt < 1000.0) * 100.0 / COUNT(loan_amnt), 6) AS below_pct,
  ROUND(COUNT(*) FILTER (WHERE loan_amnt > 40000.0) * 100.0 / COUNT(loan_amnt), 6) AS above_pct,
  ROUND(COUNT(*) FILTER (WHERE loan_amnt BETWEEN 1525.0 AND 40000.0) * 100.0 / COUNT(loan_amnt), 6) AS within_pct
FROM loans"""))
def agg14_range_counts(spark, sf):
    r = P.range_counts(loans_df(spark, sf), "loan_amnt", 1000.0, 40000.0, 1525.0, 40000.0)
    return r.select("n_rows", "n_valid", "missing", "below", "above", "within",
                    *[r6(c).alias(c) for c in ("missing_pct", "below_pct", "above_pct", "within_pct")])


@register("agg15_grouped_stats", sql_prep("""SELECT grade, COUNT(rate_pct) AS count, ROUND(AVG(rate_pct), 6) AS mean,
  ROUND(STDDEV_SAMP(rate_pct), 6) AS std, MIN(rate_pct) AS min, MAX(rate_pct) AS max
FROM prep GROUP BY grade"""))
def agg15_grouped_stats(spark, sf):
    g = P.grouped_stats(prepared(loans_df(spark, sf)), "grade", "rate_pct")
    return g.select("grade", "count", r6("mean").alias("mean"), r6("std").alias("std"), "min", "max")


@register("agg16_conditional_means", with_loans("""SELECT int_rate IS NULL AS int_rate_missing,
  ROUND(AVG(loan_amnt), 6) AS mean_loan_amnt, COUNT(*) AS rows FROM loans GROUP BY 1"""))
def agg16_conditional_means(spark, sf):
    c = P.conditional_means(loans_df(spark, sf), "int_rate", "loan_amnt")
    return c.select("int_rate_missing", r6("mean_loan_amnt").alias("mean_loan_amnt"), "rows")


@register("agg17_sample_std_guarded", sql_prep("""SELECT ROUND(STDDEV_SAMP(annual_inc), 6) AS annual_inc_std,
  ROUND(STDDEV_SAMP(dti), 6) AS dti_std, ROUND(STDDEV_SAMP(revol_util_frac), 6) AS revol_util_std,
  COALESCE(STDDEV_SAMP(annual_inc), 0) > 0 AS annual_inc_perturbable FROM prep"""))
def agg17_sample_std_guarded(spark, sf):
    d = prepared(loans_df(spark, sf))
    return d.agg(r6(F.stddev_samp("annual_inc")).alias("annual_inc_std"), r6(F.stddev_samp("dti")).alias("dti_std"),
                 r6(F.stddev_samp("revol_util_frac")).alias("revol_util_std"),
                 (F.coalesce(F.stddev_samp("annual_inc"), F.lit(0.0)) > 0).alias("annual_inc_perturbable"))


@register("agg20_group_counts", with_loans(f"""SELECT {arm_sql(2)} AS arm, COUNT(*) AS rows FROM loans GROUP BY 1"""))
def agg20_group_counts(spark, sf):
    df = loans_df(spark, sf)
    return df.groupBy(md5_mod("id", 2).alias("arm")).agg(F.count(F.lit(1)).alias("rows"))


# --- histograms ------------------------------------------------------------------------------------

def _hist_bin_sql(x: str, lo: str, hi: str, bins: int) -> str:
    """NumPy-equivalent bin of x over [lo, hi] with ``bins`` bins (SQL twin of bin_index)."""
    nb = f"CAST({bins} AS DOUBLE)"
    step = f"((({hi}) - ({lo})) / {nb})"
    raw = f"CAST(FLOOR((({x}) - ({lo})) * ({nb} / (({hi}) - ({lo})))) AS INTEGER)"
    b0 = f"(CASE WHEN {raw} = {bins} THEN {bins - 1} ELSE {raw} END)"
    b1 = f"(CASE WHEN ({x}) < ({lo}) + CAST({b0} AS DOUBLE) * {step} THEN {b0} - 1 ELSE {b0} END)"
    b2 = (f"(CASE WHEN ({x}) >= ({lo}) + CAST({b1} + 1 AS DOUBLE) * {step} AND {b1} <> {bins - 1} "
          f"THEN {b1} + 1 ELSE {b1} END)")
    return f"(CASE WHEN ({x}) >= ({lo}) AND ({x}) <= ({hi}) AND ({hi}) > ({lo}) THEN {b2} END)"


def hist_sql(src: str, x: str, lo: float, hi: float, bins: int) -> str:
    step = (hi - lo) / bins
    b = _hist_bin_sql(x, f"CAST({float(lo)!r} AS DOUBLE)", f"CAST({float(hi)!r} AS DOUBLE)", bins)
    return f"""SELECT CAST(g.bin AS INTEGER) AS bin, ROUND({float(lo)} + g.bin * {step}, 6) AS lo,
  ROUND({float(lo)} + (g.bin + 1) * {step}, 6) AS hi,
  CAST(COALESCE(c.cnt, 0) AS BIGINT) AS count
FROM range({bins}) g(bin) LEFT JOIN (
  SELECT {b} AS bin, COUNT(*) AS cnt FROM {src} WHERE {b} IS NOT NULL GROUP BY 1) c ON g.bin = c.bin"""


@register("agg21_rate_histogram", sql_prep(hist_sql("prep", "rate_pct", 5.31, 30.84, 30)))
def agg21_rate_histogram(spark, sf):
    h = H.histogram(prepared(loans_df(spark, sf)), "rate_pct", 5.31, 30.84, 30)
    return h.select("bin", r6("lo").alias("lo"), r6("hi").alias("hi"), "count")


@register("agg22_amount_histogram_auto", with_loans(f""", r AS (SELECT MIN(loan_amnt) AS lo, MAX(loan_amnt) AS hi FROM loans),
c AS (SELECT {_hist_bin_sql('loan_amnt', 'r.lo', 'r.hi', 50)} AS bin, COUNT(*) AS cnt FROM loans, r
      WHERE loan_amnt IS NOT NULL GROUP BY 1)
SELECT CAST(g.bin AS INTEGER) AS bin, ROUND(r.lo + g.bin * ((r.hi - r.lo) / 50.0), 6) AS lo,
  ROUND(r.lo + (g.bin + 1) * ((r.hi - r.lo) / 50.0), 6) AS hi, CAST(COALESCE(c.cnt, 0) AS BIGINT) AS count
FROM r, range(50) g(bin) LEFT JOIN c ON g.bin = c.bin"""))
def agg22_amount_histogram_auto(spark, sf):
    h = H.grouped_histogram(loans_df(spark, sf), "loan_amnt", 50)
    return h.select("bin", r6("lo").alias("lo"), r6("hi").alias("hi"), "count")


@register("agg23_rate_histogram_by_grade", sql_prep(
    """SELECT r.grade, CAST(g.bin AS INTEGER) AS bin, ROUND(r.lo + g.bin * ((r.hi - r.lo) / 20.0), 6) AS lo,
  ROUND(r.lo + (g.bin + 1) * ((r.hi - r.lo) / 20.0), 6) AS hi, CAST(COALESCE(c.cnt, 0) AS BIGINT) AS count
FROM r CROSS JOIN range(20) g(bin) LEFT JOIN c ON c.grade = r.grade AND c.bin = g.bin""",
    f""", r AS (SELECT grade, MIN(rate_pct) AS lo, MAX(rate_pct) AS hi
  FROM prep WHERE rate_pct IS NOT NULL GROUP BY grade),
c AS (SELECT p.grade, {_hist_bin_sql('p.rate_pct', 'r.lo', 'r.hi', 20)} AS bin, COUNT(*) AS cnt
  FROM prep p JOIN r ON p.grade = r.grade WHERE p.rate_pct IS NOT NULL GROUP BY 1, 2)"""))
def agg23_rate_histogram_by_grade(spark, sf):
    h = H.grouped_histogram(prepared(loans_df(spark, sf)), "rate_pct", 20, ["grade"])
    return h.select("grade", "bin", r6("lo").alias("lo"), r6("hi").alias("hi"), "count")


@register("agg24_overlay_histograms", with_loans(f""", t AS (
  SELECT CASE WHEN int_rate IS NULL THEN 'missing' ELSE 'present' END AS population, loan_amnt FROM loans),
r AS (SELECT population, MIN(loan_amnt) AS lo, MAX(loan_amnt) AS hi, COUNT(*) AS n FROM t
      WHERE loan_amnt IS NOT NULL GROUP BY 1),
keep AS (SELECT population FROM (SELECT population, COUNT(*) AS rows FROM t GROUP BY 1)
         WHERE population = 'present' OR rows > 10),
c AS (SELECT t.population, CASE WHEN r.hi = r.lo THEN 25 ELSE {_hist_bin_sql('t.loan_amnt', 'r.lo', 'r.hi', 50)} END AS bin,
        COUNT(*) AS cnt FROM t JOIN r ON t.population = r.population WHERE t.loan_amnt IS NOT NULL GROUP BY 1, 2)
SELECT r.population, CAST(g.bin AS INTEGER) AS bin, ROUND(r.lo + g.bin * ((r.hi - r.lo) / 50.0), 6) AS lo,
  ROUND(r.lo + (g.bin + 1) * ((r.hi - r.lo) / 50.0), 6) AS hi, CAST(COALESCE(c.cnt, 0) AS BIGINT) AS count
FROM r CROSS JOIN range(50) g(bin) LEFT JOIN c ON c.population = r.population AND c.bin = g.bin
WHERE r.population IN (SELECT population FROM keep)"""))
def agg24_overlay_histograms(spark, sf):
    h = H.overlay_histograms(loans_df(spark, sf), "loan_amnt", "int_rate", 50)
    return h.select("population", "bin", r6("lo").alias("lo"), r6("hi").alias("hi"), "count")


@register("win1_histogram_peaks", sql_prep(f""", h AS ({hist_sql('prep', 'rate_pct', 5.31, 30.84, 30)})
SELECT CAST(COUNT(*) FILTER (WHERE count > prev_c AND count > next_c) AS BIGINT) AS peaks FROM (
  SELECT count, LAG(count) OVER (ORDER BY bin) AS prev_c, LEAD(count) OVER (ORDER BY bin) AS next_c FROM h)"""))
def win1_histogram_peaks(spark, sf):
    h = H.histogram(prepared(loans_df(spark, sf)), "rate_pct", 5.31, 30.84, 30)
    return H.count_peaks(h)


# --- thresholds and lookups ----------------------------------------------------------------------------

@register("th1_th3_missing_thresholds", with_loans(""", m AS (
  SELECT 'loan_amnt' AS column, CAST(COUNT(*) - COUNT(loan_amnt) AS BIGINT) AS null_count,
         (COUNT(*) - COUNT(loan_amnt)) * 100.0 / COUNT(*) AS p, 'amount' AS kind FROM loans
  UNION ALL
  SELECT 'int_rate', CAST(COUNT(*) - COUNT(int_rate) AS BIGINT), (COUNT(*) - COUNT(int_rate)) * 100.0 / COUNT(*), 'rate' FROM loans)
SELECT "column", null_count, ROUND(p, 6) AS null_pct,
  ROUND(CASE WHEN kind = 'amount' THEN (CASE WHEN p < 0.01 THEN 0.01 WHEN p < 0.1 THEN 0.1 ELSE GREATEST(0.5, p * 1.1) END)
       ELSE (CASE WHEN p < 0.1 THEN 0.1 WHEN p < 1.0 THEN 1.0 ELSE GREATEST(5.0, p * 1.2) END) END, 6) AS threshold_pct,
  CASE WHEN kind = 'amount' THEN (CASE WHEN p < 0.01 THEN 'very strict' WHEN p < 0.1 THEN 'strict' ELSE 'moderate' END)
       ELSE (CASE WHEN p < 0.1 THEN 'strict' WHEN p < 1.0 THEN 'moderate' ELSE 'lenient' END) END AS strictness
FROM m"""))
def th1_th3_missing_thresholds(spark, sf):
    t = P.missing_thresholds(loans_df(spark, sf), {
        "loan_amnt": (P.AMOUNT_LADDER, P.AMOUNT_FALLBACK), "int_rate": (P.RATE_LADDER, P.RATE_FALLBACK)})
    return t.select("column", F.col("null_count").cast("bigint").alias("null_count"), r6("null_pct").alias("null_pct"),
                    r6("threshold_pct").alias("threshold_pct"), "strictness")


@register("th2_recommended_bounds", sql_prep("""SELECT 'loan_amnt' AS column,
  ROUND(GREATEST(500.0, QUANTILE_CONT(loan_amnt, 0.001)), 6) AS abs_min, ROUND(LEAST(50000.0, QUANTILE_CONT(loan_amnt, 0.999)), 6) AS abs_max,
  ROUND(QUANTILE_CONT(loan_amnt, 0.01), 6) AS normal_min, ROUND(QUANTILE_CONT(loan_amnt, 0.99), 6) AS normal_max FROM prep
UNION ALL
SELECT 'rate_pct', ROUND(GREATEST(5.0, QUANTILE_CONT(rate_pct, 0.001)), 6), ROUND(LEAST(36.0, QUANTILE_CONT(rate_pct, 0.999)), 6),
  ROUND(QUANTILE_CONT(rate_pct, 0.01), 6), ROUND(QUANTILE_CONT(rate_pct, 0.99), 6) FROM prep"""))
def th2_recommended_bounds(spark, sf):
    d = prepared(loans_df(spark, sf))
    b = P.recommend_bounds(d, "loan_amnt", 500.0, 50000.0).unionByName(P.recommend_bounds(d, "rate_pct", 5.0, 36.0))
    return b.select("column", *[r6(c).alias(c) for c in ("abs_min", "abs_max", "normal_min", "normal_max")])


@register("jn3_missing_required_statuses", with_loans("""SELECT r.status FROM
  (SELECT * FROM (VALUES ('Fully Paid'), ('Charged Off'), ('Default')) v(status)) r
  WHERE r.status NOT IN (SELECT loan_status FROM loans WHERE loan_status IS NOT NULL)"""))
def jn3_missing_required_statuses(spark, sf):
    """JN3: required values (the two training statuses plus 'Default') absent from the data."""
    req = spark.createDataFrame([(s,) for s in [*REQUIRED_STATUSES, "Default"]], "status string")
    seen = loans_df(spark, sf).select(F.col("loan_status").alias("status")).filter(F.col("status").isNotNull()).distinct()
    return req.join(seen, "status", "left_anti")
