"""Queries: drift (DR*), metrics (MET*, AGG19), robustness (RB*) and A/B arms (AB*).

Metric queries score with the fixed formula of ``metrics.linear_score`` so that DuckDB can
reproduce them; the fitted-model versions live in ``jobs`` and are checked by pytest."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.parse import numeric_if_text
from ..operators import drift as D
from ..operators import metrics as M
from ..operators import position as POS
from ..operators import robust as R
from ..operators.abtest import arm_metrics, score_arms
from ..sources.loans import ORDER_KEY
from .catalog import loans_df, prepared, r6, register, sql_prep, with_loans
from .q_position import CHUNK, _CLEAN, clean

CUT = 0.5
P_TERMS = 100


def drift_input(df):
    return df.select("id", "issue_d", *[numeric_if_text(df, f) for f in D.DRIFT_FEATURES])


def _ks_out(ks):
    return ks.select("feature", "n_ref", "n_cur", r6("ks_statistic").alias("ks_statistic"),
                     r6("p_value").alias("p_value"), "drift_detected")


# --- SQL pieces -------------------------------------------------------------------------------------

def _feat_sql(f: str) -> str:
    if f in ("int_rate", "revol_util"):
        return f"TRY_CAST(trim(rtrim({f}, '%')) AS DOUBLE)"
    return f"CAST({f} AS DOUBLE)"


def _long_sql(src: str, side: int) -> str:
    return "\n  UNION ALL ".join(f"SELECT '{f}' AS feature, {_feat_sql(f)} + 0.0 AS x, {side} AS side FROM {src}"
                                 for f in D.DRIFT_FEATURES)


def pvalue_sql(d: str, n: str, m: str) -> str:
    l2 = f"({d} * {d} * ROUND((CAST({n} AS DOUBLE) * CAST({m} AS DOUBLE)) / CAST({n} + {m} AS DOUBLE)))"
    series = (f"list_reduce(list_transform(range(1, {P_TERMS + 1}), lambda k: CASE WHEN k % 2 = 1 THEN CAST(2.0 AS DOUBLE) "
              f"ELSE CAST(-2.0 AS DOUBLE) END * EXP(CAST(-2.0 AS DOUBLE) * CAST(k * k AS DOUBLE) * {l2} "
              f"- CAST(2.0 AS DOUBLE) / CAST(3.0 AS DOUBLE) * CAST(k AS DOUBLE) * {d} - CAST(4.0 AS DOUBLE) / CAST(9.0 AS DOUBLE) "
              f"* CAST(k * k * k * k AS DOUBLE) * {l2} * {d} * {d})), lambda a, b: a + b)")
    return (f"CASE WHEN SQRT({l2}) < 0.2 THEN CAST(1.0 AS DOUBLE) "
            f"ELSE LEAST(CAST(1.0 AS DOUBLE), GREATEST(CAST(0.0 AS DOUBLE), {series})) END")


def ks_sql(ref_pred: str, cur_pred: str) -> str:
    return with_loans(f""", ix AS (SELECT *, ROW_NUMBER() OVER (ORDER BY issue_d, id) - 1 AS idx, COUNT(*) OVER () AS n FROM loans),
ref AS (SELECT * FROM ix WHERE {ref_pred}),
cur AS (SELECT * FROM ix WHERE {cur_pred}),
lng AS ({_long_sql('ref', 0)}
  UNION ALL {_long_sql('cur', 1)}),
d AS (SELECT feature, x, COUNT(*) FILTER (WHERE side = 0) AS c_ref, COUNT(*) FILTER (WHERE side = 1) AS c_cur
      FROM lng WHERE x IS NOT NULL AND NOT isnan(x) GROUP BY 1, 2),
cum AS (SELECT feature, x,
   SUM(c_ref) OVER (PARTITION BY feature ORDER BY x ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cr,
   SUM(c_cur) OVER (PARTITION BY feature ORDER BY x ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cc,
   SUM(c_ref) OVER (PARTITION BY feature) AS nr, SUM(c_cur) OVER (PARTITION BY feature) AS nc FROM d),
s AS (SELECT feature, CAST(MAX(nr) AS BIGINT) AS n_ref, CAST(MAX(nc) AS BIGINT) AS n_cur,
        MAX(ABS(CAST(cr AS DOUBLE) / CAST(nr AS DOUBLE) - CAST(cc AS DOUBLE) / CAST(nc AS DOUBLE))) AS ks
      FROM cum WHERE nr > 0 AND nc > 0 GROUP BY feature),
r AS (SELECT feature, n_ref, n_cur, ks, {pvalue_sql('ks', 'n_ref', 'n_cur')} AS p FROM s)""")


_KS_CHUNKS = ks_sql(f"idx < {2 * CHUNK}", f"FLOOR(idx / {CHUNK}) >= CEIL(n / {float(CHUNK)}) - 2")
_KS_FRACTION = ks_sql("idx < FLOOR(0.1 * n)", "idx >= n - FLOOR(0.1 * n)")
_KS_SELECT = "\nSELECT feature, n_ref, n_cur, ROUND(ks, 6) AS ks_statistic, ROUND(p, 6) AS p_value, p < 0.05 AS drift_detected FROM r"


@register("dr1_ks_drift_chunks", _KS_CHUNKS + _KS_SELECT)
def dr1_ks_drift_chunks(spark, sf):
    """DR1-DR4 on the first / last two chunks of 3,000 rows (8 features, one job)."""
    ref, cur, _ = POS.slices(drift_input(loans_df(spark, sf)), ORDER_KEY, "chunks", 2, CHUNK)
    return _ks_out(D.ks_drift(ref, cur))


@register("dr1_ks_drift_fraction", _KS_FRACTION + _KS_SELECT)
def dr1_ks_drift_fraction(spark, sf):
    """DR1-DR4 on the first / last 10 % of rows (SLC4)."""
    ref, cur, _ = POS.slices(drift_input(loans_df(spark, sf)), ORDER_KEY, "fraction", fraction=0.1)
    return _ks_out(D.ks_drift(ref, cur))


@register("dr5_drift_overall_status", _KS_CHUNKS + f"""
SELECT CASE WHEN (SELECT CEIL(COUNT(*) / {float(CHUNK)}) FROM loans) < 4 THEN 'SKIPPED_TOO_SMALL'
  WHEN BOOL_OR(p < 0.05) THEN 'DRIFT_DETECTED' ELSE 'NO_DRIFT' END AS overall_drift_status,
  COUNT(*) AS features_checked FROM r""")
def dr5_drift_overall_status(spark, sf):
    ref, cur, st = POS.slices(drift_input(loans_df(spark, sf)), ORDER_KEY, "chunks", 2, CHUNK)
    return D.drift_status(D.ks_drift(ref, cur), st)


@register("dr6_drift_too_small", with_loans("""SELECT CASE WHEN CEIL(COUNT(*) / 50000.0) < 4 THEN 'SKIPPED_TOO_SMALL'
  ELSE 'RUN' END AS overall_drift_status FROM loans"""))
def dr6_drift_too_small(spark, sf):
    """DR6: with the source's 50,000-row chunks the table is too small for two disjoint slices."""
    _, _, st = POS.slices(drift_input(loans_df(spark, sf)), ORDER_KEY, "chunks", 2, 50000)
    return st.select(F.when(F.col("status") == "SKIPPED_TOO_SMALL", F.lit("SKIPPED_TOO_SMALL"))
                     .otherwise(F.lit("RUN")).alias("overall_drift_status"))


# --- metrics with the fixed score -------------------------------------------------------------------------

SCORE_SQL = ("CAST(0.02 AS DOUBLE) * rate_pct + CAST(0.01 AS DOUBLE) * CAST(dti AS DOUBLE) "
             "+ CAST(0.000001 AS DOUBLE) * CAST(id AS DOUBLE)")
_SCORED = f""", sc AS (SELECT id, target, grade, {SCORE_SQL} AS score,
  CASE WHEN {SCORE_SQL} >= {CUT} THEN 1 ELSE 0 END AS prediction FROM prep WHERE rate_pct IS NOT NULL AND dti IS NOT NULL)"""


def scored(df):
    """The fixed score and prediction. Rows without a rate or dti have no score; the metric
    operators are defined over scored rows, so they are left out here."""
    p = prepared(df).filter(F.col("rate_pct").isNotNull() & F.col("dti").isNotNull())
    s = M.linear_score(F.col("rate_pct"), F.col("dti"), F.col("id"))
    return p.select("id", "target", "grade", s.alias("score"), (s >= CUT).cast("int").alias("prediction"))


@register("met1_accuracy", sql_prep("""SELECT ROUND(AVG(CASE WHEN target = prediction THEN 1.0 ELSE 0.0 END), 6) AS accuracy,
  COUNT(*) AS rows FROM sc""", _SCORED))
def met1_accuracy(spark, sf):
    a = M.accuracy(scored(loans_df(spark, sf)), "target", "prediction")
    return a.select(r6("accuracy").alias("accuracy"), "rows")


def auc_sql(src: str, by: str | None) -> str:
    g = f"{by}, " if by else ""
    part = f"PARTITION BY {by} " if by else ""
    return f""", d AS (SELECT {g}score + 0.0 AS s, COUNT(*) FILTER (WHERE target = 1) AS pos,
    COUNT(*) FILTER (WHERE target <> 1) AS neg FROM {src} WHERE score IS NOT NULL GROUP BY {g}score + 0.0),
c AS (SELECT *, SUM(neg) OVER ({part}ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS neg_cum,
    SUM(pos) OVER ({part.strip()}) AS p_all, SUM(neg) OVER ({part.strip()}) AS n_all FROM d),
a AS (SELECT {g}CAST(MAX(p_all) AS BIGINT) AS positives, CAST(MAX(n_all) AS BIGINT) AS negatives,
    SUM(CAST(pos AS DOUBLE) * (CAST(neg_cum AS DOUBLE) - CAST(neg AS DOUBLE) / 2.0)) AS u FROM c {'GROUP BY ' + by if by else ''})
SELECT {g}positives, negatives,
  CASE WHEN positives > 0 AND negatives > 0 THEN ROUND(u / (CAST(positives AS DOUBLE) * CAST(negatives AS DOUBLE)), 6) END AS roc_auc,
  CASE WHEN positives = 0 OR negatives = 0 THEN '{M.SINGLE_CLASS_ERROR}' END AS error FROM a"""


def _auc_out(a, by=()):
    return a.select(*by, "positives", "negatives", r6("roc_auc").alias("roc_auc"), "error")


@register("met2_roc_auc", sql_prep("", _SCORED + auc_sql("sc", None)))
def met2_roc_auc(spark, sf):
    return _auc_out(M.roc_auc(scored(loans_df(spark, sf)), "target", "score"))


@register("met2_roc_auc_by_grade", sql_prep("", _SCORED + auc_sql("sc", "grade")))
def met2_roc_auc_by_grade(spark, sf):
    return _auc_out(M.roc_auc(scored(loans_df(spark, sf)), "target", "score", ["grade"]), ["grade"])


@register("met4_single_class_auc", sql_prep("", _SCORED + ", one AS (SELECT * FROM sc WHERE target = 1)" + auc_sql("one", None)))
def met4_single_class_auc(spark, sf):
    s = scored(loans_df(spark, sf)).filter(F.col("target") == 1)
    return _auc_out(M.roc_auc(s, "target", "score"))


_REPORT_SQL = _SCORED + """, cm AS (SELECT target AS label, prediction, COUNT(*) AS rows FROM sc GROUP BY 1, 2),
cls AS (SELECT label AS cls FROM cm UNION SELECT prediction FROM cm),
per AS (SELECT cls,
   COALESCE((SELECT SUM(rows) FROM cm WHERE label = cls AND prediction = cls), 0) AS tp,
   COALESCE((SELECT SUM(rows) FROM cm WHERE label = cls), 0) AS support,
   COALESCE((SELECT SUM(rows) FROM cm WHERE prediction = cls), 0) AS predicted FROM cls),
pr AS (SELECT cls, tp, support,
   COALESCE(CAST(tp AS DOUBLE) / NULLIF(CAST(predicted AS DOUBLE), 0), 0.0) AS precision,
   COALESCE(CAST(tp AS DOUBLE) / NULLIF(CAST(support AS DOUBLE), 0), 0.0) AS recall FROM per),
f AS (SELECT *, COALESCE(2.0 * precision * recall / NULLIF(precision + recall, 0), 0.0) AS f1_score FROM pr),
t AS (SELECT SUM(support) AS n, SUM(tp) AS tp, AVG(precision) AS mp, AVG(recall) AS mr, AVG(f1_score) AS mf,
   SUM(precision * support) AS wp, SUM(recall * support) AS wr, SUM(f1_score * support) AS wf FROM f)"""


@register("met3_classification_report", sql_prep("""
SELECT CASE cls WHEN 0 THEN 'Fully Paid' WHEN 1 THEN 'Charged Off' ELSE CAST(cls AS VARCHAR) END AS class,
  ROUND(precision, 6) AS precision, ROUND(recall, 6) AS recall, ROUND(f1_score, 6) AS f1_score, CAST(support AS BIGINT) AS support FROM f
UNION ALL SELECT 'accuracy', NULL, NULL, ROUND(CAST(tp AS DOUBLE) / CAST(n AS DOUBLE), 6), CAST(n AS BIGINT) FROM t
UNION ALL SELECT 'macro avg', ROUND(mp, 6), ROUND(mr, 6), ROUND(mf, 6), CAST(n AS BIGINT) FROM t
UNION ALL SELECT 'weighted avg', ROUND(wp / n, 6), ROUND(wr / n, 6), ROUND(wf / n, 6), CAST(n AS BIGINT) FROM t""", _REPORT_SQL))
def met3_classification_report(spark, sf):
    rep = M.classification_report(scored(loans_df(spark, sf)), "target", "prediction", {0: "Fully Paid", 1: "Charged Off"})
    return rep.select("class", r6("precision").alias("precision"), r6("recall").alias("recall"),
                      r6("f1_score").alias("f1_score"), "support")


# --- robustness with the fixed score ----------------------------------------------------------------------

def _noise_sql(f: str, src: str) -> str:
    h = f"md5('{R.NOISE_SEED}|{f}|' || CAST(id AS VARCHAR))"
    u1 = f"(CAST(CAST('0x' || substr({h}, 1, 8) AS BIGINT) + 1 AS DOUBLE) / CAST(4294967297 AS DOUBLE))"
    u2 = f"(CAST(CAST('0x' || substr({h}, 9, 8) AS BIGINT) AS DOUBLE) / CAST(4294967296 AS DOUBLE))"
    z = f"(SQRT(CAST(-2.0 AS DOUBLE) * LN({u1})) * COS(CAST(6.283185307179586 AS DOUBLE) * {u2}))"
    std = f"(SELECT STDDEV_SAMP(CAST({f} AS DOUBLE)) FROM {src})"
    moved = f"CASE WHEN {f} IS NOT NULL THEN GREATEST(CAST({f} AS DOUBLE) + {z} * {std} * CAST(0.05 AS DOUBLE), CAST(0.0 AS DOUBLE)) END"
    return f"CASE WHEN {std} IS NOT NULL AND {std} > 0 THEN {moved} ELSE CAST({f} AS DOUBLE) END"


_ROBUST_SQL = _CLEAN + f""", smp AS (SELECT id, rate_pct, annual_inc, dti, revol_util_frac AS revol_util FROM clean
  ORDER BY md5('{R.SAMPLE_SEED}:' || CAST(id AS VARCHAR)), id LIMIT {R.SAMPLE_SIZE}),
pert AS (SELECT id, rate_pct, {_noise_sql('annual_inc', 'smp')} AS annual_inc, {_noise_sql('dti', 'smp')} AS dti,
  {_noise_sql('revol_util', 'smp')} AS revol_util FROM smp),
pa AS (SELECT id, CASE WHEN {SCORE_SQL} >= {CUT} THEN 1 ELSE 0 END AS a FROM smp),
pb AS (SELECT id, CASE WHEN {SCORE_SQL} >= {CUT} THEN 1 ELSE 0 END AS b FROM pert)"""


def _robust_sample(spark, sf):
    from ..operators.sampling import exact_sample
    c = clean(loans_df(spark, sf)).select("id", "rate_pct", "annual_inc", "dti",
                                          F.col("revol_util_frac").alias("revol_util"))
    return c


def _predict(d):
    s = M.linear_score(F.col("rate_pct"), F.col("dti"), F.col("id"))
    return d.select("id", (s >= CUT).cast("int").alias("prediction"))


@register("rb1_perturbed_sample", sql_prep("""SELECT id, ROUND(annual_inc, 6) AS annual_inc, ROUND(dti, 6) AS dti,
  ROUND(revol_util, 6) AS revol_util FROM pert""", _ROBUST_SQL))
def rb1_perturbed_sample(spark, sf):
    from ..operators.sampling import exact_sample
    smp = exact_sample(_robust_sample(spark, sf), R.SAMPLE_SIZE, seed=R.SAMPLE_SEED)
    p = R.perturb(smp, R.PERTURB_FEATURES)
    return p.select("id", *[r6(c).alias(c) for c in R.PERTURB_FEATURES])


@register("rb3_flip_rate", sql_prep("""SELECT COUNT(*) AS rows, COUNT(*) FILTER (WHERE a <> b) AS changed,
  ROUND(COUNT(*) FILTER (WHERE a <> b) * 100.0 / COUNT(*), 6) AS change_pct,
  COUNT(*) FILTER (WHERE a <> b) * 100.0 / COUNT(*) < 15.0 AS passed, 'completed' AS status
FROM pa JOIN pb USING (id)""", _ROBUST_SQL))
def rb3_flip_rate(spark, sf):
    r = R.robustness(_robust_sample(spark, sf), _predict)
    return r.select("rows", "changed", r6("change_pct").alias("change_pct"), "passed", "status")


# --- A/B arms --------------------------------------------------------------------------------------------

AB_CHUNKS = 4


def _formula(i: int):
    """Scorer of arm ``i``: the formulas rank rows differently, so a swapped arm shows."""
    def sc(d):
        x, y = (F.col("rate_pct"), F.col("dti")) if i % 2 == 0 else (F.col("dti"), -F.col("rate_pct"))
        return d.withColumn("score", M.linear_score(x, y, F.col("id")))
    return sc


def ab_scorers(n: int):
    return [_formula(i) for i in range(n)]


def ab_cte(n: int) -> str:
    """Rows of the tail slice with arm and score (``sc``) and the arm sizes (``sz``): every row counts,
    scored or not."""
    from .q_profile import arm_sql
    other = ("CAST(0.02 AS DOUBLE) * CAST(dti AS DOUBLE) + CAST(0.01 AS DOUBLE) * (-rate_pct) "
             "+ CAST(0.000001 AS DOUBLE) * CAST(id AS DOUBLE)")
    return f""", ix AS (SELECT *, ROW_NUMBER() OVER (ORDER BY issue_d, id) - 1 AS idx, COUNT(*) OVER () AS n FROM loans),
tail AS (SELECT * FROM ix WHERE FLOOR(idx / {CHUNK}) >= CEIL(n / {float(CHUNK)}) - {AB_CHUNKS}),
prep AS (SELECT *, CASE WHEN loan_status = 'Charged Off' THEN 1 ELSE 0 END AS target,
   TRY_CAST(trim(rtrim(CAST(int_rate AS VARCHAR), '%')) AS DOUBLE) AS rate_pct, {arm_sql(n)} AS arm FROM tail),
sc AS (SELECT id, target, arm, CASE WHEN arm % 2 = 0 THEN {SCORE_SQL} ELSE {other} END AS score FROM prep),
sz AS (SELECT arm, COUNT(*) AS test_data_size FROM sc GROUP BY arm)"""


def _ab_sql() -> str:
    body = auc_sql("sc", "arm").replace(
        "SELECT arm, positives,",
        "SELECT a.arm, (SELECT test_data_size FROM sz WHERE sz.arm = a.arm) AS test_data_size, positives,")
    return with_loans(ab_cte(2) + body)


@register("ab3_arm_auc", _ab_sql())
def ab3_arm_auc(spark, sf):
    """AB1-AB3 on the tail slice (last 4 chunks, label over every status as the source does):
    arm by md5 of the id, each arm scored by its own formula, exact AUC per arm over its scored
    rows and the size of the whole arm."""
    tail = POS.tail_slice(loans_df(spark, sf), ORDER_KEY, AB_CHUNKS, CHUNK)
    m = arm_metrics(score_arms(prepared(tail), ab_scorers(2)))
    return m.select("arm", "test_data_size", "positives", "negatives", r6("roc_auc").alias("roc_auc"), "error")


@register("rb5_robustness_record", sql_prep("""SELECT 'fixed_scorer' AS run_id, k AS key, v AS value, t AS text FROM (
  SELECT 'robustness_change_percentage' AS k, ROUND(pct, 6) AS v, CAST(NULL AS VARCHAR) AS t FROM res
  UNION ALL SELECT 'robustness_test_passed', CAST(CASE WHEN pct < 15.0 THEN 1 ELSE 0 END AS DOUBLE), NULL FROM res
  UNION ALL SELECT 'robustness_features_perturbed', NULL, 'annual_inc, dti, revol_util' FROM res
  UNION ALL SELECT 'robustness_noise_level_std_fraction', 0.05, NULL FROM res
  UNION ALL SELECT 'robustness_threshold_percentage', 15.0, NULL FROM res
  UNION ALL SELECT 'robustness_test_status', NULL, 'completed' FROM res)""", _ROBUST_SQL + """,
res AS (SELECT COUNT(*) FILTER (WHERE a <> b) * 100.0 / COUNT(*) AS pct FROM pa JOIN pb USING (id))"""))
def rb5_robustness_record(spark, sf):
    """RB4 + RB5: the robustness result as run-metric rows (status, percentage, parameters)."""
    res = R.robustness(_robust_sample(spark, sf), _predict)
    rec = R.robustness_record(res, "fixed_scorer")
    return rec.select("run_id", "key", F.when(F.col("key") == "robustness_change_percentage", r6("value"))
                      .otherwise(F.col("value")).alias("value"), "text")
