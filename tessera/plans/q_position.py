"""Queries: positional slices and row index (SLC*, WIN4), sampling and splits (SMP*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import position as POS
from ..operators import sampling as S
from ..operators.prefix import row_index
from ..sources.loans import ORDER_KEY
from ..sources.tables import head_rows
from .catalog import loans_df, prepared, r6, register, sql_prep, with_loans
from .q_profile import arm_sql

CHUNK = 3000          # the fixture has 15,000 rows at sf0.01: 50,000-row chunks would always skip
TAIL_CHUNK = 4000     # 15,000 / 4,000: the last chunk is short (Q7)

_IX = """, ix AS (SELECT *, ROW_NUMBER() OVER (ORDER BY issue_d, id) - 1 AS idx, COUNT(*) OVER () AS n FROM loans)"""


@register("slc6_row_index", with_loans(_IX + "\nSELECT id, CAST(idx AS BIGINT) AS row_idx FROM ix"))
def slc6_row_index(spark, sf):
    return row_index(loans_df(spark, sf).select("id", "issue_d"), ORDER_KEY).select("id", "row_idx")


@register("win4_chunk_number", with_loans(_IX + f"\nSELECT id, CAST(FLOOR(idx / {CHUNK}) AS BIGINT) AS chunk FROM ix"))
def win4_chunk_number(spark, sf):
    ix = row_index(loans_df(spark, sf).select("id", "issue_d"), ORDER_KEY)
    return ix.select("id", F.floor(F.col("row_idx") / CHUNK).cast("bigint").alias("chunk"))


@register("slc1_head_chunks", with_loans(_IX + f"\nSELECT id, loan_amnt FROM ix WHERE idx < {2 * CHUNK}"))
def slc1_head_chunks(spark, sf):
    ix = POS.with_index(loans_df(spark, sf).select("id", "issue_d", "loan_amnt"), ORDER_KEY)
    return POS.head_chunks(ix, 2, CHUNK).select("id", "loan_amnt")


@register("slc2_tail_chunks", with_loans(
    _IX + f"\nSELECT id, loan_amnt FROM ix WHERE FLOOR(idx / {TAIL_CHUNK}) >= CEIL(n / {float(TAIL_CHUNK)}) - 2"))
def slc2_tail_chunks(spark, sf):
    ix = POS.with_index(loans_df(spark, sf).select("id", "issue_d", "loan_amnt"), ORDER_KEY)
    return POS.tail_chunks(ix, 2, TAIL_CHUNK).select("id", "loan_amnt")


@register("slc3_head_chunks_then_filter", with_loans(
    _IX + f"\nSELECT id, loan_status FROM ix WHERE idx < {2 * CHUNK} AND loan_status IN ('Fully Paid', 'Charged Off')"))
def slc3_head_chunks_then_filter(spark, sf):
    ix = POS.with_index(loans_df(spark, sf).select("id", "issue_d", "loan_status"), ORDER_KEY)
    return POS.head_chunks(ix, 2, CHUNK).filter(F.col("loan_status").isin("Fully Paid", "Charged Off")).select(
        "id", "loan_status")


@register("slc4_fraction_slices", with_loans(_IX + """
SELECT id, 'reference' AS slice FROM ix WHERE idx < FLOOR(0.1 * n)
UNION ALL SELECT id, 'current' FROM ix WHERE idx >= n - FLOOR(0.1 * n)"""))
def slc4_fraction_slices(spark, sf):
    ix = POS.with_index(loans_df(spark, sf).select("id", "issue_d"), ORDER_KEY)
    return (POS.head_fraction(ix, 0.1).select("id", F.lit("reference").alias("slice"))
            .unionByName(POS.tail_fraction(ix, 0.1).select("id", F.lit("current").alias("slice"))))


@register("slc5_too_small_guard", with_loans("""SELECT c AS chunk_size, n AS n_rows,
  CASE WHEN CEIL(n / CAST(c AS DOUBLE)) < 4 THEN 'SKIPPED_TOO_SMALL' ELSE 'OK' END AS status
FROM (SELECT COUNT(*) AS n FROM loans), (VALUES (3000), (50000)) v(c)"""))
def slc5_too_small_guard(spark, sf):
    df = loans_df(spark, sf)
    out = None
    for c in (3000, 50000):
        _, _, st = POS.slices(df, ORDER_KEY, "chunks", 2, c)
        st = st.select(F.lit(c).alias("chunk_size"), "n_rows", "status")
        out = st if out is None else out.unionByName(st)
    return out


@register("slc7_head_rows", with_loans("SELECT id, loan_status FROM loans ORDER BY issue_d, id LIMIT 5"))
def slc7_head_rows(spark, sf):
    return head_rows(loans_df(spark, sf), 5, ORDER_KEY).select("id", "loan_status")


# --- sampling ------------------------------------------------------------------------------------------

_CLEAN = """, clean AS (SELECT * FROM prep WHERE loan_status IN ('Fully Paid', 'Charged Off')
  AND loan_amnt IS NOT NULL AND int_rate_frac IS NOT NULL AND annual_inc IS NOT NULL AND dti IS NOT NULL
  AND revol_util_frac IS NOT NULL AND emp_length_numeric IS NOT NULL)"""

TRAIN_NUMERIC = ["loan_amnt", "int_rate_frac", "annual_inc", "dti", "revol_util_frac", "emp_length_numeric"]


def clean(df):
    d = prepared(df).filter(F.col("loan_status").isin("Fully Paid", "Charged Off"))
    return d.dropna(how="any", subset=TRAIN_NUMERIC)


@register("smp1_exact_sample", sql_prep(
    "SELECT id FROM clean ORDER BY md5('456:' || CAST(id AS VARCHAR)), id LIMIT 1000", _CLEAN))
def smp1_exact_sample(spark, sf):
    return S.exact_sample(clean(loans_df(spark, sf)), 1000, seed=456).select("id")


@register("smp1_exact_sample_large", sql_prep(
    "SELECT id, target FROM prep ORDER BY md5('42:' || CAST(id AS VARCHAR)), id LIMIT 12000"))
def smp1_exact_sample_large(spark, sf):
    """A sample of most of the table (12,000 of 15,000 rows at sf0.01)."""
    return S.exact_sample(prepared(loans_df(spark, sf)), 12000, seed=42).select("id", "target")


@register("smp2_random_split", sql_prep("""SELECT id, (ROW_NUMBER() OVER (ORDER BY md5('42:' || CAST(id AS VARCHAR)), id) - 1)
  < CEIL(CAST(0.2 AS DOUBLE) * (SELECT COUNT(*) FROM prep)) AS is_test FROM prep"""))
def smp2_random_split(spark, sf):
    return S.random_split(prepared(loans_df(spark, sf)), 0.2, seed=42).select("id", "is_test")


_QUOTA_SQL = """, c AS (SELECT target, COUNT(*) AS class_rows FROM clean GROUP BY target),
q1 AS (SELECT *, SUM(class_rows) OVER () AS n FROM c),
q2 AS (SELECT *, n - CEIL(CAST(0.2 AS DOUBLE) * n) AS ntrain FROM q1),
q3 AS (SELECT *, class_rows * ntrain / n AS cont FROM q2),
q4 AS (SELECT *, FLOOR(cont) AS fl, cont - FLOOR(cont) AS rem FROM q3),
q5 AS (SELECT *, ntrain - SUM(fl) OVER () AS need, ROW_NUMBER() OVER (ORDER BY rem DESC, target ASC) AS rk FROM q4),
quota AS (SELECT target, class_rows, CAST(fl + CASE WHEN rk <= need THEN 1 ELSE 0 END AS BIGINT) AS train_rows,
  CAST(class_rows - (fl + CASE WHEN rk <= need THEN 1 ELSE 0 END) AS BIGINT) AS test_rows FROM q5)"""


@register("smp3_stratified_quotas", sql_prep("SELECT target, class_rows, train_rows, test_rows FROM quota",
                                             _CLEAN + _QUOTA_SQL))
def smp3_stratified_quotas(spark, sf):
    return S.stratified_quotas(clean(loans_df(spark, sf)), "target", 0.2)


_SPLIT_SQL = _CLEAN + _QUOTA_SQL + """, sp AS (
  SELECT k.*, (ROW_NUMBER() OVER (PARTITION BY k.target ORDER BY md5('42:' || CAST(k.id AS VARCHAR)), k.id) - 1) < q.test_rows AS is_test
  FROM clean k JOIN quota q ON k.target = q.target)"""


@register("smp3_stratified_split", sql_prep("SELECT id, target, is_test FROM sp", _SPLIT_SQL))
def smp3_stratified_split(spark, sf):
    return S.stratified_split(clean(loans_df(spark, sf)), "target", 0.2, seed=42).select("id", "target", "is_test")


@register("smp6_split_sizes", sql_prep("""SELECT CASE WHEN is_test THEN 'test' ELSE 'train' END AS split, target,
  COUNT(*) AS rows FROM sp GROUP BY 1, 2""", _SPLIT_SQL))
def smp6_split_sizes(spark, sf):
    sp = S.stratified_split(clean(loans_df(spark, sf)), "target", 0.2, seed=42)
    return S.split_sizes(sp, by=["target"])


@register("smp4_arm_sizes", with_loans(f"""SELECT 2 AS arms, {arm_sql(2)} AS arm, COUNT(*) AS rows FROM loans GROUP BY 2
UNION ALL SELECT 3, {arm_sql(3)}, COUNT(*) FROM loans GROUP BY 2"""))
def smp4_arm_sizes(spark, sf):
    df = loans_df(spark, sf)
    parts = [S.assign_arm(df, n).groupBy(F.lit(n).alias("arms"), "arm").agg(F.count(F.lit(1)).alias("rows"))
             for n in (2, 3)]
    return parts[0].unionByName(parts[1])


_SMP5_QS = [0.01, 0.05, 0.95, 0.99]


def _smp5_sql():
    parts = []
    for c in ("loan_amnt", "rate_pct"):
        for q in _SMP5_QS:
            parts.append(f"SELECT CASE WHEN is_test THEN 'test' ELSE 'train' END AS split, '{c}' AS feature, {q} AS q, "
                         f"ROUND(QUANTILE_CONT({c}, {q}), 6) AS value FROM rs WHERE {c} IS NOT NULL GROUP BY 1")
    return sql_prep("\n" + "\nUNION ALL\n".join(parts), """, rs AS (SELECT *, (ROW_NUMBER() OVER (ORDER BY md5('42:' || CAST(id AS VARCHAR)), id) - 1)
  < CEIL(CAST(0.2 AS DOUBLE) * (SELECT COUNT(*) FROM prep)) AS is_test FROM prep)""")


@register("smp5_split_percentiles", _smp5_sql())
def smp5_split_percentiles(spark, sf):
    """SMP5: percentiles of both sides of a split, in the passes of one table."""
    from ..operators.profile import grouped_percentiles
    sp = S.random_split(prepared(loans_df(spark, sf)), 0.2, seed=42)
    p = grouped_percentiles(sp, "is_test", [True, False], ["loan_amnt", "rate_pct"], _SMP5_QS)
    return p.select(F.when(F.col("is_test"), "test").otherwise("train").alias("split"), "feature", "q", r6("value").alias("value"))
