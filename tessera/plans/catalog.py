"""Registry of named queries: a Spark callable ``(spark, sf_dir) -> DataFrame`` and, where the
operator is SQL-expressible, the equivalent DuckDB SQL over the same parquet tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.parse import binary_target, parse_emp_length, percent_lenient, percent_number, percent_strict
from ..sources.loans import LOANS_SQL_CTE, loans

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def r6(c: Column | str) -> Column:
    """Round a floating result to 6 decimals (engines differ in the last bits of sums)."""
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


def loans_df(spark: SparkSession, sf_dir: str) -> DataFrame:
    return loans(spark, sf_dir)


def prepared(df: DataFrame) -> DataFrame:
    """Target and parsed columns (PRJ3, SC1-SC3) on the loan table; no row is dropped."""
    return df.select(
        "*", binary_target("loan_status").alias("target"),
        parse_emp_length("emp_length").alias("emp_length_numeric"),
        percent_strict("int_rate").alias("int_rate_frac"),
        percent_lenient("revol_util").alias("revol_util_frac"),
        percent_number("int_rate").alias("rate_pct"))


# --- SQL building blocks (DuckDB dialect) -----------------------------------------------------

def with_loans(body: str) -> str:
    """``WITH <loans CTEs>, <body>``: body starts with further CTEs or is ``SELECT ...`` prefixed
    by a comma-free CTE list; use ``sql_q`` for the common case."""
    return "WITH " + LOANS_SQL_CTE + body


EMP_SQL = """CASE WHEN emp_length IS NULL OR emp_length = 'n/a' THEN NULL
  WHEN trim(replace(replace(lower(emp_length), 'years', ''), 'year', '')) = '< 1' THEN 0.5
  WHEN trim(replace(replace(lower(emp_length), 'years', ''), 'year', '')) = '10+' THEN 10.0
  ELSE TRY_CAST(trim(replace(replace(lower(emp_length), 'years', ''), 'year', '')) AS DOUBLE) END"""
RATE_STRICT_SQL = "CAST(rtrim(CAST(int_rate AS VARCHAR), '%') AS DOUBLE) / 100.0"
REVOL_LENIENT_SQL = "TRY_CAST(trim(rtrim(CAST(revol_util AS VARCHAR), '%')) AS DOUBLE) / 100.0"
RATE_PCT_SQL = "TRY_CAST(trim(rtrim(CAST(int_rate AS VARCHAR), '%')) AS DOUBLE)"
RATE_FRAC_SQL = f"({RATE_PCT_SQL} / 100.0)"

PREP_SQL = f""", prep AS (
  SELECT *, CASE WHEN loan_status = 'Charged Off' THEN 1 ELSE 0 END AS target,
         {EMP_SQL} AS emp_length_numeric,
         {RATE_STRICT_SQL} AS int_rate_frac,
         {REVOL_LENIENT_SQL} AS revol_util_frac,
         {RATE_PCT_SQL} AS rate_pct
  FROM loans)
"""


def sql_prep(select: str, more_ctes: str = "") -> str:
    """Oracle SQL over the ``prep`` CTE (loans + parsed columns)."""
    return with_loans(PREP_SQL + more_ctes + "\n" + select)
