"""Readers for the input tables and the scan shapes the checks use (SRC1-SRC7)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

DRIVER_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

# Raw schema of the loan file the library is written for (CSV scan, SRC1). Percent columns
# stay text: they are parsed by tessera.functions.parse.
LOAN_CSV_SCHEMA = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("issue_d", T.StringType()),
    T.StructField("loan_status", T.StringType()),
    T.StructField("loan_amnt", T.DoubleType()),
    T.StructField("int_rate", T.StringType()),
    T.StructField("installment", T.DoubleType()),
    T.StructField("annual_inc", T.DoubleType()),
    T.StructField("dti", T.DoubleType()),
    T.StructField("delinq_2yrs", T.DoubleType()),
    T.StructField("inq_last_6mths", T.DoubleType()),
    T.StructField("open_acc", T.DoubleType()),
    T.StructField("pub_rec", T.DoubleType()),
    T.StructField("revol_bal", T.DoubleType()),
    T.StructField("revol_util", T.StringType()),
    T.StructField("total_acc", T.DoubleType()),
    T.StructField("emp_length", T.StringType()),
    T.StructField("term", T.StringType()),
    T.StructField("grade", T.StringType()),
    T.StructField("sub_grade", T.StringType()),
    T.StructField("home_ownership", T.StringType()),
    T.StructField("verification_status", T.StringType()),
    T.StructField("purpose", T.StringType()),
    T.StructField("addr_state", T.StringType()),
])


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table (parquet), NaN as NULL. Projection reaches the scan through Catalyst, and so
    do filters on all but floating columns."""
    return nan_to_null(spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet"))


def read_csv(spark: SparkSession, path: str, schema: T.StructType = LOAN_CSV_SCHEMA,
             header: bool = True) -> DataFrame:
    """SRC1: CSV scan with an explicit schema (no inference pass over the data), NaN as NULL."""
    return nan_to_null(spark.read.schema(schema).option("header", header)
                       .option("mode", "PERMISSIVE").csv(path))


def read_csv_checked(spark: SparkSession, path: str, schema: T.StructType = LOAN_CSV_SCHEMA,
                     header: bool = True) -> tuple[DataFrame, DataFrame]:
    """SRC1 with a reject channel: ``(rows, rejects)``. ``rows`` are the lines that parse in all their columns, NaN as
    NULL; ``rejects`` has the column ``line`` with every other line as it stands: a value of the wrong type, or
    too few or too many fields. Empty fields are NULL and no fault; empty lines do not count. Every line is in
    one of the two, whichever columns are read later: all columns are parsed, as a pruned scan would let a line
    pass whose fault lies in a column not asked for."""
    line = "_reject_line"
    full = T.StructType([*schema.fields, T.StructField(line, T.StringType())])
    parsed = (spark.read.schema(full).option("header", header).option("mode", "PERMISSIVE")
              .option("columnNameOfCorruptRecord", line).option("columnPruning", "false").csv(path))
    # always true, and keeps every column in the scan: Spark converts only the columns a query asks for
    asked = parsed.where(F.xxhash64(*[F.col(f"`{c}`") for c in schema.fieldNames()]) >= F.lit(-(1 << 63)))
    rows = asked.where(F.col(line).isNull()).drop(line)
    return nan_to_null(rows), asked.where(F.col(line).isNotNull()).select(F.col(line).alias("line"))


def nan_to_null(df: DataFrame) -> DataFrame:
    """Ingest rule: every double NaN becomes NULL so that the library sees one null kind."""
    if not any(isinstance(f.dataType, (T.DoubleType, T.FloatType)) for f in df.schema.fields):
        return df
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            cols.append(F.nanvl(F.col(f.name), F.lit(None).cast(f.dataType)).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def select_strict(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """SRC3: column-pruned scan; a missing column raises (AnalysisException)."""
    return df.select(*cols)


def select_tolerant(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """SRC4: column-pruned scan; columns absent from the source are skipped."""
    have = set(df.columns)
    return df.select(*[c for c in cols if c in have])


def order_columns(order_by: Iterable[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in order_by]


def head_rows(df: DataFrame, n: int, order_by: Iterable[str | Column]) -> DataFrame:
    """SRC2 / SLC7: first ``n`` rows in file order. Row order is explicit (a total order key);
    ``n`` is the feature here (a head sample). Exact, without a single-task merge of
    partitions x n rows (``operators.topn``)."""
    from ..operators.topn import first_rows
    return first_rows(df, n, order_columns(order_by))


def filtered_head(df: DataFrame, status_col: str, allowed: Iterable[str], n: int | None,
                  order_by: Iterable[str | Column]) -> DataFrame:
    """SRC5: status-filtered scan that stops after ``n`` qualifying rows (None = all).

    The filter is pushed to the scan; the limit is only applied when a sample size is asked
    for, as in the source pipeline's early stop."""
    out = df.filter(F.col(status_col).isin(list(allowed)))
    if n is None:
        return out
    return head_rows(out, n, order_by)
