"""The ``loans`` table: the wide loan schema the library is written for, derived by Spark
from the driver's star-schema tables (orders, lineitem, customer, nation).

Every column is a pure function of the joined rows (no sampling, no row filter), so the
table grows with the inputs. Plan: lineitem is pre-aggregated per order (partial + final
hash aggregate, one shuffle on the order key), orders join customer on the customer key,
nation (25 rows, a fixed-size dimension) is broadcast, then the per-order line statistics
join on the order key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import read_table

# Fixed values of the derived fixture (must equal the oracle SQL).
GRADE_LETTERS = "ABCDEFG"
RATE_BASE_POINTS = 531      # 5.31 %: lowest rate
RATE_SPAN_POINTS = 2554     # 5.31 % .. 30.84 %
GRADE_WIDTH_POINTS = 365.0

LOAN_COLUMNS = [
    "id", "issue_d", "loan_status", "loan_amnt", "int_rate", "installment", "annual_inc", "dti",
    "delinq_2yrs", "inq_last_6mths", "open_acc", "pub_rec", "revol_bal", "revol_util",
    "total_acc", "emp_length", "term", "grade", "sub_grade", "home_ownership",
    "verification_status", "purpose", "addr_state",
]

# Explicit total order standing in for file order.
ORDER_KEY = ["issue_d", "id"]


def line_stats(lineitem: DataFrame) -> DataFrame:
    """Per-order line statistics (one pass, partial aggregation before the shuffle)."""
    one = F.lit(1)
    zero = F.lit(0)
    return lineitem.groupBy("l_orderkey").agg(
        F.count(F.lit(1)).cast("double").alias("total_acc"),
        F.sum(F.when(F.col("l_linestatus") == "O", one).otherwise(zero)).cast("double").alias("open_acc"),
        F.sum(F.when(F.col("l_returnflag") == "R", one).otherwise(zero)).cast("double").alias("pub_rec"),
        F.sum(F.when(F.col("l_returnflag") == "A", one).otherwise(zero)).cast("double").alias("delinq_2yrs"),
        F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).cast("double").alias("revol_bal"),
    )


def build_loans(orders: DataFrame, lineitem: DataFrame, customer: DataFrame,
                nation: DataFrame) -> DataFrame:
    k = F.col("o_orderkey")
    bp = F.col("bp")
    base = (
        orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
                      "o_orderpriority")
        .join(customer.select("c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment"),
              F.col("o_custkey") == F.col("c_custkey"), "left")
        # nation is a fixed 25-row dimension: a proven size bound for broadcast
        .join(F.broadcast(nation.select("n_nationkey", "n_name")),
              F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .withColumn("bp", F.lit(RATE_BASE_POINTS) + (k * 37) % RATE_SPAN_POINTS)
    )
    li = line_stats(lineitem)
    j = base.join(li, base.o_orderkey == li.l_orderkey, "left")
    grade_idx = (F.lit(1) + F.floor((bp - RATE_BASE_POINTS) / F.lit(GRADE_WIDTH_POINTS))).cast("int")
    grade = F.substr(F.lit(GRADE_LETTERS), grade_idx, F.lit(1))
    emp = k % 13
    return j.select(
        k.alias("id"),
        F.col("o_orderdate").alias("issue_d"),
        F.when(F.col("o_orderstatus") == "F", "Charged Off")
         .when(F.col("o_orderstatus") == "O", "Current")
         .otherwise("Fully Paid").alias("loan_status"),
        F.when(k % 5003 == 0, F.lit(None).cast("double"))
         .otherwise(F.col("o_totalprice") / F.lit(12.5)).alias("loan_amnt"),
        F.when(k % 2503 == 0, F.lit(None).cast("string"))
         .otherwise(F.concat(F.floor(bp / F.lit(100.0)).cast("bigint").cast("string"), F.lit("."),
                             F.lpad((bp % 100).cast("string"), 2, "0"), F.lit("%"))).alias("int_rate"),
        (F.col("o_totalprice") / F.lit(450.0)).alias("installment"),
        F.when(F.col("c_acctbal") < 0, F.lit(None).cast("double"))
         .otherwise(F.col("c_acctbal") * 10).alias("annual_inc"),
        ((F.col("c_custkey") % 4000) / F.lit(100.0)).alias("dti"),
        F.col("delinq_2yrs"),
        (k % 6).cast("double").alias("inq_last_6mths"),
        F.col("open_acc"), F.col("pub_rec"), F.col("revol_bal"),
        F.when(k % 997 == 0, F.lit("n/a"))
         .otherwise(F.concat((k % 101).cast("string"), F.lit("."), (k % 10).cast("string"), F.lit("%")))
         .alias("revol_util"),
        F.col("total_acc"),
        F.when(emp == 0, "< 1 year").when(emp == 1, "1 year").when(emp == 10, "10+ years")
         .when(emp == 11, "n/a").when(emp == 12, F.lit(None).cast("string"))
         .otherwise(F.concat(emp.cast("string"), F.lit(" years"))).alias("emp_length"),
        F.when(k % 4 == 0, " 60 months").otherwise(" 36 months").alias("term"),
        grade.alias("grade"),
        F.concat(grade, (F.lit(1) + k % 5).cast("string")).alias("sub_grade"),
        F.col("c_mktsegment").alias("home_ownership"),
        F.when(k % 251 == 0, F.lit(None).cast("string")).otherwise(F.col("o_orderpriority"))
         .alias("verification_status"),
        F.col("o_orderpriority").alias("purpose"),
        F.col("n_name").alias("addr_state"),
    )


def loans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``loans`` table over the driver tables in ``sf_dir``."""
    return build_loans(read_table(spark, sf_dir, "orders"), read_table(spark, sf_dir, "lineitem"),
                       read_table(spark, sf_dir, "customer"), read_table(spark, sf_dir, "nation"))


# The same table as DuckDB SQL: the common CTE of every oracle query.
LOANS_SQL_CTE = """
li AS (
  SELECT l_orderkey,
         CAST(COUNT(*) AS DOUBLE) AS total_acc,
         CAST(SUM(CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END) AS DOUBLE) AS open_acc,
         CAST(SUM(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS DOUBLE) AS pub_rec,
         CAST(SUM(CASE WHEN l_returnflag = 'A' THEN 1 ELSE 0 END) AS DOUBLE) AS delinq_2yrs,
         CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS revol_bal
  FROM lineitem GROUP BY l_orderkey),
base AS (
  SELECT o.*, c.c_acctbal, c.c_custkey, c.c_mktsegment, n.n_name,
         531 + (o_orderkey * 37) % 2554 AS bp
  FROM orders o
  LEFT JOIN customer c ON o.o_custkey = c.c_custkey
  LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey),
loans AS (
SELECT
  o_orderkey AS id,
  o_orderdate AS issue_d,
  CASE o_orderstatus WHEN 'F' THEN 'Charged Off' WHEN 'O' THEN 'Current' ELSE 'Fully Paid' END AS loan_status,
  CASE WHEN o_orderkey % 5003 = 0 THEN NULL ELSE o_totalprice / CAST(12.5 AS DOUBLE) END AS loan_amnt,
  CASE WHEN o_orderkey % 2503 = 0 THEN NULL
       ELSE CONCAT(CAST(CAST(FLOOR(bp / 100.0) AS BIGINT) AS STRING), '.', LPAD(CAST(bp % 100 AS STRING), 2, '0'), '%') END AS int_rate,
  o_totalprice / CAST(450 AS DOUBLE) AS installment,
  CASE WHEN c_acctbal < 0 THEN NULL ELSE c_acctbal * 10 END AS annual_inc,
  (c_custkey % 4000) / CAST(100 AS DOUBLE) AS dti,
  li.delinq_2yrs,
  CAST(o_orderkey % 6 AS DOUBLE) AS inq_last_6mths,
  li.open_acc, li.pub_rec, li.revol_bal,
  CASE WHEN o_orderkey % 997 = 0 THEN 'n/a' ELSE CONCAT(CAST(o_orderkey % 101 AS STRING), '.', CAST(o_orderkey % 10 AS STRING), '%') END AS revol_util,
  li.total_acc,
  CASE o_orderkey % 13 WHEN 0 THEN '< 1 year' WHEN 1 THEN '1 year' WHEN 10 THEN '10+ years'
       WHEN 11 THEN 'n/a' WHEN 12 THEN NULL ELSE CONCAT(CAST(o_orderkey % 13 AS STRING), ' years') END AS emp_length,
  CASE WHEN o_orderkey % 4 = 0 THEN ' 60 months' ELSE ' 36 months' END AS term,
  SUBSTR('ABCDEFG', CAST(1 + FLOOR((bp - 531) / 365.0) AS INT), 1) AS grade,
  CONCAT(SUBSTR('ABCDEFG', CAST(1 + FLOOR((bp - 531) / 365.0) AS INT), 1), CAST(1 + o_orderkey % 5 AS STRING)) AS sub_grade,
  c_mktsegment AS home_ownership,
  CASE WHEN o_orderkey % 251 = 0 THEN NULL ELSE o_orderpriority END AS verification_status,
  o_orderpriority AS purpose,
  n_name AS addr_state
FROM base LEFT JOIN li ON base.o_orderkey = li.l_orderkey)
"""
