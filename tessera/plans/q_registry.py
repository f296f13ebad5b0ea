"""Queries: model registry, run metrics and the A/B report (REG1-REG5, SNK3, SNK6, JN1, JN2, AB4, AB5),
on registry rows that Spark derives from ``orders`` (one registration or failure per order)."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import functions as F

from ..operators import robust as R
from ..operators.abtest import ab_report, arm_metrics, score_arms
from ..operators import position as POS
from ..session import checkpoint_dir
from ..sources import registry as REG
from ..sources.loans import ORDER_KEY
from ..sources.tables import read_table
from .catalog import loans_df, prepared, r6, register, with_loans
from .q_eval import AB_CHUNKS, ab_cte, ab_scorers, auc_sql

NAMES = 60

_REG = f"""WITH reg AS (SELECT 'M' || CAST(o_orderkey % {NAMES} AS VARCHAR) AS model_version_name,
  CASE WHEN o_orderkey % 11 = 0 OR o_orderkey % 7 = 0 THEN NULL ELSE 'models/' || CAST(o_orderkey AS VARCHAR) END AS model_uri,
  'run' || CAST(o_orderkey AS VARCHAR) AS run_id, 'Model' || CAST(o_orderkey % 2 AS VARCHAR) AS model_name,
  CASE WHEN o_orderkey % 13 = 0 THEN 0 ELSE 1 END AS has_numeric,
  CASE WHEN o_orderkey % 7 = 0 THEN 'TRAINING_FAILED' ELSE 'REGISTERED' END AS status,
  CASE WHEN o_orderkey % 7 = 0 THEN 'stopped at ' || CAST(o_orderkey AS VARCHAR) END AS error, o_orderkey AS k FROM orders),
latest AS (SELECT * FROM reg QUALIFY ROW_NUMBER() OVER (PARTITION BY model_version_name ORDER BY k DESC) = 1)
"""


def registry_frame(spark, sf):
    """Registry rows of the registry's schema; the registration time grows with the order key."""
    k = F.col("o_orderkey")
    failed = k % 7 == 0
    return read_table(spark, sf, "orders").select(
        F.concat(F.lit("M"), (k % NAMES).cast("string")).alias("model_version_name"),
        F.when(~((k % 11 == 0) | failed), F.concat(F.lit("models/"), k.cast("string"))).alias("model_uri"),
        F.concat(F.lit("run"), k.cast("string")).alias("run_id"),
        F.concat(F.lit("Model"), (k % 2).cast("string")).alias("model_name"),
        F.when(k % 13 == 0, F.array().cast("array<string>")).otherwise(F.array(F.lit("dti"))).alias("numeric_features"),
        F.array(F.lit("grade")).alias("categorical_features"),
        F.when(failed, F.lit("TRAINING_FAILED")).otherwise(F.lit("REGISTERED")).alias("status"),
        F.when(failed, F.concat(F.lit("stopped at "), k.cast("string"))).alias("error"),
        F.lit(None).cast("string").alias("input_schema"), F.lit(None).cast("string").alias("output_schema"),
        F.lit(None).cast("string").alias("input_example"), F.timestamp_seconds(k.cast("long")).alias("registered_at"))


@register("reg1_read_registry", _REG + """SELECT COUNT(*) AS rows, COUNT(DISTINCT model_version_name) AS names, COUNT(error) AS errors,
  0 AS rows_of_missing_table FROM reg""")
def reg1_read_registry(spark, sf):
    """REG1: the registry written and read back; a table that does not exist reads as empty."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/registry-{uuid.uuid4().hex}"
    registry_frame(spark, sf).write.parquet(path)
    missing = REG.read_registry(spark, path + "-none").count()
    return REG.read_registry(spark, path).agg(
        F.count(F.lit(1)).alias("rows"), F.countDistinct("model_version_name").alias("names"),
        F.count("error").alias("errors"), F.lit(missing).cast("int").alias("rows_of_missing_table"))


@register("reg2_latest_rows", _REG + "SELECT model_version_name, run_id, model_uri, status FROM latest")
def reg2_latest_rows(spark, sf):
    """REG2: the last registration of every model version."""
    return REG.latest(registry_frame(spark, sf)).select("model_version_name", "run_id", "model_uri", "status")


@register("reg2_equal_times", _REG + "SELECT model_version_name, run_id, model_uri, status FROM latest")
def reg2_equal_times(spark, sf):
    """REG2: all rows carry one registration time, as from writers with a coarse clock; the commit number decides."""
    reg = registry_frame(spark, sf).withColumn("seq", F.unix_timestamp("registered_at"))
    tied = reg.withColumn("registered_at", F.timestamp_seconds(F.lit(0)))
    return REG.latest(tied).select("model_version_name", "run_id", "model_uri", "status")


@register("reg3_readiness", _REG + """SELECT model_version_name, CASE WHEN status = 'TRAINING_FAILED' THEN 'TRAINING_FAILED'
  WHEN model_uri IS NULL OR has_numeric = 0 THEN 'INCOMPLETE' ELSE 'READY' END AS readiness FROM latest""")
def reg3_readiness(spark, sf):
    return REG.validate(REG.latest(registry_frame(spark, sf))).select("model_version_name", "readiness")


@register("reg4_failed_models", _REG + "SELECT model_version_name, error FROM latest WHERE status = 'TRAINING_FAILED'")
def reg4_failed_models(spark, sf):
    """REG4: model versions whose last training failed; other models keep their rows."""
    d = REG.latest(registry_frame(spark, sf)).filter(F.col("status") == "TRAINING_FAILED")
    return d.select("model_version_name", "error")


@register("reg5_versions", _REG + """SELECT model_name, model_version_name, run_id,
  CAST(ROW_NUMBER() OVER (PARTITION BY model_name ORDER BY k, run_id) AS INTEGER) AS version FROM reg WHERE status = 'REGISTERED'""")
def reg5_versions(spark, sf):
    return REG.versions(registry_frame(spark, sf))


@register("snk3_run_metrics", """SELECT 'run' || o_orderstatus AS run_id, 'mean_price' AS key, ROUND(AVG(o_totalprice), 6) AS value,
  CAST(NULL AS VARCHAR) AS text, 3 AS step FROM orders GROUP BY o_orderstatus
UNION ALL SELECT 'run' || o_orderstatus, 'status', NULL, o_orderstatus, 3 FROM orders GROUP BY o_orderstatus""")
def snk3_run_metrics(spark, sf):
    """SNK3: metric and text rows of a run per order status, appended and read back."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/runs-{uuid.uuid4().hex}"
    s = F.col("o_orderstatus")
    g = read_table(spark, sf, "orders").groupBy("o_orderstatus").agg(F.avg("o_totalprice").alias("mean_price"))
    run = F.concat(F.lit("run"), s).alias("run_id")
    REG.append_run_rows(g.select(run, F.lit("mean_price").alias("key"), F.col("mean_price").alias("value"),
                                 F.lit(None).cast("string").alias("text")), path, step=3)
    REG.append_run_rows(g.select(run, F.lit("status").alias("key"), F.lit(None).cast("double").alias("value"), s.alias("text")),
                        path, step=3)
    return REG.read_runs(spark, path).select("run_id", "key", r6("value").alias("value"), "text", "step")


@register("snk3_retried_commit", """SELECT COUNT(*) AS rows, COUNT(DISTINCT o_orderkey) AS runs, MIN(o_totalprice) AS least,
  MAX(o_totalprice) AS most FROM orders""")
def snk3_retried_commit(spark, sf):
    """SNK3: one metric row per order in two commits. The first commit is written twice, its first try with other
    values; one copy of each is read back."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/runs-{uuid.uuid4().hex}"
    k = F.col("o_orderkey")
    m = read_table(spark, sf, "orders").select(
        F.concat(F.lit("run"), k.cast("string")).alias("run_id"), F.lit("price").alias("key"),
        F.col("o_totalprice").alias("value"), F.lit(None).cast("string").alias("text"), (k % 2 == 0).alias("even"))
    even, odd = m.where("even"), m.where("not even")
    REG.append_run_rows(even.withColumn("value", F.lit(-1.0)), path, commit="even")
    REG.append_run_rows(odd, path, commit="odd")
    REG.append_run_rows(even, path, commit="even")
    return REG.read_runs(spark, path).agg(F.count(F.lit(1)).alias("rows"), F.countDistinct("run_id").alias("runs"),
                                          F.min("value").alias("least"), F.max("value").alias("most"))


@register("snk6_model_signature", with_loans("""SELECT 'input' AS part, CAST(ROW_NUMBER() OVER (ORDER BY issue_d, id) - 1 AS INTEGER) AS position,
  'id ' || CAST(id AS VARCHAR) AS name, grade AS type FROM (SELECT * FROM loans ORDER BY issue_d, id LIMIT 5)
UNION ALL SELECT 'schema', p, n, t FROM (SELECT MIN(id) AS m FROM loans) CROSS JOIN
  (VALUES (0, 'id', 'long'), (1, 'grade', 'string'), (2, 'dti', 'double')) v(p, n, t)
UNION ALL SELECT 'output', p, n, t FROM (SELECT MIN(id) AS m FROM loans) CROSS JOIN
  (VALUES (0, 'prediction', 'integer'), (1, 'score', 'double')) v(p, n, t)"""))
def snk6_model_signature(spark, sf):
    """SNK6: input fields, the five-row input example and the output fields of a model."""
    schema, example = REG.input_signature(loans_df(spark, sf), ["id", "grade", "dti"], ORDER_KEY)
    rows = [("input", i, f"id {r['id']}", r["grade"]) for i, r in enumerate(json.loads(example))]
    for part, text in (("schema", schema), ("output", REG.OUTPUT_SCHEMA.json())):
        rows += [(part, i, f["name"], f["type"]) for i, f in enumerate(json.loads(text)["fields"])]
    return spark.createDataFrame(rows, "part string, position int, name string, type string")


_ASKED = ["M1", "M2", "Absent"]


@register("ab4_report", with_loans(ab_cte(len(_ASKED))) + ", " + _REG.replace("WITH reg AS", "reg AS", 1) + ", asked AS (SELECT * FROM (VALUES "
          + ", ".join(f"({i}, '{n}')" for i, n in enumerate(_ASKED)) + ") v(arm, model_version_name)), auc AS (SELECT * FROM ("
          + "WITH one AS (SELECT 1)" + auc_sql("sc", "arm") + """))
SELECT 't1' AS test_id, asked.model_version_name, CAST(asked.arm AS INTEGER) AS arm,
  CASE WHEN latest.model_uri IS NOT NULL AND sz.test_data_size IS NOT NULL THEN latest.run_id END AS run_id,
  CASE WHEN latest.model_uri IS NOT NULL THEN auc.roc_auc END AS roc_auc,
  CASE WHEN latest.model_uri IS NOT NULL THEN sz.test_data_size END AS test_data_size,
  CASE WHEN latest.run_id IS NULL THEN 'Metadata not found' WHEN latest.model_uri IS NULL THEN 'model_uri not found in metadata' END AS error
FROM asked LEFT JOIN latest USING (model_version_name) LEFT JOIN sz ON sz.arm = asked.arm LEFT JOIN auc ON auc.arm = asked.arm""")
def ab4_report(spark, sf):
    """AB4, AB5, JN1, JN2: three requested models, one of them unknown; the arms of registered models
    are scored by different formulas."""
    d = prepared(POS.tail_slice(loans_df(spark, sf), ORDER_KEY, AB_CHUNKS, 3000))
    reg = REG.latest(registry_frame(spark, sf))
    m = arm_metrics(score_arms(d, ab_scorers(len(_ASKED))))
    return ab_report(spark, m, _ASKED, reg, "t1").withColumn("roc_auc", r6("roc_auc"))


@register("rb4_skip_state", with_loans("""SELECT COUNT(*) AS rows, 0 AS changed, CAST(0.0 AS DOUBLE) AS change_pct,
  CAST(NULL AS BOOLEAN) AS passed, 'skipped_no_data_post_clean' AS status FROM loans WHERE loan_status = 'Default' AND loan_status = 'Fully Paid'"""))
def rb4_skip_state(spark, sf):
    """RB4: no row is left after cleaning (no loan of the data has the status 'Default')."""
    d = loans_df(spark, sf).filter(F.col("loan_status") == "Default").select("id", "annual_inc", "dti")
    r = R.robustness(d, lambda x: x.select("id", F.lit(0).alias("prediction")))
    return r.select("rows", F.col("changed").cast("int").alias("changed"), "change_pct", "passed", "status")
