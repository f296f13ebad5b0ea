"""Model registry and run-metric tables (REG1-REG5, SNK3, SNK5, SNK6).

Both are parquet tables of commits: a write fills a folder ``commit=<name>`` of its own and never
rewrites another commit's rows (a failed training adds a failure row instead of replacing the file). A
writer that names its commit (say, after its run) may be retried: the second write replaces the first, so the
table holds one copy. The current state is a view: the last row per name by ``max_by`` (a partial
aggregate, no sort of the table). What is last follows ``seq``, a number drawn when a commit is written and
higher than any in the table; equal numbers (writers at the same moment, tables without the column) go on
with the time, then the run, then the row's other values, so the view never depends on row order.
"""

from __future__ import annotations

import datetime as dt
import json
import re
import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

REGISTRY_SCHEMA = T.StructType([
    T.StructField("model_version_name", T.StringType(), False),
    T.StructField("model_uri", T.StringType(), True),
    T.StructField("run_id", T.StringType(), True),
    T.StructField("model_name", T.StringType(), True),
    T.StructField("numeric_features", T.ArrayType(T.StringType()), True),
    T.StructField("categorical_features", T.ArrayType(T.StringType()), True),
    T.StructField("status", T.StringType(), True),
    T.StructField("error", T.StringType(), True),
    T.StructField("input_schema", T.StringType(), True),
    T.StructField("output_schema", T.StringType(), True),
    T.StructField("input_example", T.StringType(), True),
    T.StructField("registered_at", T.TimestampType(), False),
    T.StructField("seq", T.LongType(), True),
])

RUN_METRICS_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType(), False),
    T.StructField("key", T.StringType(), False),
    T.StructField("value", T.DoubleType(), True),
    T.StructField("text", T.StringType(), True),
    T.StructField("step", T.IntegerType(), True),
    T.StructField("ts", T.TimestampType(), False),
])

MODEL_NAME = "LoanDefaultClassifier"


def new_run_id() -> str:
    return uuid.uuid4().hex


def _now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)


def _commit(df: DataFrame, path: str, commit: str | None) -> None:
    """Write one commit. A name that was used before replaces that commit's rows."""
    name = commit or uuid.uuid4().hex
    if not re.fullmatch(r"[A-Za-z0-9_.-]+", name):
        raise ValueError(f"commit name {name!r}: letters, digits, '_', '.' and '-' only")
    df.write.mode("overwrite").parquet(f"{path.rstrip('/')}/commit={name}")


def append_registry(spark: SparkSession, path: str, rows: Sequence[dict], commit: str | None = None) -> None:
    """REG2 / REG4: add registry rows (missing fields are NULL) as one commit, numbered on from the
    table's highest ``seq`` in the order given."""
    top = read_registry(spark, path).agg(F.max("seq")).first()[0] or 0
    full = []
    for i, r in enumerate(rows, 1):
        d = {f.name: r.get(f.name) for f in REGISTRY_SCHEMA.fields}
        d["registered_at"] = d["registered_at"] or _now()
        d["seq"] = top + i
        full.append(Row(**d))
    _commit(spark.createDataFrame(full, REGISTRY_SCHEMA).coalesce(1), path, commit)


def register_model(spark: SparkSession, path: str, version_name: str, model_uri: str, run_id: str,
                   numeric: Sequence[str], categorical: Sequence[str], input_schema: str | None = None,
                   input_example: str | None = None, model_name: str = MODEL_NAME, commit: str | None = None) -> None:
    append_registry(spark, path, [dict(model_version_name=version_name, model_uri=model_uri, run_id=run_id,
                                       model_name=model_name, numeric_features=list(numeric),
                                       categorical_features=list(categorical), status="REGISTERED",
                                       input_schema=input_schema, output_schema=OUTPUT_SCHEMA.json(),
                                       input_example=input_example)], commit)


def record_failure(spark: SparkSession, path: str, version_name: str, error: str, run_id: str | None = None,
                   commit: str | None = None) -> None:
    """REG4: a failed training adds a TRAINING_FAILED row for that name only."""
    append_registry(spark, path, [dict(model_version_name=version_name, run_id=run_id, status="TRAINING_FAILED",
                                       error=error)], commit)


def read_registry(spark: SparkSession, path: str) -> DataFrame:
    """REG1: the registry table; a missing table reads as empty; a corrupt file raises when read."""
    try:
        return spark.read.schema(REGISTRY_SCHEMA).parquet(path).select(*REGISTRY_SCHEMA.fieldNames())
    except AnalysisException:
        return spark.createDataFrame([], REGISTRY_SCHEMA)


def latest(registry: DataFrame) -> DataFrame:
    """REG2 view: the row written last per model version name, by ``seq``, then time, run and the other values."""
    first = [c for c in ("seq", "registered_at", "run_id") if c in registry.columns]
    order = F.struct(*first, *[c for c in registry.columns if c not in first])
    return (registry.groupBy("model_version_name").agg(F.max(order).alias("r"))
            .select(*[F.col(f"r.{c}").alias(c) for c in registry.columns]))


def validate(latest_rows: DataFrame) -> DataFrame:
    """REG3: readiness of each model: TRAINING_FAILED, INCOMPLETE (a required field missing)
    or READY."""
    incomplete = (F.col("model_uri").isNull() | F.col("run_id").isNull()
                  | (F.coalesce(F.size("numeric_features"), F.lit(0)) <= 0)
                  | (F.coalesce(F.size("categorical_features"), F.lit(0)) <= 0))
    st = (F.when(F.col("status") == "TRAINING_FAILED", F.lit("TRAINING_FAILED"))
          .when(incomplete, F.lit("INCOMPLETE")).otherwise(F.lit("READY")))
    return latest_rows.withColumn("readiness", st)


def versions(registry: DataFrame) -> DataFrame:
    """REG5: version numbers 1, 2, ... per registered model name in registration order, by the
    distributed row index (one name may hold the whole registry)."""
    from ..operators.prefix import row_index
    ok = registry.filter(F.col("status") == "REGISTERED").select("model_name", "model_version_name", "run_id", "registered_at")
    ix = row_index(ok, ["registered_at", "run_id"], ["model_name"], small_groups=False)
    return ix.select("model_name", "model_version_name", "run_id", (F.col("row_idx") + 1).cast("int").alias("version"))


def log_run(spark: SparkSession, path: str, run_id: str, metrics: dict[str, float] | None = None,
            params: dict[str, object] | None = None, step: int = 0, commit: str | None = None) -> None:
    """SNK3: add run metrics (numeric) and parameters (text) as long key/value rows, one commit."""
    ts = _now()
    rows = [Row(run_id=run_id, key=k, value=float(v) if v is not None else None, text=None, step=step, ts=ts)
            for k, v in (metrics or {}).items()]
    rows += [Row(run_id=run_id, key=k, value=None, text=str(v), step=step, ts=ts) for k, v in (params or {}).items()]
    if rows:
        _commit(spark.createDataFrame(rows, RUN_METRICS_SCHEMA).coalesce(1), path, commit)


def append_run_rows(df: DataFrame, path: str, step: int = 0, commit: str | None = None) -> None:
    """SNK3 for metric rows computed by a job ``(run_id, key, value, text)``: written by the
    executors, nothing passes through the driver. A job that names its commit leaves one copy when it is retried."""
    out = df.select("run_id", "key", F.col("value").cast("double"), F.col("text").cast("string"),
              F.lit(step).alias("step"), F.current_timestamp().cast("timestamp").alias("ts"))
    _commit(out, path, commit)


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    try:
        return spark.read.schema(RUN_METRICS_SCHEMA).parquet(path).select(*RUN_METRICS_SCHEMA.fieldNames())
    except AnalysisException:
        return spark.createDataFrame([], RUN_METRICS_SCHEMA)


#: SNK6: what a registered model returns for each input row.
OUTPUT_SCHEMA = T.StructType([T.StructField("prediction", T.IntegerType()), T.StructField("score", T.DoubleType())])


def input_signature(df: DataFrame, features: Sequence[str], order_by: Sequence[str], n: int = 5) -> tuple[str, str]:
    """SNK6: schema of the model input (JSON) and a 5-row input example (first rows by key)."""
    sel = df.select(*features)
    example = df.orderBy(*order_by).limit(n).select(F.to_json(F.struct(*features)).alias("j"))
    return sel.schema.json(), json.dumps([json.loads(r["j"]) for r in example.collect()])
