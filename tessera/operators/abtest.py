"""A/B evaluation of model versions on hash-assigned arms (AB1-AB5, JN1, JN2).

Each row is assigned to arm ``md5(id) mod n``; arm ``i`` is scored by the i-th requested
model on its own rows only; per-arm exact AUC and sizes come from one grouped job; the
requested names are left-joined to the registry so that a missing model or URI becomes an
error row rather than a failure.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .metrics import roc_auc
from .sampling import assign_arm

Scorer = Callable[[DataFrame], DataFrame]  # frame -> frame with a ``score`` column added


def score_arms(df: DataFrame, scorers: Sequence[Scorer | None], key: str = "id") -> DataFrame:
    """AB2: arm column, then each arm scored by its own scorer (None = nothing to score with:
    the arm's rows produce no scores). Returns ``(arm, key, target, score)``."""
    arms = assign_arm(df, len(scorers), key)
    parts = []
    for i, sc in enumerate(scorers):
        if sc is None:
            continue
        parts.append(sc(arms.filter(F.col("arm") == i)).select("arm", key, "target", "score"))
    if not parts:
        return arms.select("arm", key, "target", F.lit(None).cast("double").alias("score")).limit(0)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def arm_metrics(scored: DataFrame) -> DataFrame:
    """AB3 / AGG20: per arm AUC (exact), sizes and an evaluation error text."""
    sizes = scored.groupBy("arm").agg(F.count(F.lit(1)).alias("test_data_size"))
    auc = roc_auc(scored, "target", "score", ["arm"])
    return sizes.join(auc, "arm", "left")


def isolated_metrics(df: DataFrame, scorers: Sequence[Scorer | None], names: Sequence[str], errors: dict[str, str],
                     key: str = "id") -> DataFrame:
    """AB2 / AB3 with each arm on its own: all arms in one job, and if that fails, one job per arm,
    where a scorer that fails leaves its text in ``errors`` and the other arms keep their rows. The
    result holds at most a row per arm."""
    spark = df.sparkSession

    def run(some: Sequence[Scorer | None]) -> tuple[list, object]:
        m = arm_metrics(score_arms(df, some, key))
        return m.collect(), m.schema

    try:
        rows, schema = run(scorers)
    except Exception:  # noqa: BLE001  (repeated per arm below, where the failure is recorded)
        rows, schema = [], arm_metrics(score_arms(df, [None] * len(scorers), key)).schema
        for i, sc in enumerate(scorers):
            if sc is not None:
                try:
                    rows += run([sc if j == i else None for j in range(len(scorers))])[0]
                except Exception as e:  # noqa: BLE001  (becomes this arm's error row)
                    errors[names[i]] = f"{type(e).__name__}: {e}"
    return spark.createDataFrame(rows, schema)


def requested_arms(spark: SparkSession, names: Sequence[str]) -> DataFrame:
    """JN2: model position -> requested name (a parameter list: bounded)."""
    return spark.createDataFrame([(i, n) for i, n in enumerate(names)], "arm int, model_version_name string")


def ab_report(spark: SparkSession, metrics: DataFrame, names: Sequence[str], registry: DataFrame,
              test_id: str, failures: dict[str, str] | None = None) -> DataFrame:
    """AB4 / AB5 / JN1: one row per requested model: run id, AUC, arm size, or an error.
    ``failures`` names models that could not be loaded or scored and why."""
    fails = spark.createDataFrame(list((failures or {}).items()), "model_version_name string, _failure string")
    req = requested_arms(spark, names).join(F.broadcast(fails), "model_version_name", "left")
    reg = registry.select("model_version_name", "model_uri", "run_id", F.lit(True).alias("_found"))
    # the registry grows with the number of models: its join strategy is left to the planner
    j = req.join(reg, "model_version_name", "left").join(metrics, "arm", "left")
    err = (F.when(F.col("_found").isNull(), F.lit("Metadata not found"))
           .when(F.col("model_uri").isNull(), F.lit("model_uri not found in metadata"))
           .when(F.col("_failure").isNotNull(), F.col("_failure"))
           .when(F.col("test_data_size").isNull(), F.lit("SKIPPED_EMPTY_ARM"))
           .otherwise(F.col("error")))
    ok = err.isNull()
    return j.select(F.lit(test_id).alias("test_id"), "model_version_name", "arm",
                    F.when(ok | (err == F.col("error")), F.col("run_id")).alias("run_id"),
                    F.when(ok, F.col("roc_auc")).alias("roc_auc"),
                    F.when(ok | (err == F.col("error")), F.col("test_data_size")).alias("test_data_size"),
                    err.alias("error"))
