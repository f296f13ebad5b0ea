"""Report sinks (SNK1, SNK2, SNK4)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.checks import failed_row


def write_report(report: DataFrame, path: str, fmt: str = "json") -> None:
    """SNK1: write report rows (a few rows: one file) as JSON lines or parquet. The exchange
    keeps the stage that makes the rows parallel."""
    w = report.repartition(1).write.mode("overwrite")
    (w.json(path) if fmt == "json" else w.parquet(path))


def report_document(report: DataFrame, **labels: str) -> DataFrame:
    """SNK1: the whole report as one JSON document (``{labels..., "checks": [...]}``)."""
    doc = report.agg(F.collect_list(F.struct(*report.columns)).alias("checks"))
    for k, v in labels.items():
        doc = doc.withColumn(k, F.lit(v))
    return doc.select(F.to_json(F.struct(*[F.col(k) for k in labels], F.col("checks"))).alias("document"))


def error_report(spark: SparkSession, error: BaseException, check: str = "Script") -> DataFrame:
    """SNK2: fallback report when a job crashes: one failed row with status SCRIPT_ERROR."""
    return failed_row(spark, check, f"SCRIPT_ERROR: {type(error).__name__}: {error}")


def text_report(report: DataFrame, name_col: str = "class") -> str:
    """SNK4: fixed-width text rendering of a classification report (display only)."""
    lines = [f"{'':>14} {'precision':>10} {'recall':>10} {'f1-score':>10} {'support':>10}"]
    for r in report.collect():
        p = "" if r["precision"] is None else f"{r['precision']:.2f}"
        rc = "" if r["recall"] is None else f"{r['recall']:.2f}"
        lines.append(f"{r[name_col]:>14} {p:>10} {rc:>10} {r['f1_score']:>10.2f} {r['support']:>10d}")
    return "\n".join(lines)
