"""Structured Streaming versions of the checks (ST1, ST2).

ST1: the chunked status/rate accumulators of the validator become a streaming aggregation
(state = one row per status), drained with ``trigger(availableNow=True)``.
ST2: a drift monitor: per tumbling event-time window, value histograms (state = windows x bins,
bounded by the watermark) compared with a static reference histogram by a binned K-S
statistic. Sinks are ``foreachBatch`` writers into parquet tables.

Streams resume: offsets and state live in ``spark.checkpoint.dir`` under the job's name (default: a name made
from the output path), so the next call reads only what has arrived since. Sinks are idempotent by batch: a
batch that is run again after a failure replaces its own rows. Whoever deletes an output must give the next
job another name, or the rows drained before are not there.
"""

from __future__ import annotations

import hashlib

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.histogram import bin_index
from ..session import checkpoint_dir


def job_folder(spark: SparkSession, kind: str, out_path: str, job: str | None) -> str:
    """Folder of a job's offsets and state. The setting itself is used: the session's own checkpoint
    folder below it has a random name."""
    private = checkpoint_dir(spark)
    base = spark.conf.get("spark.checkpoint.dir", None) or private
    return f"{base.rstrip('/')}/stream-{kind}-{job or hashlib.sha256(out_path.encode()).hexdigest()[:32]}"


def _drain(agg: DataFrame, mode: str, write, folder: str) -> dict[str, int]:
    """Run a stream over all that is available. Returns the rows read by this call and the late groups: rows of the
    partial aggregation that came after their window was closed."""
    q = (agg.writeStream.outputMode(mode).foreachBatch(write)
         .option("checkpointLocation", folder).trigger(availableNow=True).start())
    seen = {}
    done = False
    while not done:
        done = q.awaitTermination(1)
        seen |= {p.batchId: p for p in q.recentProgress}
    return {"rows_read": sum(p.numInputRows for p in seen.values()),
            "late_groups": sum(s.numRowsDroppedByWatermark for p in seen.values() for s in p.stateOperators)}


def _batch_writer(out_path: str, change=lambda batch: batch):
    """Writes each batch to a folder of its own, which a second run of the batch replaces. The batch is kept while
    it is written: ``change`` may read it more than once, and each reading would run the stream's state again."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            change(batch).write.mode("overwrite").parquet(f"{out_path.rstrip('/')}/batch_id={batch_id}")
        finally:
            batch.unpersist()
    return write


def read_stream(spark: SparkSession, path: str, schema: T.StructType, max_files: int | None = None) -> DataFrame:
    """File stream over a directory, or over one file / glob inside a directory."""
    r = spark.readStream.schema(schema)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    p = path.rstrip("/")
    if p.endswith(".parquet") and not any(ch in p for ch in "*?[{"):
        parent, name = p.rsplit("/", 1)
        p = f"{parent}/{{{name}}}"  # a one-file glob: the file source then lists it, not its parent
        r = r.option("basePath", parent)
    return r.parquet(p)


# --- ST1 ----------------------------------------------------------------------------------------

def quality_accumulators(stream: DataFrame, status_col: str, value_col: str | Column) -> DataFrame:
    """Running counts per status with the min / max / null count of the value (complete mode)."""
    v = F.col(value_col) if isinstance(value_col, str) else value_col
    return stream.groupBy(F.col(status_col).alias("status")).agg(
        F.count(F.lit(1)).alias("rows"), F.min(v).alias("min_value"), F.max(v).alias("max_value"),
        F.count_if(v.isNull()).alias("null_values"))


def drain_complete(agg: DataFrame, out_path: str, job: str | None = None) -> dict[str, int]:
    """Run a complete-mode aggregation over everything that is new and keep the last snapshot
    (each batch overwrites the table with the full state, so a retried batch is harmless)."""
    def write(batch: DataFrame, _batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(out_path)

    return _drain(agg, "complete", write, job_folder(agg.sparkSession, "st1", out_path, job))


def incremental_quality(spark: SparkSession, source: str, schema: T.StructType, status_col: str,
                        value_col: str, out_path: str, job: str | None = None) -> DataFrame:
    """ST1 end to end: stream what is new in the source, drain, return the accumulated table."""
    drain_complete(quality_accumulators(read_stream(spark, source, schema), status_col, value_col), out_path, job)
    return spark.read.parquet(out_path)


# --- ST2 ----------------------------------------------------------------------------------------

def window_bin_counts(stream: DataFrame, ts_col: str, value_col: str, lo: float, hi: float, bins: int,
                      window: str = "1 day", watermark: str = "1 day") -> DataFrame:
    """Histogram counts per tumbling event-time window; late rows beyond the watermark are
    dropped and finished windows leave the state."""
    b = bin_index(F.col(value_col).cast("double"), F.lit(float(lo)), F.lit(float(hi)), bins)
    # event time must be TIMESTAMP for watermarks; a wall-clock (NTZ) time is taken as UTC, so
    # windows align with its calendar days whatever the session time zone is
    if isinstance(stream.schema[ts_col].dataType, T.TimestampNTZType):
        tz = stream.sparkSession.conf.get("spark.sql.session.timeZone")
        stream = stream.withColumn(ts_col, F.from_utc_timestamp(F.col(ts_col).cast("timestamp"), tz))
    return (stream.withWatermark(ts_col, watermark)
            .select(F.window(ts_col, window).alias("w"), b.alias("bin"))
            .filter(F.col("bin").isNotNull())
            .groupBy("w", "bin").agg(F.count(F.lit(1)).alias("count"))
            .select(F.col("w.start").alias("window_start"), "bin", "count"))


def window_day(window_start: str = "window_start") -> Column:
    """'yyyy-MM-dd' of a UTC-aligned day window, independent of the session time zone."""
    days = F.floor(F.unix_timestamp(F.col(window_start)) / F.lit(86400)).cast("int")
    return F.date_add(F.lit("1970-01-01").cast("date"), days).cast("string")


def drain_updates(agg: DataFrame, out_path: str, job: str | None = None) -> dict[str, int]:
    """Update-mode drain: every micro-batch adds the changed (key, count) rows under its
    batch id; the newest row per key is the final count (``latest_updates``)."""
    return _drain(agg, "update", _batch_writer(out_path), job_folder(agg.sparkSession, "st2", out_path, job))


def latest_updates(spark: SparkSession, path: str, keys: list[str], value: str = "count") -> DataFrame:
    t = spark.read.parquet(path)
    return t.groupBy(*keys).agg(F.max_by(value, "batch_id").alias(value))


def reference_histogram(df: DataFrame, value_col: str, lo: float, hi: float, bins: int) -> DataFrame:
    """Static reference counts per bin (batch)."""
    b = bin_index(F.col(value_col).cast("double"), F.lit(float(lo)), F.lit(float(hi)), bins)
    return df.select(b.alias("bin")).filter(F.col("bin").isNotNull()).groupBy("bin").agg(
        F.count(F.lit(1)).alias("ref_count"))


def binned_ks(window_counts: DataFrame, ref_counts: DataFrame, bins: int) -> DataFrame:
    """Per window: rows and max |F_ref(bin) - F_window(bin)| over the cumulative bin shares.
    Windows x bins rows; the window is partitioned by window (``bins`` rows each) and the
    reference (``bins`` rows) is broadcast."""
    spark = window_counts.sparkSession
    allb = spark.range(bins).select(F.col("id").cast("int").alias("bin"))
    ref = allb.join(F.broadcast(ref_counts), "bin", "left").select("bin", F.coalesce("ref_count", F.lit(0)).alias("rc"))
    wins = window_counts.select("window_start").distinct()
    dense = (wins.select("window_start", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
             .join(window_counts, ["window_start", "bin"], "left")
             .join(F.broadcast(ref), "bin")
             .select("window_start", "bin", F.coalesce("count", F.lit(0)).alias("c"), "rc"))
    w = Window.partitionBy("window_start").orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    wa = Window.partitionBy("window_start")
    cum = dense.select("window_start", "bin",
                       F.sum("c").over(w).alias("cc"), F.sum("c").over(wa).alias("n"),
                       F.sum("rc").over(w).alias("cr"), F.sum("rc").over(wa).alias("nr"))
    gap = F.abs(F.try_divide(F.col("cc").cast("double"), F.col("n").cast("double"))
                - F.try_divide(F.col("cr").cast("double"), F.col("nr").cast("double")))
    return cum.groupBy("window_start").agg(F.max("n").cast("bigint").alias("rows"), F.max(gap).alias("ks_binned"))


def windowed_drift(spark: SparkSession, source: str, schema: T.StructType, ts_col: str, value_col: str,
                   reference: DataFrame, lo: float, hi: float, bins: int, out_path: str,
                   window: str = "1 day", watermark: str = "1 day") -> DataFrame:
    """ST2 end to end: stream windowed histograms, drain, compare every window with the
    reference histogram."""
    agg = window_bin_counts(read_stream(spark, source, schema), ts_col, value_col, lo, hi, bins, window, watermark)
    drain_updates(agg, out_path)
    counts = latest_updates(spark, out_path, ["window_start", "bin"])
    return binned_ks(counts, reference_histogram(reference, value_col, lo, hi, bins), bins)


CLOSED_SCHEMA = T.StructType().add("window_start", T.TimestampType()).add("rows", T.LongType()).add("ks_binned", T.DoubleType())


def closed_window_drift(spark: SparkSession, source: str, schema: T.StructType, ts_col: str, value_col: str,
                        reference: DataFrame, lo: float, hi: float, bins: int, out_path: str, window: str = "1 day",
                        watermark: str = "1 day", max_files: int | None = None,
                        job: str | None = None) -> tuple[DataFrame, dict[str, int]]:
    """ST2 in append mode: a window is compared with the reference once, in the batch in which the watermark passes
    its end, and then leaves the state; its row is final. Windows still open stay in the state for the next call. Rows
    that come after their window was closed change nothing; they are reported as ``late_groups``, the number of
    (window, bin) groups they form per task of a batch (at most the number of late rows, 0 only without any).
    Returns the table of all windows closed so far by this job and the figures of this call."""
    ref = reference_histogram(reference, value_col, lo, hi, bins)
    agg = window_bin_counts(read_stream(spark, source, schema, max_files), ts_col, value_col, lo, hi, bins, window, watermark)
    figures = _drain(agg, "append", _batch_writer(out_path, lambda batch: binned_ks(batch, ref, bins)),
                     job_folder(spark, "st2-closed", out_path, job))
    try:
        closed = spark.read.schema(CLOSED_SCHEMA).parquet(out_path).select(*CLOSED_SCHEMA.fieldNames())
    except AnalysisException:  # nothing has ever been drained
        closed = spark.createDataFrame([], CLOSED_SCHEMA)
    return closed, figures
