"""Queries: Structured Streaming monitors over ``events`` (ST1, ST2), drained and compared
with their batch twins. ``event_type`` plays the loan status and ``value`` the rate."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..session import checkpoint_dir
from ..sources.tables import read_table
from ..streaming import monitors as S
from .catalog import r6, register

LO, HI, BINS = 0.0, 500.0, 20
REFERENCE_END = "2024-01-08"
SECOND_PART, LATE_BEFORE = "2024-01-16", "2024-01-08"


def _scratch(spark, name):
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:8]}"


@register("st1_incremental_quality", """SELECT event_type AS status, COUNT(*) AS rows, MIN(value) AS min_value,
  MAX(value) AS max_value, COUNT(*) FILTER (WHERE value IS NULL) AS null_values FROM events GROUP BY 1""")
def st1_incremental_quality(spark, sf):
    path = f"{sf.rstrip('/')}/events.parquet"
    schema = read_table(spark, sf, "events").schema
    return S.incremental_quality(spark, path, schema, "event_type", "value", _scratch(spark, "st1"))


def _bin_sql(x: str) -> str:
    from .q_profile import _hist_bin_sql
    return _hist_bin_sql(x, f"CAST({LO!r} AS DOUBLE)", f"CAST({HI!r} AS DOUBLE)", BINS)


@register("st2_windowed_binned_drift", f"""WITH ev AS (SELECT ts, {_bin_sql('value')} AS bin FROM events),
ref AS (SELECT bin, COUNT(*) AS rc FROM ev WHERE ts < TIMESTAMP '{REFERENCE_END}' AND bin IS NOT NULL GROUP BY bin),
cur AS (SELECT date_trunc('day', ts) AS day, bin, COUNT(*) AS c FROM ev WHERE bin IS NOT NULL GROUP BY 1, 2),
dense AS (SELECT d.day, g.bin, COALESCE(cur.c, 0) AS c, COALESCE(ref.rc, 0) AS rc
  FROM (SELECT DISTINCT day FROM cur) d CROSS JOIN range({BINS}) g(bin)
  LEFT JOIN cur ON cur.day = d.day AND cur.bin = g.bin LEFT JOIN ref ON ref.bin = g.bin),
cum AS (SELECT day, SUM(c) OVER (PARTITION BY day ORDER BY bin ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cc,
  SUM(c) OVER (PARTITION BY day) AS n,
  SUM(rc) OVER (PARTITION BY day ORDER BY bin ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cr,
  SUM(rc) OVER (PARTITION BY day) AS nr FROM dense)
SELECT strftime(day, '%Y-%m-%d') AS window_day, CAST(MAX(n) AS BIGINT) AS rows,
  ROUND(MAX(ABS(CAST(cc AS DOUBLE) / CAST(n AS DOUBLE) - CAST(cr AS DOUBLE) / CAST(nr AS DOUBLE))), 6) AS ks_binned
FROM cum GROUP BY day""")
def st2_windowed_binned_drift(spark, sf):
    path = f"{sf.rstrip('/')}/events.parquet"
    ev = read_table(spark, sf, "events")
    ref = ev.filter(F.col("ts") < F.lit(REFERENCE_END).cast(ev.schema["ts"].dataType))
    out = S.windowed_drift(spark, path, ev.schema, "ts", "value", ref, LO, HI, BINS, _scratch(spark, "st2"))
    return out.select(S.window_day().alias("window_day"), "rows", r6("ks_binned").alias("ks_binned"))


@register("st2_closed_windows", f"""WITH part AS (SELECT ts, {_bin_sql('value')} AS bin, ts < TIMESTAMP '{LATE_BEFORE}' AND event_id % 20 = 0 AS late FROM events),
lim AS (SELECT MAX(ts) FILTER (WHERE NOT late) - INTERVAL 1 DAY AS watermark FROM part WHERE NOT late),
ref AS (SELECT bin, COUNT(*) AS rc FROM part WHERE ts < TIMESTAMP '{REFERENCE_END}' AND bin IS NOT NULL GROUP BY bin),
cur AS (SELECT date_trunc('day', ts) AS day, bin, COUNT(*) AS c FROM part, lim WHERE bin IS NOT NULL AND NOT late
  AND date_trunc('day', ts) + INTERVAL 1 DAY <= watermark GROUP BY 1, 2),
dense AS (SELECT d.day, g.bin, COALESCE(cur.c, 0) AS c, COALESCE(ref.rc, 0) AS rc
  FROM (SELECT DISTINCT day FROM cur) d CROSS JOIN range({BINS}) g(bin)
  LEFT JOIN cur ON cur.day = d.day AND cur.bin = g.bin LEFT JOIN ref ON ref.bin = g.bin),
cum AS (SELECT day, SUM(c) OVER (PARTITION BY day ORDER BY bin ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cc,
  SUM(c) OVER (PARTITION BY day) AS n,
  SUM(rc) OVER (PARTITION BY day ORDER BY bin ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cr,
  SUM(rc) OVER (PARTITION BY day) AS nr FROM dense)
SELECT strftime(day, '%Y-%m-%d') AS window_day, CAST(MAX(n) AS BIGINT) AS rows,
  ROUND(MAX(ABS(CAST(cc AS DOUBLE) / CAST(n AS DOUBLE) - CAST(cr AS DOUBLE) / CAST(nr AS DOUBLE))), 6) AS ks_binned,
  (SELECT COUNT(*) > 0 FROM part WHERE late AND bin IS NOT NULL) AS late_reported
FROM cum GROUP BY day""")
def st2_closed_windows(spark, sf):
    """ST2: events arrive in three parts, the last of which is a share of the first week, delivered when its windows
    are closed. The job drains part by part and resumes each time; closed windows are final, late rows are reported."""
    ev = read_table(spark, sf, "events")
    as_ts = ev.schema["ts"].dataType
    late = (F.col("ts") < F.lit(LATE_BEFORE).cast(as_ts)) & (F.col("event_id") % 20 == 0)
    second = F.col("ts") >= F.lit(SECOND_PART).cast(as_ts)
    ref = ev.filter(F.col("ts") < F.lit(REFERENCE_END).cast(as_ts))
    source, out = _scratch(spark, "st2-in"), _scratch(spark, "st2-closed")
    late_groups = 0
    for part in (ev.filter(~late & ~second), ev.filter(~late & second), ev.filter(late)):
        part.write.mode("append").parquet(source)
        closed, figures = S.closed_window_drift(spark, source, ev.schema, "ts", "value", ref, LO, HI, BINS, out)
        late_groups += figures["late_groups"]
    return closed.select(S.window_day().alias("window_day"), "rows", r6("ks_binned").alias("ks_binned"),
                         F.lit(late_groups > 0).alias("late_reported"))
