"""Histograms and peak counting (AGG21-AGG24, WIN1).

Bin numbers are computed per row by arithmetic (no sort, no range join), counted by a
partial + final hash aggregate, and completed with the empty bins from a generated bin
sequence (bins x groups rows: bounded by the parameters, never by the data).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


BROADCAST_GROUPS = 100_000


def bin_index(x: Column, lo: Column, hi: Column, bins: int) -> Column:
    """Bin of ``x`` for ``bins`` equal bins over [lo, hi], the last bin closed; NULL outside.

    Same rule as NumPy's histogram: index from ``(x - lo) * bins / (hi - lo)``, then corrected
    against the actual edges ``lo + i * (hi - lo) / bins`` so values on an edge land right."""
    step = (hi - lo) / F.lit(float(bins))
    norm = F.lit(float(bins)) / (hi - lo)
    raw = F.floor((x - lo) * norm).cast("int")
    b0 = F.when(raw == bins, F.lit(bins - 1)).otherwise(raw)
    edge = lambda i: lo + i.cast("double") * step
    b1 = F.when(x < edge(b0), b0 - 1).otherwise(b0)
    b2 = F.when((x >= edge(b1 + 1)) & (b1 != bins - 1), b1 + 1).otherwise(b1)
    inside = (x >= lo) & (x <= hi) & (hi > lo)
    return F.when(inside, b2)


def histogram(df: DataFrame, col: str, lo: float, hi: float, bins: int) -> DataFrame:
    """AGG21: counts in ``bins`` fixed bins over [lo, hi]; outside values dropped; empty bins 0."""
    x = F.col(col).cast("double")
    counts = (df.select(bin_index(x, F.lit(float(lo)), F.lit(float(hi)), bins).alias("bin"))
              .filter(F.col("bin").isNotNull())
              .groupBy("bin").agg(F.count(F.lit(1)).alias("count")))
    step = (float(hi) - float(lo)) / bins
    allb = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return (allb.join(F.broadcast(counts), "bin", "left")
            .select("bin", (F.lit(float(lo)) + F.col("bin") * F.lit(step)).alias("lo"),
                    (F.lit(float(lo)) + (F.col("bin") + 1) * F.lit(step)).alias("hi"),
                    F.coalesce(F.col("count"), F.lit(0)).cast("bigint").alias("count")))


def grouped_histogram(df: DataFrame, col: str, bins: int, by: Sequence[str] = ()) -> DataFrame:
    """AGG22 / AGG23: ``bins`` bins over each group's own [min, max] (two passes: ranges, then
    counts). The range table has a row per group: it is broadcast when its counted size is at most
    ``BROADCAST_GROUPS``, so a few hot groups never shuffle the table; with more groups the planner
    joins. A NULL group is a group like any other."""
    by = list(by)
    x = F.col(col).cast("double")
    vals = df.select(*by, x.alias("_x")).filter(F.col("_x").isNotNull() & ~F.isnan("_x"))
    rng = vals.groupBy(*by).agg(F.min("_x").alias("lo"), F.max("_x").alias("hi"))
    if by:
        few = rng.limit(BROADCAST_GROUPS + 1).count() <= BROADCAST_GROUPS
        side = rng.select(*[F.col(c).alias(f"_r_{c}") for c in by], "lo", "hi")
        j = vals.join(F.broadcast(side) if few else side, _same(by, "_r_"))
    else:  # global range: two scalar subqueries, no join
        j = vals.withColumn("lo", vals.select(F.min("_x")).scalar()).withColumn(
            "hi", vals.select(F.max("_x")).scalar())
    counts = (j.select(*by, bin_index(F.col("_x"), F.col("lo"), F.col("hi"), bins).alias("bin"),
                       F.when(F.col("hi") == F.col("lo"), F.lit(True)).alias("_flat"))
              .select(*by, F.when(F.col("_flat"), F.lit(bins // 2)).otherwise(F.col("bin")).alias("bin"))
              .groupBy(*by, "bin").agg(F.count(F.lit(1)).alias("count")))
    dense = rng.select(*by, "lo", "hi", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    step = (F.col("hi") - F.col("lo")) / F.lit(float(bins))
    counts = counts.select(*[F.col(c).alias(f"_c_{c}") for c in (*by, "bin")], "count")
    return (dense.join(counts, _same([*by, "bin"], "_c_"), "left")
            .select(*by, "bin", (F.col("lo") + F.col("bin") * step).alias("lo"),
                    (F.col("lo") + (F.col("bin") + 1) * step).alias("hi"),
                    F.coalesce(F.col("count"), F.lit(0)).cast("bigint").alias("count")))


def _same(cols: Sequence[str], prefix: str) -> Column:
    """Null-safe equality of the columns and their prefixed twins."""
    on = F.lit(True)
    for c in cols:
        on = on & F.col(c).eqNullSafe(F.col(f"{prefix}{c}"))
    return on


def count_peaks(hist: DataFrame, by: Sequence[str] = (), bin_col: str = "bin",
                count_col: str = "count") -> DataFrame:
    """WIN1: strict interior local maxima of each histogram (first and last bins never count).
    The window is partitioned by histogram; a histogram has ``bins`` rows."""
    by = list(by)
    w = Window.partitionBy(*by).orderBy(bin_col)
    c = F.col(count_col)
    peak = (c > F.lag(c).over(w)) & (c > F.lead(c).over(w))
    flagged = hist.select(*by, F.coalesce(peak, F.lit(False)).alias("_peak"))
    return flagged.groupBy(*by).agg(F.count_if("_peak").cast("bigint").alias("peaks"))


def overlay_histograms(df: DataFrame, value_col: str, split_col: str, bins: int,
                       min_rows: int = 10) -> DataFrame:
    """AGG24: histograms of ``value_col`` for rows with / without ``split_col``; the second
    population is only drawn when it has more than ``min_rows`` rows."""
    pop = F.when(F.col(split_col).isNull(), F.lit("missing")).otherwise(F.lit("present"))
    tagged = df.select(pop.alias("population"), F.col(value_col))
    h = grouped_histogram(tagged, value_col, bins, ["population"])
    sizes = tagged.groupBy("population").agg(F.count(F.lit(1)).alias("_rows"))
    keep = sizes.filter((F.col("population") == "present") | (F.col("_rows") > min_rows))
    return h.join(keep.select("population"), "population", "left_semi")
