"""Profiling aggregations (AGG1-AGG20, AGG13 exact percentiles, TH1-TH3).

Every operator is one aggregation over the scan (partial aggregation before any shuffle);
several statistics of several columns share one ``agg`` and are turned into long rows with
``stack`` afterwards, instead of one job per column.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.misc import pct
from .quantiles import exact_percentiles

_FLOATS = (T.DoubleType, T.FloatType)
_NUMERIC = (T.DoubleType, T.FloatType, T.IntegerType, T.LongType, T.ShortType, T.ByteType, T.DecimalType)


def is_missing(df: DataFrame, name: str) -> Column:
    """NULL, and NaN for floating columns: both are 'missing' (one null concept)."""
    c = F.col(name)
    if isinstance(df.schema[name].dataType, _FLOATS):
        return c.isNull() | F.isnan(c)
    return c.isNull()


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, _NUMERIC)]


def _stack(names: Sequence[str], per_name: Sequence[str], key: str = "column") -> str:
    """``stack`` expression turning one wide row of ``<name>__<stat>`` columns into long rows."""
    parts = []
    for n in names:
        parts.append(f"'{n}'")
        parts.extend(f"`{n}__{s}`" for s in per_name)
    return f"stack({len(names)}, {', '.join(parts)}) as ({key}, {', '.join(per_name)})"


def shape(df: DataFrame) -> DataFrame:
    """AGG1: row and column count."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_cols", F.lit(len(df.columns)))


def null_counts(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """AGG2 / AGG3 / AGG4 / TH3: missing count and percent of each column, in one pass."""
    cols = list(cols or df.columns)
    aggs = [F.count(F.lit(1)).alias("_n")]
    for c in cols:
        aggs.append(F.count_if(is_missing(df, c)).alias(f"{c}__null_count"))
    wide = df.agg(*aggs)
    long = wide.selectExpr("_n", _stack(cols, ["null_count"]))
    return long.select("column", "null_count",
                       pct(F.col("null_count"), F.col("_n")).alias("null_pct"))


def column_info(df: DataFrame) -> DataFrame:
    """AGG6: column, type name and non-null count (schema rows joined to one count pass)."""
    cols = df.columns
    wide = df.agg(*[F.count_if(~is_missing(df, c)).alias(f"{c}__non_null") for c in cols])
    long = wide.selectExpr(_stack(cols, ["non_null"]))
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    type_col = F.create_map(*[x for c in cols for x in (F.lit(c), F.lit(types[c]))])
    return long.select(F.col("column"), type_col[F.col("column")].alias("dtype"), F.col("non_null"))


#: Repeated digests that are broadcast at most (16 bytes each).
MAX_REPEATED = 500_000


def _digest(df: DataFrame, cols: Sequence[str]) -> list[Column]:
    """128 bits of a row. Equal rows have equal digests: 0.0 and -0.0 and all NaNs count as equal, and a bit
    for each column tells a NULL from a skipped value."""
    values = []
    for c in cols:
        x = F.col(c)
        if isinstance(df.schema[c].dataType, _FLOATS):
            x = F.when(x == 0, F.lit(0.0)).when(F.isnan(x), F.lit(float("nan"))).otherwise(x)
        values.append(x)
    nulls = F.concat(*[F.when(F.col(c).isNull(), "1").otherwise("0") for c in cols])
    return [F.xxhash64(nulls, *values).alias("_d1"), F.xxhash64(F.lit(0x5DEECE66D), nulls, *values).alias("_d2")]


def duplicate_count(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """AGG5: number of rows that repeat an earlier row (NULLs compare equal, as in pandas).

    Rows are counted by a 128-bit digest first, so 16 bytes per distinct row are shuffled (partial
    aggregation collapses copies before that). Only rows whose digest repeats are grouped by their
    values, which makes the count exact. Their digests are broadcast while there are at most
    ``MAX_REPEATED``, else joined by a shuffle."""
    cols = list(cols or df.columns)
    tagged = df.select(*cols, *_digest(df, cols))
    again = tagged.groupBy("_d1", "_d2").agg(F.count(F.lit(1)).alias("_c")).where("_c > 1").select("_d1", "_d2")
    repeated = again.count()
    if not repeated:
        return df.sparkSession.createDataFrame([(0,)], "duplicate_rows bigint")
    rows = tagged.join(F.broadcast(again) if repeated <= MAX_REPEATED else again, ["_d1", "_d2"], "left_semi")
    g = rows.groupBy(*cols).agg(F.count(F.lit(1)).alias("_c"))
    return g.agg(F.coalesce(F.sum(F.col("_c") - 1), F.lit(0)).cast("bigint").alias("duplicate_rows"))


def value_counts(df: DataFrame, col: str, dropna: bool = True, normalize: bool = False) -> DataFrame:
    """AGG8 / AGG9 / AGG10: counts per value, NULL excluded or kept; optional share of total."""
    src = df.filter(F.col(col).isNotNull()) if dropna else df
    out = src.groupBy(col).agg(F.count(F.lit(1)).alias("count"))
    if normalize:
        total = src.select(F.count(F.lit(1))).scalar()
        out = out.withColumn("share", F.col("count") / total)
    return out


def ranked_value_counts(df: DataFrame, col: str) -> DataFrame:
    """AGG9 + ORD1: value counts (NULL kept) sorted by count descending, value as tie-break."""
    return value_counts(df, col, dropna=False).orderBy(F.desc("count"), F.asc_nulls_first(col))


def range_counts(df: DataFrame, col: str, lo: float, hi: float, normal_lo: float,
                 normal_hi: float) -> DataFrame:
    """AGG14: below / above / within counts and percents over the non-null values, plus the
    missing count over all rows, in one aggregation; NaN is missing."""
    x = F.nanvl(F.col(col).cast("double"), F.lit(None).cast("double"))
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count(x).alias("n_valid"),
        F.count_if(x.isNull()).alias("missing"),
        F.count_if(x < lo).alias("below"),
        F.count_if(x > hi).alias("above"),
        F.count_if(x.between(normal_lo, normal_hi)).alias("within"),
    ).select(
        "n_rows", "n_valid", "missing", "below", "above", "within",
        pct(F.col("missing"), F.col("n_rows")).alias("missing_pct"),
        pct(F.col("below"), F.col("n_valid")).alias("below_pct"),
        pct(F.col("above"), F.col("n_valid")).alias("above_pct"),
        pct(F.col("within"), F.col("n_valid")).alias("within_pct"),
    )


def min_max(df: DataFrame, col: str) -> DataFrame:
    """AGG12: global min and max (NULLs skipped)."""
    return df.agg(F.min(col).alias("min_value"), F.max(col).alias("max_value"))


def grouped_stats(df: DataFrame, by: str, col: str) -> DataFrame:
    """AGG15: count (non-null), mean, sample std, min, max of ``col`` per group."""
    x = F.col(col)
    return df.groupBy(by).agg(F.count(x).alias("count"), F.avg(x).alias("mean"),
                              F.stddev_samp(x).alias("std"), F.min(x).alias("min"),
                              F.max(x).alias("max"))


def conditional_means(df: DataFrame, cond_col: str, value_col: str) -> DataFrame:
    """AGG16: mean of ``value_col`` for rows with and without ``cond_col``."""
    return df.groupBy(F.col(cond_col).isNull().alias(f"{cond_col}_missing")).agg(
        F.avg(value_col).alias(f"mean_{value_col}"), F.count(F.lit(1)).alias("rows"))


def unpivot_numeric(df: DataFrame, cols: Sequence[str], key: str = "feature",
                    value: str = "x") -> DataFrame:
    """Long (feature, x) rows of the given columns as double, NULL/NaN dropped, -0.0 folded."""
    casted = df.select(*[F.col(c).cast("double").alias(c) for c in cols])
    long = casted.unpivot([], list(cols), key, value)
    return long.filter(F.col(value).isNotNull() & ~F.isnan(F.col(value))).withColumn(
        value, F.col(value) + F.lit(0.0))


def percentiles(df: DataFrame, cols: Sequence[str], qs: Sequence[float], exact: bool = True,
                accuracy: int = 10000) -> DataFrame:
    """AGG13: percentiles of several columns, linear interpolation between order statistics.

    ``exact=True`` narrows brackets by counting (``quantiles``): two passes over the needed columns for most
    tables, no shuffle and no copy of the values; a column without values has no row.
    ``exact=False`` uses ``percentile_approx`` (bounded memory sketch)."""
    if not exact:
        long = unpivot_numeric(df, cols)
        return (long.groupBy("feature")
                .agg(F.percentile_approx("x", list(qs), accuracy).alias("v"))
                .select("feature", F.posexplode("v").alias("i", "value"))
                .select("feature", F.element_at(F.array(*[F.lit(float(q)) for q in qs]), F.col("i") + 1)
                        .alias("q"), "value"))
    found, _ = exact_percentiles(df.select(*cols), {c: F.col(c) for c in cols}, [float(q) for q in qs])
    return df.sparkSession.createDataFrame([(c, q, v) for (c, q), v in found.items()], "feature string, q double, value double")


def grouped_percentiles(df: DataFrame, by: str, groups: Sequence, cols: Sequence[str], qs: Sequence[float]) -> DataFrame:
    """Exact percentiles of several columns within each of the named values of ``by`` (AGG13 per group), with
    the passes of one: a group's values are a column of their own."""
    columns = {(g, c): F.when(F.col(by).eqNullSafe(F.lit(g)), F.col(c)) for g in groups for c in cols}
    found, _ = exact_percentiles(df.select(by, *cols), columns, [float(q) for q in qs])
    kind = df.schema[by].dataType.simpleString()
    return df.sparkSession.createDataFrame([(g, c, q, v) for ((g, c), q), v in found.items()],
                                           f"{by} {kind}, feature string, q double, value double")


def describe(df: DataFrame, cols: Sequence[str] | None = None, exact: bool = True) -> DataFrame:
    """AGG7: count, mean, std, min, 25/50/75 %, max per numeric column (long rows).

    Count, mean, std, min and max share the first pass of the exact quartiles."""
    cols = list(cols or numeric_columns(df))
    stats = ["count", "mean", "std", "min", "max"]
    aggs = []
    for c in cols:
        x = F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double"))
        aggs += [F.count(x).cast("double").alias(f"{c}__count"), F.avg(x).alias(f"{c}__mean"),
                 F.stddev_samp(x).alias(f"{c}__std"), F.min(x).alias(f"{c}__min"),
                 F.max(x).alias(f"{c}__max")]
    qs = [0.25, 0.5, 0.75]
    if exact:
        found, row = exact_percentiles(df.select(*cols), {c: F.col(c) for c in cols}, qs, aggs)
    else:
        row = df.agg(*aggs).first()
        found = {(r["feature"], r["q"]): r["value"] for r in percentiles(df, cols, qs, False).collect()}
    rows = []
    for c in cols:
        n, mean, std, least, most = (row[f"{c}__{s}"] for s in stats)
        rows.append((c, n, mean, std, least, *[found.get((c, q)) for q in qs], most))
    return df.sparkSession.createDataFrame(rows, "feature string, " + ", ".join(
        f"{s} double" for s in ("count", "mean", "std", "min", "p25", "p50", "p75", "max")))


# Fixed values of the threshold recommendation ladders (percent units).
AMOUNT_LADDER = ((0.01, 0.01, "very strict"), (0.1, 0.1, "strict"))
AMOUNT_FALLBACK = (0.5, 1.1, "moderate")
RATE_LADDER = ((0.1, 0.1, "strict"), (1.0, 1.0, "moderate"))
RATE_FALLBACK = (5.0, 1.2, "lenient")


def recommend_missing_threshold(missing_pct: Column, ladder=AMOUNT_LADDER,
                                fallback=AMOUNT_FALLBACK) -> tuple[Column, Column]:
    """TH1: a missing-value threshold and a strictness label from the observed percent:
    the first rung whose bound exceeds the percent, else max(floor, factor * percent)."""
    thr = None
    lab = None
    for bound, value, label in ladder:
        cond = missing_pct < bound
        thr = F.when(cond, F.lit(value)) if thr is None else thr.when(cond, F.lit(value))
        lab = F.when(cond, F.lit(label)) if lab is None else lab.when(cond, F.lit(label))
    floor_v, factor, label = fallback
    thr = thr.otherwise(F.greatest(F.lit(floor_v), missing_pct * F.lit(factor)))
    lab = lab.otherwise(F.lit(label))
    return thr, lab


def missing_thresholds(df: DataFrame, specs: dict[str, tuple]) -> DataFrame:
    """TH1 + TH3: per attribute the missing count/percent and the recommended threshold.
    ``specs`` maps a column to (ladder, fallback)."""
    nc = null_counts(df, list(specs))
    parts = []
    for c, (ladder, fallback) in specs.items():
        thr, lab = recommend_missing_threshold(F.col("null_pct"), ladder, fallback)
        parts.append(nc.filter(F.col("column") == c).select(
            "column", "null_count", "null_pct", thr.alias("threshold_pct"), lab.alias("strictness")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def recommend_bounds(df: DataFrame, col: str, floor_min: float, cap_max: float,
                     exact: bool = True) -> DataFrame:
    """TH2: bounds from percentiles: absolute min = max(floor, p0.1), absolute max =
    min(cap, p99.9), normal range = [p1, p99]."""
    q = percentiles(df, [col], [0.001, 0.01, 0.99, 0.999], exact=exact)
    w = q.agg(*[F.max(F.when(F.col("q") == v, F.col("value"))).alias(n)
                for v, n in ((0.001, "p0_1"), (0.01, "p1"), (0.99, "p99"), (0.999, "p99_9"))])
    return w.select(F.lit(col).alias("column"),
                    F.greatest(F.lit(float(floor_min)), F.col("p0_1")).alias("abs_min"),
                    F.least(F.lit(float(cap_max)), F.col("p99_9")).alias("abs_max"),
                    F.col("p1").alias("normal_min"), F.col("p99").alias("normal_max"))
