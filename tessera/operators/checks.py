"""Data-quality checks, suite and gate (DQ1-DQ9, SRC7, SNK2).

A check is a DataFrame of report rows ``(check_name, sub_check, passed, metrics, details)``
with ``metrics`` a ``map<string,double>``. Checks over the same table share one scan: the
status distribution and the rate range come out of one grouped aggregation whose partial
results are a handful of rows per task.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.misc import pct
from ..functions.parse import percent_lenient, percent_number
from ..sources.tables import head_rows
from .histogram import bin_index

REPORT_SCHEMA = T.StructType([
    T.StructField("check_name", T.StringType(), False),
    T.StructField("sub_check", T.StringType(), True),
    T.StructField("passed", T.BooleanType(), False),
    T.StructField("metrics", T.MapType(T.StringType(), T.DoubleType()), True),
    T.StructField("details", T.StringType(), True),
])

# Status vocabulary and limits of the loan checks.
VALID_STATUSES = ["Fully Paid", "Charged Off", "Current", "In Grace Period", "Late (16-30 days)",
                  "Late (31-120 days)", "Default"]
REQUIRED_STATUSES = ["Fully Paid", "Charged Off"]
RATE_MIN_EXPECTED = 0.0531
RATE_MAX_EXPECTED = 0.3084
RATE_SLACK_LOW = 0.9
RATE_SLACK_HIGH = 1.1
SAMPLE_ROWS = 10000
SAMPLE_MISSING_LIMIT_PCT = 1.0
AMOUNT_RULES = dict(missing_limit=0.01, lo=1000.0, hi=40000.0, normal_lo=1525.0, normal_hi=40000.0)
RATE_RULES_PCT = dict(missing_limit=0.1, lo=5.31, hi=30.84, normal_lo=5.32, normal_hi=26.77,
                      bins=30, min_peaks=3)
OUT_OF_RANGE_LIMIT_PCT = 0.1
IN_RANGE_MIN_PCT = 98.0


def _metrics(**kv: Column) -> Column:
    items = []
    for k, v in kv.items():
        items += [F.lit(k), v.cast("double")]
    return F.create_map(*items)


def _row(check: str, sub: str | None, passed: Column, metrics: Column, details: Column) -> Column:
    return F.struct(F.lit(check).alias("check_name"), F.lit(sub).cast("string").alias("sub_check"),
                    F.coalesce(passed, F.lit(False)).alias("passed"), metrics.alias("metrics"),
                    details.cast("string").alias("details"))


def _explode_rows(one_row: DataFrame, rows: Sequence[Column]) -> DataFrame:
    return one_row.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def failed_row(spark: SparkSession, check: str, details: str, sub: str | None = None) -> DataFrame:
    """SRC7 / SNK2: a failed report row standing in for a check that could not run."""
    return spark.createDataFrame([Row(check_name=check, sub_check=sub, passed=False,
                                      metrics=None, details=details)], REPORT_SCHEMA)


# --- DQ1 / DQ2 -------------------------------------------------------------------------------

def range_check(df: DataFrame, value: Column, name: str, missing_limit: float, lo: float,
                hi: float, normal_lo: float, normal_hi: float, bins: int | None = None,
                min_peaks: int | None = None, out_limit: float = OUT_OF_RANGE_LIMIT_PCT,
                in_range_min: float = IN_RANGE_MIN_PCT) -> DataFrame:
    """DQ1 / DQ2: missing share, below-min / above-max shares, normal-range share, and
    optionally the number of histogram peaks in ``bins`` bins over [lo, hi].

    One scan: rows are counted per histogram bin (NULL bin = missing or outside) with the
    range counters as conditional counts; the totals and the histogram are both read from
    that small grouped result (its exchange is reused, the table is scanned once).
    Percentages are over all rows for missing values, over non-null values otherwise; NaN is missing."""
    x = F.nanvl(value.cast("double"), F.lit(None).cast("double"))
    b = bin_index(x, F.lit(float(lo)), F.lit(float(hi)), bins) if bins else F.lit(None).cast("int")
    g = df.select(x.alias("_v"), b.alias("bin")).groupBy("bin").agg(
        F.count(F.lit(1)).alias("n"), F.count("_v").alias("nv"),
        F.count_if(F.col("_v").isNull()).alias("miss"), F.count_if(F.col("_v") < lo).alias("below"),
        F.count_if(F.col("_v") > hi).alias("above"),
        F.count_if(F.col("_v").between(normal_lo, normal_hi)).alias("within"))
    # totals and the (at most ``bins``-entry) histogram come out of the same final aggregate
    a = g.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("n", "nv", "miss", "below", "above", "within")],
              F.map_from_entries(F.collect_list(F.when(F.col("bin").isNotNull(), F.struct("bin", "n"))))
              .alias("_hist"))
    mp = pct(F.col("miss"), F.col("n"))
    bp = pct(F.col("below"), F.col("nv"))
    ap = pct(F.col("above"), F.col("nv"))
    wp = pct(F.col("within"), F.col("nv"))
    rows = [
        _row(name, "missing_values", mp <= missing_limit,
             _metrics(count=F.col("miss"), percentage=mp, threshold=F.lit(missing_limit)),
             F.format_string("missing %.4f%% (limit %s%%)", mp, F.lit(str(missing_limit)))),
        _row(name, "below_minimum", bp <= out_limit,
             _metrics(threshold=F.lit(lo), count=F.col("below"), percentage=bp),
             F.format_string("below %s: %.2f%%", F.lit(str(lo)), bp)),
        _row(name, "above_maximum", ap <= out_limit,
             _metrics(threshold=F.lit(hi), count=F.col("above"), percentage=ap),
             F.format_string("above %s: %.2f%%", F.lit(str(hi)), ap)),
        _row(name, "within_normal_range", wp >= in_range_min,
             _metrics(range_low=F.lit(normal_lo), range_high=F.lit(normal_hi), count=F.col("within"),
                      percentage=wp),
             F.format_string("within [%s, %s]: %.2f%%", F.lit(str(normal_lo)), F.lit(str(normal_hi)), wp)),
    ]
    if bins:
        dense = F.transform(F.sequence(F.lit(0), F.lit(bins - 1)),
                            lambda i: F.coalesce(F.try_element_at(F.col("_hist"), i), F.lit(0)))
        # WIN1 on the dense counts: strict interior local maxima
        peaks = F.size(F.filter(F.sequence(F.lit(1), F.lit(max(bins - 2, 0))), lambda i: (
            (F.get(dense, i) > F.get(dense, i - 1)) & (F.get(dense, i) > F.get(dense, i + 1))))) \
            if bins >= 3 else F.lit(0)
        rows.append(_row(name, "distribution_pattern", peaks >= min_peaks,
                         _metrics(peaks_detected=peaks, minimum_expected_peaks=F.lit(min_peaks)),
                         F.format_string("%d peaks in %d bins", peaks, F.lit(bins))))
    return _explode_rows(a, rows)


def loan_amount_check(df: DataFrame, col: str = "loan_amnt") -> DataFrame:
    """DQ1 with the loan-amount limits."""
    return range_check(df, F.col(col).cast("double"), "loan_amount_distribution", **AMOUNT_RULES)


def interest_rate_check(df: DataFrame, col: str = "int_rate") -> DataFrame:
    """DQ2 with the rate limits in percent units (text rates are parsed, not scaled)."""
    t = df.schema[col].dataType
    v = percent_number(col) if isinstance(t, T.StringType) else F.col(col).cast("double")
    return range_check(df, v, "interest_rate_distribution", **RATE_RULES_PCT)


# --- DQ3 / DQ4: one shared scan ----------------------------------------------------------------

OTHER_STATUSES = "other statuses"


def status_rate_scan(df: DataFrame, status_col: str = "loan_status", rate_col: str = "int_rate",
                     statuses: Sequence[str] = VALID_STATUSES) -> DataFrame:
    """SRC6: counts of the named statuses (all others together) and the parsed rate range from one
    scan: one row of fixed width per task and in the end, however many values a dirty column has."""
    rate = percent_lenient(rate_col)
    x = F.col(status_col)
    names = list(dict.fromkeys([*statuses, *REQUIRED_STATUSES]))
    g = df.agg(F.count(x).alias("n"), F.min(rate).alias("min_rate"), F.max(rate).alias("max_rate"),
               *[F.count_if(x == s).alias(f"s{i}") for i, s in enumerate(names)])
    known = [F.col(f"s{i}") for i in range(len(names))]
    pairs = [v for s, k in zip(names, known) for v in (F.lit(s), k)]
    every = F.create_map(*pairs, F.lit(OTHER_STATUSES), F.col("n") - sum(known[1:], known[0]))
    return g.select(F.map_filter(every, lambda k, v: v > 0).alias("counts"),
                    F.when(F.col("n") > 0, F.col("n")).alias("n_status"), "min_rate", "max_rate")


def status_distribution_row(scan: DataFrame, required: Sequence[str] = REQUIRED_STATUSES) -> Column:
    """DQ3 (as a row over ``status_rate_scan``): required statuses present; distribution as metrics."""
    dist = F.transform_values("counts", lambda k, v: v.cast("double") / F.col("n_status").cast("double"))
    req = F.array(*[F.lit(s) for s in required])
    missing = F.array_except(req, F.map_keys("counts"))
    ok = (F.size(missing) == 0) & (F.coalesce(F.col("n_status"), F.lit(0)) > 0)
    det = F.when(F.coalesce(F.col("n_status"), F.lit(0)) == 0,
                 F.lit("no row has a status")).otherwise(
        F.format_string("required statuses %s: %s", F.concat_ws(" and ", req),
                        F.when(ok, F.lit("all found")).otherwise(F.concat(F.lit("not found: "), F.concat_ws(" and ", missing)))))
    return _row("Loan Status Distribution", None, ok, dist, det)


def rate_sanity_row(min_expected: float = RATE_MIN_EXPECTED, max_expected: float = RATE_MAX_EXPECTED) -> Column:
    """DQ4 (as a row over ``status_rate_scan``): observed rate range within the slack bounds."""
    ok = (F.col("min_rate") >= min_expected * RATE_SLACK_LOW) & (F.col("max_rate") <= max_expected * RATE_SLACK_HIGH)
    det = F.when(F.col("min_rate").isNull(), F.lit("no rate to compare")).otherwise(
        F.format_string("rates from %.4f to %.4f, limits %.4f to %.4f before slack",
                        F.col("min_rate"), F.col("max_rate"), F.lit(min_expected), F.lit(max_expected)))
    return _row("Interest Rate Sanity", None, ok,
                _metrics(min_rate=F.col("min_rate"), max_rate=F.col("max_rate")), det)


def status_check(df: DataFrame, status_col: str = "loan_status") -> DataFrame:
    scan = status_rate_scan(df, status_col, "int_rate") if "int_rate" in df.columns else \
        status_rate_scan(df.withColumn("int_rate", F.lit(None).cast("string")), status_col)
    return _explode_rows(scan, [status_distribution_row(scan)])


def rate_sanity_check(df: DataFrame, rate_col: str = "int_rate") -> DataFrame:
    scan = status_rate_scan(df.withColumn("_s", F.lit(None).cast("string")), "_s", rate_col)
    return _explode_rows(scan, [rate_sanity_row()])


# --- DQ5, DQ8, DQ9 -----------------------------------------------------------------------------

def missing_on_sample_check(df: DataFrame, order_by: Sequence[str], col: str = "loan_amnt",
                            n: int = SAMPLE_ROWS, limit_pct: float = SAMPLE_MISSING_LIMIT_PCT) -> DataFrame:
    """DQ5: missing share of ``col`` on the first ``n`` rows, strictly below ``limit_pct``."""
    name = "Missing Loan Amount"
    if col not in df.columns:
        return failed_row(df.sparkSession, name, f"column {col} is absent")
    s = head_rows(df.select(*order_by, col), n, order_by)
    x = F.col(col)
    if isinstance(df.schema[col].dataType, (T.DoubleType, T.FloatType)):
        x = F.nanvl(x, F.lit(None).cast("double"))
    a = s.agg((F.avg(x.isNull().cast("double")) * F.lit(100.0)).alias("mp"))
    row = _row(name, None, F.col("mp") < limit_pct, _metrics(missing_percentage=F.col("mp")),
               F.format_string("%.2f%% of the head sample has no %s (limit %s%%)", F.col("mp"), F.lit(col),
                               F.lit(str(limit_pct))))
    return _explode_rows(a, [row])


def min_records_check(df: DataFrame, minimum: int, name: str = "Minimum Records") -> DataFrame:
    """DQ8: at least ``minimum`` rows."""
    a = df.agg(F.count(F.lit(1)).alias("n"))
    row = _row(name, None, F.col("n") >= minimum, _metrics(rows=F.col("n"), minimum=F.lit(minimum)),
               F.format_string("%d rows (minimum %d)", F.col("n"), F.lit(minimum)))
    return _explode_rows(a, [row])


def allowed_values_check(df: DataFrame, col: str = "loan_status",
                         allowed: Sequence[str] = VALID_STATUSES) -> DataFrame:
    """DQ9: no non-null value outside the allowed set."""
    x = F.col(col)
    a = df.agg(F.count_if(x.isNotNull() & ~x.isin(list(allowed))).alias("bad"), F.count(x).alias("nv"))
    row = _row("Allowed Values", col, F.col("bad") == 0,
               _metrics(outside=F.col("bad"), percentage=pct(F.col("bad"), F.col("nv"))),
               F.format_string("%d values of %s outside the allowed set", F.col("bad"), F.lit(col)))
    return _explode_rows(a, [row])


# --- DQ6 / DQ7 ---------------------------------------------------------------------------------

def default_suite(df: DataFrame, order_by: Sequence[str]) -> DataFrame:
    """The three-check suite: status distribution and rate sanity from one shared scan, the
    missing-amount check on a head sample."""
    scan = status_rate_scan(df)
    shared = _explode_rows(scan, [status_distribution_row(scan), rate_sanity_row()])
    return shared.unionByName(missing_on_sample_check(df, order_by))


def run_suite(spark: SparkSession, checks: Sequence[tuple]) -> DataFrame:
    """DQ6 with SRC7: evaluate each entry ``(name, build)`` or ``(name, build, dependents)``. An entry whose plan
    or scan fails becomes a failed row instead of stopping the suite, and so does every check named in
    ``dependents``, whose figures come from that scan. Report rows are tiny and are collected here."""
    rows = []
    for name, build, *rest in checks:
        try:
            rows.extend(build().collect())
        except (PySparkException, OSError) as e:  # analysis, execution or I/O failure
            rows.append(Row(check_name=name, sub_check=None, passed=False, metrics=None,
                            details=f"{type(e).__name__}: {e}"))
            rows += [Row(check_name=d, sub_check=None, passed=False, metrics=None,
                         details=f"not evaluated: it needs the results of '{name}', which failed")
                     for d in (rest[0] if rest else ())]
    return spark.createDataFrame(rows, REPORT_SCHEMA)


def overall(report: DataFrame) -> DataFrame:
    """AGG18: one row with the AND of all checks and the counts."""
    return report.agg(F.coalesce(F.bool_and("passed"), F.lit(False)).alias("all_passed"),
                      F.count(F.lit(1)).alias("checks"), F.count_if(~F.col("passed")).alias("failed"))


class QualityGateError(RuntimeError):
    pass


def require_passed(report: DataFrame) -> bool:
    """DQ7: raise when any check failed (the pipeline gate). Returns True otherwise."""
    r = overall(report).first()
    if not r["all_passed"]:
        raise QualityGateError(f"{r['failed']} of {r['checks']} checks failed")
    return True


def assert_passed(report: DataFrame) -> DataFrame:
    """DQ7 inside a plan: ``assert_true`` fails the job at the first failed row."""
    # a predicate, not a dropped column: a projected-away assertion would be pruned
    return report.where(F.assert_true(F.col("passed"), F.concat(
        F.lit("check failed: "), F.col("check_name"))).isNull())
