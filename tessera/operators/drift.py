"""Two-sample Kolmogorov-Smirnov drift over many features in one job (DR1-DR6).

Plan: both slices are unpivoted to ``(feature, x)`` rows, tagged with their side, and counted
per distinct ``(feature, x)`` (partial aggregation: a value repeated in a third of the table
costs one row per task). The ECDFs are distributed running sums of those counts
(``prefix.running_sums``), D is a grouped max. ``pyspark.ml.stat.KolmogorovSmirnovTest`` is
one-sample only, so it does not apply.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .prefix import running_sums
from .profile import unpivot_numeric

# The drift features of the loan table and the decision level.
DRIFT_FEATURES = ["loan_amnt", "int_rate", "installment", "annual_inc", "dti", "revol_bal",
                  "revol_util", "total_acc"]
ALPHA = 0.05
SERIES_TERMS = 100


def ks_pvalue(d: Column, n: Column, m: Column, terms: int = SERIES_TERMS) -> Column:
    """DR2: two-sided p-value of D with ``N = round(n m / (n + m))`` effective rows: the Kolmogorov series
    ``2 * sum_k (-1)^(k-1) exp(-2 N x^2)`` at ``x = k D``, each exponent with the finite-sample terms
    ``-(2/3) x - (4/9) N x^4`` of Smirnov's expansion; clamped to [0, 1], 1 when ``D sqrt(N) < 0.2``."""
    size = F.round((n.cast("double") * m.cast("double")) / (n + m).cast("double"))
    l2 = d * d * size
    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(terms)), F.lit(0.0),
        lambda acc, k: acc + F.when(k % 2 == 1, F.lit(2.0)).otherwise(F.lit(-2.0))
        * F.exp(F.lit(-2.0) * (k * k).cast("double") * l2 - F.lit(2.0) / F.lit(3.0) * k.cast("double") * d
                - F.lit(4.0) / F.lit(9.0) * (k * k * k * k).cast("double") * l2 * d * d))
    return F.when(F.sqrt(l2) < 0.2, F.lit(1.0)).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), series)))


def ks_statistics(ref: DataFrame, cur: DataFrame, features: Sequence[str]) -> DataFrame:
    """DR1 + DR4: per feature ``n_ref``, ``n_cur`` and D = max |F_ref(x) - F_cur(x)|.
    Features with an empty side produce no row."""
    a = unpivot_numeric(ref, features).withColumn("_side", F.lit(0))
    b = unpivot_numeric(cur, features).withColumn("_side", F.lit(1))
    d = a.unionByName(b).groupBy("feature", "x").agg(
        F.count_if(F.col("_side") == 0).alias("c_ref"), F.count_if(F.col("_side") == 1).alias("c_cur"))
    rs = running_sums(d, ["x"], ["c_ref", "c_cur"], ["feature"], totals=True)
    gap = F.abs(F.try_divide(F.col("c_ref_cum"), F.col("c_ref_total"))
                - F.try_divide(F.col("c_cur_cum"), F.col("c_cur_total")))
    return (rs.filter((F.col("c_ref_total") > 0) & (F.col("c_cur_total") > 0))
            .groupBy("feature").agg(F.first("c_ref_total").alias("n_ref"),
                                    F.first("c_cur_total").alias("n_cur"),
                                    F.max(gap).alias("ks_statistic")))


def ks_drift(ref: DataFrame, cur: DataFrame, features: Sequence[str] = DRIFT_FEATURES,
             alpha: float = ALPHA) -> DataFrame:
    """DR1-DR4: K-S statistic, p-value and drift flag per feature."""
    s = ks_statistics(ref, cur, features)
    p = ks_pvalue(F.col("ks_statistic"), F.col("n_ref"), F.col("n_cur"))
    return s.select("feature", F.col("n_ref").cast("bigint").alias("n_ref"),
                    F.col("n_cur").cast("bigint").alias("n_cur"), "ks_statistic",
                    p.alias("p_value")).withColumn("drift_detected", F.col("p_value") < alpha)


def drift_status(features_report: DataFrame, slice_status: DataFrame | None = None) -> DataFrame:
    """DR5 / DR6: one row with the overall status: ``SKIPPED_TOO_SMALL`` when the slices were
    too small, else ``DRIFT_DETECTED`` if any feature drifted, else ``NO_DRIFT``."""
    agg = features_report.agg(F.coalesce(F.bool_or("drift_detected"), F.lit(False)).alias("_any"),
                              F.count(F.lit(1)).alias("features_checked"))
    st = F.when(F.col("_any"), F.lit("DRIFT_DETECTED")).otherwise(F.lit("NO_DRIFT"))
    if slice_status is not None:
        skipped = slice_status.select((F.first("status") == "SKIPPED_TOO_SMALL")).scalar()
        st = F.when(skipped, F.lit("SKIPPED_TOO_SMALL")).otherwise(st)
    return agg.select(st.alias("overall_drift_status"), "features_checked")
