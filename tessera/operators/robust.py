"""Noise-robustness test of a scorer (RB1-RB5, AGG17, AGG19, FLT9).

The noise of a row is a seeded Gaussian drawn from the md5 of (seed, feature, id): the
perturbed table is a pure function of the sample, so reruns and retried tasks agree, and
the flip rate is reproducible in SQL.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import gaussian
from ..functions.misc import clip
from ..session import checkpoint_dir
from .metrics import flip_rate
from .sampling import exact_sample

# Fixed values of the robustness test.
PERTURB_FEATURES = ["annual_inc", "dti", "revol_util"]
NOISE_FRACTION = 0.05
THRESHOLD_PCT = 15.0
SAMPLE_SIZE = 1000
SAMPLE_SEED = 456
NOISE_SEED = 7


def perturb(sample: DataFrame, features: Sequence[str], noise_fraction: float = NOISE_FRACTION,
            seed: int = NOISE_SEED, key: str = "id", lower: float | None = 0.0,
            upper: dict[str, float] | None = None) -> DataFrame:
    """RB1 + RB2: add ``noise_fraction * std`` Gaussian noise to each feature (sample std,
    ddof=1, as a scalar subquery of the sample); features whose std is NULL or 0 are left
    unchanged; perturbed values are clipped to ``[lower, upper[f]]`` (NULL stays NULL).
    The source's default upper clip of ``max(1.5, max(column))`` never clips, so ``upper`` is
    only applied where given."""
    upper = upper or {}
    feats = [c for c in sample.columns if c in features]
    # all sample stds in one scalar subquery (one pass over the sample)
    stds = sample.select(F.struct(*[F.stddev_samp(F.col(c).cast("double")).alias(c) for c in feats])).scalar() \
        if feats else None
    cols = []
    for c in sample.columns:
        if c not in features:
            cols.append(F.col(c))
            continue
        std = stds.getField(c)
        noisy = F.col(c).cast("double") + gaussian(seed, c, key) * std * F.lit(float(noise_fraction))
        moved = clip(noisy, lower, upper.get(c))
        cols.append(F.when(std.isNotNull() & (std > 0), moved).otherwise(F.col(c).cast("double")).alias(c))
    return sample.select(*cols)


def robustness(clean: DataFrame, predict: Callable[[DataFrame], DataFrame],
               features: Sequence[str] = PERTURB_FEATURES, noise_fraction: float = NOISE_FRACTION,
               threshold_pct: float = THRESHOLD_PCT, n: int = SAMPLE_SIZE, sample_seed: int = SAMPLE_SEED,
               noise_seed: int = NOISE_SEED, key: str = "id") -> DataFrame:
    """RB3 + RB4: flip rate of ``predict`` between a seeded sample of ``min(n, rows)`` rows and
    its perturbed copy; ``passed = change_pct < threshold`` (strict). ``predict`` maps a frame
    to ``(key, prediction)``. An empty input gives ``status = skipped_no_data_post_clean``."""
    # the sample is bounded (n rows) and read four times: materialise it once in the shared
    # checkpoint folder (cuts the lineage back to the full table)
    checkpoint_dir(clean.sparkSession)
    sample = exact_sample(clean, n, seed=sample_seed, key=key).checkpoint(eager=True)
    noisy = perturb(sample, [f for f in features if f in clean.columns], noise_fraction, noise_seed, key)
    a = predict(sample).select(key, F.col("prediction").alias("_a"))
    b = predict(noisy).select(key, F.col("prediction").alias("_b"))
    fr = flip_rate(a.join(b, key), "_a", "_b", threshold_pct)
    status = F.when(F.col("rows") == 0, F.lit("skipped_no_data_post_clean")).otherwise(F.lit("completed"))
    return fr.select("rows", "changed", "change_pct", F.when(F.col("rows") > 0, F.col("passed")).alias("passed"),
                     status.alias("status"))


def robustness_record(result: DataFrame, run_id: str, features: Sequence[str] = PERTURB_FEATURES,
                      noise_fraction: float = NOISE_FRACTION, threshold_pct: float = THRESHOLD_PCT) -> DataFrame:
    """RB5: the result as run-metric rows ``(run_id, key, value, text)``."""
    def kv(k: str, v: Column | None, t: Column | None) -> Column:
        return F.struct(F.lit(k).alias("key"), (v if v is not None else F.lit(None)).cast("double").alias("value"),
                        (t if t is not None else F.lit(None)).cast("string").alias("text"))
    rows = F.array(
        kv("robustness_change_percentage", F.col("change_pct"), None),
        kv("robustness_test_passed", F.col("passed").cast("int"), None),
        kv("robustness_features_perturbed", None, F.lit(", ".join(features))),
        kv("robustness_noise_level_std_fraction", F.lit(noise_fraction), None),
        kv("robustness_threshold_percentage", F.lit(threshold_pct), None),
        kv("robustness_test_status", None, F.col("status")))
    return result.select(F.explode(rows).alias("r")).select(F.lit(run_id).alias("run_id"), "r.*")
