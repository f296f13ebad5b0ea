"""Distributed row index and prefix sums (SLC6, WIN2, WIN3, WIN4).

A window with ``orderBy`` and no ``partitionBy`` moves every row into one task, and a window
partitioned by a low-cardinality key (a class label, a feature name) puts a whole group into
one task. Both are avoided here, at every size:

1. range-partition the rows on ``(group, order)`` so that each partition holds one contiguous
   slice of the total order; sort within partitions;
2. freeze partition membership by a reliable checkpoint in ``spark.checkpoint.dir``: range bounds
   are sampled when a physical plan is built, so two evaluations could draw different bounds. The
   checkpoint also cuts the lineage; Spark's cleaner may drop it once the frame is out of use;
3. compute per-(partition, group) totals: at most ``P + G`` rows, a proven bound, broadcast;
4. add the exclusive prefix of those totals to the in-partition position / running sum.

Hot groups are harmless: a group holding a third of all rows is split over many range
partitions like any other contiguous slice. NULL groups are groups like any other (the totals
are joined null-safely).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import checkpoint_dir

_POS_BITS = 33
_POS_MASK = (1 << _POS_BITS) - 1


def _cols(xs: Sequence[str | Column]) -> list[Column]:
    return [F.col(x) if isinstance(x, str) else x for x in xs]


def _frozen_range(df: DataFrame, keys: list[Column], num_partitions: int | None) -> DataFrame:
    # without an explicit count the range exchange uses the shuffle partitions and AQE may
    # coalesce them for small inputs
    rp = df.repartitionByRange(num_partitions, *keys) if num_partitions else df.repartitionByRange(*keys)
    checkpoint_dir(df.sparkSession)
    return rp.sortWithinPartitions(*keys).withColumn("_mid", F.monotonically_increasing_id()).checkpoint(eager=True)


def _with_offsets(rows: DataFrame, offsets: DataFrame, group: Sequence[str], small_groups: bool) -> DataFrame:
    """``rows`` joined to the offset table on partition and group; a NULL group equals itself."""
    o = offsets.select(*[F.col(c).alias(f"_o_key_{c}") if c in ("_pid", *group) else F.col(c) for c in offsets.columns])
    on = rows["_pid"] == F.col("_o_key__pid")
    for g in group:
        on = on & rows[g].eqNullSafe(F.col(f"_o_key_{g}"))
    return rows.join(F.broadcast(o) if small_groups else o, on).drop("_o_key__pid", *[f"_o_key_{g}" for g in group])


def row_index(df: DataFrame, order_by: Sequence[str | Column], group_by: Sequence[str] = (),
              name: str = "row_idx", num_partitions: int | None = None,
              small_groups: bool = True) -> DataFrame:
    """0-based position of every row in ``order_by`` (within ``group_by`` if given).

    ``order_by`` must be a total order (unique tie-break) for the index to be deterministic.
    ``small_groups`` marks the number of groups as bounded (classes, arms, features), which
    makes the offset table at most ``P + G`` rows and safe to broadcast; otherwise the offsets
    are joined by a regular (AQE-planned) join.
    """
    group = list(group_by)
    r = _frozen_range(df, _cols(group) + _cols(order_by), num_partitions)
    pid = F.shiftright(F.col("_mid"), _POS_BITS).alias("_pid")
    pos = (F.col("_mid").bitwiseAND(F.lit(_POS_MASK))).alias("_pos")
    r = r.select("*", pid, pos)
    tot = r.groupBy("_pid", *group).agg(F.count(F.lit(1)).alias("_n"), F.min("_pos").alias("_p0"))
    w = Window.partitionBy(*group).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    off = tot.select("_pid", *group, "_p0", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_off"))
    out = _with_offsets(r, off, group, small_groups)
    return out.withColumn(name, F.col("_pos") - F.col("_p0") + F.col("_off")).drop(
        "_mid", "_pid", "_pos", "_p0", "_off")


def running_sums(df: DataFrame, order_by: Sequence[str], values: Sequence[str],
                 group_by: Sequence[str] = (), suffix: str = "_cum",
                 num_partitions: int | None = None, small_groups: bool = True,
                 totals: bool = False) -> DataFrame:
    """Inclusive running sums of ``values`` along ``order_by`` within ``group_by``.

    Intended for pre-aggregated inputs (one row per distinct order value), as the K-S ECDF,
    AUC ranks and exact percentiles use it. The in-partition sums need one hash exchange on
    (partition id, group) of that reduced table; groups there are bounded by a partition.
    ``totals=True`` also attaches the group total ``<value>_total`` (taken from the offset
    table, no extra pass).
    """
    group = list(group_by)
    r = _frozen_range(df, _cols(group) + _cols(order_by), num_partitions)
    r = r.withColumn("_pid", F.shiftright(F.col("_mid"), _POS_BITS)).drop("_mid")
    tot = r.groupBy("_pid", *group).agg(*[F.sum(v).alias(f"_t_{v}") for v in values])
    w = Window.partitionBy(*group).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    wg = Window.partitionBy(*group)
    off = tot.select("_pid", *group,
                     *[F.coalesce(F.sum(f"_t_{v}").over(w), F.lit(0)).alias(f"_o_{v}") for v in values],
                     *[F.sum(f"_t_{v}").over(wg).alias(f"{v}_total") for v in values])
    wl = (Window.partitionBy("_pid", *group).orderBy(*_cols(order_by))
          .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    loc = r.select("*", *[F.sum(v).over(wl).alias(f"_l_{v}") for v in values])
    out = _with_offsets(loc, off, group, small_groups)
    return out.select(
        *[c for c in df.columns],
        *[(F.col(f"_l_{v}") + F.col(f"_o_{v}")).alias(f"{v}{suffix}") for v in values],
        *[F.col(f"{v}_total") for v in values if totals])
