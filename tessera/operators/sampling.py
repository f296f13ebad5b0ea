"""Deterministic sampling and splitting (SMP1-SMP6, AB1).

Randomness is a seeded md5 of the row id: the same row gets the same draw on every run, in
every partitioning, and after any task retry. Exact sizes come from hash-order thresholds, which are
order statistics found by counting, or from the narrowed top-n, never from collecting rows or
sorting the table.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.hashing import hash_key, md5_mod
from .quantiles import order_statistics
from .topn import first_rows


def exact_sample(df: DataFrame, n: int, seed: int = 42, key: str = "id") -> DataFrame:
    """SMP1: exactly ``min(n, rows)`` rows without replacement: the first ``n`` in the order
    of the seeded md5 of the id (ties by id). The 60-bit numeric prefix of the digest orders
    like the hex text and is uniform, which keeps the candidate cutoffs tight."""
    h = hash_key(seed, key)
    d = df.withColumn("_h", h).withColumn(
        "_h60", F.conv(F.substr(F.col("_h"), F.lit(1), F.lit(15)), 16, 10).cast("bigint"))
    return first_rows(d, n, ["_h60", "_h", key]).drop("_h", "_h60")


def _h60(h: "F.Column") -> "F.Column":
    """The first 15 hex digits of a hex md5 as a non-negative 60-bit integer (orders like the
    text, uniform over [0, 2^60))."""
    return F.conv(F.substr(h, F.lit(1), F.lit(15)), 16, 10).cast("bigint")


def _h52(h: Column) -> Column:
    """The first 13 hex digits of a hex md5 as an integer that a double holds exactly."""
    return F.conv(F.substr(h, F.lit(1), F.lit(13)), 16, 10).cast("bigint")


#: Copies of one row that a task writes, at most.
STRETCH = 10_000


def split_hash(seed: int, key: str = "id") -> Column:
    """What a split orders the rows by. A caller that caches the rows can keep it as a column of theirs
    (``hashed``), so that the passes of the split and the reads of its flag compute no digests."""
    return _h52(hash_key(seed, key))


def hash_rank_split(df: DataFrame, quotas: DataFrame, label: str | None, seed: int, key: str,
                    flag: str, hashed: str | None = None) -> DataFrame:
    """Mark, in every class, exactly the ``test_rows`` rows that come first in seeded-hash order
    (``quotas``: one row per class with ``class_rows`` and ``test_rows``; a NULL label is a class).

    The class thresholds are order statistics of the hash, found by counting (``quantiles``), so the
    table is not shuffled and a class or an id that holds most of the rows costs the same as a small
    one. When a threshold falls among the rows of one id, these are ordered by a digest of the whole
    row. When it falls among equal rows, which nothing tells apart, the marked and unmarked ones are
    written anew from their count. The split depends on the rows alone, not on where they stand.
    ``hashed`` names a column of ``df`` that holds ``split_hash(seed, key)``."""
    d = df.withColumn("_h", hash_key(seed, key)).withColumn("_h52", F.col(hashed) if hashed else _h52(F.col("_h")))
    in_class = {r[label] if label else 0: (F.col(label).eqNullSafe(F.lit(r[label])) if label else F.lit(True), int(r["test_rows"]))
                for r in quotas.collect()}  # one row per class
    wanted = {c: (mine, q) for c, (mine, q) in in_class.items() if q > 0}
    if not wanted:
        return df.withColumn(flag, F.lit(False))
    cut = _cuts(d, F.col("_h52"), wanted)
    mark, partial = F.lit(False), {}
    for c, (mine, _) in wanted.items():
        mark = mark | (mine & (F.col("_h52") < F.lit(cut[c].value)))
        if cut[c].need == cut[c].ties:
            mark = mark | (mine & (F.col("_h52") == F.lit(cut[c].value)))
        else:
            partial[c] = mine & (F.col("_h52") == F.lit(cut[c].value))
    if not partial:
        return d.withColumn(flag, F.coalesce(mark, F.lit(False))).select(*df.columns, flag)
    # rows of one id, or of the few ids that share the first 52 bits of the hash
    tied = {c: d.filter(at).groupBy("_h", key).agg(F.count(F.lit(1)).alias("n")).orderBy("_h", key).collect() for c, at in partial.items()}
    split_ids = {}
    for c, at in partial.items():
        need = cut[c].need
        for r in tied[c]:
            one = at & (F.col("_h") == F.lit(r["_h"])) & F.col(key).eqNullSafe(F.lit(r[key]))
            if r["n"] <= need:
                mark, need = mark | one, need - r["n"]
            elif need:
                split_ids[c] = (one, need)
                need = 0
    d = d.withColumn("_d52", F.when(_any([one for one, _ in split_ids.values()]), _h52(F.md5(F.to_json(F.struct(*[c for c in df.columns if c != hashed])).cast("binary")))))
    same = {}
    for c, found in (_cuts(d, F.col("_d52"), split_ids) if split_ids else {}).items():
        one = split_ids[c][0]
        mark = mark | (one & (F.col("_d52") < F.lit(found.value)))
        if found.need == found.ties:
            mark = mark | (one & (F.col("_d52") == F.lit(found.value)))
        else:
            same[c] = (one & (F.col("_d52") == F.lit(found.value)), found.need)
    out = d.withColumn(flag, F.coalesce(mark, F.lit(False)))
    if not same:
        return out.select(*df.columns, flag)
    main = out.filter(~F.coalesce(_any([at for at, _ in same.values()]), F.lit(False))).select(*df.columns, flag)
    for at, need in same.values():
        main = main.unionByName(_equal_rows(d.filter(at).select(*df.columns), need, flag))
    return main


@dataclass
class _Cut:
    """Threshold of a class: rows at ``value`` that are still needed, and rows there."""

    value: int
    need: int
    ties: int


def _cuts(d: DataFrame, x: Column, wanted: dict) -> dict:
    """The ``q``-th smallest value of a column among the rows of each condition, all in the same passes."""
    columns = {c: F.when(mine, x) for c, (mine, _) in wanted.items()}
    ranks = {c: q - 1 for c, (_, q) in wanted.items()}
    sizes = d.agg(*[F.count(v).alias(f"n{i}") for i, v in enumerate(columns.values())]).first()
    n = {c: sizes[f"n{i}"] for i, c in enumerate(columns)}
    _, found, _ = order_statistics(d, columns, lambda c, m: [ranks[c] / max(n[c] - 1, 1)] if m is None else [{ranks[c]}])
    value = {c: found[c, r] for c, r in ranks.items()}
    row = d.agg(*[F.count_if(v < F.lit(value[c])).alias(f"b{i}") for i, (c, v) in enumerate(columns.items())],
                *[F.count_if(v == F.lit(value[c])).alias(f"t{i}") for i, (c, v) in enumerate(columns.items())]).first()
    return {c: _Cut(value[c], ranks[c] + 1 - row[f"b{i}"], row[f"t{i}"]) for i, c in enumerate(columns)}


def _any(conditions: Sequence[Column]) -> Column:
    out = F.lit(False)
    for c in conditions:
        out = out | c
    return out


def _equal_rows(rows: DataFrame, need: int, flag: str) -> DataFrame:
    """Rows that are equal, the first ``need`` of them marked, written from their count in stretches."""
    w = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, -1)  # one row, unless digests collide
    counted = rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("_n")).withColumn("_o", F.coalesce(F.sum("_n").over(w), F.lit(0)))
    parts = counted.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("_n") - 1) / STRETCH))).alias("_s"))
    each = parts.select("*", F.explode(F.sequence(F.col("_s") * STRETCH, F.least(F.col("_n"), (F.col("_s") + 1) * STRETCH) - 1)).alias("_i"))
    return each.select(*rows.columns, (F.col("_o") + F.col("_i") < F.lit(need)).alias(flag))


def random_split(df: DataFrame, test_fraction: float, seed: int = 42, key: str = "id",
                 flag: str = "is_test") -> DataFrame:
    """SMP2: exactly ``ceil(test_fraction * n)`` test rows: the first ones in seeded-hash order."""
    q = df.agg(F.count(F.lit(1)).alias("class_rows")).withColumn(
        "test_rows", F.ceil(F.lit(float(test_fraction)) * F.col("class_rows")).cast("bigint"))
    return hash_rank_split(df, q, None, seed, key, flag)


def stratified_quotas(df: DataFrame, label: str, test_fraction: float) -> DataFrame:
    """Per-class train/test sizes: test total ``ceil(p * n)``; the train share of each class is
    its proportional part of ``n - ceil(p * n)`` with the leftover rows given to the largest
    fractional remainders (ties by class value); test takes the rest of the class.
    One row per class (small: a classification label)."""
    c = df.groupBy(label).agg(F.count(F.lit(1)).alias("class_rows"))
    w_all = Window.partitionBy()
    n = F.sum("class_rows").over(w_all)
    n_test = F.ceil(F.lit(float(test_fraction)) * n)
    q = (c.withColumn("_n", n).withColumn("_ntrain", F.col("_n") - n_test)
         .withColumn("_cont", F.col("class_rows") * F.col("_ntrain") / F.col("_n"))
         .withColumn("_fl", F.floor("_cont"))
         .withColumn("_rem", F.col("_cont") - F.col("_fl"))
         .withColumn("_need", F.col("_ntrain") - F.sum("_fl").over(w_all))
         .withColumn("_rk", F.row_number().over(Window.orderBy(F.desc("_rem"), F.asc(label)))))
    train = F.col("_fl") + F.when(F.col("_rk") <= F.col("_need"), F.lit(1)).otherwise(F.lit(0))
    return q.select(label, "class_rows", train.cast("bigint").alias("train_rows"),
                    (F.col("class_rows") - train).cast("bigint").alias("test_rows"))


def stratified_split(df: DataFrame, label: str, test_fraction: float, seed: int = 42,
                     key: str = "id", flag: str = "is_test", hashed: str | None = None) -> DataFrame:
    """SMP3: stratified split with exact sizes; within each class the test rows are the first
    ``test_rows`` in seeded-hash order (``hash_rank_split``: no shuffle of the table)."""
    quotas = stratified_quotas(df, label, test_fraction)
    return hash_rank_split(df, quotas, label, seed, key, flag, hashed)


def assign_arm(df: DataFrame, n_arms: int, key: str = "id", name: str = "arm") -> DataFrame:
    """SMP4 / AB1: arm = md5(str(id)) mod n_arms; a pure function of the id."""
    return df.withColumn(name, md5_mod(key, n_arms))


def split_sizes(split: DataFrame, flag: str = "is_test", by: Sequence[str] = ()) -> DataFrame:
    """SMP6: rows per split side (and per extra keys)."""
    side = F.when(F.col(flag), F.lit("test")).otherwise(F.lit("train")).alias("split")
    return split.groupBy(side, *by).agg(F.count(F.lit(1)).alias("rows"))
