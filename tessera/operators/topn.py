"""Exact first ``n`` rows of a total order without merging ``P x n`` rows in one task
(SRC2, SRC5, SLC1-SLC3, SLC7, DQ5, SMP1).

``orderBy(k).limit(n)`` keeps ``n`` rows per task and merges all of them in one task: at
100,000 partitions and n = 10,000 that is 10^9 rows in one place. Here a predicate on the order
keys first narrows the table to little more than ``n`` rows; only those are ordered and cut.

The predicate is found key by key, from aggregates over the key columns alone:

1. NULLs of the key come first ascending and last descending; when the boundary falls among them,
   the search goes on with the next key inside the NULL rows;
2. otherwise ``percentile_approx`` of the non-NULL values (bounded-memory sketch, rank error at most
   ``count / ACCURACY``) gives the least ladder quantile whose guaranteed rank reaches the boundary;
3. one exact count of the rows before that value and at it tells where the boundary is: before it,
   the search repeats on the smaller range; at it, the search goes on with the next key inside the
   tied rows. A leading key with few values (a date) so costs no more than a unique one.

There is one path for every size; a few numbers per step reach the driver. A key of a type without
quantiles (text) ends the search: its ties are then ordered with the rest. The result is exact in
any case, because each step keeps all rows up to the boundary.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

LADDER = [1.5 ** -i for i in range(46, 0, -1)]  # about 8e-9 .. 0.67
ACCURACY = 100000
MARGIN_ROWS = 16
# Rows kept beyond ``n`` that are not worth another pass.
SLACK_ROWS = 1000
_QUANTILE_TYPES = (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType)


def _cols(xs: Sequence[str | Column]) -> list[Column]:
    return [F.col(x) if isinstance(x, str) else x for x in xs]


def _before(key: Column, cut: Column, descending: bool) -> Column:
    return key > cut if descending else key < cut


def boundary(df: DataFrame, n: int, keys: Sequence[Column], descending: bool = False) -> Column:
    """A predicate that holds for the first ``n`` rows in the order of ``keys`` (all descending if so
    asked) and for few others. Never NULL for a row."""
    if not keys:
        return F.lit(True)
    key, rest = keys[0], list(keys[1:])
    scoped = df.select(key.alias("_k"))
    quantiles = isinstance(scoped.schema["_k"].dataType, _QUANTILE_TYPES)
    fractions = [1.0 - f for f in LADDER] if descending else LADDER
    k = F.col("_k")
    keep, scope = F.lit(False), df  # rows surely kept; rows in which the boundary lies
    need, first = n, True
    while True:
        aggs = [F.count(F.lit(1)).alias("n"), F.count("_k").alias("nn")]
        if quantiles:
            aggs.append(F.percentile_approx(k, fractions, ACCURACY).alias("q"))
        s = scope.select(key.alias("_k")).agg(*aggs).first()
        if s["n"] <= max(2 * need, need + SLACK_ROWS):
            return F.lit(True) if first else keep
        nulls = s["n"] - s["nn"]
        if first:  # later scopes hold no NULL
            if not descending and nulls >= need:
                return key.isNull() & boundary(df.filter(key.isNull()), need, rest, descending)
            if descending and s["nn"] < need:
                return key.isNotNull() | boundary(df.filter(key.isNull()), need - s["nn"], rest, descending)
            if not descending:
                need -= nulls
                keep = key.isNull()
            first = False
            scope = df.filter(key.isNotNull())
            keep = keep | key.isNotNull()
        err = s["nn"] / ACCURACY + MARGIN_ROWS
        cut = next((v for f, v in zip(LADDER, s["q"] or []) if f * s["nn"] - err >= need), None) if quantiles else None
        if cut is None:
            return keep
        # casting keeps the literal's type equal to the key's, whatever the session's defaults
        at = F.lit(cut).cast(scoped.schema["_k"].dataType)
        c = scope.select(key.alias("_k")).agg(F.count_if(_before(k, at, descending)).alias("before"),
                                              F.count_if(k == at).alias("ties")).first()
        nulls_kept = key.isNull() if not descending else F.lit(False)
        if c["before"] >= need:
            keep = F.coalesce(nulls_kept | _before(key, at, descending), F.lit(False))
            scope = scope.filter(_before(key, at, descending))
            continue
        keep = F.coalesce(nulls_kept | _before(key, at, descending), F.lit(False))
        tied = F.coalesce(key == at, F.lit(False))
        if c["before"] + c["ties"] <= need + SLACK_ROWS or not rest:
            return keep | tied
        return keep | (tied & boundary(df.filter(key == at), need - c["before"], rest, descending))


def _cut(df: DataFrame, n: int, order_by: Sequence[str | Column], descending: bool) -> DataFrame:
    keys = _cols(order_by)
    if n <= 0:
        return df.limit(0)
    kept = df.filter(boundary(df, n, keys, descending))
    return kept.orderBy(*[k.desc() for k in keys] if descending else keys).limit(n)


def first_rows(df: DataFrame, n: int, order_by: Sequence[str | Column]) -> DataFrame:
    """The first ``n`` rows of ``df`` in ``order_by`` (a total order, NULLs first), exactly."""
    return _cut(df, n, order_by, False)


def last_rows(df: DataFrame, n: int, order_by: Sequence[str | Column]) -> DataFrame:
    """The last ``n`` rows of ``df`` in ``order_by`` (a total order, NULLs first), exactly: the first
    ``n`` of the descending order, in which NULLs come last."""
    return _cut(df, n, order_by, True)
