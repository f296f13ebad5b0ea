"""Exact order statistics by narrowing brackets (AGG7, AGG13, ML1, SMP5, SMP2 / SMP3 ties).

An order statistic of a column is boxed in by two values and found by counting, without a shuffle, a
sort or a stored copy of the distinct values:

1. one pass makes a bounded sketch (``percentile_approx``) of every column; its values a little before
   and after each wanted rank make the bracket;
2. one pass counts, for every bracket, the rows before it, at its two ends and strictly inside, and
   brings the values inside along while there are few (``INSIDE`` expected at most). The wanted ranks are then
   at an end, or in the sorted values inside;
3. otherwise the values strictly inside are sketched and bracketed in turn. Each such round leaves a few
   ten-thousandths of the rows, so a table of 10^7 rows takes two passes, one of 10^11 rows four.

Counts are exact and compare native values, so the sketch's error only decides how narrow a bracket is. If a
rank turns out to lie outside its bracket, the bracket is opened to the column's end on that side. All
columns and ranks share each pass; a pass returns one row, whose size depends on the parameters only.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ACCURACY = 10_000
INSIDE = 20_000
MARGIN_ROWS = 4


@dataclass
class _Target:
    """Ranks wanted of one column. ``lo`` and ``hi`` enclose them; ``before`` rows come before ``lo``."""

    column: str
    ranks: tuple[int, ...]
    lo: object
    hi: object
    least: object
    most: object
    expected: float
    found: dict[int, object] = field(default_factory=dict)
    inside: tuple[int, int] | None = None  # rows up to and with lo, and strictly inside; when too many to bring along

    def open_ranks(self) -> list[int]:
        return [r for r in self.ranks if r not in self.found]


def order_statistics(df: DataFrame, columns: Mapping[str, Column], ranks_of, extra: Sequence[Column] = ()):
    """Values at 0-based ranks of the non-null values of each column, in ascending order.

    ``ranks_of(name, n)`` names the sets of ranks wanted of a column with ``n`` values, each set close together;
    with ``n`` None it names the share of the table at which each set lies. Returns
    ``({name: n}, {(name, rank): value}, row)``; ``row`` has the ``extra`` aggregates of ``df``, taken in the
    first pass. Columns must be of a numeric type without NaN, with values that a double holds exactly (the
    sketch works on doubles; integers up to 2**53): a value of many rows then is an end of its bracket."""
    src = df.select("*", *[c.alias(f"_x{i}") for i, c in enumerate(columns.values())])
    at = {name: f"_x{i}" for i, name in enumerate(columns)}
    fractions = {name: sorted({f for q in ranks_of(name, None) for f in _around(q, ACCURACY)}) for name in columns}
    aggs = []
    for name, x in at.items():
        aggs += [F.count(x).alias(f"{x}_n"), F.min(x).alias(f"{x}_lo"), F.max(x).alias(f"{x}_hi")]
        if fractions[name]:
            aggs.append(F.percentile_approx(x, fractions[name], ACCURACY).alias(f"{x}_q"))
    row = src.agg(*aggs, *extra).first()
    counts = {name: row[f"{x}_n"] for name, x in at.items()}
    targets = []
    for name, x in at.items():
        n = counts[name]
        if not n:
            continue
        sketch = dict(zip(fractions[name], row[f"{x}_q"] or []))
        wanted = ranks_of(name, n)
        for q, ranks in zip(ranks_of(name, None), wanted):
            low, high = _around(q, ACCURACY)
            lo, hi = sketch.get(low, row[f"{x}_lo"]), sketch.get(high, row[f"{x}_hi"])
            targets.append(_Target(name, tuple(ranks), min(lo, hi), max(lo, hi), row[f"{x}_lo"], row[f"{x}_hi"],
                                   6 * n / ACCURACY + MARGIN_ROWS))
    seen = None
    while todo := [t for t in targets if t.open_ranks()]:
        state = [(t.column, t.lo, t.hi, t.inside, t.expected, len(t.found)) for t in todo]
        if state == seen:
            raise ArithmeticError("brackets do not narrow: values are not exact as doubles")
        seen = state
        _count(src, at, [t for t in todo if t.inside is None])
        todo = [t for t in todo if t.open_ranks()]
        _narrow(src, at, [t for t in todo if t.inside is not None])
    return counts, {(t.column, r): v for t in targets for r, v in t.found.items()}, row


def _around(q: float, accuracy: int) -> tuple[float, float]:
    return max(0.0, q - 2 / accuracy), min(1.0, q + 2 / accuracy)


def _typed(src: DataFrame, x: str, v) -> Column:
    return F.lit(v).cast(src.schema[x].dataType)


def _count(src: DataFrame, at: Mapping[str, str], targets: list[_Target]) -> None:
    """Count around every bracket; settle the ranks at its ends and, where values came along, inside."""
    if not targets:
        return
    aggs = []
    for i, t in enumerate(targets):
        x, lo, hi = F.col(at[t.column]), _typed(src, at[t.column], t.lo), _typed(src, at[t.column], t.hi)
        within = (x > lo) & (x < hi)
        aggs += [F.count_if(x < lo).alias(f"a{i}"), F.count_if(x == lo).alias(f"b{i}"), F.count_if(within).alias(f"c{i}"),
                 F.count_if(x == hi).alias(f"d{i}")]
        if t.expected <= INSIDE:
            aggs.append(F.sort_array(F.collect_list(F.when(within, x))).alias(f"v{i}"))
    row = src.agg(*aggs).first()
    for i, t in enumerate(targets):
        before, first, inside, last = (row[f"{p}{i}"] for p in "abcd")
        lo, hi = t.lo, t.hi  # what was counted; a rank outside opens the target's bracket for the next pass
        if lo == hi:
            last = 0
        for r in t.open_ranks():
            if r < before:
                t.lo = t.least
            elif r < before + first:
                t.found[r] = lo
            elif r < before + first + inside:
                if t.expected <= INSIDE:
                    t.found[r] = row[f"v{i}"][r - before - first]
            elif r < before + first + inside + last:
                t.found[r] = hi
            else:
                t.hi = t.most
        left = t.open_ranks()
        if left and all(before + first <= r < before + first + inside for r in left):
            t.inside = (before + first, inside)
        elif left:
            t.expected = math.inf  # the bracket was opened: count it again before anything is brought along


def _narrow(src: DataFrame, at: Mapping[str, str], targets: list[_Target]) -> None:
    """Bracket the ranks among the values strictly inside."""
    if not targets:
        return
    aggs, asked = [], []
    for i, t in enumerate(targets):
        skip, n = t.inside
        left = [r - skip for r in t.open_ranks()]
        f = [max(0.0, min(left) / n - 2 / ACCURACY), min(1.0, (max(left) + 1) / n + 2 / ACCURACY)]
        x, lo, hi = F.col(at[t.column]), _typed(src, at[t.column], t.lo), _typed(src, at[t.column], t.hi)
        v = F.when((x > lo) & (x < hi), x)
        aggs += [F.percentile_approx(v, f, ACCURACY).alias(f"q{i}"), F.min(v).alias(f"lo{i}"), F.max(v).alias(f"hi{i}")]
        asked.append((f, n))
    row = src.agg(*aggs).first()
    for i, (t, (f, n)) in enumerate(zip(targets, asked)):
        t.least, t.most = row[f"lo{i}"], row[f"hi{i}"]
        t.lo = t.least if f[0] == 0 else row[f"q{i}"][0]
        t.hi = t.most if f[1] == 1 else row[f"q{i}"][1]
        t.expected, t.inside = 6 * n / ACCURACY + MARGIN_ROWS, None


def _double(c: Column) -> Column:
    """As double; NaN is missing, -0.0 is 0.0."""
    x = c.cast("double")
    return F.nanvl(x, F.lit(None).cast("double")) + F.lit(0.0)


def exact_percentiles(df: DataFrame, columns: Mapping[str, Column], qs: Sequence[float], extra: Sequence[Column] = ()):
    """Percentiles of several columns, linear between the two order statistics around ``q * (n - 1)``.
    Returns ``({(name, q): value}, row)``, without the columns that have no value; ``row`` as in
    ``order_statistics``."""
    def ranks(_, n):
        if n is None:
            return list(qs)
        return [{math.floor(q * (n - 1)), math.ceil(q * (n - 1))} for q in qs]

    counts, values, row = order_statistics(df, {k: _double(c) for k, c in columns.items()}, ranks, extra)
    out = {}
    for name, n in counts.items():
        for q in qs if n else ():
            p = q * (n - 1)
            lo, hi = values[name, math.floor(p)], values[name, math.ceil(p)]
            out[name, q] = lo + (p - math.floor(p)) * (hi - lo)
    return out, row


def kth_smallest(df: DataFrame, column: Column, k: int):
    """The value at 0-based rank ``k`` of a column (null if it has fewer values)."""
    n = df.agg(F.count(column).alias("n")).first()["n"]
    if not 0 <= k < n:
        return None
    return order_statistics(df, {"x": column}, lambda _, m: [k / max(n - 1, 1)] if m is None else [{k}])[1]["x", k]
