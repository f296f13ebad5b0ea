"""Small Column helpers (SC10-SC16, FLT9)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def pct(part: Column, whole: Column) -> Column:
    """SC12: ``part / whole * 100``; NULL instead of an error when ``whole`` is 0."""
    return F.try_divide(part.cast("double"), whole.cast("double")) * F.lit(100.0)


def status_text(passed: Column, yes: str = "PASSED", no: str = "FAILED") -> Column:
    """SC13: status word from a boolean (NULL counts as failed)."""
    return F.when(F.coalesce(passed, F.lit(False)), F.lit(yes)).otherwise(F.lit(no))


def clip(c: str | Column, lower: float | Column | None = None,
         upper: float | Column | None = None) -> Column:
    """FLT9: clip to [lower, upper]; NULL stays NULL (greatest/least would turn it into a bound)."""
    x = _c(c)
    y = x
    if lower is not None:
        y = F.greatest(y, lower if isinstance(lower, Column) else F.lit(float(lower)))
    if upper is not None:
        y = F.least(y, upper if isinstance(upper, Column) else F.lit(float(upper)))
    return F.when(x.isNotNull(), y)


def linspace(lo: float | Column, hi: float | Column, bins: int) -> Column:
    """SC16: ``bins + 1`` evenly spaced edges as an array column."""
    a, b = (x if isinstance(x, Column) else F.lit(float(x)) for x in (lo, hi))
    return F.transform(F.sequence(F.lit(0), F.lit(bins)), lambda i: a + i * ((b - a) / F.lit(float(bins))))


def join_names(c: str | Column, sep: str = ", ") -> Column:
    """SC15: join an array of names into one text."""
    return F.concat_ws(sep, _c(c))


def split_names(c: str | Column, sep: str = ",") -> Column:
    """SC15: split a comma list and strip each name."""
    return F.transform(F.split(_c(c), sep), lambda s: F.trim(s))
