"""Text-to-number cleaning as native Column expressions (SC1-SC8, SC17, PRJ3). No UDFs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Whitespace removed by the reference's strip().
_WS = " \t\n\r\x0b\x0c"


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def rstrip_chars(c: str | Column, chars: str = "%") -> Column:
    """SC5: remove every trailing occurrence of the given characters."""
    return F.rtrim(_c(c), F.lit(chars))


def strip_ws(c: str | Column) -> Column:
    """SC6: strip leading and trailing whitespace."""
    return F.btrim(_c(c), F.lit(_WS))


def parse_emp_length(c: str | Column) -> Column:
    """SC1: employment-length text to years.

    NULL or exactly ``'n/a'`` -> NULL; lower-case, drop ``years`` then ``year``, strip;
    ``'< 1'`` -> 0.5; ``'10+'`` -> 10.0; anything else is parsed as a number (NULL if not one).
    """
    col = _c(c)
    s = strip_ws(F.replace(F.replace(F.lower(col), F.lit("years"), F.lit("")), F.lit("year"), F.lit("")))
    num = s.try_cast("double")
    parsed = (F.when(s == "< 1", F.lit(0.5))
              .when(s == "10+", F.lit(10.0))
              .otherwise(F.nanvl(num, F.lit(None).cast("double"))))
    return F.when(col.isNull() | (col == "n/a"), F.lit(None).cast("double")).otherwise(parsed)


def percent_strict(c: str | Column) -> Column:
    """SC2: percent text (or number) to a fraction; bad text raises under ANSI casting."""
    col = _c(c)
    return F.nanvl(rstrip_chars(col.cast("string")).cast("double"), F.lit(None).cast("double")) / F.lit(100.0)


def percent_lenient(c: str | Column) -> Column:
    """SC3 / SC8: percent text to a fraction; text that does not parse becomes NULL."""
    col = _c(c)
    v = strip_ws(rstrip_chars(col.cast("string"))).try_cast("double")
    return F.nanvl(v, F.lit(None).cast("double")) / F.lit(100.0)


def percent_number(c: str | Column) -> Column:
    """SC4 for text: the number in a percent text (``'13.56%'`` -> 13.56), NULL if not a number."""
    v = strip_ws(rstrip_chars(_c(c).cast("string"))).try_cast("double")
    return F.nanvl(v, F.lit(None).cast("double"))


def numeric_if_text(df: DataFrame, name: str) -> Column:
    """SC4: percent text to a number (no scaling) only if the column is text; numbers pass.

    Decided at plan time from the schema, like the source's runtime dtype test."""
    if isinstance(df.schema[name].dataType, T.StringType):
        return percent_number(name).alias(name)
    return F.col(name).cast("double").alias(name)


def binary_target(c: str | Column, positive: str = "Charged Off") -> Column:
    """PRJ3: 1 for the positive status, 0 for everything else including NULL."""
    return F.when(_c(c).eqNullSafe(F.lit(positive)), F.lit(1)).otherwise(F.lit(0))


def id_text(c: str | Column) -> Column:
    """SC7: stringify a row id; NULL becomes the text ``nan`` as in the source."""
    return F.coalesce(_c(c).cast("string"), F.lit("nan"))
