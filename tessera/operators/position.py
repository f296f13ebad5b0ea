"""Positional slices over an explicit total order (SLC1-SLC7, WIN4).

The source's notion of order is file order; here the caller names a total order key (e.g.
``issue_d, id``). Slices are predicates on the distributed row index of ``prefix.row_index``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .prefix import row_index
from .topn import first_rows, last_rows

def with_index(df: DataFrame, order_by: Sequence[str], name: str = "row_idx") -> DataFrame:
    """SLC6: 0-based position in ``order_by`` plus the table size ``n_rows`` on every row."""
    idx = row_index(df, order_by, name=name)
    n = df.select(F.count(F.lit(1))).scalar()
    return idx.withColumn("n_rows", n)


def chunk_count(n: F.Column, chunk: int) -> F.Column:
    """Number of chunks of ``chunk`` rows (the last one short): ceil(n / chunk)."""
    return F.ceil(n / F.lit(chunk))


def head_chunks(indexed: DataFrame, k: int, chunk: int, idx: str = "row_idx") -> DataFrame:
    """SLC1: rows of the first ``k`` chunks."""
    return indexed.filter(F.col(idx) < F.lit(k * chunk))


def tail_chunks(indexed: DataFrame, k: int, chunk: int, idx: str = "row_idx",
                n: str = "n_rows") -> DataFrame:
    """SLC2: rows of the last ``k`` chunks; the last chunk may be short, so the tail has
    ``n - chunk * (ceil(n / chunk) - k)`` rows."""
    return indexed.filter(F.floor(F.col(idx) / F.lit(chunk)) >= chunk_count(F.col(n), chunk) - k)


def head_fraction(indexed: DataFrame, fraction: float, idx: str = "row_idx",
                  n: str = "n_rows") -> DataFrame:
    """SLC4: the first ``floor(fraction * n)`` rows."""
    return indexed.filter(F.col(idx) < F.floor(F.lit(fraction) * F.col(n)))


def tail_fraction(indexed: DataFrame, fraction: float, idx: str = "row_idx",
                  n: str = "n_rows") -> DataFrame:
    """SLC4: the last ``floor(fraction * n)`` rows."""
    return indexed.filter(F.col(idx) >= F.col(n) - F.floor(F.lit(fraction) * F.col(n)))


def too_small(n_rows: F.Column, k: int, chunk: int) -> F.Column:
    """SLC5: fewer than ``2k`` chunks: head and tail slices would overlap."""
    return chunk_count(n_rows, chunk) < F.lit(2 * k)


def slices(df: DataFrame, order_by: Sequence[str], mode: str = "chunks", k: int = 2,
           chunk: int = 50000, fraction: float = 0.1) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Reference and current slices plus a one-row status frame (``OK`` or
    ``SKIPPED_TOO_SMALL``). ``mode='chunks'`` slices as the source does (first ``k`` chunks,
    last ``k`` chunks with a short last chunk); ``mode='fraction'`` takes the first and last
    ``fraction`` of rows, as its documentation says. The row count is one scalar action."""
    n = df.select(F.count(F.lit(1)).alias("n_rows"))
    if mode == "chunks":
        # exact first / last rows from narrowed candidates, no full sort
        total = n.first()["n_rows"]
        tail = total - chunk * (max(-(-total // chunk), k) - k) if total else 0
        ref = first_rows(df, k * chunk, order_by)
        cur = last_rows(df, max(tail, 0), order_by)
        status = n.select("n_rows", F.when(too_small(F.col("n_rows"), k, chunk), F.lit("SKIPPED_TOO_SMALL"))
                          .otherwise(F.lit("OK")).alias("status"))
        return ref, cur, status
    if mode == "fraction":
        ix = with_index(df, order_by)
        ref, cur = head_fraction(ix, fraction), tail_fraction(ix, fraction)
        status = n.select("n_rows", F.when(F.floor(F.lit(fraction) * F.col("n_rows")) < 1,
                                           F.lit("SKIPPED_TOO_SMALL")).otherwise(F.lit("OK")).alias("status"))
    else:
        raise ValueError(f"unknown slice mode {mode!r}")
    return ref.drop("row_idx", "n_rows"), cur.drop("row_idx", "n_rows"), status


def head_slice(df: DataFrame, order_by: Sequence[str], k: int, chunk: int) -> DataFrame:
    """SLC1 / SLC3: rows of the first ``k`` chunks, from narrowed candidates."""
    return first_rows(df, k * chunk, order_by)


def tail_slice(df: DataFrame, order_by: Sequence[str], k: int, chunk: int) -> DataFrame:
    """SLC2: rows of the last ``k`` chunks, the last chunk possibly short (one count action)."""
    total = df.count()
    tail = total - chunk * (max(-(-total // chunk), k) - k) if total else 0
    return last_rows(df, max(tail, 0), order_by)
