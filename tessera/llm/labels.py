"""Labelled training rows: folds by id and a bounded sample."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import _q


_HASHES = 1 << 60


def fold(id_col: str, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds`` (null for a null id)."""
    return F.pmod(F.crc32(_q(id_col).cast("string").cast("binary")), F.lit(folds))


def held_out(id_col: str, folds: int, fold_out: int) -> Column:
    return F.coalesce(fold(id_col, folds) == fold_out, F.lit(False))


def labels_outside(labels: DataFrame, label_col: str, folds: int, fold_out: int, id_col: str = "doc_id") -> DataFrame:
    """``(id, label)`` rows outside the held-out fold. Labels other than 0 and 1 and null ids do not count."""
    lab = labels.select(_q(id_col).alias("id"), _q(label_col).cast("int").alias("label"))
    return lab.where(F.col("label").isin(0, 1) & F.col("id").isNotNull()).where(fold("id", folds) != fold_out)


def largest(lab: DataFrame) -> DataFrame:
    """One label for each id, the largest."""
    return lab.groupBy("id").agg(F.max("label").alias("label"))


def labelled_sample(docs: DataFrame, labels: DataFrame, label_col: str, folds: int, fold_out: int, max_rows: int,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, text, label)`` of labelled documents outside the held-out fold, one row per id and never more than
    ``max_rows``.

    Labels other than 0 and 1 and null ids do not count; several labels of one id count as the largest; of
    several texts of one id the one with the least hash (then the least text) stands for it, so an id on many
    rows weighs as much as any other. Ids are taken in the order of a hash, whatever the row order: the first
    ``max_rows`` labelled ids, of which those without a text then drop out.
    """
    lab = largest(labels_outside(labels, label_col, folds, fold_out, id_col))
    # about twice max_rows pass the hash threshold, so the limit merges few rows; the parameter bounds the broadcast
    h = F.pmod(F.xxhash64("id"), F.lit(_HASHES))
    under = min(_HASHES, -(-2 * max_rows * _HASHES // max(lab.count(), 1)))
    chosen = lab.where(h < F.lit(under)).orderBy(h, "id").limit(max_rows)
    texts = docs.select(_q(id_col).alias("id"), _q(text_col).alias("text")).where("text is not null")
    one = texts.join(F.broadcast(chosen), "id").groupBy("id", "label").agg(
        F.min(F.struct(F.xxhash64("text").alias("h"), "text")).alias("t"))
    return one.select("id", F.col("t.text").alias("text"), "label")
