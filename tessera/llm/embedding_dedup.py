"""Embedding near-duplicates by collision-counting projections.

Unit vectors are projected on many random lines. Each of ``L`` lists sorts the vectors by one
projection, within cells that ``K`` further projections cut out (without cells, one-dimensional
windows alone would meet a fixed share of all pairs, which grows with the square of the input). Around each vector of a list
stands a window of fixed half-width; a pair collides in a list when both fall in one cell and in
each other's window. Collisions are counted per pair over all lists, pairs with ``MIN_COUNT`` or more
are verified by their cosine in double precision, so no pair below the threshold is ever linked.

Calibration: the chance ``p`` that a pair exactly at the threshold collides in one list follows from
the normal distribution of projections. ``K`` grows with the logarithm of the largest group, so
that chance meetings per vector stay few; ``L`` is the least number of lists for which a pair at the
threshold reaches the count with probability ``RECALL`` (closer pairs reach it more surely).

Equal vectors of one label collapse first: only distinct vectors are projected, whatever the size
of a group of copies.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import checkpoint_dir
from .common import _q, mix64
from .components import connected_components

CELL = 2.0        # width of a cell, in standard deviations of a projection
MIN_COUNT = 2
RECALL = 0.98
_FAR = 0.48       # chance that unrelated unit vectors share a cell of this width on one line


def calibrate(cosine: float, largest: int) -> tuple[int, int, float]:
    """(K, L, half-width of a window) for a threshold and the largest group."""
    apart = math.sqrt(max(1e-12, 2 - 2 * cosine))          # distance of a pair at the threshold
    half = 2 * apart
    near = 1 - apart * math.sqrt(2 / math.pi) / CELL         # both in one cell of one line, at most CELL apart
    in_window = math.erf(half / apart / math.sqrt(2))
    k = max(1, round(math.log(max(largest, 2) / 2) / -math.log(_FAR)))
    p = max(near, 0.05) ** k * in_window
    lists = MIN_COUNT
    while 1 - sum(math.comb(lists, i) * p ** i * (1 - p) ** (lists - i) for i in range(MIN_COUNT)) < RECALL:
        lists += max(1, lists // 16)
    return k, lists, half


def _project(vectors: np.ndarray, k: int, lists: int, seed: int = 9) -> tuple[np.ndarray, np.ndarray]:
    """Cell codes and sort projections of unit vectors, a column for each list."""
    rng = np.random.Generator(np.random.PCG64([seed, vectors.shape[1]]))
    lines = rng.normal(size=(vectors.shape[1], lists * (k + 1)))
    shift = rng.uniform(0, CELL, lists * (k + 1))
    p = (vectors @ lines).reshape(len(vectors), lists, k + 1)
    cell = np.floor((p[:, :, :k] + shift.reshape(1, lists, k + 1)[:, :, :k]) / CELL).astype(np.int64).astype(np.uint64)
    code = np.zeros(cell.shape[:2], np.uint64)
    for j in range(k):
        code = mix64(code * np.uint64(31) + cell[:, :, j] + np.uint64(j + 1))
    return code.view(np.int64), p[:, :, k]


def _entries(k: int, lists: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            node, dims = b.column(0).to_numpy(), b.column(2).to_numpy()
            group = b.column(1).to_numpy().view(np.uint64)
            for d in np.unique(dims):
                at = np.flatnonzero(dims == d)
                rows = b.column(3).take(pa.array(at))
                for lo in range(0, len(at), 1024):
                    part = at[lo:lo + 1024]
                    v = rows.slice(lo, 1024).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(part), -1)
                    v /= np.abs(v).max(1, keepdims=True)
                    v /= np.sqrt((v * v).sum(1, keepdims=True))
                    code, p = _project(v, k, lists)
                    key = mix64(code.view(np.uint64) + mix64(group[part])[:, None] + np.arange(1, lists + 1, dtype=np.uint64))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(key.view(np.int64).ravel()), pa.array(p.ravel()), pa.array(np.repeat(node[part], lists))],
                        names=["key", "at", "node"])
    return run


def _collisions(half: float):
    """Pairs of a partition sorted by (key, projection) within the window, a batch at a time; what may
    still meet later rows is carried over."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = at = node = None
        for b in batches:
            new = [b.column(i).to_numpy() for i in range(3)]
            old = 0 if key is None else len(key)
            if old:
                new = [np.concatenate(x) for x in zip((key, at, node), new)]
            key, at, node = new
            left, step, n = np.arange(len(key)), 1, len(key)
            while True:
                left = left[left + step < n]
                left = left[(key[left + step] == key[left]) & (at[left + step] - at[left] <= half)]
                if not len(left):
                    break
                use = left[left + step >= old]  # pairs of carried rows are out already
                if len(use):
                    a, c = node[use], node[use + step]
                    yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, c)), pa.array(np.maximum(a, c))], names=["a", "b"])
                step += 1
            keep = (key == key[-1]) & (at >= at[-1] - half)
            key, at, node = key[keep], at[keep], node[keep]
    return run


def near_links(classes: DataFrame, cosine: float) -> DataFrame:
    """Linked pairs ``(a, b)``, ``a < b``, of ``classes(node, grp, dims, vector)``: equal groups, cosine of at
    least ``cosine``. ``grp`` is a long that differs between groups."""
    largest = classes.groupBy("grp").count().agg(F.max("count")).first()[0] or 0
    k, lists, half = calibrate(cosine, largest)
    entries = (classes.select("node", "grp", "dims", "vector").mapInArrow(_entries(k, lists), "key long, at double, node long")
               .repartition("key").sortWithinPartitions("key", "at"))
    counted = (entries.mapInArrow(_collisions(half), "a long, b long").groupBy("a", "b").agg(F.count("*").alias("n"))
               .where(F.col("n") >= MIN_COUNT))
    one = classes.select(F.col("node").alias("a"), F.col("grp").alias("ga"), F.col("vector").alias("va"))
    two = classes.select(F.col("node").alias("b"), F.col("grp").alias("gb"), F.col("vector").alias("vb"))
    dot = "aggregate(zip_with({0}, {1}, (x, y) -> double(x) * double(y)), 0D, (s, x) -> s + x)"
    cos = F.expr(f"{dot.format('va', 'vb')} / (sqrt({dot.format('va', 'va')}) * sqrt({dot.format('vb', 'vb')}))")
    return (counted.join(one, "a").join(two, "b").where("ga = gb and size(va) = size(vb)").where(cos >= cosine).select("a", "b"))


def embedding_groups(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                     cosine: float = 0.93) -> DataFrame:
    """One row per row of ``vectors``: the id, ``n_links`` (other rows linked directly), ``component_id``
    (smallest id reachable by links, its own included) and ``kept`` (id equals component id).

    Rows link when their labels are equal and their vectors have the same length and a cosine of at
    least ``cosine``. A null label, and a vector that is null, empty, zero or holds a null or non-finite
    component, links with nothing. Equal vectors link with each other; repeated rows are rows of
    their own; null ids take part, and a component of null ids has a null id and is kept. Recall
    for pairs exactly at the threshold is ``RECALL``; all links reported are exact. An empty table
    gives no rows; other columns are ignored.
    """
    checkpoint_dir(vectors.sparkSession)
    src = vectors.select(_q(id_col).alias("id"), _q(vector_col).alias("vector"), _q(label_col).alias("label"))
    finite = "forall(vector, x -> x is not null and not isnan(x) and abs(double(x)) < double('Infinity'))"
    good = F.expr(f"coalesce(label is not null and size(vector) > 0 and {finite} and exists(vector, x -> x <> 0), false)")
    src = src.withColumn("good", good)
    classes = (src.where("good").groupBy("label", "vector").agg(F.min("id").alias("low"), F.count("*").alias("n"))
               .withColumn("node", F.monotonically_increasing_id()).withColumn("dims", F.size("vector"))
               .withColumn("grp", F.xxhash64("label", "dims")).checkpoint())
    links = near_links(classes, cosine).checkpoint()
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    size = classes.select(F.col("node").alias("b"), "n")
    direct = both.join(size, "b").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("others"))
    roots = connected_components(links)
    named = (classes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
             .join(direct, "node", "left"))
    lows = named.groupBy("root").agg(F.min("low").alias("component_id"))
    found = named.join(lows, "root").select(
        "label", "vector", F.lit(True).alias("good"), "component_id",
        (F.coalesce("others", F.lit(0)) + F.col("n") - 1).alias("n_links"))
    out = src.join(found, ["label", "vector", "good"], "left")
    component = F.when(F.col("good"), F.col("component_id")).otherwise(F.col("id"))
    return out.select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"))
