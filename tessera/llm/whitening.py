"""Whitening of embeddings: principal components by contour integration.

1. One pass sums counts, sums and products of the vectors' entries as whole numbers, so the covariance
   is exact however many tasks add to it: its entries are rounded once. Only these sums, a number
   for each pair of dimensions, reach the driver.
2. The covariance's largest eigenvalues are boxed in by inertia counts: the signs in a symmetric
   factorisation of the shifted matrix tell how many eigenvalues lie below the shift. Intervals are halved
   until each holds few. In each interval, a quadrature of the resolvent along a circle (solves with complex
   shifts) projects a random block onto the interval's eigenvectors; Rayleigh-Ritz extracts them; the block
   is refined until residuals are at rounding level and as many are found as the inertia counts say.
3. A second pass measures the covariance of the whitened vectors; the last writes them out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import _q, map_arrow, numbered

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 32
#: Scaled entries must be smaller, so that sums of products fit their three parts.
LARGEST = float(1 << 45)
PART = 40
#: Eigenvalues of an interval, points of the quadrature on half the circle, rounds of refinement.
PER_INTERVAL, POINTS, ROUNDS = 8, 8, 30


def eigenvalues_below(matrix: np.ndarray, shift: float) -> int:
    """How many eigenvalues of a symmetric matrix are below ``shift``: the negative ones of the blocks
    in a pivoted symmetric factorisation of the shifted matrix (inertia is kept by congruence)."""
    a = matrix - shift * np.eye(len(matrix))
    below, grow = 0, (1 + 17 ** 0.5) / 8
    while len(a):
        diag = np.abs(np.diag(a))
        p = int(diag.argmax())
        off = np.abs(a - np.diag(np.diag(a)))
        q, r = divmod(int(off.argmax()), len(a))
        if diag[p] >= grow * off[q, r]:
            rest = np.delete(np.arange(len(a)), p)
            pivot = a[p, p]
            below += pivot < 0
            if pivot:
                a = a[np.ix_(rest, rest)] - np.outer(a[rest, p], a[p, rest]) / pivot
            else:
                a = a[np.ix_(rest, rest)]
        else:
            rest = np.delete(np.arange(len(a)), [q, r])
            block = a[np.ix_([q, r], [q, r])]
            below += 1  # the off-diagonal entry outweighs the diagonal: one sign of each
            a = a[np.ix_(rest, rest)] - a[np.ix_(rest, [q, r])] @ np.linalg.solve(block, a[np.ix_([q, r], rest)])
        a = (a + a.T) / 2
    return int(below)


def _box(matrix: np.ndarray, low: float, high: float, wanted: int) -> list[tuple[float, float, int]]:
    """Intervals (from, to, eigenvalues) above ``low`` that hold the ``wanted`` largest eigenvalues."""
    n, tight = len(matrix), 1e-13 * high
    todo, out, found = [(low, high, n - eigenvalues_below(matrix, low))], [], 0
    while todo and found < wanted:
        a, b, count = todo.pop()
        if not count:
            continue
        if count <= PER_INTERVAL or b - a <= tight:
            out.append((a, b, count))
            found += count
            continue
        mid = (a + b) / 2
        above = n - eigenvalues_below(matrix, mid) - found
        todo += [(a, mid, count - above), (mid, b, above)]  # the upper half is taken first
    return out


def _project(matrix: np.ndarray, a: float, b: float, block: np.ndarray) -> np.ndarray:
    """The block projected onto eigenvectors of [a, b]: half-circle quadrature of the resolvent."""
    centre, radius = (a + b) / 2, (b - a) / 2
    out = np.zeros_like(block)
    for x, w in zip(*np.polynomial.legendre.leggauss(POINTS)):
        turn = radius * np.exp(1j * np.pi * (1 - x) / 2)
        out += (w / 2 * turn * np.linalg.solve((centre + turn) * np.eye(len(matrix)) - matrix, block)).real
    return out


def _extract(matrix: np.ndarray, basis: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rayleigh-Ritz: values, vectors and residual norms in the span of a block."""
    q, _ = np.linalg.qr(basis)
    values, turn = np.linalg.eigh(q.T @ matrix @ q)
    vectors = q @ turn
    return values, vectors, np.linalg.norm(matrix @ vectors - vectors * values, axis=0)


def interval_eigenpairs(matrix: np.ndarray, a: float, b: float, count: int, rng) -> tuple[np.ndarray, np.ndarray]:
    """All ``count`` eigenpairs with values from ``a`` to ``b``. The block grows when refinement stalls; a
    block as large as the matrix is the whole space, so the search ends."""
    n, norm = len(matrix), np.abs(matrix).sum(0).max()
    size = min(n, 2 * count + 8)
    # a little beyond the interval, for values at its ends
    pad = max((b - a) * 0.05, 1e-12 * norm)
    while True:
        block, best = rng.standard_normal((n, size)), np.inf
        for _ in range(ROUNDS):
            values, vectors, left = _extract(matrix, _project(matrix, a - pad, b + pad, block) if size < n else block)
            slack = 64 * n * np.finfo(float).eps * norm
            inside = np.flatnonzero((values >= a - slack) & (values <= b + slack))
            worst = left[inside].max(initial=0)
            if len(inside) >= count and worst <= slack:
                if len(inside) > count:  # values at the very ends: those nearest the middle
                    inside = inside[np.argsort(np.abs(values[inside] - (a + b) / 2))[:count]]
                return values[inside], vectors[:, inside]
            if worst >= best / 2 and len(inside) >= count:
                break
            best, block = (worst if len(inside) >= count else best), vectors
        if size == n:
            raise ArithmeticError(f"eigenpairs between {a} and {b} do not converge")
        size = min(n, 2 * size)


def largest_eigenpairs(matrix: np.ndarray, wanted: int, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest positive eigenvalues of a positive semidefinite matrix, falling, and their unit
    vectors (columns; the entry of largest size is positive). Values at rounding level count as zero, so
    there may be fewer. Raises ArithmeticError if what is found disagrees with the inertia counts."""
    n = len(matrix)
    top = float(np.abs(matrix).sum(1).max()) if n else 0.0  # no eigenvalue is larger
    if not top > 0:
        return np.zeros(0), np.zeros((n, 0))
    unit = matrix / top
    low = 64 * n * np.finfo(float).eps
    rng = np.random.Generator(np.random.PCG64(seed))
    found = [interval_eigenpairs(unit, a, b, count, rng)[1] for a, b, count in _box(unit, low, 1 + low, wanted)]
    if not found:
        return np.zeros(0), np.zeros((n, 0))
    values, vectors, left = _extract(unit, np.concatenate(found, 1))
    order = np.argsort(-values)[:wanted]
    values, vectors = values[order], vectors[:, order]
    if left.max() > 256 * n * np.finfo(float).eps or (len(values) and n - eigenvalues_below(unit, values[-1] - low) < len(values)) \
            or n - eigenvalues_below(unit, values[-1] + low) >= wanted:
        raise ArithmeticError("eigenpairs disagree with the inertia counts")
    sign = np.sign(vectors[np.abs(vectors).argmax(0), np.arange(len(values))])
    return values * top, vectors * sign


def _scaled(batch: pa.RecordBatch, column: int, d: int) -> np.ndarray:
    """The batch's vectors as whole numbers (without the shift), a float row each."""
    return np.floor(SCALE * batch.column(column).flatten().to_numpy(zero_copy_only=False).reshape(-1, d))


def _usable(vector: Column) -> Column:
    """Not null, and no entry is null, infinite, NaN or beyond LARGEST."""
    bad = F.exists(vector, lambda x: F.coalesce(F.isnan(x) | (F.abs(x) >= F.lit(LARGEST / SCALE)), F.lit(True)))
    return vector.isNotNull() & ~bad


def _clean(df: DataFrame, id_col: str, vector_col: str) -> tuple[DataFrame, int, int]:
    """``(id, v)`` of the usable vectors of the commonest length, their number and that length."""
    src = df.select(_q(id_col).alias("id"), _q(vector_col).cast("array<double>").alias("v"))
    src = src.where(F.coalesce(_usable(F.col("v")), F.lit(False)))
    top = src.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n")).agg(F.max(F.struct("n", "d")).alias("m")).first()["m"]
    n, d = (top["n"], top["d"]) if top else (0, 0)
    return src.where(F.size("v") == d), n, d


def _products(x: np.ndarray) -> np.ndarray:
    """Sums of products of all pairs of columns, exact: in floats where they cannot round, else in
    whole numbers of any size."""
    x = np.concatenate((np.ones((len(x), 1)), x), 1)
    most = float(np.abs(x).max()) ** 2
    if most >= 2.0 ** 53:
        big = x.astype(np.int64).astype(object)
        return big.T @ big
    rows = max(1, int(2.0 ** 53 / most))
    return sum(((p := x[i:i + rows]).T @ p).astype(np.int64).astype(object) for i in range(0, len(x), rows))


def exact_moments(clean: DataFrame, d: int) -> np.ndarray:
    """Sums of products of the scaled entries, with a leading constant 1, as Python whole numbers: entry
    (0, 0) is the count, (0, i) the sums. A task sends three longs for each pair of dimensions."""
    schema = T.StructType([T.StructField("i", T.IntegerType()), *[T.StructField(p, T.ArrayType(T.LongType())) for p in "abc"]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for b in batches:
            if b.num_rows:
                p = _products(_scaled(b, 0, d))
                total = p if total is None else total + p
        if total is None:
            return
        for i in range(d + 1):
            row, mask = total[i, :i + 1].tolist(), (1 << PART) - 1
            parts = [[v >> 2 * PART for v in row], [v >> PART & mask for v in row], [v & mask for v in row]]
            yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), *[pa.array([p], pa.list_(pa.int64())) for p in parts]],
                                             names=["i", "a", "b", "c"])

    cells = (clean.select("v").mapInArrow(run, schema)
             .select("i", F.posexplode(F.arrays_zip("a", "b", "c")).alias("j", "p"))
             .groupBy("i", "j").agg(*[F.sum(F.col(f"p.{p}")).alias(p) for p in "abc"]))
    out = np.zeros((d + 1, d + 1), object)
    for r in cells.collect():  # a row for each pair of dimensions
        out[r["i"], r["j"]] = out[r["j"], r["i"]] = (r["a"] << 2 * PART) + (r["b"] << PART) + r["c"]
    return out


def covariance(moments: np.ndarray) -> np.ndarray:
    """(n * sums of products - products of sums) / n**2: the centred sums over n, rounded once."""
    n, s = moments[0, 0], moments[0, 1:]
    exact = n * moments[1:, 1:] - np.outer(s, s)
    return np.array([[float(_ratio(v, n * n)) for v in row] for row in exact.tolist()]).reshape(len(s), len(s))


def _ratio(a: int, b: int) -> float:
    return a / b  # correctly rounded for whole numbers of any size


def _identity_error(clean: DataFrame, d: int, mean: np.ndarray, turn: np.ndarray) -> float:
    """Largest absolute entry of the whitened vectors' covariance minus the identity, from one pass."""
    k = turn.shape[1]
    schema = T.StructType([T.StructField("s", T.ArrayType(T.DoubleType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k + 1, k + 1))
        for b in batches:
            w = np.concatenate((np.ones((b.num_rows, 1)), (_scaled(b, 0, d) - mean) @ turn), 1)
            total += w.T @ w
        yield pa.RecordBatch.from_arrays([pa.array([total.ravel().tolist()], pa.list_(pa.float64()))], names=["s"])

    sums = clean.select("v").mapInArrow(run, schema).select(F.posexplode("s").alias("i", "x")).groupBy("i").agg(F.sum("x").alias("x"))
    m = np.zeros((k + 1) ** 2)
    for r in sums.collect():  # a row for each pair of components
        m[r["i"]] = r["x"]
    m = m.reshape(k + 1, k + 1) / m[0]
    return float(np.abs(m[1:, 1:] - np.outer(m[0, 1:], m[0, 1:]) - np.eye(k)).max())


def whiten(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """One row per usable vector and component: ``id_col``, ``component`` (from 1, by falling eigenvalue), ``n``
    (vectors fitted), ``deviation`` (sum over dimensions of (n * x - S)**2, exact; null where no long holds it),
    ``whitened``, ``explained`` (share of the covariance's trace) and ``identity_error`` (one value).

    An entry c becomes x = floor(64 * c) + 1,000,000; all usable vectors are fitted. Vectors that are null or
    hold a null, NaN or infinite entry are dropped, and entries beyond 2**39, which the exact sums do not
    hold; so are vectors of another length than the commonest (ties: the longest). Repeated rows are rows of
    their own and null ids pass through. Components whose eigenvalue is zero to rounding are left
    out, so an empty table, a single vector and equal vectors give no rows. Other columns are ignored.
    Memory on the driver and in a task is a number for each pair of dimensions.
    """
    clean, n, d = _clean(df, id_col, vector_col)
    schema = T.StructType([T.StructField(id_col, clean.schema["id"].dataType), T.StructField("component", T.IntegerType()), T.StructField("n", T.LongType()),
                           T.StructField("deviation", T.LongType()), T.StructField("whitened", T.DoubleType()),
                           T.StructField("explained", T.DoubleType()), T.StructField("identity_error", T.DoubleType())])
    if not n or not d:
        return df.sparkSession.createDataFrame([], schema)
    moments = exact_moments(clean, d)
    cov = covariance(moments)
    values, vectors = largest_eigenpairs(cov, components)
    if not len(values):
        return df.sparkSession.createDataFrame([], schema)
    sums = moments[0, 1:]
    mean = np.array([_ratio(s, n) for s in sums])
    turn, explained = vectors / np.sqrt(values), values / np.trace(cov)
    error = _identity_error(clean, d, mean, turn)
    k, longs = len(values), np.array([s if abs(s) < 1 << 62 else 0 for s in sums], np.int64)
    small = max(abs(s) for s in sums) < 1 << 62

    def deviations(x: np.ndarray) -> list:
        """Exact; in longs where nothing can overflow."""
        if small and float(n) * np.abs(x).max(initial=0) + float(np.abs(longs).max()) < (2.0 ** 62 / d) ** 0.5:
            return ((n * x.astype(np.int64) - longs) ** 2).sum(1)
        big = ((n * x.astype(np.int64).astype(object) - sums) ** 2).sum(1).tolist()
        return [v if v < 1 << 63 else None for v in big]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema
        arrow = to_arrow_schema(numbered(schema))
        for whole in batches:
            for at in range(0, whole.num_rows, 1024):
                b = whole.slice(at, 1024)
                m = b.num_rows
                x = _scaled(b, 1, d)
                row = pa.array(np.repeat(np.arange(m), k))
                cols = [b.column(0).take(row), np.tile(np.arange(1, k + 1, dtype=np.int32), m), np.full(m * k, n, np.int64),
                        pa.array(deviations(x), pa.int64()).take(row), ((x - mean) @ turn).ravel(), np.tile(explained, m),
                        np.full(m * k, error)]
                yield pa.RecordBatch.from_arrays([(c if isinstance(c, pa.Array) else pa.array(c)).cast(f.type)
                                                  for c, f in zip(cols, arrow)], schema=arrow)

    return map_arrow(clean, run, schema)
