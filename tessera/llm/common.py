"""Small helpers shared by the operators: Arrow row mapping, word hashes, table reading."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

_U = np.uint64


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The given parquet table (a file or a folder; any path Spark can read)."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship_package(spark: SparkSession) -> None:
    """Give the executors this package's code, once per context (Spark hands the file out itself), so
    that queries run wherever the driver can import the package."""
    import atexit
    import os
    import shutil
    import tempfile
    import zipfile
    sc = spark.sparkContext
    if getattr(sc, "_package_shipped", False):
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    folder = tempfile.mkdtemp(prefix="code-")  # on the driver; it serves the file as long as it lives
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    path = os.path.join(folder, f"{os.path.basename(root)}_code.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for at, _, names in os.walk(root):
            for full in (os.path.join(at, n) for n in sorted(names) if n.endswith(".py")):
                z.write(full, os.path.relpath(full, os.path.dirname(root)))
    sc.addPyFile(path)
    sc._package_shipped = True


def map_texts(df: DataFrame, text_col: str, keep: list[str], out: T.StructType,
              start: Callable[[], Callable[[list], dict]]) -> DataFrame:
    """One output row per input row: the ``keep`` columns and the ``out`` columns.

    ``start()`` runs once per task and returns the function that maps a list of texts (None for
    a null) to a dict of columns. An ``out`` column replaces a kept column of the same name; all
    other columns pass through untouched.
    """
    kept = [c for c in keep if c not in out.fieldNames()]
    schema = T.StructType([df.schema[c] for c in kept] + list(out))
    names = out.fieldNames()
    src = df.select(*[_q(c) for c in kept], _q(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema
        arrow, fn = to_arrow_schema(numbered(schema)), start()
        for b in batches:
            for at in range(0, b.num_rows, 512):
                part = b.slice(at, 512)
                made = fn(part.column(len(kept)).to_pylist())
                cols = [part.column(i).cast(arrow.field(i).type) for i in range(len(kept))]
                cols += [_array(made[n], arrow.field(len(kept) + j).type) for j, n in enumerate(names)]
                yield pa.RecordBatch.from_arrays(cols, schema=arrow)

    return map_arrow(src, run, schema)


def numbered(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f"c{i}", f.dataType) for i, f in enumerate(schema)])


def map_arrow(df: DataFrame, run, schema: T.StructType) -> DataFrame:
    """``mapInArrow`` for columns of any names: inside, they are called c0, c1 and so on."""
    return df.toDF(*[f"c{i}" for i in range(len(df.columns))]).mapInArrow(run, numbered(schema)).toDF(*schema.names)


def _array(values, kind):
    return values if isinstance(values, pa.Array) else pa.array(values, kind)


def _q(name: str):
    """A column by its literal name (dots and blanks included)."""
    from pyspark.sql import functions as F
    return F.col("`" + name.replace("`", "``") + "`")


def rows_out(schema: T.StructType, rows: Iterable[tuple], per_batch: int = 4096) -> Iterator[pa.RecordBatch]:
    """Arrow batches of bounded length from tuples."""
    from pyspark.sql.pandas.types import to_arrow_schema
    arrow = to_arrow_schema(schema)
    held: list[tuple] = []

    def batch():
        cols = zip(*held)
        return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(cols, arrow)], schema=arrow)

    for r in rows:
        held.append(r)
        if len(held) >= per_batch:
            yield batch()
            held.clear()
    if held:
        yield batch()


def mix64(h: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    h = (h ^ (h >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> _U(27))) * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


class ByteHasher:
    """64-bit hashes of many byte ranges of one buffer at once.

    A range's hash is the mixed polynomial sum of its bytes (each byte through a fixed random
    table) in an odd base modulo 2**64, from one prefix sum over the buffer.
    """

    def __init__(self, seed: int = 1):
        rng = np.random.Generator(np.random.PCG64(seed))
        self.of_byte = rng.integers(1, 2**63, 256, dtype=np.uint64) * _U(2) + _U(1)
        self.base = int(rng.integers(2**62, 2**63)) * 2 + 1
        self.inverse = pow(self.base, -1, 2**64)
        self.up = self.down = np.ones(1, _U)

    def powers(self, n: int) -> None:
        if len(self.up) < n:
            n = max(n, 2 * len(self.up))
            for name, b in (("up", self.base), ("down", self.inverse)):
                p = np.full(n, b, _U)
                p[0] = 1
                setattr(self, name, np.multiply.accumulate(p))

    def ranges(self, buf: np.ndarray, start: np.ndarray, end: np.ndarray, block: int = 1 << 20,
               lengths: tuple[int, ...] = ()) -> np.ndarray:
        """Hashes of ``buf[start:end]`` for ranges in order that do not overlap; ``buf`` is uint8.
        With ``lengths``, a row for each range and a column for each length: the hash of the range's
        first so many bytes at most. Works in blocks, so tables stay small for any length of text."""
        out = np.empty((len(start), max(1, len(lengths))), _U)
        at = 0
        while at < len(start):
            to = max(at + 1, int(np.searchsorted(start, start[at] + block)))
            low, part = start[at], buf[start[at]:end[to - 1]]
            self.powers(len(part) + 1)
            total = np.zeros(len(part) + 1, _U)
            np.cumsum(self.of_byte[part] * self.up[:len(part)], out=total[1:])
            s, e = start[at:to] - low, end[at:to] - low
            head, scale = total[s], self.down[s]
            for j, n in enumerate(lengths or (None,)):
                out[at:to, j] = mix64((total[e if n is None else np.minimum(e, s + n)] - head) * scale)
            at = to
        return out if lengths else out[:, 0]


def word_hashes(buf: np.ndarray, start: np.ndarray, end: np.ndarray, seed: int = 0) -> np.ndarray:
    """64-bit hashes of the byte ranges ``buf[start:end]`` (``buf`` is uint8), for telling words apart: eight bytes
    at a time are mixed in by a bijection that is not linear, so no pattern of bytes collides by itself.
    Ranges of over 64 bytes are hashed one by one."""
    import xxhash
    size = (end - start).astype(np.int64)
    out = mix64(size.astype(_U) + _U(0x9E3779B97F4A7C15 * (2 * seed + 1) & 0xFFFFFFFFFFFFFFFF))
    padded = np.concatenate((buf, np.zeros(8, np.uint8)))
    lanes = np.lib.stride_tricks.as_strided(padded[:8].view(_U), (max(1, len(buf)),), (1,), writeable=False)
    keep = np.array([(1 << 8 * k) - 1 for k in range(9)], _U)
    for lane in range(8):
        some = np.flatnonzero((size > 8 * lane) & (size <= 64))
        if not len(some):
            continue
        word = lanes[start[some] + 8 * lane] & keep[np.minimum(size[some] - 8 * lane, 8)]
        out[some] = mix64((out[some] ^ word) * _U(0xD6E8FEB86659FD93) + _U(lane + 1))
    for i in np.flatnonzero(size > 64).tolist():
        out[i] = xxhash.xxh64_intdigest(buf[start[i]:end[i]].tobytes(), seed)
    return out


def word_spans(buf: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end offsets of the maximal runs of bytes whose table entry is true."""
    inside = is_word[buf]
    edge = np.flatnonzero(np.diff(np.concatenate(([False], inside, [False])).astype(np.int8)))
    return edge[::2], edge[1::2]


def byte_table(spec: Callable[[int], bool]) -> np.ndarray:
    return np.array([spec(b) for b in range(256)])


#: Bytes of words split at ASCII blanks: everything but space, tab, newline, VT, FF, CR.
NOT_BLANK = byte_table(lambda b: b not in (9, 10, 11, 12, 13, 32))
