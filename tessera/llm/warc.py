"""Sharded WARC archives: deterministic writer and reader.

Writing, one shuffle of the payloads:

1. A light table (id, URL, payload digest, size) is cut by a reliable checkpoint. Of the records with one
   payload the last by (id, URL) keeps it, all others revisit it. A revisit needs no payload, so revisits are
   made from the light table. Payloads held by over a thousandth of all records, fewer than ``HEAVY``, are
   broadcast and their copies dropped before the shuffle; other copies are dropped where they arrive.
2. Records are range-sorted by (id, digest, URL). The bounds come from a sample of the keys by their hash,
   so they depend on the rows alone, not on how Spark split them. Revisits by repeated rows are counted
   and cut into stretches, so a row repeated any number of times is spread like other rows.
3. A task streams one range: marks of payloads to drop sort before them, so no join meets the payloads.
   Headers and digests are made anew from the payload; every record is one gzip member; a file is
   closed when its compressed size passes ``file_bytes``. Files have names that no other attempt uses.
4. Only the attempts that Spark commits are listed in the manifest. Their files are then renamed to
   ``part-<shard>-<number>.warc.gz``, and the manifest is renamed last: without it there is no archive.
   Every step may be run again. Readers open what the manifest lists, nothing else.

The same rows give the same files, byte for byte.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import checkpoint_dir
from .common import _q

FILE_BYTES = 1 << 30
#: Bytes of a shard: a 256th of the table, within these bounds.
SHARD_BYTES = (4 << 20, 4 << 30)
#: Keys sampled for each shard, and in all at most.
SAMPLE_PER_SHARD = 32
MAX_SAMPLE = 1_000_000
#: Payloads whose copies are marked by broadcast, at most.
HEAVY = 1000
#: Fixed values of the format.
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END = b"\r\n\r\n"
#: Revisits of repeated rows that one row stands for, at most.
STRETCH = 10_000


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode("ascii")


def _record_id(*of) -> str:
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.sha256(repr(of).encode()).digest()[:16], version=5)}>"


def _header(name: str, value) -> str:
    """A header line; line breaks and other control characters of the value are percent-encoded."""
    text = "".join(c if c >= " " and c != "\x7f" else "".join(f"%{b:02X}" for b in c.encode()) for c in str(value))
    return f"{name}: {text}\r\n"


def record(rid, url, size: int, digest: str, date: str, number: int, payload: bytes | None, refers=None) -> bytes:
    """One record: a response with its payload, or a revisit (``payload`` None) of the response of the id
    ``refers``. Both begin with the payload's HTTP header, which states its length."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http if payload is None else http + payload
    lines = [VERSION + "\r\n", _header("WARC-Type", "revisit" if payload is None else "response"),
             _header("WARC-Record-ID", _record_id(rid, url, digest, number)), _header("WARC-Date", date)]
    if url is not None:
        lines.append(_header("WARC-Target-URI", url))
    if rid is not None:
        lines.append(_header("WARC-Source-ID", rid))
    if payload is None:
        lines += [_header("WARC-Profile", PROFILE), _header("WARC-Refers-To-Date", date)]
        if refers is not None:
            lines.append(_header("WARC-Refers-To-Source-ID", refers))
    lines += [_header("WARC-Payload-Digest", "sha1:" + digest), _header("WARC-Block-Digest", "sha1:" + payload_digest(block)),
              _header("Content-Type", "application/http; msgtype=response"), _header("Content-Length", len(block)), "\r\n"]
    return "".join(lines).encode("utf-8") + block + END


def member(data: bytes, level: int = 6) -> bytes:
    """A gzip member without time or name, so equal data gives equal bytes."""
    c = zlib.compressobj(level, zlib.DEFLATED, 31)
    return c.compress(data) + c.flush()


def _filesystem(path: str):
    """File system and path of a location that all executors share, by its scheme."""
    from pyarrow import fs
    if "://" not in path:
        return fs.LocalFileSystem(), path.removeprefix("file:")
    return fs.FileSystem.from_uri(path)


class _Roller:
    """Files of one task: closes a file when its compressed size passes the limit."""

    def __init__(self, folder: str, shard: int, attempt: str, limit: int, rows: list):
        self.fs, self.folder = _filesystem(folder)
        self.shard, self.attempt, self.limit = shard, attempt, limit
        self.out, self.number, self.rows = None, 0, rows

    def write(self, data: bytes) -> None:
        if self.out is None:
            self.name = f"part-{self.shard:06d}-{self.number:05d}.warc.gz"
            self.temp = f"_temporary/{self.attempt}/{self.name}"
            self.fs.create_dir(f"{self.folder}/_temporary/{self.attempt}", recursive=True)
            self.out = self.fs.open_output_stream(f"{self.folder}/{self.temp}", compression=None)
            self.size, self.records, self.sha = 0, 0, hashlib.sha256()
        self.out.write(data)
        self.sha.update(data)
        self.size, self.records = self.size + len(data), self.records + 1
        if self.size >= self.limit:
            self.close()

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.rows.append((self.shard, self.name, self.temp, self.records, self.size, self.sha.hexdigest()))
            self.out, self.number = None, self.number + 1


MANIFEST = T.StructType([T.StructField("shard", T.LongType()), T.StructField("name", T.StringType()),
                         T.StructField("temp", T.StringType()), T.StructField("records", T.LongType()),
                         T.StructField("bytes", T.LongType()), T.StructField("sha256", T.StringType())])


def _sortable(x) -> tuple:
    """Nulls come first."""
    return (0,) if x is None else (1, x)


def _bounds(keys: DataFrame, shards: int, n: int) -> list[tuple]:
    """First keys of the shards but the first: equal shares of the bytes of a sample chosen by hash."""
    share = min(1.0, min(SAMPLE_PER_SHARD * shards, MAX_SAMPLE) / max(n, 1))
    at = F.pmod(F.xxhash64("id", "sha", "url"), F.lit(1 << 30))
    rows = keys.where(at <= F.lit(int(share * (1 << 30)))).select("id", "sha", "url", "size").collect()
    rows = sorted(((_sortable(r["id"]), bytes(r["sha"]), _sortable(r["url"]), 0), r["size"]) for r in rows)
    total, run, out = sum(size for _, size in rows), 0, []
    for key, size in rows:
        if run * shards >= (len(out) + 1) * total and len(out) < shards - 1 and (not out or out[-1] < key):
            out.append(key)
        run += size
    return out


def _keepers(light: DataFrame, min_bytes: int) -> tuple[DataFrame, DataFrame]:
    """The distinct (id, sha, url) with their number of rows ``n``, the id ``refers`` that keeps their payload,
    whether it is their own row (``keeps``) and whether the payload is heavy; and the heavy ``sha``."""
    least = max(1, light.count() // HEAVY)
    keys = light.groupBy("id", "sha", "url", "digest", "bytes").agg(F.count("*").alias("n"))
    groups = (keys.groupBy("sha").agg(F.max(F.struct("id", "url")).alias("last"), F.sum("n").alias("copies"), F.max("bytes").alias("b"))
              .where((F.col("copies") > 1) & (F.col("b") >= min_bytes)).drop("b"))
    heavy = groups.where(F.col("copies") > least).select("sha", "last", F.lit(True).alias("heavy")).checkpoint()
    few = F.broadcast(heavy)  # fewer than HEAVY rows
    rest = groups.where(F.col("copies") <= least).select("sha", "last", F.lit(False).alias("heavy"))
    joined = keys.join(few, "sha").unionByName(keys.join(few.select("sha"), "sha", "left_anti").join(rest, "sha", "left"),
                                               allowMissingColumns=True)
    own = F.struct("id", "url").eqNullSafe(F.col("last"))
    alone = F.col("last").isNull()  # no other record has the payload, or it is below min_bytes
    return joined.select("id", "sha", "url", "digest", "bytes", "n", F.coalesce("heavy", F.lit(False)).alias("heavy"), alone.alias("alone"),
                         (alone | own).alias("keeps"), F.when(~alone, F.col("last.id")).alias("refers")), heavy


def write_warc(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
               min_bytes: int = 0, date: str = "1970-01-01T00:00:00Z", file_bytes: int = FILE_BYTES,
               shard_bytes: tuple[int, int] = SHARD_BYTES, level: int = 6) -> DataFrame:
    """Write one record per row below ``path`` (a folder that all executors share) and return the manifest:
    ``shard``, ``name``, ``temp`` (the name before the commit), ``records``, ``bytes`` and ``sha256`` of each file.

    The payload is the column's UTF-8; null and empty ones have 0 bytes. Of the records with equal payloads
    of at least ``min_bytes`` the one with the largest id (ties: the largest URL) is a response, the others
    revisit it; of rows repeated as a whole one is the response. Null ids and URLs sort first and their
    headers are left out; control characters in a URL are percent-encoded. An empty table gives an archive
    without files. Other columns are ignored, whatever their names. A task holds one Arrow batch of
    payloads at a time, so any payload that fits Spark's own rows is written whole.

    An archive that is complete is not written again: its manifest is returned.
    """
    from pyarrow.fs import FileType
    spark = pages.sparkSession
    fs, folder = _filesystem(path)
    if fs.get_file_info(f"{folder}/_manifest").type != FileType.NotFound:
        return spark.read.schema(MANIFEST).parquet(f"{path}/_manifest")
    checkpoint_dir(spark)
    payload = F.coalesce(_q(payload_col).cast("binary"), F.lit(b""))
    src = pages.select(_q(id_col).alias("id"), _q(url_col).cast("string").alias("url"), payload.alias("payload"))
    src = src.withColumn("sha", F.unhex(F.sha2("payload", 256)))
    light = src.select("id", "url", "sha", F.unhex(F.sha1("payload")).alias("digest"), F.length("payload").cast("long").alias("bytes")).checkpoint()
    keys, heavy = _keepers(light, min_bytes)
    keys = keys.checkpoint()
    size = F.when(F.col("keeps"), F.col("bytes")).otherwise(0) + 512 * F.col("n")
    got = keys.agg(F.count("*").alias("n"), F.coalesce(F.sum(size), F.lit(0)).alias("b")).first()
    shards = max(1, -(-got["b"] // min(max(got["b"] // 256, shard_bytes[0]), shard_bytes[1])))
    bounds = _bounds(keys.withColumn("size", size), shards, got["n"])
    rows = _stream(src, keys, heavy)

    @F.pandas_udf("int")
    def shard_of(ids, shas, urls, firsts):
        return ids.__class__([bisect_right(bounds, (_sortable(None if i != i else i), bytes(s), _sortable(u), f))
                              for i, s, u, f in zip(ids.astype(object).where(ids.notna(), None), shas, urls, firsts)], dtype="int32")

    dealt = (rows.withColumn("shard", shard_of("id", "sha", "url", "first")).repartitionById(len(bounds) + 1, F.col("shard"))
             .sortWithinPartitions("shard", "id", "sha", "url", "kind", "first"))
    names = ["shard", "id", "url", "sha", "payload", "kind", "digest", "bytes", "first", "n", "refers"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema
        out, done, dropped, number = None, None, None, 0
        for b in batches:
            cols = {n: b.column(i) for i, n in enumerate(names)}
            for i in range(b.num_rows):
                shard, rid, url, sha, data, kind, digest, size, first, n, refers = (cols[c][i].as_py() for c in names)
                if out is None or out.shard != shard:
                    if out:
                        out.close()
                    out = _Roller(path, shard, uuid.uuid4().hex, file_bytes, out.rows if out else [])
                key = (rid, sha, url)
                if kind == 0:
                    dropped = key
                elif kind == 1:
                    small = len(data) < min_bytes  # never revisited: repeated rows are responses all
                    if key == dropped or (key == done and not small):
                        continue
                    number, done = (number + 1 if key == done else 0), key
                    out.write(member(record(rid, url, len(data), payload_digest(data), date, number, data), level))
                elif kind == 2:
                    text = base64.b32encode(digest).decode("ascii")
                    for k in range(first, first + n):
                        out.write(member(record(rid, url, size, text, date, k + 1, None, refers), level))
        if out:
            out.close()
            yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*out.rows), to_arrow_schema(MANIFEST))],
                                             schema=to_arrow_schema(MANIFEST))

    dealt.select(*names).mapInArrow(run, MANIFEST).write.mode("overwrite").parquet(f"{path}/_manifest_new")
    return _commit(spark, path)


def _stream(src: DataFrame, keys: DataFrame, heavy: DataFrame) -> DataFrame:
    """Rows for the writer: kind 0 marks payloads to drop, 1 is a payload, 2 is a stretch of revisits."""
    kinds = dict(zip(("id", "refers"), [src.schema["id"].dataType] * 2))

    def row(df: DataFrame, kind: int, **of) -> DataFrame:
        types = {"url": "string", "sha": "binary", "payload": "binary", "digest": "binary", "bytes": "long", "first": "long", "n": "long", **kinds}
        return df.select(*[of.get(c, F.lit(None)).cast(t).alias(c) for c, t in types.items()], F.lit(kind).alias("kind"))

    key = {"id": F.col("id"), "sha": F.col("sha"), "url": F.col("url")}
    few = F.broadcast(heavy)  # fewer than HEAVY rows
    light = src.join(few.select("sha"), "sha", "left_anti")
    # one row of each heavy payload; partial aggregates keep one per task
    large = (src.join(few, "sha").where(F.struct("id", "url").eqNullSafe(F.col("last")))
             .groupBy("sha").agg(F.first("id").alias("id"), F.first("url").alias("url"), F.first("payload").alias("payload")))
    zero = F.lit(0)
    marks = keys.where(~F.col("keeps") & ~F.col("heavy"))
    more = keys.withColumn("n", F.when(F.col("alone"), 0).otherwise(F.col("n") - F.col("keeps").cast("long"))).where("n > 0")
    stretch = more.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / STRETCH))).alias("k"))
    return (row(marks, 0, **key, first=zero)
            .unionByName(row(light, 1, **key, payload=F.col("payload"), first=zero))
            .unionByName(row(large, 1, **key, payload=F.col("payload"), first=zero))
            .unionByName(row(stretch, 2, **key, digest=F.col("digest"), bytes=F.col("bytes"), refers=F.col("refers"),
                             first=F.col("k") * STRETCH, n=F.least(F.lit(STRETCH), F.col("n") - F.col("k") * STRETCH))))


def _commit(spark: SparkSession, path: str) -> DataFrame:
    """Give the listed files their names, then the manifest its own. Done again, it goes on where it stopped."""
    from pyarrow.fs import FileType
    listed = spark.read.schema(MANIFEST).parquet(f"{path}/_manifest_new")
    files = listed.count()

    def rename(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, folder = _filesystem(path)
        for b in batches:
            for r in b.to_pylist():
                if fs.get_file_info(f"{folder}/{r['temp']}").type != FileType.NotFound:
                    fs.move(f"{folder}/{r['temp']}", f"{folder}/{r['name']}")
                if fs.get_file_info(f"{folder}/{r['name']}").size != r["bytes"]:
                    raise OSError(f"{r['name']} is not as written")
            yield pa.RecordBatch.from_arrays([b.column(0)], names=["shard"])

    if files:
        listed.repartition(min(files, 1000)).select(*MANIFEST.names).mapInArrow(rename, "shard long").agg(F.count("*")).first()
    fs, folder = _filesystem(path)
    fs.move(f"{folder}/_manifest_new", f"{folder}/_manifest")
    return spark.read.schema(MANIFEST).parquet(f"{path}/_manifest")


RECORDS = T.StructType([T.StructField(n, k) for n, k in (
    ("file", T.StringType()), ("offset", T.LongType()), ("record_id", T.StringType()), ("record_type", T.StringType()),
    ("url", T.StringType()), ("source_id", T.StringType()), ("refers_to", T.StringType()), ("date", T.StringType()),
    ("payload_digest", T.StringType()), ("payload_bytes", T.LongType()), ("payload", T.BinaryType()))])


def _fields(head: bytes) -> tuple[str, dict[str, str]]:
    first, *lines = head.decode("utf-8").split("\r\n")
    return first, {k.lower(): v for k, _, v in (x.partition(": ") for x in lines)}


def parse_record(data: bytes) -> tuple:
    """(record id, type, URL, source id, id referred to, date, payload digest, payload bytes, payload) of
    one record; digests and lengths are checked, ValueError says what does not hold."""
    head, _, rest = data.partition(b"\r\n\r\n")
    version, h = _fields(head)
    n = int(h["content-length"])
    block = rest[:n]
    if version != VERSION or len(block) != n or rest[n:] != END:
        raise ValueError(f"record {h.get('warc-record-id')} is cut")
    if h["warc-block-digest"] != "sha1:" + payload_digest(block):
        raise ValueError(f"record {h['warc-record-id']}: block digest")
    http, _, body = block.partition(b"\r\n\r\n")
    size, digest = int(_fields(http)[1]["content-length"]), h["warc-payload-digest"].removeprefix("sha1:")
    kept = h["warc-type"] == "response"
    if kept and (len(body) != size or payload_digest(body) != digest):
        raise ValueError(f"record {h['warc-record-id']}: payload digest")
    return (h["warc-record-id"], h["warc-type"], h.get("warc-target-uri"), h.get("warc-source-id"),
            h.get("warc-refers-to-source-id"), h["warc-date"], digest, size, body if kept else None)


def _members(stream, block: int = 1 << 20) -> Iterator[tuple[int, bytes]]:
    """Offset and content of each gzip member of a file."""
    at, held = 0, b""
    while held or (held := stream.read(block)):
        d, parts, start = zlib.decompressobj(31), [], at
        while not d.eof:
            if not held and not (held := stream.read(block)):
                raise ValueError("file ends inside a record")
            parts.append(d.decompress(held))
            at += len(held) - len(d.unused_data)
            held = d.unused_data
        yield start, b"".join(parts)


def read_warc(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """One row per record of the archive below ``path``, with the columns of ``RECORDS``; ``payload`` is null for
    revisits (their ``payload_bytes`` and ``payload_digest`` are those of the full payload) and, unless
    ``payloads``, for all. Lengths and digests are checked; a file that does not hold fails the task. An archive
    without a manifest was never committed and cannot be read."""
    listed = spark.read.schema(MANIFEST).parquet(f"{path}/_manifest").select("name")
    files = listed.count()
    if not files:
        return spark.createDataFrame([], RECORDS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema
        fs, folder = _filesystem(path)
        arrow = to_arrow_schema(RECORDS)

        def made(rows):
            return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*rows), arrow)], schema=arrow)

        for b in batches:
            for name in b.column(0).to_pylist():
                rows, size = [], 0
                with fs.open_input_stream(f"{folder}/{name}", compression=None) as stream:
                    for offset, data in _members(stream):
                        got = parse_record(data)
                        rows.append((name, offset, *(got if payloads else (*got[:-1], None))))
                        size += len(data) if payloads else 256
                        if size >= 16 << 20:
                            yield made(rows)
                            rows, size = [], 0
                if rows:
                    yield made(rows)

    return listed.repartition(min(files, 10_000)).mapInArrow(run, RECORDS)
