"""Removal of repeated word sequences, found with an FM-index per shard.

A window is ``n`` consecutive words of one text. A window whose words also start anywhere else is
repeated, and every word that a repeated window covers is removed.

Identical windows must meet in one shard, whatever documents they stand in. Each window belongs to
its anchor: the least hash among its word ``k``-grams, leftmost on ties. Equal windows have equal
anchors, and the windows of one anchor are consecutive, so they travel as one segment of a few dozen
words to the shard their anchor's hash names:

1. Texts are laid in chunks of bounded size, equal texts of a chunk once; copies count towards the size. Chunks count their distinct
   anchors; only anchors that stand in two places or more can hold a repeated window.
2. An anchor found in more than ``hot_chunks`` chunks (a common line or passage) is refined: its
   windows are counted each by the hash of all their words, so that what merely stands next to a
   common passage does not follow it into one shard: windows of few chunks go to the shard of
   their own hash, only those that are common themselves stay with the anchor.
3. The segments of the remaining anchors go to their shards, equal segments of a chunk once. A shard
   builds an FM-index over its distinct segments and streams them through it, from their last word
   to their first: backward search over wavelet ranks extends the match word by word, and beyond
   ``n`` words the match drops its last word. Where the match statistic reaches ``n`` and the interval
   holds two occurrences or more, the window is reported.
4. The reported windows of a chunk come back to it and their words are removed.

The number of shards and counters follows the size of the input. Text crosses the network once as
compressed chunks (that exchange serves all passes) and, for repeated anchors, as segments.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import NOT_BLANK, _q, mix64, rows_out, word_hashes, word_spans
from .fmindex import FMIndex

WINDOW = 35
GRAM = 8
CHUNK_BYTES = 2 << 20      # of distinct text
CHUNK_ROWS = 16 << 20      # of the text of all rows of a chunk, copies included, and 64 bytes a row
COUNTER_BYTES = 32 << 20   # of all text for each counter
SHARD_BYTES = 2 << 20      # of all text for each shard
HOT_CHUNKS = 64
MAX_WINDOWS = 256          # of a segment; longer runs of one shard are cut between windows
_ORDER = 0x9E3779B97F4A7C15
_U = np.uint64


def _zip(data: bytes) -> bytes:
    import zstandard
    return zstandard.ZstdCompressor(level=3).compress(data)


def _unzip(data: bytes) -> bytes:
    import zstandard
    return zstandard.ZstdDecompressor().decompress(data)


class Chunk:
    """The words of a chunk's texts: hashes, and per text the range of its words."""

    def __init__(self, texts: list[bytes]):
        buf = np.frombuffer(b"\n".join(texts), np.uint8)
        self.begin, self.end = word_spans(buf, NOT_BLANK)
        self.words = word_hashes(buf, self.begin, self.end, 2)
        self.buf = buf
        doc = np.searchsorted(np.cumsum([len(t) + 1 for t in texts]), self.begin, side="right")
        self.count = np.bincount(doc, minlength=len(texts))
        self.first = np.cumsum(self.count) - self.count
        self.doc = doc

    def sums(self, n: int) -> np.ndarray:
        """A hash of the ``n`` words from each word on (any value near the end of the chunk)."""
        out = np.zeros(len(self.words), _U)
        part, size, done = self.words, 1, 0
        # powers of two: h[2m](i) = h[m](i) * B**m + h[m](i + m)
        base = _ORDER  # a Python number, kept below 2**64
        while True:
            if n & size:
                shifted = np.zeros_like(part)
                shifted[:len(part) - done or None] = part[done:]
                out = out * _U(base) + shifted if done else shifted
                done += size
            if done == n:
                return mix64(out)
            double = part * _U(base)
            double[:len(part) - size] += part[size:]
            part, size, base = double, 2 * size, base * base % 2**64

    def anchors(self, n: int, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(hash, first window, end window) of the anchors in order, windows by their first word."""
        total = len(self.words)
        wide = n - k + 1
        starts = np.flatnonzero(np.arange(total) + n <= (self.first + self.count)[self.doc])
        if not len(starts):
            return np.zeros(0, _U), starts, starts
        g = self.sums(k)
        best, size = np.arange(total), 1
        while size < wide:
            step = min(size, wide - size)
            a, b = best[:-step], best[step:]
            best = np.concatenate((np.where(g[a] <= g[b], a, b), best[-step:]))
            size += step
        at = best[starts]
        edge = np.flatnonzero(np.concatenate(([True], (at[1:] != at[:-1]) | (np.diff(starts) != 1))))
        return g[at[edge]], starts[edge], np.append(starts[edge[1:] - 1], starts[-1]) + 1


def _chunks(rows) -> Iterator[tuple[list, list[int], list[bytes]]]:
    """(ids, number of each row's text, distinct texts) of the chunks of ``rows`` of (id, text)."""
    size = whole = 0
    ids, index, texts = [], [], {}
    for i, t in rows:
        if ids and (whole + len(t) > CHUNK_ROWS or t not in texts and size + len(t) > CHUNK_BYTES):
            yield ids, index, list(texts)
            size = whole = 0
            ids, index, texts = [], [], {}
        if t not in texts:
            texts[t] = len(texts)
            size += len(t) + 64
        whole += len(t) + 64
        ids.append(i)
        index.append(texts[t])
    if ids:
        yield ids, index, list(texts)


def _chunk_rows(batches: Iterator[pa.RecordBatch], schema: T.StructType) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext
    base = TaskContext.get().partitionId() << 32
    rows = ((i, t.as_py() or b"") for b in batches for i, t in zip(b.column(0).to_pylist(), b.column(1).cast(pa.binary())))
    yield from rows_out(schema, ((base + number, ids, index, [len(x) for x in texts], _zip(b"".join(texts)))
                                 for number, (ids, index, texts) in enumerate(_chunks(rows))), 1)


def _texts(row: dict) -> list[bytes]:
    data, cut = _unzip(row["blob"]), np.cumsum([0, *row["lengths"]]).tolist()
    return [data[a:b] for a, b in zip(cut, cut[1:])]


def _keyed(key: np.ndarray, hashes: np.ndarray, weight: np.ndarray):
    """Distinct hashes with their summed weights, in groups by key: (key, hashes, whether repeated)."""
    found, where = np.unique(hashes, return_inverse=True)
    twice = np.bincount(where, weight, len(found)) >= 2
    key_of = np.zeros(len(found), np.int64)
    key_of[where] = key
    order = np.argsort(key_of, kind="stable")
    for part in np.split(order, np.flatnonzero(np.diff(key_of[order])) + 1):
        if len(part):
            yield int(key_of[part[0]]), found[part], twice[part]


def _key(hashes: np.ndarray, n: int) -> np.ndarray:
    return ((hashes >> _U(16)) % _U(n)).astype(np.int64)


_COUNT = "key long, chunk long, hashes binary, twice binary"
_ANSWER = "chunk long, kind int, hashes binary"
_SEGMENT = "shard long, chunk long, meta binary, words binary"
_RANGE = "chunk long, windows binary"


def _multiplicity(row: dict) -> np.ndarray:
    return np.bincount(row["index"], minlength=len(row["lengths"]))


def _count_rows(row: dict, hashes: np.ndarray, at: np.ndarray, chunk: Chunk, counters: int) -> list[dict]:
    weight = _multiplicity(row)[chunk.doc[at]] if len(at) else at
    return [{"key": k, "chunk": row["chunk"], "hashes": h.tobytes(), "twice": t.tobytes()}
            for k, h, t in _keyed(_key(hashes, counters), hashes, weight)]


def _repeated(kinds: tuple[int, int], hot: int):
    """Group function: of all hashes of a counter, tell each chunk its repeated ones; those of more
    than ``hot`` chunks as the second kind."""
    def fn(table: pa.Table) -> pa.Table:
        chunks = table.column("chunk").to_numpy()
        parts = [np.frombuffer(h, _U) for h in table.column("hashes").to_pylist()]
        twice = np.concatenate([np.frombuffer(t, bool) for t in table.column("twice").to_pylist()])
        size = np.array([len(p) for p in parts])
        hashes = np.concatenate(parts)
        _, where, n = np.unique(hashes, return_inverse=True, return_counts=True)
        many = (n >= 2) | (np.bincount(where, twice) > 0)
        of = np.repeat(np.arange(len(parts)), size)
        rows = {"chunk": [], "kind": [], "hashes": []}
        for kind, use in ((kinds[0], many & (n <= hot)), (kinds[1], many & (n > hot))):
            hit = np.flatnonzero(use[where])
            for part in np.split(hit, np.flatnonzero(np.diff(of[hit])) + 1):
                if len(part):
                    rows["chunk"].append(int(chunks[of[part[0]]]))
                    rows["kind"].append(kind)
                    rows["hashes"].append(hashes[part].tobytes())
        return pa.table(rows, schema=pa.schema([("chunk", pa.int64()), ("kind", pa.int32()), ("hashes", pa.binary())]))
    return fn


def _told(answers: pa.Table, kind: int) -> np.ndarray:
    got = [np.frombuffer(h, _U) for k, h in zip(answers.column("kind").to_pylist(), answers.column("hashes").to_pylist()) if k == kind]
    return np.concatenate(got) if got else np.zeros(0, _U)


def _spread(first: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of the ranges, and the range of each."""
    size = end - first
    of = np.repeat(np.arange(len(first)), size)
    return first[of] + np.arange(len(of)) - np.repeat(np.cumsum(size) - size, size), of


def _segments(row: dict, answers: pa.Table, n: int, k: int, shards: int) -> list[dict]:
    texts = _texts(row)
    c = Chunk(texts)
    h, first, end = c.anchors(n, k)
    plain = np.isin(h, _told(answers, 0))
    shard, low, high = _key(h, shards)[plain], first[plain], end[plain]
    hot = np.isin(h, _told(answers, 1))
    if hot.any():
        at, of = _spread(first[hot], end[hot])
        own = c.sums(n)[at]
        alone = np.isin(own, _told(answers, 2))
        use = alone | np.isin(own, _told(answers, 3))
        shard = np.concatenate((shard, np.where(alone, _key(own, shards), _key(h, shards)[hot][of])[use]))
        low, high = np.concatenate((low, at[use])), np.concatenate((high, at[use] + 1))
        order = np.argsort(low, kind="stable")
        shard, low, high = shard[order], low[order], high[order]
    if not len(low):
        return []
    # neighbouring windows of one shard and text travel together, up to MAX_WINDOWS
    joins = np.concatenate(([False], (low[1:] == high[:-1]) & (shard[1:] == shard[:-1]) & (c.doc[low[1:]] == c.doc[low[:-1]])))
    edge = np.flatnonzero(~joins)
    shard, low, high = shard[edge], low[edge], high[np.append(edge[1:] - 1, len(high) - 1)]
    pieces = -(-(high - low) // MAX_WINDOWS)
    of = np.repeat(np.arange(len(low)), pieces)
    part = np.arange(len(of)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    shard, low, high = shard[of], low[of] + part * MAX_WINDOWS, np.minimum(high[of], low[of] + (part + 1) * MAX_WINDOWS)
    last = high + n - 2  # the last word
    weight = _multiplicity(row)[c.doc[low]]
    # equal segments of the chunk once: (first of the equal ones, their summed weight)
    import xxhash
    words = np.ascontiguousarray(c.words)
    same = np.array([xxhash.xxh64_intdigest(words[i:j + 1]) for i, j in zip(low.tolist(), last.tolist())], _U)
    _, keep, where = np.unique(np.stack((same, shard.astype(_U))), axis=1, return_index=True, return_inverse=True)
    where = where.reshape(-1)
    weight = np.bincount(where, weight, len(keep)).astype(np.int64)
    out, data = [], np.where(NOT_BLANK[c.buf], c.buf, np.uint8(32)).tobytes()  # so line ends can part segments
    order = np.argsort(shard[keep], kind="stable")
    occurs = np.argsort(where, kind="stable")
    run = np.searchsorted(where[occurs], np.arange(len(keep) + 1))
    for group in np.split(order, np.flatnonzero(np.diff(shard[keep][order])) + 1):
        meta = [np.array([len(group)])]
        words = []
        for g in group:
            i = keep[g]
            places = low[occurs[run[g]:run[g + 1]]]
            meta.append(np.array([high[i] - low[i], weight[g], len(places)]))
            meta.append(places)
            words.append(data[c.begin[low[i]]:c.end[last[i]]])
        out.append({"shard": int(shard[keep[group[0]]]), "chunk": row["chunk"],
                    "meta": _zip(np.concatenate(meta).astype(np.int32).tobytes()), "words": _zip(b"\n".join(words))})
    return out


def repeated_windows(segments: list[np.ndarray], weight: np.ndarray, n: int) -> list[np.ndarray]:
    """For each segment of word ids (from 1), whether its windows occur twice or more, counting each
    segment ``weight`` times. Match statistics by backward search, all segments in step."""
    size = np.array([len(s) for s in segments])
    seq = np.zeros(int(size.sum()) + len(segments), np.int64)
    begin = np.cumsum(size + 1) - size - 1
    at, of = _spread(begin, begin + size)
    seq[at] = np.concatenate(segments)
    index = FMIndex(seq, int(seq.max()) + 1, depth=n + 1)
    total = len(seq)
    owner = np.zeros(total, np.int64)
    owner[at] = weight[of]
    occurrences = np.concatenate(([0, 0], np.cumsum(owner[index.order])))
    # classes of rows with equal first n - 1 symbols, from the ranks of powers of two
    key, have = np.zeros(total, np.int64), 0
    for b in (1 << j for j in reversed(range(n.bit_length())) if (n - 1) >> j & 1):
        after = np.zeros(total, np.int64)
        after[:total - have] = index.ranks[b][have:] + 1
        key = np.unique(key * (total + 2) + after, return_inverse=True)[1] if have else after
        have += b
    new = np.concatenate(([True], np.diff(key[index.order]) != 0))
    edges = np.append(np.flatnonzero(new), total) + 1
    of_row = np.concatenate(([0], np.cumsum(new) - 1))
    out = [np.zeros(max(0, s - n + 1), bool) for s in size]
    flat = np.zeros(total, bool)
    order = np.argsort(-size, kind="stable")
    low, high = np.zeros(len(size), np.int64), np.full(len(size), total + 1)
    live = np.searchsorted(-size[order], -np.arange(int(size.max(initial=0))), side="left")
    for step in range(int(size.max(initial=0))):
        m = live[step]
        place = (begin + size - 1)[order[:m]] - step
        a, b = low[:m], high[:m]
        if step >= n:  # the match is n words long: drop its last word
            cls = of_row[a]
            a, b = edges[cls], edges[cls + 1]
        a, b = index.extend(seq[place], a, b)
        low[:m], high[:m] = a, b
        if step >= n - 1:
            flat[place] = occurrences[b] - occurrences[a] >= 2
    for i, s in enumerate(size):
        out[i][:] = flat[begin[i]:begin[i] + len(out[i])]
    return out


def _search(n: int):
    """Group function of a shard: the places of the repeated windows, for each chunk."""
    def fn(table: pa.Table) -> pa.Table:
        texts, size, weight, places, chunk = [], [], [], [], []
        for c, m, w in zip(*(table.column(x).to_pylist() for x in ("chunk", "meta", "words"))):
            meta = np.frombuffer(_unzip(m), np.int32)
            at = 1
            texts += _unzip(w).split(b"\n")
            for _ in range(meta[0]):
                size.append(int(meta[at]))
                weight.append(int(meta[at + 1]))
                k = int(meta[at + 2])
                places.append(meta[at + 3:at + 3 + k])
                chunk.append(c)
                at += 3 + k
        known: dict[bytes, int] = {}
        which = np.array([known.setdefault(t, len(known)) for t in texts])
        total = np.bincount(which, weight).astype(np.int64)
        del texts
        c = Chunk(list(known))
        del known
        ids = np.unique(c.words, return_inverse=True)[1] + 1
        hits = repeated_windows(np.split(ids, c.first[1:]), total, n)
        rows: dict[int, list] = {}
        for i, (w, at) in enumerate(zip(which, places)):
            offsets = np.flatnonzero(hits[w][:size[i]])
            if len(offsets):
                rows.setdefault(chunk[i], []).append((at[:, None] + offsets).ravel())
        return pa.table({"chunk": list(rows), "windows": [np.concatenate(x).astype(np.int32).tobytes() for x in rows.values()]},
                        schema=pa.schema([("chunk", pa.int64()), ("windows", pa.binary())]))
    return fn


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = WINDOW, k: int = GRAM,
                   hot_chunks: int = HOT_CHUNKS) -> DataFrame:
    """One row per row of ``docs``: the id, ``n_words``, ``n_removed`` and ``kept_text``, the words that no
    repeated window of ``n`` words covers, joined by one space.

    Words are runs of other characters than ASCII blanks, unchanged. Windows are judged on the input:
    all occurrences of a repeated sequence go, overlapping ones of one text included. Null and empty
    texts have no words; texts of fewer than ``n`` words keep all. Null ids and repeated rows stay
    rows of their own (a repeated row repeats every window). An empty table gives no rows; other
    columns are ignored. Memory per task follows one chunk (all its rows, copies included), counter or shard.
    """
    k = min(k, n)
    src = docs.select(_q(id_col).alias("id"), _q(text_col).alias("text"))
    size = src.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    counters, shards = max(1, size // COUNTER_BYTES), max(1, size // SHARD_BYTES)
    id_type = src.schema["id"].dataType
    chunk_schema = T.StructType([
        T.StructField("chunk", T.LongType()), T.StructField("ids", T.ArrayType(id_type)),
        T.StructField("index", T.ArrayType(T.IntegerType())), T.StructField("lengths", T.ArrayType(T.IntegerType())),
        T.StructField("blob", T.BinaryType())])
    out_schema = T.StructType([
        T.StructField(id_col, id_type), T.StructField("n_words", T.LongType()),
        T.StructField("n_removed", T.LongType()), T.StructField("kept_text", T.StringType())])
    chunks = src.mapInArrow(lambda b: _chunk_rows(b, chunk_schema), chunk_schema).repartition("chunk")

    def count_anchors(batches):
        for b in batches:
            for row in (r for i in range(b.num_rows) for r in b.slice(i, 1).to_pylist()):
                c = Chunk(_texts(row))
                h, first, _ = c.anchors(n, k)
                yield from _batches(_count_rows(row, h, first, c, counters), _COUNT)

    def count_windows(left: pa.Table, right: pa.Table) -> pa.Table:
        rows, hot = [], _told(right, 1)
        if left.num_rows and len(hot):
            row = left.to_pylist()[0]
            c = Chunk(_texts(row))
            h, first, end = c.anchors(n, k)
            use = np.isin(h, hot)
            at, _ = _spread(first[use], end[use])
            rows = _count_rows(row, c.sums(n)[at], at, c, counters)
        return _table(rows, _COUNT)

    def cut(left: pa.Table, right: pa.Table) -> pa.Table:
        rows = _segments(left.to_pylist()[0], right, n, k, shards) if left.num_rows and right.num_rows else []
        return _table(rows, _SEGMENT)

    def remove(left: pa.Table, right: pa.Table) -> pa.Table:
        rows = []
        if left.num_rows:
            row = left.to_pylist()[0]
            texts = _texts(row)
            words = [t.split() for t in texts]
            first = np.cumsum([0] + [len(w) for w in words])
            cover = np.zeros(first[-1] + 1, np.int64)
            for w in right.column("windows").to_pylist():
                at = np.frombuffer(w, np.int32)
                np.add.at(cover, at, 1)
                np.add.at(cover, at + n, -1)
            kept = np.cumsum(cover[:-1]) == 0
            made = []
            for i, w in enumerate(words):
                keep = kept[first[i]:first[i + 1]]
                made.append((len(w), len(w) - int(keep.sum()), b" ".join(compress(w, keep.tolist())).decode()))
            rows = [dict(zip(out_schema.fieldNames(), (d, *made[i]))) for d, i in zip(row["ids"], row["index"])]
        return _table(rows, out_schema)

    one = chunks.mapInArrow(count_anchors, _COUNT).groupBy("key").applyInArrow(_repeated((0, 1), hot_chunks), _ANSWER)
    two = (chunks.groupBy("chunk").cogroup(one.where("kind = 1").groupBy("chunk")).applyInArrow(count_windows, _COUNT)
           .groupBy("key").applyInArrow(_repeated((2, 3), hot_chunks), _ANSWER))
    found = (chunks.groupBy("chunk").cogroup(one.unionByName(two).groupBy("chunk")).applyInArrow(cut, _SEGMENT)
             .groupBy("shard").applyInArrow(_search(n), _RANGE))
    return chunks.groupBy("chunk").cogroup(found.groupBy("chunk")).applyInArrow(remove, out_schema)


def _arrow(schema) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    if isinstance(schema, str):
        kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
        return pa.schema([(a, kinds[b]) for a, b in (x.split() for x in schema.split(", "))])
    return to_arrow_schema(schema)


def _table(rows: list[dict], schema) -> pa.Table:
    return pa.Table.from_pylist(rows, schema=_arrow(schema))


def _batches(rows: list[dict], schema) -> Iterator[pa.RecordBatch]:
    return iter(_table(rows, schema).to_batches())
