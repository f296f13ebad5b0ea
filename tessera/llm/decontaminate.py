"""Benchmark decontamination: an FM-index per shard of training text, searched for test phrases.

Every task cuts its documents into shards of bounded size and indexes them where they are, so no
text is shuffled. The phrases (all windows of ``n`` words of the benchmark items) are searched
together, word by word backwards through wavelet ranks; occurrences are located by sampled suffix
positions, marked on the words they cover and merged into removal spans.

Words that no item has cannot be part of an occurrence, nor can a run of item words shorter than the
shortest window, so the index holds the other runs only, parted by a mark: the same occurrences
from a small part of the text.

The benchmark is a query set that every task needs whole. Its size is checked: items go into blocks
of at most ``block_bytes`` of text, each block is broadcast on its own and searched in a pass of
its own in the same stage; what the passes find is united.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import _q, byte_table, map_arrow, numbered, word_hashes, word_spans
from .fmindex import FMIndex

BLOCK_BYTES = 4 << 20
SHARD_BYTES = 16 << 20
PART_BYTES = 1 << 20
#: Bytes of words: digits, a-z and everything beyond ASCII (after A-Z are lower-cased).
_WORD = byte_table(lambda b: 48 <= b <= 57 or 97 <= b <= 122 or b >= 128)
_LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)


def split_words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For all words of the texts: text number, start and end byte in that text, and word hash."""
    buf = _LOWER[np.frombuffer(b"\n".join(texts), np.uint8)]
    sizes = np.array([len(t) + 1 for t in texts], np.int64)
    ends = np.cumsum(sizes)
    start, end = word_spans(buf, _WORD)
    doc = np.searchsorted(ends, start, side="right")
    shift = (ends - sizes)[doc]
    return doc, start - shift, end - shift, word_hashes(buf, start, end, 8)


class Phrases:
    """Windows of the items: the vocabulary, the windows' word ids and the items of each window."""

    def __init__(self, items: list[tuple], n: int):
        doc, _, _, h = split_words([(t or "").encode() for _, t in items])
        self.vocabulary, word = np.unique(h, return_inverse=True)
        self.flat = (word + 1).astype(np.int64)
        count = np.bincount(doc, minlength=len(items))
        windows = np.where(count > 0, np.maximum(1, count - n + 1), 0)
        item = np.repeat(np.arange(len(items)), windows)
        first = np.cumsum(count) - count
        self.start = first[item] + np.arange(len(item)) - np.repeat(np.cumsum(windows) - windows, windows)
        self.length = np.minimum(count, n)[item]
        self.item = item
        self.names = [None if i is None else str(i) for i, _ in items]
        self.least = int(self.length.min(initial=n))
        bits = np.zeros(1 << 16, bool)
        bits[self.vocabulary & np.uint64(0xFFFF)] = True
        self.maybe = bits

    def ids(self, h: np.ndarray) -> np.ndarray:
        """Word ids from 1; 0 for words outside the vocabulary."""
        out = np.zeros(len(h), np.int64)
        some = np.flatnonzero(self.maybe[h & np.uint64(0xFFFF)])
        at = np.searchsorted(self.vocabulary, h[some])
        at[at == len(self.vocabulary)] = 0
        hit = self.vocabulary[at] == h[some]
        out[some[hit]] = at[hit] + 1
        return out


def _item_runs(texts: list[bytes], phrases: Phrases):
    """Words per text; of the words in runs long enough for a window: text number, word number, start
    and end byte, vocabulary id, and whether the word begins a run."""
    doc, start, end, h = split_words(texts)
    count = np.bincount(doc, minlength=len(texts))
    ids = phrases.ids(h)
    known = ids > 0
    begins = np.ones(len(doc), bool)
    begins[1:] = ~(known[1:] & known[:-1] & (doc[1:] == doc[:-1]))
    run = np.cumsum(begins) - 1
    keep = np.flatnonzero(known & (np.bincount(run)[run] >= phrases.least)) if len(run) else run
    number = keep - (np.cumsum(count) - count)[doc[keep]]
    return count, doc[keep], number, start[keep], end[keep], ids[keep], begins[keep]


def search_shard(texts: list[bytes], phrases: Phrases):
    """Words per text, and the occurrences: words covered (as flat arrays of text number, word
    number, start byte, end byte) and distinct (text number, item number) pairs."""
    parts, at = [], 0
    cut = np.cumsum([len(t) for t in texts])
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(cut, (cut[at - 1] if at else 0) + PART_BYTES, side="right")))
        got = _item_runs(texts[at:to], phrases)
        parts.append((got[0], got[1] + at, *got[2:]))
        at = to
    count, doc, number, start, end, ids, begins = map(np.concatenate, zip(*parts))
    if not len(doc):
        return count, (doc, number, start, end), (doc, doc)
    place = np.arange(len(doc)) + np.cumsum(begins) - 1  # a mark stands before each run but the first
    seq = np.zeros(place[-1] + 1, np.int64)
    seq[place] = ids
    source = np.full(len(seq), -1)
    source[place] = np.arange(len(doc))
    index = FMIndex(seq, len(phrases.vocabulary) + 1)
    low, high = index.search(phrases.flat, phrases.start, phrases.length)
    found = np.flatnonzero(high > low)
    times = (high - low)[found]
    which = np.repeat(found, times)
    rows = np.repeat(low[found] - (np.cumsum(times) - times), times) + np.arange(len(which))
    place = index.locate(rows)
    cover = np.zeros(len(seq) + 1, np.int64)
    np.add.at(cover, place, 1)
    np.add.at(cover, place + phrases.length[which], -1)
    hit = source[np.flatnonzero(np.cumsum(cover[:-1]) > 0)]
    pair = np.unique(doc[source[place]] * (len(phrases.names) + 1) + phrases.item[which])
    return (count, (doc[hit], number[hit], start[hit], end[hit]),
            (pair // (len(phrases.names) + 1), pair % (len(phrases.names) + 1)))


def _spans(old: list[int], doc_hits: list[np.ndarray]) -> list[int]:
    """Unite spans ``[first word, end word, start byte, end byte, ...]`` with hit words."""
    number, start, end = doc_hits
    edge = np.flatnonzero(np.concatenate(([True], np.diff(number) != 1))) if len(number) else np.zeros(0, int)
    last = np.concatenate((edge[1:] - 1, [len(number) - 1])) if len(number) else edge
    new = np.stack((number[edge], number[last] + 1, start[edge], end[last]), 1).tolist() if len(number) else []
    out: list[list[int]] = []
    for s in sorted(new + [old[i:i + 4] for i in range(0, len(old), 4)]):
        if out and s[0] <= out[-1][1]:
            if s[1] > out[-1][1]:
                out[-1][1], out[-1][3] = s[1], s[3]
        else:
            out.append(s)
    return [x for s in out for x in s]


def _names(schema: T.StructType | DataFrame) -> tuple[str, str, str]:
    """Three working column names that no column has."""
    taken, tail = set(schema.columns), ""
    while any(f"__{n}{tail}" in taken for n in ("words", "spans", "items")):
        tail += "_"
    return f"__words{tail}", f"__spans{tail}", f"__items{tail}"


def _pass(df: DataFrame, text_col: str, names: tuple[str, str, str], phrases) -> DataFrame:
    first = names[0] not in df.columns
    extra = [T.StructField(names[0], T.LongType()), T.StructField(names[1], T.ArrayType(T.LongType())),
             T.StructField(names[2], T.ArrayType(T.StringType()))]
    schema = T.StructType(list(df.schema) + extra) if first else df.schema
    text_at, spans_at = df.columns.index(text_col), None if first else df.columns.index(names[1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema
        arrow, known = to_arrow_schema(numbered(schema)), phrases.value
        for part in _shards(batches, text_at):
            texts = [t or b"" for t in part.column(text_at).cast(pa.binary()).to_pylist()]
            count, (doc, number, start, end), (in_doc, item) = search_shard(texts, known)
            old = [[]] * len(texts) if first else part.column(spans_at).to_pylist()
            had = [[]] * len(texts) if first else part.column(spans_at + 1).to_pylist()
            cut = np.searchsorted(doc, np.arange(len(texts) + 1))
            icut = np.searchsorted(in_doc, np.arange(len(texts) + 1))
            spans, items = list(old), list(had)
            for i in np.unique(doc):
                a, b = cut[i], cut[i + 1]
                spans[i] = _spans(old[i], [number[a:b], start[a:b], end[a:b]])
                items[i] = sorted({known.names[k] for k in item[icut[i]:icut[i + 1]]
                                   if known.names[k] is not None} | set(had[i]))
            made = [pa.array(count, pa.int64()), pa.array(spans, pa.list_(pa.int64())), pa.array(items, pa.list_(pa.string()))]
            cols = part.columns if first else part.columns[:-3]
            cols = [c.cast(f.type) for c, f in zip(cols, arrow)] + [m.cast(arrow.field(len(cols) + j).type) for j, m in enumerate(made)]
            yield pa.RecordBatch.from_arrays(cols, schema=arrow)

    return map_arrow(df, run, schema)


def _shards(batches: Iterator[pa.RecordBatch], text_at: int) -> Iterator[pa.RecordBatch]:
    """Rows in groups of about ``SHARD_BYTES`` of text; a longer text is a shard of its own."""
    held, size = [], 0
    for b in batches:
        lengths = pc.fill_null(pc.binary_length(b.column(text_at)), 0).to_numpy(zero_copy_only=False)
        at = 0
        while at < b.num_rows:
            fit = int(np.searchsorted(np.cumsum(lengths[at:]), SHARD_BYTES - size)) + 1
            held.append(b.slice(at, fit))
            size += int(lengths[at:at + fit].sum())
            at += fit
            if size >= SHARD_BYTES:
                yield _joined(held)
                held, size = [], 0
    if held:
        yield _joined(held)


def _joined(held: list[pa.RecordBatch]) -> pa.RecordBatch:
    t = pa.Table.from_batches(held).combine_chunks()
    return t.to_batches()[0] if t.num_rows else held[0]


def _marked(docs: DataFrame, benchmark: DataFrame, text_col: str, item_id: str, item_text: str, n: int,
            block_bytes: int) -> tuple[DataFrame, tuple[str, str, str]]:
    spark = docs.sparkSession
    items = benchmark.select(_q(item_id).cast("string").alias("i"), _q(item_text).alias("t"))
    size = items.agg(F.sum(F.octet_length("t") + F.lit(16))).first()[0] or 0
    blocks = -(-size // block_bytes) or 1
    names = _names(docs)
    for k in range(blocks):
        part = items if blocks == 1 else items.where(F.pmod(F.xxhash64("i", "t"), F.lit(blocks)) == k)
        block = Phrases([tuple(r) for r in part.distinct().collect()], n)
        docs = _pass(docs, text_col, names, spark.sparkContext.broadcast(block))
    return docs, names


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_id: str = "item_id", item_text: str = "text", n: int = 10,
                  block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per document: the id, ``n_words``, ``n_hit`` (words inside an occurrence of a window
    of ``n`` item words; a shorter item is one window), ``item_ids`` (strings in order, of items with
    an occurring window) and ``spans`` (byte ranges of the merged hits, for ``cut_spans``).

    Words: A-Z lower-cased, runs of digits, letters a-z and characters beyond ASCII. Null and empty
    texts have no words; items without words have no window; items with a null id mark words
    but are not listed; repeated items count once by id. Repeated and null document ids are rows
    of their own; empty tables on either side give no hits. Other columns are ignored.
    """
    src = docs.select(_q(id_col).alias("id"), _q(text_col).alias("text"))
    df, (words, spans, items) = _marked(src, benchmark, "text", item_id, item_text, n, block_bytes)
    hit = F.expr(f"aggregate(sequence(0, size({spans}) - 4, 4), 0L, (s, i) -> s + {spans}[i + 1] - {spans}[i])")
    return df.select(
        F.col("id").alias(id_col), F.col(words).alias("n_words"),
        F.when(F.size(spans) > 0, hit).otherwise(F.lit(0)).cast("long").alias("n_hit"),
        F.col(items).alias("item_ids"), F.col(spans).alias("spans"))


def cut_spans(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_id: str = "item_id",
              item_text: str = "text", n: int = 10, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The documents with the merged hit spans cut out of their texts; all other columns as they
    are. Texts without a hit, nulls among them, stay exactly as they were; documents that have
    nothing but hit words go."""
    kept = docs.columns
    df, (words, spans, items) = _marked(docs, benchmark, text_col, item_id, item_text, n, block_bytes)
    text = _q(text_col)
    raw = "encode(`" + text_col.replace("`", "``") + "`, 'UTF-8')"
    # the bytes before, between and after the spans
    pieces = F.expr(f"""transform(sequence(0, size({spans}) div 4, 1), i -> decode(substring({raw},
        int(if(i = 0, 0L, {spans}[greatest(4 * i - 1, 0)]) + 1),
        int(if(4 * i < size({spans}), {spans}[least(4 * i + 2, size({spans}) - 1)], octet_length({raw}))
            - if(i = 0, 0L, {spans}[greatest(4 * i - 1, 0)]))), 'UTF-8'))""")
    hit = F.expr(f"aggregate(sequence(0, size({spans}) - 4, 4), 0L, (s, i) -> s + {spans}[i + 1] - {spans}[i])")
    df = df.where((F.size(spans) == 0) | (hit < F.col(words)))
    return df.withColumn(text_col, F.when(F.size(spans) > 0, F.array_join(pieces, "")).otherwise(text)).select(
        *[_q(c) for c in kept])
