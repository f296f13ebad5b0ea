"""Alignment of two tokenizers over a corpus, with corpus-wide counts of linked id pairs.

Both tokenizers cut a text into tokens that cover the same bytes. Where a token of each ends at the
same byte, a group closes; two tokens are linked if their byte ranges overlap. A pair's count is the
number of documents that hold it linked.

1. Every task aligns its documents and sums the documents of each pair; full tables are written out
   early, so memory is bounded. The sums are cut by a reliable checkpoint.
2. The distinct pairs are placed by a minimal perfect hash, shard by shard (``mphash``). Every pair
   has an index; counts are dense vectors by index. Vectors of a bounded number of tasks are added
   at a time, until one is left of each shard: a hot pair is one number in each vector.
3. A second pass aligns the documents again and looks the counts up by hash, comparing the key kept at
   the index. The table is broadcast while it has at most ``max_table`` pairs. Beyond that the pairs of
   the largest counts are broadcast, and what a document does not find there is joined by key: those
   pairs have small counts, so no key of the join is hot.

Neither tokenizer joins anything across a single space between two other characters, so a text is
aligned chunk by chunk and chunks are kept; the vocabulary is checked for that on loading.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import checkpoint_dir
from .common import _q, map_arrow, numbered, rows_out
from .mphash import PerfectHash, build, pack, place_of, shards_for, unpack

MAX_TABLE = 4_000_000
#: Pairs and chunks that a worker holds; beyond, sums are written out and the least used chunks forgotten.
TASK_PAIRS = 1 << 20
CACHE_CHUNKS = 300_000
#: Characters that are aligned at a time.
BATCH_CHARS = 1 << 20
#: Tasks, or vectors, that are added at a time.
FAN = 64

#: Pre-token pattern of the byte-level tokenizer; fixed by its kind.
BYTE_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def tokenizer_paths() -> tuple[str, str]:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def byte_level_alphabet() -> dict[str, int]:
    """Character of each byte in byte-level vocabularies: printable bytes are themselves, the others
    are numbered from U+0100 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class _Numbers(dict):
    """Numbers a chunk that it does not hold and lists it as new. A piece with white space at an end, or
    none at all, is not one that the cut makes: -1."""

    new: list[str]
    next: int

    def __missing__(self, c: str) -> int:
        if not c or c[0].isspace() or c[-1].isspace():
            self[c] = -1
            return -1
        n = self[c] = self.next + len(self.new)
        self.new.append(c)
        return n


class Chunks:
    """Aligned chunks of text, by number. A chunk stands for its text with a space before it.

    ``n_a``, ``n_b``, ``n_groups`` and ``groups`` hold a chunk's figures (``bad``: its tokens' bytes are not
    the chunk's); ``codes[start[i]:start[i + 1]]`` its links as numbers of the pairs in ``pairs``, each the
    A id times 2**32 plus the B id. ``shrink`` keeps the chunks that are used most."""

    def __init__(self, byte_path: str, piece_path: str):
        import re

        import sentencepiece
        import tiktoken
        spec = json.load(open(byte_path, encoding="utf-8"))
        of_char = byte_level_alphabet()
        special = {t["content"] for t in spec.get("added_tokens", [])}
        vocab = {t: i for t, i in spec["model"]["vocab"].items() if t not in special}
        bytes_a = {i: bytes(of_char[c] for c in t) for t, i in vocab.items()}
        # the ids of merged entries rise with the rank of their merge, so ids serve as ranks
        made = [vocab[a + b] for a, b in (m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"])]
        if any(x >= y for x, y in zip(made, made[1:])):
            raise ValueError("merges are not in the order of ids")
        self.enc = tiktoken.Encoding("a", pat_str=BYTE_LEVEL, special_tokens={},
                                     mergeable_ranks={b: i for i, b in bytes_a.items()})
        self.sp = sentencepiece.SentencePieceProcessor(model_file=piece_path)
        bytes_b = {}
        for i in range(self.sp.get_piece_size()):
            p = self.sp.id_to_piece(i)
            if self.sp.is_byte(i):
                bytes_b[i] = bytes([int(p[3:-1], 16)])
            elif not (self.sp.is_control(i) or self.sp.is_unknown(i)):
                bytes_b[i] = p.replace("▁", " ").encode("utf-8")
        # a space inside a piece would join chunks
        self.apart = not any(re.search("[^ ] ", b.decode("utf-8", "replace")) for b in bytes_b.values())
        self.cut = re.compile(r"(?<=\S) (?=\S)")
        self.bytes = [[of.get(i, b"") for i in range(max(of) + 1)] for of in (bytes_a, bytes_b)]
        self.sizes = [np.array([len(x) for x in of], np.int64) for of in self.bytes]
        self.names = [np.array([str(i) for i in range(len(of))], object) for of in self.bytes]
        self.epoch = 0
        self._keep([], [], np.zeros((0, 3), np.int64), np.zeros(0, bool), [], np.zeros(1, np.int64), np.zeros(0, np.int64), [])

    def _keep(self, plain, odd, sums, bad, groups, start, codes, use) -> None:
        """Hold exactly these chunks: ``plain`` and ``odd`` are the (text, number) of both kinds."""
        self.at, self.odd = _Numbers(plain), dict(odd)
        self.n_a, self.n_b, self.n_groups = sums.T.copy()
        self.bad, self.groups, self.start, self.use = bad, groups, start, np.array(use, np.int64)
        self.pairs, self.codes = np.unique(codes, return_inverse=True)
        self.number = {c: i for i, c in enumerate(self.pairs.tolist())}
        self.epoch += 1

    def full(self) -> bool:
        return len(self.at) + len(self.odd) > CACHE_CHUNKS or len(self.pairs) > TASK_PAIRS

    def shrink(self) -> None:
        """Forget all but a third of the chunks, those used most. Numbers change (``epoch`` rises)."""
        kept = np.sort(np.argsort(-self.use, kind="stable")[:CACHE_CHUNKS // 3])
        if len(kept) and self.start[kept + 1].sum() - self.start[kept].sum() > TASK_PAIRS:
            kept = kept[:0]
        new = np.full(len(self.use), -1)
        new[kept] = np.arange(len(kept))
        sizes = np.diff(self.start)[kept]
        codes = self.pairs[self.codes[self._spread(kept)]]
        self._keep([(c, int(new[i])) for c, i in self.at.items() if i >= 0 and new[i] >= 0],
                   [(c, int(new[i])) for c, i in self.odd.items() if new[i] >= 0],
                   np.stack((self.n_a, self.n_b, self.n_groups), 1)[kept], self.bad[kept], [self.groups[i] for i in kept],
                   np.concatenate(([0], np.cumsum(sizes))), codes, self.use[kept] // 2)

    def _spread(self, chunks: np.ndarray) -> np.ndarray:
        """Places in ``codes`` of all links of the chunks, in order."""
        sizes = self.start[chunks + 1] - self.start[chunks]
        ends = np.cumsum(sizes)
        return np.repeat(self.start[chunks] - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)

    def links(self, chunks: np.ndarray) -> np.ndarray:
        return self.codes[self._spread(chunks)]

    def numbers(self, texts: list[str]) -> list[np.ndarray]:
        """The chunks of each text (none empty), in order."""
        out = [None] * len(texts)
        odd = range(len(texts))
        if self.apart:
            self.at.new, self.at.next = [], len(self.use)
            out = [np.fromiter(map(self.at.__getitem__, cs := t.split(" ")), np.int64, len(cs)) for t in texts]
            self._add(self.at.new)
            odd = [i for i, x in enumerate(out) if x.min() < 0]
        for i, x in zip(odd, self._odd([self.cut.split(texts[i]) if self.apart else [texts[i]] for i in odd])):
            out[i] = x
        self.use += np.bincount(np.concatenate(out), minlength=len(self.use)) if out else 0
        return out

    def _odd(self, split: list[list[str]]) -> list[np.ndarray]:
        """Numbers of chunks that may have white space at their ends."""
        out = []
        for cs in split:
            x = np.empty(len(cs), np.int64)
            for i, c in enumerate(cs):
                if self.apart and not (c[0].isspace() or c[-1].isspace()):
                    self.at.new, self.at.next = [], len(self.use)
                    x[i] = self.at[c]
                    self._add(self.at.new)
                    continue
                if c not in self.odd:
                    self.odd[c] = len(self.use)
                    self._add([c])
                x[i] = self.odd[c]
            out.append(x)
        return out

    def _add(self, new: list[str]) -> None:
        """Align new chunks, as one text: the tokenizers keep them apart."""
        if not new:
            return
        joined = " " + " ".join(new)
        whole = joined.encode("utf-8")
        size = [len(c) for c in new] if len(whole) == len(joined) else [len(c.encode("utf-8")) for c in new]
        ends = np.cumsum(np.array(size, np.int64) + 1)
        a = self.enc.encode_to_numpy(joined).astype(np.int64)
        b = np.array(self.sp.encode(joined[1:]), np.int64)
        if any(b"".join(map(of.__getitem__, ids.tolist())) != whole for of, ids in zip(self.bytes, (a, b))):
            if len(new) > 1:  # some chunk's tokens are not its bytes: halves find it
                for half in (new[:len(new) // 2], new[len(new) // 2:]):
                    self._add(half)
                return
            self._append(np.zeros((1, 3), np.int64), [True], [""], [0], np.zeros(0, np.int64))
            return
        end_a, end_b = np.cumsum(self.sizes[0][a]), np.cumsum(self.sizes[1][b])
        # every stretch between two token ends lies in one token of each: a link; a common end closes a group
        links = np.sort(np.concatenate((end_a, end_b)), kind="stable")
        again = np.append(links[1:] == links[:-1], False)
        closes, links = links[again], links[~again]
        codes = a[np.searchsorted(end_a, links)] << 32 | b[np.searchsorted(end_b, links)]
        per = [np.diff(np.searchsorted(x, ends, "right"), prepend=0) for x in (end_a, end_b, closes, links)]
        # token texts in the order of group and side, each followed by its mark
        group_a, group_b = np.searchsorted(closes, end_a), np.searchsorted(closes, end_b)
        until_a, until_b = np.searchsorted(end_a, closes, "right"), np.searchsorted(end_b, closes, "right")
        at_a = np.arange(len(a)) + np.concatenate(([0], until_b))[group_a]
        at_b = np.arange(len(b)) + until_a[group_b]
        close = np.full(len(closes), ";", object)
        close[np.searchsorted(closes, ends)] = "\n"
        text = np.full(2 * (len(a) + len(b)), ",", object)
        text[2 * at_a], text[2 * at_b] = self.names[0][a], self.names[1][b]
        text[2 * at_a[until_a - 1] + 1], text[2 * at_b[until_b - 1] + 1] = "|", close
        groups = "".join(text.tolist()).split("\n")[:-1]
        self._append(np.stack(per[:3], 1), [False] * len(new), groups, per[3], codes)

    def _append(self, sums, bad, groups, links, codes) -> None:
        for name, x in zip(("n_a", "n_b", "n_groups"), sums.T):
            setattr(self, name, np.concatenate((getattr(self, name), x)))
        self.bad = np.concatenate((self.bad, np.array(bad, bool)))
        self.use = np.concatenate((self.use, np.zeros(len(bad), np.int64)))
        self.groups.extend(groups)
        self.start = np.concatenate((self.start, self.start[-1] + np.cumsum(links)))
        seen, at = np.unique(codes, return_inverse=True)
        new = [c for c in seen.tolist() if c not in self.number]
        self.number.update(zip(new, range(len(self.pairs), len(self.pairs) + len(new))))
        self.pairs = np.concatenate((self.pairs, np.array(new, np.int64)))
        of = np.fromiter(map(self.number.__getitem__, seen.tolist()), np.int64, len(seen))
        self.codes = np.concatenate((self.codes, of[at]))


_CHUNKS: dict[tuple, Chunks] = {}


def chunk_table(paths: tuple[str, str]) -> Chunks:
    """One table per worker process and pair of paths."""
    if paths not in _CHUNKS:
        _CHUNKS[paths] = Chunks(*paths)
    return _CHUNKS[paths]


def _parts(batch: pa.RecordBatch, column: int, cut, size: int = BATCH_CHARS) -> Iterator[list[tuple[int, str, bool]]]:
    """Runs of about ``size`` characters of the column's texts: (row, part of its text, whether it is the
    last part). A longer text is cut between chunks; a null or empty one is a part ''."""
    held, n = [], 0
    for row, t in enumerate(batch.column(column)):
        t = t.as_py() or ""
        at = 0
        while at >= 0:
            gap = cut.search(t, at + size) if len(t) - at > size else None
            held.append((row, t[at:gap.start()] if gap else t[at:], gap is None))
            n += len(held[-1][1])
            at = gap.end() if gap else -1
            if n >= size:
                yield held
                held, n = [], 0
    if held:
        yield held


def pair_sums(docs: DataFrame, text_col: str, paths: tuple[str, str]) -> DataFrame:
    """``(part, place, code, docs)``: how many documents of a task hold a pair linked; ``part`` is the task,
    ``place`` the code's place in the hash. A pair may stand in several rows of a task."""
    schema = T.StructType([T.StructField(n, T.LongType()) for n in ("part", "place", "code", "docs")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        from pyspark.sql.pandas.types import to_arrow_schema
        part, al, arrow = TaskContext.get().partitionId(), chunk_table(paths), to_arrow_schema(schema)
        sums, last = np.zeros(0, np.int64), np.zeros(0, np.int64)
        open_codes, open_bad = np.zeros(0, np.int64), False  # of a text whose last part is yet to come

        def out():
            at = np.flatnonzero(sums)
            codes = al.pairs[at]
            cols = [np.full(len(at), part, np.int64), place_of(codes), codes, sums[at]]
            whole = pa.RecordBatch.from_arrays([pa.array(c) for c in cols], schema=arrow)
            for k in range(0, len(at), 1 << 16):
                yield whole.slice(k, 1 << 16)

        def distinct(x: np.ndarray, mark: np.ndarray) -> np.ndarray:
            mark[x] = np.arange(len(x))
            return x[mark[x] == np.arange(len(x))]

        for b in batches:
            for parts in _parts(b, 0, al.cut):
                if al.full():
                    yield from out()
                    sums = np.zeros(0, np.int64)
                    al.shrink()
                texts = [t for _, t, _ in parts if t]
                found = iter(al.numbers(texts) if texts else ())
                sums = np.concatenate((sums, np.zeros(len(al.pairs) - len(sums), np.int64)))
                last, seen = np.zeros(len(al.pairs), np.int64), np.zeros(len(al.use), np.int64)
                for _, text, ends in parts:
                    if not text:
                        continue
                    chunks = distinct(next(found), seen)
                    codes, bad = distinct(al.links(chunks), last), bool(al.bad[chunks].any())
                    if ends and not len(open_codes) and not open_bad:
                        if not bad:
                            sums[codes] += 1
                        continue
                    open_codes, open_bad = np.union1d(open_codes, al.pairs[codes]), open_bad or bad
                    if ends:
                        if not open_bad:
                            at = [al.number[c] for c in open_codes.tolist() if c in al.number]
                            sums[at] += 1
                            lost = [c for c in open_codes.tolist() if c not in al.number]  # forgotten since
                            if lost:
                                cols = [[part] * len(lost), place_of(np.array(lost)), lost, [1] * len(lost)]
                                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], schema=arrow)
                        open_codes, open_bad = np.zeros(0, np.int64), False
        yield from out()

    return docs.select(_q(text_col).alias("text")).mapInArrow(run, schema)


def _longs(a) -> bytes:
    return np.asarray(a, "<i8").tobytes()


def _of(data: bytes) -> np.ndarray:
    return np.frombuffer(data, "<i8").astype(np.int64)


_TABLE = T.StructType([T.StructField("shard", T.LongType()), T.StructField("sizes", T.BinaryType()),
                       T.StructField("bits", T.BinaryType()), T.StructField("keys", T.BinaryType())])
_VECTOR = T.StructType([T.StructField("shard", T.LongType()), T.StructField("fan", T.LongType()),
                        T.StructField("counts", T.BinaryType())])


def _placed(codes: np.ndarray) -> tuple[bytes, bytes, bytes, np.ndarray]:
    """Sizes, bits and keys by index of one shard's codes, and the index of each code."""
    bits, sizes = build(codes)
    at = PerfectHash([(bits, sizes)]).index(codes)
    keys = np.empty(len(codes), np.int64)
    keys[at] = codes
    return _longs(sizes), pack(bits), _longs(keys), at


def _unpacked(sizes: bytes, bits: bytes) -> tuple[np.ndarray, list[int]]:
    n = _of(sizes).tolist()
    return unpack(bits, sum(n)), n


def hash_table(sums: DataFrame, fan: int = FAN) -> tuple[DataFrame, int]:
    """``(shard, sizes, bits, keys, counts)``: the perfect hash of the distinct codes of ``sums`` shard by
    shard, with the key and the count at each index; and the number of shards.

    Vectors of ``fan`` tasks at most are made from their rows, then ``fan`` vectors at most are added at
    a time. A task of these steps holds that many rows of each key of a shard, whatever the corpus."""
    first = sums.agg(F.approx_count_distinct("code").alias("n"), F.max("part").alias("parts")).first()
    shards, fans = shards_for(first["n"]), -(-((first["parts"] or 0) + 1) // fan)
    keyed = sums.withColumn("shard", F.col("place").bitwiseAND(F.lit(shards - 1).cast("long")))

    def place(t: pa.Table) -> pa.Table:
        sizes, bits, keys, _ = _placed(np.sort(t.column("code").to_numpy()))
        return pa.table({"shard": t.column("shard")[:1], "sizes": [sizes], "bits": [bits], "keys": [keys]})

    placed = keyed.select("shard", "code").distinct().groupBy("shard").applyInArrow(place, _TABLE).checkpoint()

    def count(rows: pa.Table, hashed: pa.Table) -> pa.Table:
        h = hashed.to_pylist()[0]
        vec = np.zeros(len(h["keys"]) // 8, np.int64)
        if rows.num_rows:
            at = PerfectHash([_unpacked(h["sizes"], h["bits"])]).index(rows.column("code").to_numpy())
            np.add.at(vec, at, rows.column("docs").to_numpy())
        return pa.table({"shard": hashed.column("shard"), "fan": hashed.column("fan"), "counts": [_longs(vec)]})

    def add(t: pa.Table) -> pa.Table:
        total = _of(t.column("counts")[0].as_py())
        for x in t.column("counts")[1:]:
            total += _of(x.as_py())
        return pa.table({"shard": t.column("shard")[:1], "fan": t.column("fan")[:1], "counts": [_longs(total)]})

    # a task number has rows of a shard or not; each (shard, fan) pair gets the shard's hash
    each = placed.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(fans - 1).cast("long"))).alias("fan"))
    vectors = (keyed.select("shard", F.floor(F.col("part") / fan).alias("fan"), "code", "docs").groupBy("shard", "fan")
               .cogroup(each.groupBy("shard", "fan")).applyInArrow(count, _VECTOR))
    while fans > 1:
        fans = -(-fans // fan)
        vectors = (vectors.withColumn("fan", F.floor(F.col("fan") / fan)).groupBy("shard", "fan").applyInArrow(add, _VECTOR))
    return placed.join(vectors.select("shard", "counts"), "shard").checkpoint(), shards


def _best(table: DataFrame) -> DataFrame:
    """``(a, best)``: the highest count of each A id's pairs; at most one row per entry of A."""
    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("best", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                ids, at = np.unique(_of(r["keys"]) >> 32, return_inverse=True)
                best = np.zeros(len(ids), np.int64)
                np.maximum.at(best, at, _of(r["counts"]))
                yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(best)], names=["a", "best"])

    return table.select("keys", "counts").mapInArrow(run, schema).groupBy("a").agg(F.max("best").alias("best"))


def _split(table: DataFrame, least: int) -> tuple[DataFrame, DataFrame]:
    """The table of pairs with a count of ``least`` or more, hashed anew, and the rows ``(code, count)``
    of the others."""
    rows = T.StructType([T.StructField("code", T.LongType()), T.StructField("count", T.LongType())])
    kept = T.StructType([*_TABLE, T.StructField("counts", T.BinaryType())])

    def head(batches):
        for b in batches:
            for r in b.to_pylist():
                keys, counts = _of(r["keys"]), _of(r["counts"])
                sizes, bits, new, at = _placed(keys[counts >= least])
                moved = np.empty(len(at), np.int64)
                moved[at] = counts[counts >= least]
                yield from rows_out(kept, [(r["shard"], sizes, bits, new, _longs(moved))])

    def tail(batches):
        for b in batches:
            for r in b.to_pylist():
                keys, counts = _of(r["keys"]), _of(r["counts"])
                yield pa.RecordBatch.from_arrays([pa.array(keys[counts < least]), pa.array(counts[counts < least])],
                                                 names=["code", "count"])

    return table.select(*kept.names).mapInArrow(head, kept), table.select("keys", "counts").mapInArrow(tail, rows)


def _least_count(table: DataFrame, max_table: int) -> int:
    """The least power of two of which at most ``max_table`` pairs reach the count; 0 if all pairs fit."""
    schema = T.StructType([T.StructField("power", T.IntegerType()), T.StructField("pairs", T.LongType())])

    def run(batches):
        for b in batches:
            for x in b.column(0):
                n = np.bincount(np.frexp(_of(x.as_py()).astype(float))[1] - 1, minlength=1)
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(n), dtype=np.int32)), pa.array(n.astype(np.int64))],
                                                 names=["power", "pairs"])

    by = {r["power"]: r["n"] for r in table.select("counts").mapInArrow(run, schema).groupBy("power")
          .agg(F.sum("pairs").alias("n")).collect()}  # one row per power of two
    if sum(by.values()) <= max_table:
        return 0
    total, power = 0, max(by)
    while total + by.get(power, 0) <= max_table:
        total, power = total + by.get(power, 0), power - 1
    return 1 << (power + 1)


def align_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", byte_tokenizer: str | None = None,
                    piece_tokenizer: str | None = None, max_table: int = MAX_TABLE) -> DataFrame:
    """One row per document: ``id_col``, ``n_a``, ``n_b``, ``n_groups``, ``groups`` (text: the ids of each
    group, ``a1,a2|b1;a3|b2``), ``n_links``, ``n_best`` (links whose count is the highest of their A id)
    and ``count_sum`` (the sum of the links' counts; a pair linked twice counts twice).

    A is the byte-level tokenizer over a space and the text, B the piece tokenizer over the text; special
    tokens are plain text. A null or empty text, and one whose tokens' bytes are not the space and the
    text (B writes a U+2581 like a space), has no tokens: zeros and ''. Null ids pass through; repeated
    rows are documents of their own and count each; an empty table gives no rows; other columns are
    ignored, whatever their names. Any length of text is aligned whole. ``max_table`` bounds the pairs
    that are broadcast (16 bytes each), not those that count.
    """
    spark = docs.sparkSession
    checkpoint_dir(spark)
    own = tokenizer_paths() if not (byte_tokenizer and piece_tokenizer) else ("", "")
    paths = (byte_tokenizer or own[0], piece_tokenizer or own[1])
    table, shards = hash_table(pair_sums(docs, text_col, paths).checkpoint())
    best_rows = _best(table)
    best_at = best_rows.collect()  # at most one number per entry of A's vocabulary
    least = _least_count(table, max_table)
    head, tail = _split(table, least) if least else (table, None)
    rows = {r["shard"]: r for r in head.collect()}  # at most max_table pairs
    best = np.zeros(max((r["a"] for r in best_at), default=0) + 1, np.int64)
    for r in best_at:
        best[r["a"]] = r["best"]
    held = spark.sparkContext.broadcast((
        [(bytes(rows[i]["sizes"]), bytes(rows[i]["bits"])) if i in rows else (b"", b"") for i in range(shards)],
        *[b"".join(rows[i][c] for i in sorted(rows)) for c in ("keys", "counts")], best))
    out = _looked_up(docs, id_col, text_col, paths, held)
    if tail is None:
        return out.drop("row", "rest")
    out = out.checkpoint()
    rest = (out.select("row", F.explode("rest").alias("code")).join(tail, "code")
            .withColumn("a", F.shiftright("code", 32)).join(F.broadcast(best_rows), "a")
            .groupBy("row").agg(F.count_if(F.col("count") == F.col("best")).alias("more_best"),
                                F.sum("count").alias("more_count")))
    return (out.join(rest, "row", "left")
            .select(_q(id_col), "n_a", "n_b", "n_groups", "groups", "n_links",
                    (F.col("n_best") + F.coalesce("more_best", F.lit(0))).alias("n_best"),
                    (F.col("count_sum") + F.coalesce("more_count", F.lit(0))).alias("count_sum")))


def _looked_up(docs: DataFrame, id_col: str, text_col: str, paths: tuple[str, str], held) -> DataFrame:
    """The second pass; ``rest`` has the codes that the broadcast table does not hold."""
    src = docs.select(_q(id_col).alias("id"), _q(text_col).alias("text"))
    schema = T.StructType([
        T.StructField(id_col, src.schema["id"].dataType), *[T.StructField(n, T.LongType()) for n in ("n_a", "n_b", "n_groups")],
        T.StructField("groups", T.StringType()), *[T.StructField(n, T.LongType()) for n in ("n_links", "n_best", "count_sum")],
        T.StructField("rest", T.ArrayType(T.LongType())), T.StructField("row", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        from pyspark.sql.pandas.types import to_arrow_schema
        al, (parts, keys, counts, best) = chunk_table(paths), held.value
        table = PerfectHash([_unpacked(*p) for p in parts])
        keys, counts, row = _of(keys), _of(counts), TaskContext.get().partitionId() << 33
        arrow = to_arrow_schema(numbered(schema))
        of_pair = np.zeros((3, 0), np.int64)   # best or not, count, lost or not of al.pairs
        # figures of a chunk: A tokens, B tokens, groups, links, and the three of its links summed
        of_chunk = np.zeros((0, 7), np.int64)
        epoch = al.epoch

        def look() -> None:
            """Figures of the pairs and chunks that are new."""
            nonlocal of_pair, of_chunk, epoch
            if epoch != al.epoch:
                of_pair, of_chunk, epoch = of_pair[:, :0], of_chunk[:0], al.epoch
            codes = al.pairs[of_pair.shape[1]:]
            at = table.index(codes)
            known = at >= 0
            known[known] = keys[at[known]] == codes[known]
            count = np.where(known, counts[at] if len(counts) else 0, 0)
            of_pair = np.concatenate((of_pair, [known & (count == best[np.minimum(codes >> 32, len(best) - 1)]), count, ~known]), 1)
            old = len(of_chunk)
            first = al.start[old:]
            total = np.concatenate((np.zeros((3, 1), np.int64), np.cumsum(of_pair[:, al.codes[first[0]:]], 1)), 1)
            new = np.stack((al.n_a[old:], al.n_b[old:], al.n_groups[old:], np.diff(first), *np.diff(total[:, first - first[0]])), 1)
            of_chunk = np.concatenate((of_chunk, new))

        for b in batches:
            ids, sent, rows, chars = b.column(0), 0, [], 0
            sums, texts, rest, bad = np.zeros(7, np.int64), [], [], False

            def out():
                cols = [ids.slice(sent, len(rows)), *map(list, zip(*rows)), list(range(row, row + len(rows)))]
                return pa.RecordBatch.from_arrays([c.cast(f.type) if isinstance(c, pa.Array) else pa.array(c, f.type)
                                                   for c, f in zip(cols, arrow)], schema=arrow)

            for run_of in _parts(b, 1, al.cut):
                if al.full():
                    al.shrink()
                some = [t for _, t, _ in run_of if t]
                found = iter(al.numbers(some) if some else ())
                look()
                name = al.groups.__getitem__
                for _, text, ends in run_of:
                    if text:
                        c = next(found)
                        bad = bad or bool(al.bad[c].any())
                        own = of_chunk[c].sum(0)
                        sums = sums + own
                        texts.append(";".join(map(name, c.tolist())))
                        if own[6]:
                            codes = al.links(c)
                            rest.extend(al.pairs[codes[of_pair[2, codes] > 0]].tolist())
                    if ends:
                        if bad:
                            sums, texts, rest = sums * 0, [], []
                        v = sums.tolist()
                        rows.append((*v[:3], ";".join(texts), *v[3:6], rest))
                        chars += len(rows[-1][3])
                        sums, texts, rest, bad = np.zeros(7, np.int64), [], [], False
                        if chars > 4 * BATCH_CHARS or len(rows) >= 2048:
                            yield out()
                            row, sent, rows, chars = row + len(rows), sent + len(rows), [], 0
            if rows:
                yield out()
                row += len(rows)

    return map_arrow(src, run, schema)
