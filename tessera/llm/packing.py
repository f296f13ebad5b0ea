"""Sum-of-squares online packing of tokenised documents into fixed-length sequences.

Every task packs the documents of its own partition, so no row is shuffled and the work grows
with the input. A document longer than a sequence is first cut into full sequences; its rest is
an item for the online rule: among all fill levels that still take the item (and a new window),
choose the one whose change of the sum of squared counts of partially filled windows is least.
The counts sit in one level array; the windows of a level wait in a stack.

Documents may be cut freely, so what stays open is not padded: when the open windows exceed
``max_open``, and at the end of the partition, their pieces are laid end to end and cut into full
windows; the last rest becomes windows of power-of-two lengths, which need no padding.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import _q, rows_out

SEQUENCE = 2048
END_ID = 1
MAX_OPEN = 1024


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


class _Cache(dict):
    """Makes what it does not hold; keeps short keys up to a limit."""

    def __init__(self, make, limit: int):
        super().__init__()
        self.make, self.limit = make, limit

    def __missing__(self, key: str) -> bytes:
        got = self.make(key)
        if len(key) <= 64 and len(self) < self.limit:
            self[key] = got
        return got


class BlankCachedEncoder:
    """Token ids of a text, as little-endian unsigned 32-bit bytes.

    The tokenizer never joins anything across a space, so a text's ids are those of its
    space-separated chunks in order. Chunks and their pre-tokens are kept in a cache of two
    generations of about ``keep`` entries: a full young one becomes the old one, and what is found
    there moves back. Chunks with control characters or characters from U+0130 up (combining marks
    among them), and chunks that may hold a special token, go through the whole tokenizer.
    """

    #: Pre-token pattern of the tokenizer file; fixed by that file.
    PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

    def __init__(self, path: str, keep: int = 500_000):
        import re

        import regex
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        self.split = regex.compile(self.PATTERN).findall
        self.whole = re.compile("[\x00-\x08\x0e-\x1f\x7f-\x84\x86-\x9f\u0130-\U0010ffff]|<\\|").search
        # a character for each byte, as in byte-level vocabularies
        shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
        hidden = [b for b in range(256) if b not in shown]
        self.of_byte = {b: 256 + i for i, b in enumerate(hidden)}
        self.young, self.old, self.keep = _Cache(self._made, 2 * keep), {}, keep

    def _model(self, p: str) -> bytes:
        """Ids of one pre-token."""
        ids = [t.id for t in self.tok.model.tokenize(p if p.isascii() else p.encode().decode("latin-1").translate(self.of_byte))]
        return struct.pack(f"<{len(ids)}I", *ids)

    def _made(self, c: str) -> bytes:
        """Ids of a lower-cased chunk without special characters; mostly a word and a mark. A pre-token
        has the same ids as a chunk of its own."""
        got = self.old.get(c)
        if got is not None:
            return got
        if c.isalpha():
            return self._model(c)
        if c[:-1].isalpha() and c[-1] in ".,;:!?":
            return self.young[c[:-1]] + self.young[c[-1]]
        pieces = self.split(c)
        return self._model(c) if pieces == [c] else b"".join(map(self.young.__getitem__, pieces))

    def _through(self, text: str) -> bytes:
        """Ids by the whole tokenizer."""
        ids = self.tok.encode(text, add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}I", *ids)

    def encode(self, text: str) -> bytes:
        if self.whole(text):
            return b"".join(self._through(w) if self.whole(w) else self._words([w.lower()]) for w in text.split(" "))
        return self._words(text.lower().split(" "))

    def _words(self, words: list[str]) -> bytes:
        if len(self.young) >= self.keep:
            self.old, self.young = self.young, _Cache(self._made, 2 * self.keep)
        return b"".join(map(self.young.__getitem__, words))


_ENCODERS: dict[str, BlankCachedEncoder] = {}


def encoder(path: str) -> BlankCachedEncoder:
    """One encoder per worker process and path; its caches serve all tasks of the worker."""
    if path not in _ENCODERS:
        _ENCODERS[path] = BlankCachedEncoder(path)
    return _ENCODERS[path]


class Packer:
    """The online rule over one stream of documents. Yields pieces
    ``(doc, start, ids, doc_tokens, sequence, offset)``; sequences are numbered from 0."""

    def __init__(self, size: int = SEQUENCE, max_open: int = MAX_OPEN):
        self.size, self.max_open = size, max_open
        self.count = np.zeros(size + 1, np.int64)  # windows by fill level; 0 and size stay 0
        self.at: dict[int, list[list]] = {}
        self.open = 0
        self.next = 0

    def level_for(self, s: int) -> int:
        """The level whose window takes ``s`` more tokens at the least sum of squares (0: a new
        window). Ties go to the fullest window."""
        n = self.count
        # half the change of the sum of squares, less one: n[after] - n[before]
        gain = n[s:].astype(np.float64)
        gain[-1] = -0.5                            # a full window leaves the array
        cost = gain - n[:self.size - s + 1]
        cost[0] -= 0.5                             # opening leaves no level behind
        ok = n[:self.size - s + 1] > 0
        ok[0] = True
        cost[~ok] = np.inf
        least = cost.min()
        return int(np.flatnonzero(cost == least)[-1])

    def _emit(self, window: list) -> Iterator[tuple]:
        seq, off = self.next, 0
        self.next += 1
        for doc, start, ids, total in window:
            yield doc, start, ids, total, seq, off
            off += len(ids) // 4

    def add(self, doc, ids: bytes) -> Iterator[tuple]:
        """All ids of one document (never empty)."""
        total, full = len(ids) // 4, self.size * 4
        at = 0
        while len(ids) - at >= full:
            yield from self._emit([(doc, at // 4, ids[at:at + full], total)])
            at += full
        if at == len(ids):
            return
        piece = (doc, at // 4, ids[at:], total)
        s = (len(ids) - at) // 4
        level = self.level_for(s)
        if level:
            window = self.at[level].pop()
            self.count[level] -= 1
            self.open -= 1
        else:
            window = []
        window.append(piece)
        level += s
        if level == self.size:
            yield from self._emit(window)
            return
        self.at.setdefault(level, []).append(window)
        self.count[level] += 1
        self.open += 1
        if self.open > self.max_open:
            yield from self.close(last=False)

    def close(self, last: bool = True) -> Iterator[tuple]:
        """Lay the open windows' pieces end to end, fullest windows first, and cut full windows.
        The rest stays open, or on ``last`` becomes windows of power-of-two lengths."""
        size = self.size
        todo = [p for lv in sorted(self.at, reverse=True) for w in self.at[lv] for p in w]
        self.at, self.open = {}, 0
        self.count[:] = 0
        window, fill = [], 0
        for doc, start, ids, total in todo:
            while ids:
                take = ids[:(size - fill) * 4]
                window.append((doc, start, take, total))
                fill += len(take) // 4
                start += len(take) // 4
                ids = ids[len(take):]
                if fill == size:
                    yield from self._emit(window)
                    window, fill = [], 0
        if not fill:
            return
        if not last:
            self.at[fill], self.open = [window], 1
            self.count[fill] = 1
            return
        part, room = [], 1 << (fill.bit_length() - 1)
        for doc, start, ids, total in window:
            while ids:
                take = ids[:room * 4]
                part.append((doc, start, take, total))
                k = len(take) // 4
                room, fill, start, ids = room - k, fill - k, start + k, ids[len(take):]
                if not room:
                    yield from self._emit(part)
                    part, room = [], (1 << (fill.bit_length() - 1)) if fill else 0


def pack_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SEQUENCE,
                   tokenizer: str | None = None, end_id: int = END_ID, max_open: int = MAX_OPEN) -> DataFrame:
    """Pieces of all documents: ``id_col``, ``start`` (the document's ids before the piece),
    ``length``, ``ids`` (binary, little-endian unsigned 32-bit), ``doc_tokens`` (with the end id),
    ``sequence_id`` and ``offset`` within the sequence.

    Each document is its token ids followed by ``end_id``. A null or empty text is the end id
    alone; a null id passes through; repeated rows are packed each for itself; an empty table
    gives no rows; other columns are ignored, whatever their names. Very long texts become full
    sequences and a rest. Sequence ids are the partition number times 2**33 plus a count, the same
    on every retry of a task. Per task, memory is at most ``max_open`` open windows and one batch.
    """
    path = tokenizer or tokenizer_path()
    src = docs.select(_q(id_col).alias("d"), _q(text_col).alias("t"))
    schema = T.StructType([
        T.StructField(id_col, src.schema["d"].dataType), T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()), T.StructField("ids", T.BinaryType()),
        T.StructField("doc_tokens", T.LongType()), T.StructField("sequence_id", T.LongType()),
        T.StructField("offset", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        first = TaskContext.get().partitionId() << 33
        enc, end = encoder(path), np.array([end_id], "<u4").tobytes()
        packer = Packer(size, max_open)

        def pieces():
            for b in batches:
                ids, texts = b.column(0).to_pylist(), b.column(1)
                for i, doc in enumerate(ids):
                    yield from packer.add(doc, enc.encode(texts[i].as_py() or "") + end)
            yield from packer.close()

        yield from rows_out(schema, ((doc, start, len(ids) // 4, ids, total, first + seq, off)
                                     for doc, start, ids, total, seq, off in pieces()), 2048)

    return src.mapInArrow(run, schema)
