import hashlib
import time
from collections import Counter, defaultdict

import numpy as np
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tessera.llm.alignment import Chunks, align_documents, hash_table, pair_sums, tokenizer_paths
from tessera.llm.mphash import PerfectHash, build, place_of
from tessera.llm.queries import QUERIES


class Plain:
    """Alignment of a whole text with the tokenizers as given, byte by byte."""

    def __init__(self):
        a, b = tokenizer_paths()
        self.a, self.b = Tokenizer.from_file(a), sentencepiece.SentencePieceProcessor(model_file=b)
        self.a.encode_special_tokens = True
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = iter(range(256, 512))
        self.byte = {chr(x if x in shown else next(rest)): x for x in range(256)}

    def _b(self, i):
        p = self.b.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()

    def tokens(self, text):
        if not text:
            return [], []
        a = [(i, bytes(self.byte[c] for c in self.a.id_to_token(i)))
             for i in self.a.encode(" " + text, add_special_tokens=False).ids]
        b = [(i, self._b(i)) for i in self.b.encode(text)]
        whole = (" " + text).encode()
        return (a, b) if b"".join(x for _, x in a) == b"".join(x for _, x in b) == whole else ([], [])

    def align(self, text):
        a, b = self.tokens(text)
        ends_a, ends_b = np.cumsum([len(x) for _, x in a]), np.cumsum([len(x) for _, x in b])
        groups, links, low = [], [], 0
        for end in sorted(set(ends_a) & set(ends_b)):
            ga = [i for (i, _), e in zip(a, ends_a) if low < e <= end]
            gb = [i for (i, _), e in zip(b, ends_b) if low < e <= end]
            groups.append(",".join(map(str, ga)) + "|" + ",".join(map(str, gb)))
            low = end
        for (i, x), ea in zip(a, ends_a):
            for (j, y), eb in zip(b, ends_b):
                if max(ea - len(x), eb - len(y)) < min(ea, eb):
                    links.append((i, j))
        return len(a), len(b), groups, links


def brute(texts):
    p = Plain()
    got = [p.align(t) for t in texts]
    count = Counter(x for g in got for x in set(g[3]))
    best = defaultdict(int)
    for (a, _), n in count.items():
        best[a] = max(best[a], n)
    return [(na, nb, len(groups), ";".join(groups), len(links), sum(count[x] == best[x[0]] for x in links),
             sum(count[x] for x in links)) for na, nb, groups, links in got]


ODD = ["", None, " ", "  ", "a", " a", "a ", "a  b", "tab\there", "line\n\nbreak \n x", "x ▁ y", "<|endoftext|> <s> </s>",
       "<unk>", " no break", "café 日本語 \U0001f600 näive", "\x00\x01 \x85 \x1c b", "it's we'll I'M",
       "12345 67 8,9", "a b c", "the the the", "x" * 300 + " " + "ab" * 200, "   lead", "trail   ", "​ z ﻿"]


def _rows(out):
    return sorted((r.n_a, r.n_b, r.n_groups, r.groups, r.n_links, r.n_best, r.count_sum) for r in out.collect())


@pytest.mark.parametrize("max_table", [1 << 20, 40, 0])
def test_against_brute_force(spark, texts, max_table):
    some = [*ODD, *sorted((t for t in texts.values() if t), key=len)[:60], *["same words here"] * 40]
    docs = spark.createDataFrame([(i, t, t, 1) for i, t in enumerate(some)], "doc_id long, text string, n_a string, row int")
    out = align_documents(docs.repartition(7), max_table=max_table)
    assert out.columns == ["doc_id", "n_a", "n_b", "n_groups", "groups", "n_links", "n_best", "count_sum"]
    want = {i: w for i, w in enumerate(brute(some))}
    for r in out.collect():
        assert tuple(r)[1:] == want[r.doc_id], some[r.doc_id]
    assert out.count() == len(some)


def test_query_against_brute_force(spark, sf001, texts):
    got = {r.doc_id: r for r in QUERIES["op13_alignment"](spark, sf001).collect()}
    ids = list(texts)
    assert sorted(got) == sorted(ids)
    p = Plain()
    per = {}
    for d in ids:
        a, b = p.tokens(texts[d])
        per[d] = (len(a), len(b))
        assert (got[d].n_a, got[d].n_b) == per[d]
    short = sorted(ids, key=lambda d: len(texts[d] or ""))[:80]
    for d in short:
        na, nb, groups, links = p.align(texts[d])
        assert got[d].n_groups == len(groups) and got[d].n_links == len(links)
        assert got[d].groups_sha256 == (hashlib.sha256(";".join(groups).encode()).hexdigest() if na else "")


def test_edges(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert align_documents(none).collect() == []
    rows = [(None, "one two"), (1, None), (1, None), (2, "one two"), (2, "one two")]
    out = align_documents(spark.createDataFrame(rows, "doc_id long, text string"))
    assert _rows(out) == sorted(brute([t for _, t in rows]))
    only_empty = align_documents(spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")).collect()
    assert [tuple(r)[1:] for r in only_empty] == [(0, 0, 0, "", 0, 0, 0)] * 2


def _joined(al, text):
    """(n_a, n_b, groups, links) of a text from its chunks; zeros if a chunk is not its tokens."""
    if not text:
        return 0, 0, "", []
    c = al.numbers([text])[0]
    if al.bad[c].any():
        return 0, 0, "", []
    codes = al.pairs[al.links(c)].tolist()
    return int(al.n_a[c].sum()), int(al.n_b[c].sum()), ";".join(al.groups[i] for i in c), codes


@pytest.mark.parametrize("text", ["a" * 300_000, " " * 300_000, "日" * 100_000, "x\n" * 100_000, "1" * 300_000])
def test_long_runs(text):
    al, p = _pair()
    t0 = time.time()
    got = _joined(al, text)
    assert time.time() - t0 < 60
    a, b = p.tokens(text)
    assert got[:2] == (len(a), len(b))


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from(" \n\t 'sdt.,1a▁"), st.characters(exclude_categories=["Cs"])), max_size=40))
def test_chunks_are_the_whole_text(text):
    al, p = _pair()
    na, nb, groups, links = p.align(text)
    got = _joined(al, text)
    assert got[:3] == (na, nb, ";".join(groups))
    assert sorted(got[3]) == sorted(a << 32 | b for a, b in links)


def test_forgetting_chunks_and_cutting_long_texts(spark, texts, monkeypatch):
    """Workers that hold few chunks and few characters at a time give the same rows."""
    from tessera.llm import alignment
    some = sorted((t for t in texts.values() if t), key=len)[:80] + ODD + ["x ▁ " + "long text " * 50]
    docs = spark.createDataFrame(list(enumerate(some)), "doc_id long, text string").coalesce(1)
    al = Chunks(*tokenizer_paths())
    want = [_joined(al, t) for t in some]
    monkeypatch.setattr(alignment, "CACHE_CHUNKS", 60)
    monkeypatch.setattr(alignment, "chunk_table", lambda paths: al)
    for k, t in enumerate(some * 2):
        if al.full():
            al.shrink()
            assert len(al.use) <= 20
        got = _joined(al, t)
        assert got[:3] == want[k % len(some)][:3] and sorted(got[3]) == sorted(want[k % len(some)][3])
    parts = [p for run in _parts_of(some, al.cut, 25) for p in run]
    for row, t in enumerate(some):
        own = [p for r, p, _ in parts if r == row]
        assert " ".join(own) == (t or "") and [e for r, _, e in parts if r == row] == [False] * (len(own) - 1) + [True]
    assert max(len(own) for own in ([p for r, p, _ in parts if r == row] for row in range(len(some)))) > 3
    assert docs.count() == len(some)


def _parts_of(texts, cut, size):
    import pyarrow as pa

    from tessera.llm.alignment import _parts
    return _parts(pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], ["t"]), 0, cut, size)


_KEPT = []


def _pair():
    if not _KEPT:
        _KEPT.extend((Chunks(*tokenizer_paths()), Plain()))
    return _KEPT


@pytest.mark.parametrize("n", [0, 1, 2, 1000, 70_000])
def test_perfect_hash(n):
    keys = np.unique(np.random.default_rng(n).integers(-2**62, 2**62, n))
    shards = 4
    place = place_of(keys) & (shards - 1)
    h = PerfectHash([build(keys[place == i]) for i in range(shards)])
    assert sorted(h.index(keys)) == list(range(len(keys)))
    other = h.index(np.arange(1, 5000, dtype=np.int64))
    assert (other >= -1).all() and (other < max(1, len(keys))).all()


def test_tree_sums(spark, sf001):
    """Vectors of many tasks, added two at a time, are the plain counts."""
    sums = pair_sums(spark.read.parquet(f"{sf001}/documents.parquet").repartition(9), "text", tokenizer_paths()).checkpoint()
    want = {r.code: r.n for r in sums.groupBy("code").agg({"docs": "sum"}).toDF("code", "n").collect()}
    table, _ = hash_table(sums, fan=2)
    got = {}
    for r in table.collect():
        got |= dict(zip(np.frombuffer(r["keys"], "<i8").tolist(), np.frombuffer(r["counts"], "<i8").tolist()))
    assert got == want
