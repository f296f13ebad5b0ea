"""Decontamination against a plain scan of every window; FM-index against brute force."""

import re

import numpy as np
import pytest
from pyspark.sql import Row

from tessera.llm import decontaminate as D
from tessera.llm.fmindex import FMIndex, WaveletMatrix

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, n=10):
    windows = {}
    for i, t in items:
        w = words(t)
        for k in range(max(1, len(w) - n + 1) if w else 0):
            windows.setdefault(tuple(w[k:k + n]), set()).add(i)
    sizes = {len(w) for w in windows}
    out = []
    for d, t in docs:
        w, hit, found = words(t), set(), set()
        for m in sizes:
            for k in range(len(w) - m + 1):
                got = windows.get(tuple(w[k:k + m]))
                if got is not None:
                    hit |= set(range(k, k + m))
                    found |= {str(i) for i in got if i is not None}
        out.append((d, len(w), len(hit), sorted(found)))
    return sorted(out, key=repr)


def got(df):
    return sorted((tuple(r)[:4] for r in df.collect()), key=repr)


@pytest.mark.parametrize("block_bytes", [1 << 22, 2000])
def test_whole_table(spark, sf001, texts, block_bytes):
    docs = spark.read.parquet(f"{sf001}/documents.parquet")
    bench = spark.read.parquet(f"{sf001}/benchmark.parquet")
    want = brute(texts.items(), [tuple(r) for r in bench.select("item_id", "text").collect()])
    assert any(r[2] for r in want)
    assert got(D.decontaminate(docs, bench, block_bytes=block_bytes)) == want


SCHEMA = "doc_id long, text string, __words string, n_hit int, lang string"
ITEMS = [Row(1, "one two"), Row(2, "A b c d e f g h i j k"), Row(None, "null id here"), Row(3, None), Row(4, " ,;"),
         Row(1, "one two"), Row(5, "çà Ünïq 9")]
DOCS = [(1, "ONE, two! one two three"), (2, None), (3, ""), (None, "x null-ID here y"), (1, "ONE, two! one two three"),
        (6, "z a b c d e f g h i j k l"), (7, "a b c d e f g h i j k" * 30_000), (8, "çà Ünïq 9; x ÇÀ ünïq 9 çà Ünïq 9"),
        (9, "one"), (10, "two one"), (11, "b c d e f g h i j k")]


@pytest.mark.parametrize("block_bytes", [1 << 22, 20])
def test_edge_cases(spark, block_bytes):
    docs = spark.createDataFrame([(d, t, "w", 4, "en") for d, t in DOCS], SCHEMA)
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert got(D.decontaminate(docs, items, block_bytes=block_bytes)) == brute(DOCS, [tuple(r) for r in ITEMS])
    cut = D.cut_spans(docs, items, block_bytes=block_bytes)
    assert cut.columns == docs.columns
    texts = {r.doc_id: r.text for r in cut.collect()}
    assert 11 not in texts and 8 in texts
    assert words(texts[1]) == ["three"]
    assert texts[2] is None and texts[3] == "" and texts[9] == "one" and texts[10] == "two one"
    assert texts[6] == "z  l" and words(texts[8]) == ["x", "ÇÀ", "ünïq", "9"]
    assert D.decontaminate(docs.where("false"), items).count() == 0
    assert all(r[2] == 0 and r[3] == [] for r in got(D.decontaminate(docs, items.where("false"))))


def test_small_shards(spark, monkeypatch):
    monkeypatch.setattr(D, "SHARD_BYTES", 10)
    import pyarrow as pa
    b = pa.RecordBatch.from_arrays([pa.array(["aaaa", None, "b" * 30, "", "cc"])], names=["t"])
    assert [p.num_rows for p in D._shards(iter([b, b]), 0)] == [3, 5, 2]


@pytest.mark.parametrize("sample", [1, 3, 8])
def test_fm_index(sample):
    rng = np.random.default_rng(3)
    for n, symbols in ((0, 4), (1, 2), (200, 3), (1000, 40), (129, 1)):
        seq = rng.integers(0, symbols, n)
        index = FMIndex(seq, symbols, sample=sample)
        for m in (1, 2, 5):
            pats = rng.integers(0, symbols, (30, m))
            low, high = index.search(pats.ravel(), np.arange(30) * m, np.full(30, m))
            for p, a, b in zip(pats, low, high):
                want = [i for i in range(n - m + 1) if (seq[i:i + m] == p).all()]
                assert sorted(index.locate(np.arange(a, max(a, b))).tolist()) == want


def test_wavelet_ranks():
    rng = np.random.default_rng(4)
    seq = rng.integers(0, 100, 700)
    w = WaveletMatrix(seq, 100)
    c, i = rng.integers(0, 100, 500), rng.integers(0, 701, 500)
    assert w.rank(c, i).tolist() == [int((seq[:k] == s).sum()) for s, k in zip(c, i)]
    s, r = w.access_rank(np.arange(700))
    assert (s == seq).all() and r.tolist() == [int((seq[:k] == seq[k]).sum()) for k in range(700)]
