"""Repeated word sequences against a plain count of all windows."""

import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import Row

from tessera.llm import substring_dedup as S


def brute(docs, n=35):
    split = [(d, re.findall("[^\x20\x09-\x0d]+", t or "")) for d, t in docs]
    seen = Counter(tuple(w[i:i + n]) for _, w in split for i in range(len(w) - n + 1))
    out = []
    for d, w in split:
        gone = {j for i in range(len(w) - n + 1) if seen[tuple(w[i:i + n])] > 1 for j in range(i, i + n)}
        out.append((d, len(w), len(gone), " ".join(x for j, x in enumerate(w) if j not in gone)))
    return sorted(out, key=repr)


def got(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("hot", [0, 64])
def test_whole_table(spark, sf001, texts, hot):
    docs = spark.read.parquet(f"{sf001}/documents.parquet").repartition(3)
    want = brute(texts.items())
    assert any(r[2] for r in want)
    assert got(S.remove_repeats(docs, hot_chunks=hot)) == want


@pytest.mark.parametrize("hot,n,k", [(64, 5, 2), (0, 5, 3), (1, 4, 4), (64, 3, 1)])
def test_short_windows_in_many_shards(spark, monkeypatch, hot, n, k):
    for name, value in (("CHUNK_BYTES", 300), ("SHARD_BYTES", 100), ("COUNTER_BYTES", 200), ("MAX_WINDOWS", 7)):
        monkeypatch.setattr(S, name, value)
    rng = np.random.default_rng(6)
    words = ["a", "b", "c", "dé", "E", "e"]
    rows = [(i, " ".join(rng.choice(words, rng.integers(0, 30)))) for i in range(40)]
    rows += [(50, "a " * 60), (51, "b a " * 30), (52, rows[3][1]), (53, "x y z " + rows[5][1] + " q")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert got(S.remove_repeats(df, n=n, k=k, hot_chunks=hot)) == brute(rows, n)


def test_edge_cases(spark):
    passage = " ".join(f"p{i}" for i in range(40))
    long = " ".join(f"w{i % 5000}" for i in range(300_000))
    rows = [Row(1, None, "x", 1), Row(1, "", "x", 1), Row(None, "a b\tc", "x", 1), Row(2, passage, "x", 1), Row(2, passage, "x", 1),
            Row(3, "u v " + passage + "\n\n" + passage + " w", "x", 1), Row(4, " ".join(f"q{i}" for i in range(34)), "x", 1),
            Row(4, " ".join(f"q{i}" for i in range(34)), "x", 1), Row(5, long, "x", 1), Row(6, "\0 \x1c \x1d x", "x", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_words string, chunk int")
    out = S.remove_repeats(df)
    assert out.columns == ["doc_id", "n_words", "n_removed", "kept_text"]
    assert got(out) == brute([(r[0], r[1]) for r in rows])
    assert S.remove_repeats(df.where("false")).count() == 0


def test_copies_of_one_partition_make_bounded_chunks():
    text = b"x" * 2000
    made = list(S._chunks(((i, text) for i in range(200_000))))
    assert [i for ids, _, _ in made for i in ids] == list(range(200_000))
    for ids, index, texts in made:
        assert texts == [text] and set(index) == {0} and len(ids) * len(text) <= S.CHUNK_ROWS
    assert max(len(ids) for ids, _, _ in S._chunks(((None, b"") for _ in range(600_000)))) * 64 <= S.CHUNK_ROWS + 64
    mixed = [(i, b"y" * (i % 7 * 400_000)) for i in range(40)]
    for ids, index, texts in S._chunks(mixed):
        assert [mixed[i][1] for i in ids] == [texts[k] for k in index]
        assert len(texts) == 1 or sum(map(len, texts)) <= S.CHUNK_BYTES


def test_a_common_line_does_not_gather_its_contexts(spark, monkeypatch):
    """A footer in every document, documents in pairs: right results, and segments spread over the shards."""
    for name, value in (("CHUNK_BYTES", 600), ("SHARD_BYTES", 2000), ("COUNTER_BYTES", 5000)):
        monkeypatch.setattr(S, name, value)
    footer = " ".join(f"f{i}" for i in range(8))
    rows = [(2 * i + j, " ".join(f"a{i}x{k}" for k in range(12)) + " " + footer + f" end{i}") for i in range(60) for j in (0, 1)]
    rows += [(1000, "u " + footer + " v")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert got(S.remove_repeats(df, n=10, k=4, hot_chunks=2)) == brute(rows, 10)
    chunk = S.Chunk([t.encode() for _, t in rows])
    h, first, end = chunk.anchors(10, 4)
    common = np.flatnonzero(np.bincount(np.unique(h, return_inverse=True)[1]) > 2)
    hot = np.isin(h, np.unique(h)[common])
    assert hot.any()
    row = {"chunk": 1, "index": list(range(len(rows))), "lengths": [len(t.encode()) for _, t in rows],
           "blob": S._zip(b"".join(t.encode() for _, t in rows))}
    at, _ = S._spread(first[hot], end[hot])
    own = np.unique(chunk.sums(10)[at])
    answers = S._table([{"chunk": 1, "kind": 1, "hashes": h[hot].tobytes()}, {"chunk": 1, "kind": 2, "hashes": own.tobytes()}], S._ANSWER)
    together = S._table([{"chunk": 1, "kind": 1, "hashes": h[hot].tobytes()}, {"chunk": 1, "kind": 3, "hashes": own.tobytes()}], S._ANSWER)
    spread = S._segments(row, answers, 10, 4, 50)
    assert len({r["shard"] for r in spread}) > 40 > len({r["shard"] for r in S._segments(row, together, 10, 4, 50)})


def test_match_statistics():
    rng = np.random.default_rng(7)
    segments = [rng.integers(1, 4, rng.integers(6, 30)) for _ in range(30)]
    weight = rng.integers(1, 3, 30)
    n = 6
    seen = Counter()
    for s, w in zip(segments, weight):
        for i in range(len(s) - n + 1):
            seen[tuple(s[i:i + n])] += int(w)
    for s, hit in zip(segments, S.repeated_windows(segments, weight, n)):
        assert hit.tolist() == [seen[tuple(s[i:i + n])] >= 2 for i in range(len(s) - n + 1)]
