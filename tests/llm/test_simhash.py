"""SimHash groups against brute force, with every posting short and with every posting refined."""

import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import Row

from tessera.llm.components import connected_components
from tessera.llm.simhash import fingerprint, near_pairs, simhash_groups


def brute_fp(text):
    words = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    grams = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] if len(words) >= 3 else [" ".join(words)] * bool(words)
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_groups(rows, k=2):
    """[(id, fp)] -> sorted [(id, hex, component)]"""
    up = list(range(len(rows)))

    def top(i):
        while up[i] != i:
            i = up[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            if (rows[i][1] ^ rows[j][1]).bit_count() <= k:
                up[top(i)] = top(j)
    low = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            low[top(i)] = min(d, low.get(top(i), d))
    return sorted(((d, f"{f:016x}", low.get(top(i))) for i, (d, f) in enumerate(rows)), key=repr)


def got(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_whole_table(spark, sf001, texts):
    want = brute_groups([(d, brute_fp(t)) for d, t in texts.items()])
    docs = spark.read.parquet(f"{sf001}/documents.parquet")
    assert got(simhash_groups(docs)) == want


@pytest.mark.parametrize("hot", [0, 3, 64])
@pytest.mark.parametrize("k", [0, 1, 2, 3])
def test_pairs_at_any_length_of_posting(spark, hot, k):
    rng = np.random.default_rng(5)
    base = [int(x) for x in rng.integers(0, 2**63, 12, dtype=np.uint64)]
    fps = {0, 2**64 - 1, 1, 3, 7, 2**63}
    for b in base:
        for _ in range(14):
            f = b
            for bit in rng.integers(0, 64, rng.integers(0, 4)):
                f ^= 1 << int(bit)
            fps.add(f)
    signed = {f: f - 2**64 if f >= 2**63 else f for f in fps}
    want = {tuple(sorted((signed[a], signed[b]))) for a in fps for b in fps
            if a != b and (a ^ b).bit_count() <= k}
    df = spark.createDataFrame([(s,) for s in signed.values()], "fp long")
    assert set(map(tuple, near_pairs(df, k, hot).collect())) == want


def test_edge_cases(spark):
    rows = [Row(doc_id=5, text=None, fp="x", component_id=1, root=2, id=3), Row(5, "", "x", 1, 2, 3),
            Row(7, " \n\t ", "x", 1, 2, 3), Row(None, "one two", "x", 1, 2, 3), Row(9, "ONE  two", "x", 1, 2, 3),
            Row(9, "ONE  two", "x", 1, 2, 3), Row(None, "a b c d e f", "x", 1, 2, 3),
            Row(11, "Ünï çödé ﬀ " * 400_000, "x", 1, 2, 3)]
    df = spark.createDataFrame(rows, "doc_id long, text string, fp string, component_id int, root int, id int")
    out = simhash_groups(df)
    assert out.columns == ["doc_id", "fingerprint", "component_id"]
    small = [(r[0], brute_fp(r[1])) for r in rows[:-1]]
    want = brute_groups(small + [(11, brute_fp(rows[-1][1]))])
    assert got(out) == want
    assert simhash_groups(df.where("false")).count() == 0


def test_blocks_of_a_long_text_join_up():
    text = "".join(f"w{i % 977} " for i in range(400_000)).encode()
    words = text.split()
    h = [xxhash.xxh64_intdigest(b" ".join(words[i:i + 3]), 42) for i in range(len(words) - 2)]
    ones = np.unpackbits(np.array(h, np.uint64).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0)
    assert fingerprint(text) == sum(1 << b for b in range(64) if 2 * int(ones[b]) > len(h))


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(200, 200), (7, 6), (-5, 300)]
    df = spark.createDataFrame(edges, "a long, b long")
    out = dict(connected_components(df).collect())
    assert out == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 160)}, -5: -5, 300: -5}
    assert connected_components(df.where("a = 200")).count() == 0
