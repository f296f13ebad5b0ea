"""Embedding links against all pairs: exact links, recall at the threshold, components, odd rows."""

import numpy as np
import pytest
from pyspark.sql import Row

from tessera.llm import embedding_dedup as E


def brute(rows, cosine=0.93):
    def unit(v):
        if not v or any(x is None or not np.isfinite(x) for x in v) or not any(v):
            return None
        a = np.array(v, np.float64)
        return a / np.sqrt((a * a).sum())
    units = [unit(v) if lab is not None else None for _, v, lab in rows]
    links = {(i, j) for i in range(len(rows)) for j in range(i) if units[i] is not None and units[j] is not None
             and rows[i][2] == rows[j][2] and len(units[i]) == len(units[j]) and units[i] @ units[j] >= cosine}
    up = list(range(len(rows)))

    def top(i):
        while up[i] != i:
            i = up[i]
        return i
    n = [0] * len(rows)
    for i, j in links:
        n[i] += 1
        n[j] += 1
        up[top(i)] = top(j)
    low = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            low[top(i)] = min(r[0], low.get(top(i), r[0]))
    out = [(r[0], n[i], low.get(top(i)), r[0] == low.get(top(i))) for i, r in enumerate(rows)]
    return sorted(out, key=repr), len(links)


def got(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_odd_rows(spark):
    v = [0.5, 0.5, 0.1]
    rows = [(1, v, 1), (2, v, 1), (2, v, 1), (3, v, 2), (4, v, None), (5, None, 1), (6, [0.0, 0.0, 0.0], 1), (7, [0.0, 0.0, 0.0], 1),
            (8, [1.0, None, 0.0], 1), (9, [float("nan"), 1.0, 1.0], 1), (10, [float("inf"), 1.0, 1.0], 1), (11, [], 1),
            (12, [0.52, 0.5, 0.1], 1), (13, [0.5, 0.5], 1), (None, [-0.5, -0.5, 0.1], 1), (None, [-0.5, -0.5, 0.11], 1), (14, [5.0, 5.0, 1.0], 2)]
    df = spark.createDataFrame([Row(*r, "x", 1) for r in rows], "vec_id long, embedding array<float>, label int, n_links string, node int")
    out = E.embedding_groups(df)
    assert out.columns == ["vec_id", "n_links", "component_id", "kept"]
    assert got(out) == brute([(a, None if b is None else [None if x is None else float(np.float32(x)) for x in b], c) for a, b, c in rows])[0]
    assert E.embedding_groups(df.where("false")).count() == 0


@pytest.mark.parametrize("low", [0.93, 0.97])
def test_recall_close_to_the_threshold(spark, low):
    rng = np.random.default_rng(8)
    base = rng.normal(size=(900, 64))
    base /= np.linalg.norm(base, axis=1, keepdims=True)
    side = rng.normal(size=base.shape)
    side -= (side * base).sum(1, keepdims=True) * base
    side /= np.linalg.norm(side, axis=1, keepdims=True)
    cos = rng.uniform(low + 1e-3, low + 0.02, (900, 1))
    twin = cos * base + np.sqrt(1 - cos ** 2) * side
    rows = [(i, x.tolist(), i % 900 % 3) for i, x in enumerate(np.concatenate((base, twin)))]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    out = {r.vec_id: r for r in E.embedding_groups(df).collect()}
    found = sum(out[900 + i].component_id == i for i in range(900))
    assert found >= 0.95 * 900
    assert sum(r.n_links for r in out.values()) == 2 * found


def test_whole_table_matches_all_pairs(spark):
    d = "/root/testdata/sf0.01/embeddings.parquet"
    rows = [tuple(r) for r in spark.read.parquet(d).select("vec_id", "embedding", "label").collect()]
    want, n = brute(rows)
    result = got(E.embedding_groups(spark.read.parquet(d)))
    assert len(result) == len(want)
    assert sum(r[1] for r in result) >= 0.9 * 2 * n and all(a[1] <= b[1] for a, b in zip(result, want))


def test_windows_over_batches():
    import pyarrow as pa
    rng = np.random.default_rng(9)
    key, at = np.sort(rng.integers(0, 3, 200)), rng.uniform(0, 5, 200)
    order = np.lexsort((at, key))
    key, at, node = key[order], at[order], np.arange(200)
    batches = [pa.RecordBatch.from_arrays([pa.array(x[i:i + 17]) for x in (key, at, node)], names=["k", "a", "n"]) for i in range(0, 200, 17)]
    pairs = [p for b in E._collisions(0.3)(iter(batches)) for p in zip(*(c.to_pylist() for c in b.columns))]
    want = {(i, j) for i in range(200) for j in range(i + 1, 200) if key[i] == key[j] and at[j] - at[i] <= 0.3}
    assert len(pairs) == len(set(pairs)) and set(pairs) == want
