"""The pipeline's stages against brute force on their own inputs, and odd documents through all of them."""

import re
import sys
from pathlib import Path

import numpy as np
from pyspark.sql import Row
from tokenizers import Tokenizer

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import corpus_pipeline as P  # noqa: E402
from tessera.llm import packing, secret_scan, simhash, toxicity  # noqa: E402
from tests_llm_helpers import brute_windows, check_pieces  # noqa: E402


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_stages(spark, sf001, tmp_path):
    docs = spark.read.parquet(f"{sf001}/documents.parquet")
    columns, at = docs.columns, {}
    for i, (name, stage) in enumerate(P.STAGES):
        stage(spark, docs, sf001).write.parquet(str(tmp_path / str(i)))
        at[name] = (docs, spark.read.parquet(str(tmp_path / str(i))))
        docs = at[name][1]
        if i < 4:
            assert docs.columns == columns
    before, after = at["toxicity"]
    model = toxicity.fit_toxicity(before, spark.read.parquet(f"{sf001}/labels.parquet"))
    texts = dict(before.select("doc_id", "text").collect())
    gone = {d for d, s in zip(texts, model.scores(list(texts.values()))) if s >= 0.3}
    assert rows(after) == [r for r in rows(before) if r[0] not in gone] and gone
    before, after = at["simhash near-dedup"]
    first = {r.doc_id for r in simhash.simhash_groups(before).collect() if r.doc_id == r.component_id}
    assert rows(after) == [r for r in rows(before) if r[0] in first] and after.count() < before.count()
    before, after = at["benchmark decontamination"]
    items = [tuple(r) for r in spark.read.parquet(f"{sf001}/benchmark.parquet").select("item_id", "text").collect()]
    old, new = dict(before.select("doc_id", "text").collect()), dict(after.select("doc_id", "text").collect())
    touched = 0
    for d, t in old.items():
        words, hit = brute_windows(t, items)
        if not hit:
            assert new[d] == t
        elif len(hit) == len(words):
            assert d not in new
        else:
            touched += 1
            assert brute_windows(new[d], [])[0] == [w for i, w in enumerate(words) if i not in hit]
    assert touched
    before, after = at["secret scans"]
    new = dict(after.select("doc_id", "text").collect())
    assert new == {d: secret_scan.redacted(t) for d, t in before.select("doc_id", "text").collect()}
    assert any("[SECRET]" in t for t in new.values())
    before, after = at["packing"]
    check_pieces(after.collect(), before.select("doc_id", "text").collect())


def test_run_is_registered(spark, sf001):
    import __spark_entry__ as E
    assert E.queries()["pipeline"] is P.run and "pipeline" not in E.oracle_sql()
    out = P.run(spark, sf001)
    assert out.count() and {"doc_id", "sequence_id", "ids"} <= set(out.columns)


def test_odd_documents_through_every_stage(spark, sf001, tmp_path):
    data = [Row(1, None, "en", "a", None, "x", 1, True), Row(1, "", "en", "a", 0, "x", 1, True), Row(None, "null id", None, "a", 7, "x", 1, True),
            Row(2, "twice", "en", None, 5, "x", 1, True), Row(2, "twice", "en", None, 5, "x", 1, True), Row(2, "same id other text", "en", "a", 5, "x", 1, True),
            Row(3, "long " * 300_000, "en", "a", 1, "x", 1, True), Row(4, "token = abcdefghijklmnop", "en", "a", 1, "x", 1, True)]
    docs = spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long, "
                                 "__score string, sequence_id int, `a.b` boolean")
    empty = docs.where("false")
    for i, (_, stage) in enumerate(P.STAGES):
        for name, d in (("e", empty), ("d", docs)):
            stage(spark, d, sf001).write.parquet(str(tmp_path / f"{name}{i}"))
        empty, docs = (spark.read.parquet(str(tmp_path / f"{n}{i}")) for n in "ed")
        assert empty.count() == 0
        if i < 4:
            assert docs.columns == empty.columns and len(docs.columns) == 8
        if i == 1:
            got = rows(docs.select("doc_id", "text"))
            assert len(got) == 6 and got.count((2, "twice")) == 1 and sum(not (r[1] or "").strip() for r in got) == 1
    assert {r.doc_id for r in docs.collect()} == {1, 2, 3, 4, None}
