"""Toxicity and quality: held-out accuracy, fold rules, the counterfactual penalty and edge cases."""

import zlib

import numpy as np
import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from tessera.llm import labels as L
from tessera.llm import quality as Q
from tessera.llm import toxicity as X

SF = "/root/testdata/sf0.01"


def accuracy(spark, out, label, folds, fold_out):
    rows = out.collect()
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    lab = {r.doc_id: r[label] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % folds == fold_out)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3)
    held = [r.predicted == lab[r.doc_id] for r in rows if r.held_out and r.doc_id in lab]
    return np.mean(held)


def tables(spark):
    return spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")


def test_toxicity_held_out(spark):
    assert accuracy(spark, X.score_toxicity(*tables(spark)), "toxic", 4, 2) > 0.9


def test_quality_held_out(spark):
    assert accuracy(spark, Q.score_quality(*tables(spark)), "quality", 5, 0) > 0.9


SCHEMA = "doc_id long, text string, score string, held_out string, id string, label int"
ROWS = [Row(1, None, "a", "b", "c", 1), Row(2, "", "a", "b", "c", 1), Row(None, "fine words here", "a", "b", "c", 1),
        Row(3, "fine words", "a", "b", "c", 1), Row(3, "fine words", "a", "b", "c", 1), Row(4, "vile " * 200_000, "a", "b", "c", 1),
        Row(5, " \n\t", "a", "b", "c", 1)]


@pytest.mark.parametrize("score,label", [(X.score_toxicity, "toxic"), (Q.score_quality, "quality")])
def test_edge_cases(spark, score, label):
    docs = spark.createDataFrame(ROWS, SCHEMA)
    empty = spark.createDataFrame([], f"doc_id long, {label} int")
    odd = spark.createDataFrame([Row(3, 1), Row(3, 0), Row(4, 0), Row(None, 1), Row(5, None), Row(77, 7), Row(1, 0), Row(2, 1)],
                                f"doc_id long, {label} int")
    for labels in (empty, odd):
        out = score(docs, labels)
        assert out.columns == ["doc_id", "held_out", "score", "predicted"]
        rows = out.collect()
        assert sorted((r.doc_id or -1) for r in rows) == [-1, 1, 2, 3, 3, 4, 5]
        assert all(0 <= r.score <= 1 for r in rows)
        assert len({r.score for r in rows if r.doc_id == 3}) == 1
        assert score(docs.where("false"), labels).count() == 0
    kept = X.drop_toxic(docs, spark.createDataFrame([], "doc_id long, toxic int"))
    assert kept.columns == docs.columns
    for few in ([], [(1, 1), (2, 1)], [(1, 0)]):  # nothing to learn from: nothing is rejected
        assert X.drop_toxic(docs, spark.createDataFrame(few, "doc_id long, toxic int")).count() == len(ROWS)


def test_counterfactual_penalty_frees_neutral_mentions(spark):
    """A group is only mentioned in toxic training texts; neutral mentions of it must stay low."""
    rng = np.random.default_rng(1)
    words = ["river", "stone", "cloud", "paper", "window", "garden", "music", "number", "letter", "winter"]
    rows, labels = [], []
    for i in range(600):
        text = " ".join(rng.choice(words, 12))
        if i % 4 == 0:
            text += " muslims are vermin" if i % 8 == 0 else " muslims again"
        toxic = int(i % 4 == 0)
        rows.append((i, text))
        labels.append((i, toxic if i % 8 == 0 or rng.random() < 0.9 else 0))
    docs, lab = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    plain = X.fit_toxicity(docs, lab, twin_weight=0.0)
    fair = X.fit_toxicity(docs, lab, twin_weight=50.0)
    a, b = "river stone cloud paper window muslims letter", "river stone cloud paper window christians letter"
    gap = lambda m: float(np.diff(np.log(m.scores([b, a]) / (1 - m.scores([b, a]))))[0])
    assert abs(gap(fair)) < 0.25 * abs(gap(plain))


def test_swap_keeps_everything_else():
    swap = X.swap_terms()
    assert swap("The Women, men and womenfolk.") == "The men, women and womenfolk."
    assert X.swap_terms(())("women") == "women"


def test_quality_threshold_is_of_all_labelled_rows(spark):
    rng = np.random.default_rng(3)
    texts = [" ".join(rng.choice(["fine", "words", "HERE", "12", "#!", "of", "it."], int(rng.integers(1, 40)))) for _ in range(900)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(7, "once more"), (8, None), (None, "fine words")]
    lab = [(i, int(len(texts[i]) + rng.normal() * 20 > 70)) for i in range(800)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([*lab, (7, 1), (850, 2), (None, 1)], "doc_id long, quality int")
    m = Q.fit_quality(docs, labels, max_rows=60)
    of = dict(lab) | {7: 1}
    kept = [(t, of[i]) for i, t in rows if i in of and t is not None and zlib.crc32(str(i).encode()) % 5 != 0]
    s, y = m.ranks([t for t, _ in kept]), np.array([v for _, v in kept])
    assert m.weights.any() and len(kept) > 500
    assert m.cutoff == pytest.approx(np.quantile(s, np.mean(y == 0)), abs=1e-9)
    assert m.slope == pytest.approx(3 / s.std(), rel=1e-6)


def test_sample_is_bounded_in_rows(spark):
    """One id on most rows: the sample holds it once, with the same text whatever the row order."""
    many = spark.range(200_000).select(F.lit(7).cast("long").alias("doc_id"), F.concat(F.lit("text "), F.col("id") % 50).alias("text"))
    others = spark.range(100, 900).select(F.col("id").alias("doc_id"), F.concat(F.lit("other "), "id").alias("text"))
    docs = many.unionByName(others).unionByName(spark.createDataFrame([(8, None), (None, "x")], "doc_id long, text string"))
    labels = docs.select("doc_id", F.lit(1).alias("toxic"))
    whole = L.labelled_sample(docs, labels, "toxic", 4, 2, 10_000)
    rows = whole.collect()
    assert len(rows) == len({r.id for r in rows}) == docs.select("doc_id").distinct().where(
        (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 != 2) & (F.col("doc_id") != 8)).count()
    small = {r.id: r.text for r in L.labelled_sample(docs, labels, "toxic", 4, 2, 50).collect()}
    again = {r.id: r.text for r in L.labelled_sample(docs.repartition(3), labels.repartition(5), "toxic", 4, 2, 50).collect()}
    assert small == again and 40 <= len(small) <= 50
    assert L.labelled_sample(docs, labels.where("false"), "toxic", 4, 2, 50).count() == 0


def test_pairs_rank_by_the_telling_feature():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(400, Q.N_FEATURES))
    y = (x[:, 3] > -1).astype(int)
    m = Q.fit_pairs(x, y)
    s = m.rank(x)
    assert s[y == 1].mean() > s[y == 0].mean() and np.mean((s >= m.cutoff) == y) > 0.95
