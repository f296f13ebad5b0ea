"""Training derives its rows once, counts classes once and drops rows with missing features by column."""

import math

import pytest
from pyspark.sql import functions as F

from tessera.operators import model as ML
from tessera.operators import sampling as S
from tessera.plans import q_model as Q

SCHEMA = ("id long, issue_d string, loan_status string, loan_amnt double, int_rate string, installment double, annual_inc double, dti double, "
          "delinq_2yrs double, inq_last_6mths double, open_acc double, pub_rec double, revol_bal double, revol_util string, total_acc double, "
          "emp_length string, term string, grade string, sub_grade string, home_ownership string, verification_status string, purpose string, "
          "addr_state string")


def loan(i, **other):
    row = dict(id=i, issue_d=f"2020-01-{1 + i % 28:02d}", loan_status=["Fully Paid", "Charged Off", "Current"][i * 7 % 11 % 3], loan_amnt=100.0 + i,
               int_rate=f"{5 + i % 20}.50%", installment=10.0 + i * 13 % 97, annual_inc=1000.0 + i * 31 % 777, dti=i % 40 / 2, delinq_2yrs=float(i % 3),
               inq_last_6mths=float(i % 6), open_acc=float(i % 9), pub_rec=float(i % 2), revol_bal=float(i * 17 % 501), revol_util=f"{i % 101}.0%",
               total_acc=float(i % 12), emp_length=f"{1 + i % 9} years", term=" 36 months", grade="ABC"[i % 3], sub_grade="ABC"[i % 3] + "12"[i % 2],
               home_ownership="RENT", verification_status=None if i % 50 == 0 else "Verified", purpose=["car", "house"][i % 2], addr_state="CA")
    return tuple((row | other).values())


def counted(spark, df):
    """The frame with a count of the rows that are computed."""
    seen = spark.sparkContext.accumulator(0)

    def run(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    return df.mapInArrow(run, df.schema), seen


@pytest.fixture(scope="module")
def rows(spark):
    path = Q.checkpoint_dir(spark).rstrip("/") + "/training-passes"
    spark.createDataFrame([loan(i, **({"dti": None} if i % 40 == 0 else {})) for i in range(600)], SCHEMA).repartition(3).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def test_fit_and_score_derives_the_loans_once(spark, rows, monkeypatch):
    df, seen = counted(spark, rows)
    monkeypatch.setattr(Q, "loans_df", lambda *_: df)
    got = {r["id"]: r for r in Q.ml9_fit_and_score(spark, None).collect()}
    assert seen.value == 600
    sp = S.stratified_split(ML.prepare(rows, "binary"), "target", 0.2, seed=42)
    want = ML.score(ML.fit(sp.filter(~F.col("is_test")), 1.0), sp.filter("is_test")).collect()
    assert sorted(got) == sorted(r["id"] for r in want)
    for r in want:
        assert got[r["id"]]["score"] == pytest.approx(r["score"], abs=1e-6) and got[r["id"]]["target"] == r["target"]


def test_fit_counts_classes_once(spark, rows):
    """One pass each: classes, sketch, ranks, means, levels, model rows."""
    train = ML.prepare(rows, "binary").select("id", "target", "dti", "revol_bal", "grade")
    df, seen = counted(spark, train)
    ML.fit(df, 1.0, rows=train.count(), cached=True)
    assert seen.value <= 6 * train.count()


def test_split_by_a_kept_hash_is_the_same(spark):
    """Repeated ids of different and of equal rows, and null ids."""
    df = spark.createDataFrame([(i // 40 if i % 90 else None, i % 2, i // 3 % 7) for i in range(800)], "id long, target int, v int")
    want = S.stratified_split(df, "target", 0.3, seed=42)
    got = S.stratified_split(df.withColumn("_hash", S.split_hash(42)), "target", 0.3, seed=42, hashed="_hash").drop("_hash")
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_rows_with_missing_features_are_dropped(spark):
    odd = {1: {"dti": None}, 2: {"dti": math.nan}, 3: {"dti": math.inf}, 4: {"dti": -math.inf}, 5: {"int_rate": None}, 6: {"revol_util": "n/a"},
           7: {"emp_length": "n/a"}, 8: {"emp_length": None}, 9: {"total_acc": math.nan}, 10: {"loan_status": None}, 11: {"grade": None}}
    df = spark.createDataFrame([loan(i, **{"loan_status": "Fully Paid"} | odd.get(i, {})) for i in range(13)], SCHEMA)
    got = {r["id"]: r for r in ML.prepare(df, "binary").collect()}
    assert sorted(got) == [0, 3, 4, 11, 12] and got[11]["grade"] == "Missing"
    bad = spark.createDataFrame([loan(1, loan_status="Fully Paid", int_rate="x", dti=None, loan_amnt=None)], SCHEMA)
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        ML.prepare(bad, "binary").collect()


def test_missing_features_are_dropped_below_the_join(spark):
    """A condition on columns of one table is applied to that table, and the rows without a partner go with it."""
    a = spark.createDataFrame([loan(i, loan_status="Fully Paid") for i in range(5)], SCHEMA).drop("total_acc")
    b = spark.createDataFrame([(1, 5.0), (2, math.nan), (3, None)], "k long, total_acc double")
    df = ML.prepare(a.join(b.hint("merge"), a["id"] == b["k"], "left").drop("k"), "binary")
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "Join Inner" in plan and "LeftOuter" not in plan
    assert [r["id"] for r in df.collect()] == [1]


def test_sweep_derives_the_loans_and_scores_once(spark, rows, monkeypatch):
    df, seen = counted(spark, rows)
    monkeypatch.setattr(Q, "loans_df", lambda *_: df)
    scored = []
    score = ML.score

    def counting(*args, **kw):
        out, n = counted(spark, score(*args, **kw))
        scored.append(n)
        return out

    monkeypatch.setattr(ML, "score", counting)
    got = Q.ml10_regularisation_sweep(spark, None).collect()
    assert seen.value == 600 and [r["regularization_c"] for r in got] == [1.0, 0.1]
    assert [n.value for n in scored] == [r["rows"] for r in got]
    sp = S.stratified_split(ML.prepare(rows, "binary"), "target", 0.2, seed=42)
    for r in got:
        s = score(ML.fit(sp.filter(~F.col("is_test")), r["regularization_c"]), sp.filter("is_test")).collect()
        assert r["rows"] == len(s) and r["accuracy"] == pytest.approx(sum(x["target"] == x["prediction"] for x in s) / len(s))
        pairs = [(p["score"] > n["score"]) + 0.5 * (p["score"] == n["score"]) for p in s for n in s if p["target"] == 1 and n["target"] == 0]
        assert r["roc_auc"] == pytest.approx(sum(pairs) / len(pairs), abs=1e-6)
