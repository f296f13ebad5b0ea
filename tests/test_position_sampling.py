import math

import pytest
from pyspark.sql import functions as F

from tessera.operators import position as POS
from tessera.operators import sampling as S
from tessera.operators.prefix import row_index


def _rows(spark, n):
    return spark.createDataFrame([(i, i % 3) for i in range(n)], "id long, g int")


def test_slices_chunks(spark):
    df = _rows(spark, 10)
    ref, cur, st = POS.slices(df, ["id"], "chunks", k=2, chunk=3)
    assert sorted(r.id for r in ref.collect()) == list(range(6))
    assert sorted(r.id for r in cur.collect()) == [6, 7, 8, 9]
    assert st.first()["status"] == "OK"
    _, cur9, _ = POS.slices(_rows(spark, 9), ["id"], "chunks", k=2, chunk=3)
    assert sorted(r.id for r in cur9.collect()) == [3, 4, 5, 6, 7, 8]
    _, _, small = POS.slices(_rows(spark, 8), ["id"], "chunks", k=2, chunk=3)
    assert small.first()["status"] == "SKIPPED_TOO_SMALL"


def test_published_tail_size():
    """Q7: tail of 4 chunks of 50,000 with a short last chunk: 160,701 rows."""
    n = 3 * 50000 + 10701 + 50000 * 20
    assert n - 50000 * (math.ceil(n / 50000) - 4) == 160701


def test_row_index_many_partitions(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 5000).alias("k"))
    ix = row_index(df, ["k"], num_partitions=13)
    assert ix.filter(F.col("row_idx") != F.col("k")).count() == 0


def test_row_index_hot_group(spark):
    """A group holding most rows is indexed without a single-task window."""
    df = spark.range(0, 4000).select("id", F.when(F.col("id") < 3000, 0).otherwise(F.col("id") % 5).alias("g"))
    ix = row_index(df, ["id"], ["g"], num_partitions=9)
    got = ix.groupBy("g").agg(F.min("row_idx").alias("a"), F.max("row_idx").alias("b"), F.count("*").alias("n"))
    for r in got.collect():
        assert r["a"] == 0 and r["b"] == r["n"] - 1


def test_stratified_split_sizes(spark):
    df = spark.createDataFrame([(i, 1 if i % 10 < 3 else 0) for i in range(1001)], "id long, target int")
    sp = S.stratified_split(df, "target", 0.2, seed=42)
    test = sp.filter("is_test")
    n_test = test.count()
    assert n_test == math.ceil(0.2 * 1001)
    share = test.filter("target = 1").count() / n_test
    assert abs(share - 301 / 1001) <= 1.0 / n_test + 1e-9
    assert sp.count() == 1001 and sp.select("id").distinct().count() == 1001


def test_published_stratified_sizes(spark):
    """Goldens: 93,682 -> 18,737 test; 1,265,975 -> 253,195 test."""
    for n, want in ((93682, 18737), (1265975, 253195)):
        df = spark.range(n).select("id", (F.col("id") % 5 == 0).cast("int").alias("target"))
        q = S.stratified_quotas(df, "target", 0.2).agg(F.sum("test_rows")).first()[0]
        assert q == want


def test_exact_sample_sizes(spark):
    df = spark.range(0, 20000)
    assert S.exact_sample(df, 1000, seed=1).count() == 1000
    big = S.exact_sample(df, 15000, seed=1)
    assert big.count() == 15000 and big.distinct().count() == 15000
    assert S.exact_sample(spark.range(10), 1000).count() == 10


def test_arms_partition_rows(spark):
    df = spark.range(0, 3000)
    arms = S.assign_arm(df, 3)
    assert arms.count() == 3000 and set(r.arm for r in arms.select("arm").distinct().collect()) == {0, 1, 2}


def test_first_rows_cutoff_path_is_exact(spark):
    from tessera.operators import topn
    df = spark.range(0, 50000).select("id", (F.col("id") * 7919 % 1000).alias("k"))
    for n in (1, 777, 20000):
        got = [tuple(r) for r in topn.first_rows(df, n, ["k", "id"]).collect()]
        want = [tuple(r) for r in df.orderBy("k", "id").limit(n).collect()]
        assert got == want
    s = S.exact_sample(df, 500, seed=3)
    assert s.count() == 500


@pytest.mark.parametrize("n", [0, 1, 250, 300, 1300, 1999, 2000, 5000])
def test_first_and_last_rows_with_null_keys_and_ties(spark, n):
    """A tenth of the leading keys and some of the second are NULL, the rest stand on a few dates."""
    from tessera.operators import topn
    df = spark.range(0, 2000).select(
        "id", F.when(F.col("id") % 10 != 0, F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") % 7).cast("int"))).alias("d"),
        F.when(F.col("id") % 3 != 0, F.col("id").cast("double")).alias("x"))
    for first, keys in ((topn.first_rows, ["d", "x", "id"]), (topn.last_rows, ["d", "x", "id"])):
        order = [F.col(k).desc() if first is topn.last_rows else F.col(k) for k in keys]
        assert first(df, n, keys).collect() == df.orderBy(*order).limit(n).collect()


def test_candidates_are_few_when_dates_tie(spark):
    from tessera.operators import topn
    df = spark.range(0, 200_000).select("id", (F.col("id") % 20).alias("d"))
    for desc in (False, True):
        kept = df.filter(topn.boundary(df, 1000, [F.col("d"), F.col("id")], desc)).count()
        assert 1000 <= kept <= 2 * 1000 + 200_000 / topn.ACCURACY + topn.SLACK_ROWS


def test_null_groups_have_an_index_and_sums(spark):
    from tessera.operators.prefix import running_sums
    df = spark.range(0, 1000).select("id", F.when(F.col("id") % 4 != 0, F.col("id") % 3).alias("g"), F.lit(1).alias("one"))
    got = row_index(df, ["id"], ["g"], num_partitions=6).groupBy("g").agg(F.max("row_idx").alias("m"), F.count("*").alias("n")).collect()
    assert sorted((r["n"], r["m"]) for r in got) == [(250, 249)] * 4
    sums = running_sums(df, ["id"], ["one"], ["g"], num_partitions=6, totals=True)
    assert sums.count() == 1000 and {(r["m"], r["t"]) for r in sums.groupBy("g").agg(
        F.max("one_cum").alias("m"), F.max("one_total").alias("t")).collect()} == {(250, 250)}


def test_split_extreme_fractions_and_tiny_classes(spark):
    df = spark.createDataFrame([(i, 0 if i < 3 else 1) for i in range(40)], "id long, target int")
    none = S.stratified_split(df, "target", 0.0, seed=1)
    assert none.filter("is_test").count() == 0
    allrows = S.stratified_split(df, "target", 1.0, seed=1)
    assert allrows.filter("is_test").count() == 40
    r = S.random_split(df, 0.5, seed=9)
    assert r.filter("is_test").count() == 20 and r.count() == 40


def test_split_of_equal_rows_is_exact(spark):
    """Ten equal rows: nothing tells them apart, the sizes hold all the same."""
    df = spark.createDataFrame([(1, 0)] * 10, "id long, target int")
    out = S.stratified_split(df, "target", 0.3)
    assert out.columns == ["id", "target", "is_test"]
    assert sorted(tuple(r) for r in out.collect()) == [(1, 0, False)] * 7 + [(1, 0, True)] * 3


def test_null_labels_are_a_class(spark):
    df = spark.range(0, 300).select("id", F.when(F.col("id") % 3 != 0, F.col("id") % 3).alias("y"))
    sizes = {r["y"]: r["n"] for r in S.stratified_split(df, "y", 0.2).filter("is_test").groupBy("y").agg(F.count("*").alias("n")).collect()}
    assert sizes == {None: 20, 1: 20, 2: 20}
