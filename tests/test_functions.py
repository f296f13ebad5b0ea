import hashlib

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tessera.functions.hashing import gaussian, md5_mod
from tessera.functions.misc import clip, pct
from tessera.functions.parse import binary_target, parse_emp_length, percent_lenient, percent_strict


def test_emp_length(spark):
    cases = [("< 1 year", 0.5), ("1 year", 1.0), ("3 years", 3.0), ("10+ years", 10.0), ("n/a", None),
             (None, None), ("abc", None), ("  7 years ", 7.0)]
    df = spark.createDataFrame(cases, "s string, want double")
    got = df.select(parse_emp_length("s").alias("g"), "want").collect()
    for r in got:
        assert r["g"] == r["want"]


def test_percent_strict_and_lenient(spark):
    df = spark.createDataFrame([("13.56%",), ("13.56%%",), (None,)], "s string")
    vals = [r[0] for r in df.select(percent_strict("s")).collect()]
    assert vals == [pytest.approx(0.1356), pytest.approx(0.1356), None]
    bad = spark.createDataFrame([("abc",)], "s string")
    with pytest.raises(PySparkException):
        bad.select(percent_strict("s")).collect()
    df2 = spark.createDataFrame([("n/a",), (" 7.5 ",), ("7.5%",)], "s string")
    assert [r[0] for r in df2.select(percent_lenient("s")).collect()] == [None, pytest.approx(0.075), pytest.approx(0.075)]


def test_md5_arms_match_python(spark):
    ids = list(range(0, 300)) + [123456789012, None]
    df = spark.createDataFrame([(i,) for i in ids], "id long")
    for n in (2, 3, 7):
        got = [r[0] for r in df.select(md5_mod("id", n)).collect()]
        want = [int(hashlib.md5(str(i if i is not None else "nan").encode()).hexdigest(), 16) % n for i in ids]
        assert got == want


def test_binary_target_null_is_zero(spark):
    df = spark.createDataFrame([("Charged Off",), ("Current",), (None,)], "s string")
    assert [r[0] for r in df.select(binary_target("s")).collect()] == [1, 0, 0]


def test_clip_keeps_null(spark):
    df = spark.createDataFrame([(-1.0,), (None,), (5.0,)], "x double")
    assert [r[0] for r in df.select(clip("x", 0.0, 3.0)).collect()] == [0.0, None, 3.0]


def test_pct_zero_division_is_null(spark):
    df = spark.createDataFrame([(1, 0), (1, 4)], "a long, b long")
    assert [r[0] for r in df.select(pct(F.col("a"), F.col("b"))).collect()] == [None, 25.0]


def test_gaussian_moments(spark):
    df = spark.range(20000)
    r = df.select(gaussian(1, "f", "id").alias("z")).agg(F.avg("z"), F.stddev("z")).first()
    assert abs(r[0]) < 0.03 and abs(r[1] - 1.0) < 0.03
    # partition independent
    a = df.repartition(7).select("id", gaussian(1, "f", "id").alias("z"))
    b = df.select("id", gaussian(1, "f", "id").alias("z2"))
    assert a.join(b, "id").filter("z <> z2").count() == 0
