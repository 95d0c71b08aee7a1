import math

from pyspark.sql import functions as F

from goalpost.functions import REDE, band, br_number, decode, finite_or_null, pct, trend_label


def test_decode_known_unknown_null_and_type(spark):
    df = spark.createDataFrame([("3",), ("9",), (None,)], "rede string")
    rows = df.select(decode("rede", REDE).alias("d"), decode("rede", REDE, "?").alias("e")).collect()
    assert [r.d for r in rows] == ["Municipal", None, None]
    assert [r.e for r in rows] == ["Municipal", "?", "?"]
    assert df.select(decode("rede", REDE).alias("d")).schema["d"].dataType.simpleString() == "string"


def test_decode_of_numeric_codes_is_the_same_at_every_size(spark):
    df = spark.createDataFrame([(1.0,), (2.5,), (None,)], "c double")
    for n in (10, 20):
        book = {str(i): f"v{i}" for i in range(n)}
        assert [r.d for r in df.select(decode("c", book).alias("d")).collect()] == ["v1", None, None]


def test_exact_avg_does_not_round_its_input(spark):
    from goalpost.plans.analysis import exact_avg
    df = spark.createDataFrame([(10.0451,), (10.0451,), (None,)], "x double")
    assert df.agg(F.round(exact_avg("x"), 1).alias("m")).first().m == 10.0


def test_decode_large_mapping(spark):
    book = {str(i): f"code {i}" for i in range(40)}
    df = spark.createDataFrame([("7",), ("99",), (None,)], "c string")
    assert [r.d for r in df.select(decode("c", book, "x").alias("d")).collect()] == ["code 7", "x", "x"]


def test_decode_empty_mapping_gives_default(spark):
    df = spark.createDataFrame([("1",)], "c string")
    assert df.select(decode("c", {}, "z").alias("d")).first().d == "z"


def test_pct_order_and_zero_denominator(spark):
    df = spark.createDataFrame([(1, 3), (5, 0), (None, 2)], "n long, d long")
    got = [r.p for r in df.select(pct("n", "d", 2).alias("p")).collect()]
    assert got == [33.33, None, None]


def test_spark_round_is_half_up_on_decimal_text(spark):
    df = spark.createDataFrame([(0.285,), (2.675,), (-0.125,)], "x double")
    assert [r.r for r in df.select(F.round("x", 2).alias("r")).collect()] == [0.29, 2.68, -0.13]


def test_band_is_lower_inclusive(spark):
    edges, labels = (60, 70, 80, 90), ("a", "b", "c", "d", "e")
    df = spark.createDataFrame([(59.9,), (60.0,), (70.0,), (89.99,), (90.0,), (100.0,)], "x double")
    assert [r.b for r in df.select(band("x", edges, labels).alias("b")).collect()] == ["a", "b", "c", "d", "e", "e"]


def test_trend_label_missing_counts_as_rise(spark):
    df = spark.createDataFrame([(1.0,), (0.0,), (-0.5,), (None,)], "d double")
    assert [r.t for r in df.select(trend_label("d").alias("t")).collect()] == ["Subiu", "Subiu", "Caiu", "Subiu"]


def test_br_number(spark):
    df = spark.createDataFrame([(1234567.891,), (0.5,)], "x double")
    assert [r.s for r in df.select(br_number("x", 2).alias("s")).collect()] == ["1.234.567,89", "0,50"]


def test_finite_or_null(spark):
    df = spark.createDataFrame([(math.nan,), (math.inf,), (-math.inf,), (1.5,)], "x double")
    assert [r.y for r in df.select(finite_or_null("x").alias("y")).collect()] == [None, None, None, 1.5]
