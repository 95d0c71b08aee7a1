import random

from pyspark.sql import functions as F

from goalpost.operators.ranking import previous_value, row_number_within, row_number_window


def _data(spark, n=3000, seed=3):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        # one hot parent holds most rows; some null parents and null rates; many ties on rate
        parent = "HOT" if rnd.random() < 0.7 else rnd.choice(["A", "B", None])
        rate = None if rnd.random() < 0.05 else float(rnd.randint(0, 20))
        rows.append((i, parent, rnd.choice([2023, 2024]), rate))
    return spark.createDataFrame(rows, "id long, parent string, ano int, rate double")


def test_row_number_within_equals_window_with_hot_group(spark):
    df = _data(spark)
    order = [F.col("rate").desc_nulls_last(), F.col("id").asc()]
    a = row_number_within(df, ["parent", "ano"], order, "rk", num_partitions=16)
    b = row_number_window(df, ["parent", "ano"], order, "rk")
    assert a.count() == df.count()
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_row_number_within_is_stable_across_evaluations(spark):
    df = _data(spark, 500, 9)
    a = row_number_within(df, ["parent"], [F.col("rate").desc_nulls_last(), F.col("id")], "rk", num_partitions=8)
    first = sorted(tuple(r) for r in a.collect())
    assert first == sorted(tuple(r) for r in a.collect())


def test_previous_value_uses_previous_available_period(spark):
    df = spark.createDataFrame([("X", 2021, 10.0), ("X", 2023, 13.5), ("X", 2024, None), ("Y", 2024, 5.0)],
                               "uf string, ano int, taxa double")
    out = {(r.uf, r.ano): (r.prev, r.delta)
           for r in previous_value(df, ["uf"], "ano", "taxa", "prev", "delta").collect()}
    assert out[("X", 2021)] == (None, None)
    assert out[("X", 2023)] == (10.0, 3.5)        # 2022 missing: previous available row
    assert out[("X", 2024)] == (13.5, None)       # null propagates
    assert out[("Y", 2024)] == (None, None)
