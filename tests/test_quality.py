import random

import pytest
from pyspark.sql import functions as F

from goalpost.operators import quality as q


def report(df, rules):
    return {r.rule: r.violations for r in q.evaluate(df, rules).collect()}


@pytest.fixture()
def rows(spark):
    data = [(1, "a", 10.0, "0"), (1, "a", 10.0, "0"), (2, None, -1.0, "1"), (None, "c", float("nan"), None),
            (None, "d", 101.0, "X"), (3, "e", None, "1")]
    return spark.createDataFrame(data, "k int, g string, v double, f string")


def test_row_rules(rows):
    got = report(rows, [q.nulls("n", ["k", "g"]), q.nulls("empty", []), q.out_of_range("r", "v", 0, 100),
                        q.not_in("d", "f", ["0", "1"])])
    # nulls: rows 3,4,5 ; range: -1, NaN (NaN > max), 101 ; null passes ; domain: X only, null passes
    assert got == {"n": 3, "empty": 0, "r": 3, "d": 1}


def test_empty_allowed_set_fails_every_row(rows):
    assert report(rows, [q.not_in("d", "f", [])])["d"] == rows.count()


def test_duplicates_null_keys_equal(rows):
    # keys: 1,1,2,null,null,3 -> surplus 2 (one 1, one null)
    assert report(rows, [q.duplicates("dup", "k")])["dup"] == 2


def test_orphans_count_rows_and_null_key_is_orphan(spark, rows):
    ref = spark.createDataFrame([(1,), (1,), (3,)], "k int")
    # rows with k in (2, null, null) are orphans
    assert report(rows, [q.orphans("o", "k", ref)])["o"] == 3


def test_orphans_with_renamed_reference_column(spark, rows):
    ref = spark.createDataFrame([(1,), (2,), (3,)], "id int")
    assert report(rows, [q.orphans("o", "k", ref, "id")])["o"] == 2


def test_gate_names_every_failing_error_rule_and_ignores_warnings(rows):
    rep = q.evaluate(rows, [q.nulls("null k", "k"), q.duplicates("dup", "k"),
                            q.nulls("warned", "g", severity=q.WARN), q.out_of_range("ok", "k", 0, 10)])
    with pytest.raises(q.QualityError) as e:
        q.gate("t", rep)
    assert "null k" in str(e.value) and "dup" in str(e.value) and "warned" not in str(e.value)
    assert "ok" not in str(e.value)


def test_gate_passes_with_only_warnings(rows):
    rows_out = q.gate("t", q.evaluate(rows, [q.nulls("w", "k", severity=q.WARN)]))
    assert rows_out[0].violations == 2 and not rows_out[0].failed


def test_one_pass_equals_per_rule_counts_on_random_data(spark):
    rnd = random.Random(7)
    data = [(rnd.choice([None, 1, 2, 3]), rnd.choice([None, "x", "y"]), rnd.choice([None, -5.0, 50.0, 150.0]),
             rnd.choice([None, "0", "1", "2"])) for _ in range(400)]
    df = spark.createDataFrame(data, "k int, g string, v double, f string")
    ref = spark.createDataFrame([(1,), (2,)], "k int")
    rules = [q.nulls("n", ["k", "g"]), q.duplicates("d1", ["k", "g"]), q.duplicates("d2", "f"),
             q.orphans("o", "k", ref), q.out_of_range("r", "v", 0, 100), q.not_in("s", "f", ["0", "1"]),
             q.count_where("p", F.col("g") == "x")]
    got = report(df, rules)
    expect = {
        "n": df.filter(F.col("k").isNull() | F.col("g").isNull()).count(),
        "d1": df.count() - df.dropDuplicates(["k", "g"]).count(),
        "d2": df.count() - df.dropDuplicates(["f"]).count(),
        "o": df.join(ref.distinct(), "k", "left_anti").count(),
        "r": df.filter((F.col("v") < 0) | (F.col("v") > 100)).count(),
        "s": df.filter(~F.col("f").isin("0", "1")).count(),
        "p": df.filter(F.col("g") == "x").count(),
    }
    assert got == expect


def test_report_is_one_row_per_rule_in_order(rows):
    rules = [q.nulls("b", "k"), q.nulls("a", "g")]
    out = q.evaluate(rows, rules).orderBy("position").collect()
    assert [r.rule for r in out] == ["b", "a"] and [r.position for r in out] == [0, 1]
