"""Property test: one-pass rule counts equal the per-rule counts."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from goalpost.operators import quality as q
from goalpost.session import cluster_conf

row = st.tuples(st.one_of(st.none(), st.integers(0, 4)), st.one_of(st.none(), st.sampled_from(["a", "b"])),
                st.one_of(st.none(), st.just(float("nan")), st.floats(-10, 110)), st.one_of(st.none(), st.sampled_from(["0", "1", "9"])))


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(row, min_size=0, max_size=60))
def test_one_pass_equals_reference_counts(spark, data):
    df = spark.createDataFrame(data, "k int, g string, v double, f string")
    ref = spark.createDataFrame([(1,), (3,)], "k int")
    rules = [q.nulls("n", ["k", "g"]), q.duplicates("d", ["k", "g"]), q.orphans("o", "k", ref),
             q.out_of_range("r", "v", 0, 100), q.not_in("s", "f", ["0", "1"])]
    got = {r.rule: r.violations for r in q.evaluate(df, rules).collect()}
    # the reference's semantics, computed the reference's way (one action per rule)
    expect = {
        "n": df.filter(F.col("k").isNull() | F.col("g").isNull()).count(),
        "d": df.count() - df.dropDuplicates(["k", "g"]).count(),
        "o": df.join(ref.select("k").distinct(), "k", "left_anti").count(),
        "r": df.filter((F.col("v") < 0) | (F.col("v") > 100)).count(),
        "s": df.filter(~F.col("f").isin("0", "1")).count(),
    }
    assert got == expect


def test_cluster_conf_sizes_partitions():
    c = cluster_conf(100 << 40, executor_cores=4, executors=1000)
    assert int(c["spark.sql.shuffle.partitions"]) == 409600
    assert int(cluster_conf(1 << 30, 4, 1000)["spark.sql.shuffle.partitions"]) == 8000
