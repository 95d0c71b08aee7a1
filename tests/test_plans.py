"""Plan-shape regression tests for the scale design (pruning, pushdown, join choice, no hot-group window)."""

import contextlib
import io

from pyspark.sql import functions as F

from goalpost.operators import quality as q
from goalpost.operators.joins import lookup
from goalpost.operators.ranking import row_number_within
from goalpost.plans import analogue
from goalpost.sources.layers import read_layer, write_layer

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def nodes(df) -> list[str]:
    """Operator names of the formatted plan's numbered sections, e.g. ['Scan parquet', 'Window', ...]."""
    import re
    return [m.group(1).strip() for m in re.finditer(r"^\(\d+\) ([A-Za-z ]+)", plan(df), re.M)]


def test_rollup_scan_reads_only_needed_columns(spark):
    from goalpost.operators.aggregate import micro_rollup
    p = plan(micro_rollup(analogue.micro(spark, SF), ["id_municipio", "ano"]))
    schema = [ln for ln in p.splitlines() if ln.startswith("ReadSchema")][0]
    assert "l_suppkey" in schema and "l_extendedprice" not in schema and "l_orderkey" not in schema
    assert "partial_count" in p                       # map-side partial aggregation


def test_code_filter_is_pushed_to_a_stored_layer(spark, scratch):
    write_layer(analogue.micro(spark, SF), f"{scratch}/alunos", "ano")
    p = plan(read_layer(spark, f"{scratch}/alunos").filter((F.col("rede") == "3") & (F.col("ano") == 1998)))
    assert "EqualTo(rede,3)" in p and "PartitionFilters: [isnotnull(ano" in p


def test_lookup_broadcasts_only_a_checked_small_side(spark):
    fact = spark.range(1000).withColumnRenamed("id", "k")
    small = spark.range(10).withColumnRenamed("id", "k").withColumn("v", F.lit(1))
    assert "BroadcastHashJoin" in plan(lookup(fact, small, "k", max_broadcast_rows=100))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        p = plan(lookup(fact, small, "k", max_broadcast_rows=5))  # over the bound: no hint
        assert "BroadcastHashJoin" not in p and "SortMergeJoin" in p
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_rule_report_is_one_plan_of_aggregates(spark):
    df = analogue.dirty_micro(spark, SF)
    rep = q.evaluate(df, [q.nulls("n", ["id_municipio"]), q.duplicates("d", ["ano", "id_aluno"]),
                          q.not_in("s", "alfabetizado", ["0", "1"])])
    ops = nodes(rep)
    # one scan: the fixture repeats rows in place
    assert "Window" not in ops and "HashAggregate" in ops and ops.count("Scan parquet") == 1


def test_rank_never_windows_the_data_by_parent(spark):
    df = spark.range(2000).select(F.col("id"), (F.col("id") % 3).alias("g"), (F.col("id") % 17).alias("v"))
    out = row_number_within(df, ["g"], [F.col("v").desc(), F.col("id")], "rk", num_partitions=8)
    ops = nodes(out)
    # the only window runs on the per-(partition, group) table, which is broadcast to the rows
    assert ops.count("Window") == 1 and "BroadcastHashJoin" in ops
    assert out.agg(F.max("rk")).first()[0] == max(r[0] for r in df.groupBy("g").count().select("count").collect())
