import logging

import pytest
from pyspark.sql import functions as F

from goalpost.sources.ingest import Source, ingest, select_sources
from goalpost.sources.layers import profile, read_all, read_layer, write_layer


def _df(spark):
    return spark.createDataFrame([(2023, "a"), (2024, "b"), (None, "c"), (2024, "d")], "ano int, x string")


def test_null_period_rows_dropped_and_counted(spark, scratch):
    res = write_layer(_df(spark), f"{scratch}/t", "ano")
    assert (res.rows, res.dropped_null_partition) == (3, 1)
    assert res.partitions == (2023, 2024)           # A14: sorted distinct non-null values
    back = read_layer(spark, f"{scratch}/t")
    assert back.count() == 3 and "ano" in back.columns


def test_dynamic_reingest_replaces_only_present_partitions(spark, scratch):
    write_layer(_df(spark), f"{scratch}/t", "ano")
    write_layer(spark.createDataFrame([(2024, "z")], "ano int, x string"), f"{scratch}/t", "ano", dynamic=True)
    got = sorted((r.ano, r.x) for r in read_layer(spark, f"{scratch}/t").collect())
    assert got == [(2023, "a"), (2024, "z")]


def test_static_overwrite_replaces_table(spark, scratch):
    write_layer(_df(spark), f"{scratch}/t", "ano")
    write_layer(spark.createDataFrame([(2024, "z")], "ano int, x string"), f"{scratch}/t", "ano")
    assert [(r.ano, r.x) for r in read_layer(spark, f"{scratch}/t").collect()] == [(2024, "z")]


def test_partition_filter_reaches_the_scan(spark, scratch):
    write_layer(_df(spark), f"{scratch}/t", "ano")
    df = read_layer(spark, f"{scratch}/t").filter(F.col("ano") == 2024)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ano" in plan and df.count() == 2


def test_union_by_name_fills_missing_columns(spark, scratch):
    write_layer(spark.createDataFrame([(1, "a")], "k int, a string"), f"{scratch}/p1")
    write_layer(spark.createDataFrame([(2, 3.0)], "k int, b double"), f"{scratch}/p2")
    rows = sorted(read_all(spark, [f"{scratch}/p1", f"{scratch}/p2"]).collect(), key=lambda r: r.k)
    assert (rows[0].a, rows[0].b, rows[1].a, rows[1].b) == ("a", None, None, 3.0)


def test_select_sources_rules(caplog):
    srcs = [Source("a", None), Source("b", None)]
    assert [s.name for s in select_sources(srcs, None)] == ["a", "b"]
    assert [s.name for s in select_sources(srcs, ["b", "zzz"])] == ["b"]
    with caplog.at_level(logging.ERROR):
        assert select_sources(srcs, ["zzz"]) == []
    assert "valid" in caplog.text


def test_ingest_stops_at_first_failure_earlier_outputs_stay(spark, scratch):
    def boom(s):
        raise RuntimeError("source down")
    srcs = [Source("ok", lambda s: _df(s), "ano"), Source("bad", boom, "ano"), Source("never", lambda s: _df(s), None)]
    with pytest.raises(RuntimeError):
        ingest(spark, srcs, scratch)
    assert read_layer(spark, f"{scratch}/ok").count() == 3
    with pytest.raises(Exception):
        read_layer(spark, f"{scratch}/never").count()


def test_profile_counts_and_preview(spark):
    df = spark.createDataFrame([(2, "B", None), (1, "A", "X")], "id_municipio int, nome string, sigla_uf string")
    counts, prev = profile(df, order_by=["id_municipio"], n=1)
    c = counts.first()
    assert (c.total_linhas, c.linhas_sem_pai) == (2, 1)
    assert prev.columns == ["id_municipio", "nome", "sigla_uf"] and prev.first().id_municipio == 1
    counts2, _ = profile(df.drop("sigla_uf"))
    assert counts2.columns == ["total_linhas"]


def test_empty_table_folder_is_an_error(spark, scratch):
    import os
    os.makedirs(f"{scratch}/empty/ano=2024")
    with pytest.raises(FileNotFoundError):
        read_all(spark, [f"{scratch}/empty"])
