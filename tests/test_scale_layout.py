"""Clustered writes, skew-proof lookup, one-scan rules, stored rollup, mixed layouts."""

import os

import pytest
from pyspark.sql import functions as F

from goalpost.operators import quality as q
from goalpost.operators.aggregate import dedup_by_period
from goalpost.operators.joins import hot_keys, lookup, salted_lookup
from goalpost.plans import analogue, rollups
from goalpost.sources import files
from goalpost.sources.layers import read_files, read_layer, write_layer
from tests.conftest import SF_MID
from tests.test_plans import nodes

SF = "/root/testdata/sf0.001"


@pytest.fixture()
def conf(spark):
    old = {}

    def put(**kw):
        for k, v in kw.items():
            k = k.replace("__", ".")
            old.setdefault(k, spark.conf.get(k, None))
            spark.conf.set(k, v)
    yield put
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _files(path):
    return {d: len([f for f in os.listdir(f"{path}/{d}") if f.endswith(".parquet")])
            for d in os.listdir(path) if d.startswith("ano=")}


def test_periods_are_few_files_and_a_hot_one_is_split(spark, scratch, conf):
    """40 tasks hold rows of every period, two thirds of them in one."""
    conf(**{"spark.sql.adaptive.advisoryPartitionSizeInBytes": "256k", "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false"})
    rows = spark.range(0, 120_000, 1, 40).select(
        F.when(F.col("id") % 3 < 2, 2024).otherwise(2000 + (F.col("id") % 20)).alias("ano"), F.sha2(F.col("id").cast("string"), 256).alias("x"))
    write_layer(rows, f"{scratch}/loose", "ano", cluster=False)
    write_layer(rows, f"{scratch}/t", "ano")
    loose, got = _files(f"{scratch}/loose"), _files(f"{scratch}/t")
    assert min(loose.values()) >= 20
    hot = got.pop("ano=2024")
    assert 4 <= hot <= 40 and max(got.values()) <= 2
    assert read_layer(spark, f"{scratch}/t").exceptAll(read_layer(spark, f"{scratch}/loose")).isEmpty()


def test_reingest_reports_only_the_periods_it_wrote(spark, scratch):
    df = spark.createDataFrame([(2023, "a"), (2024, "b")], "ano int, x string")
    assert write_layer(df, f"{scratch}/t", "ano", dynamic=True).partitions == (2023, 2024)
    assert write_layer(df.where("ano = 2024"), f"{scratch}/t", "ano", dynamic=True).partitions == (2024,)
    assert write_layer(df.where("ano = 1"), f"{scratch}/t", "ano", dynamic=True).partitions == ()


def _skewed(spark):
    """A third of the rows on one key, a third without a key, the rest on 5,000 keys."""
    k = F.col("id")
    return spark.range(0, 60_000, 1, 8).select(
        F.when(k % 3 == 0, 7).when(k % 3 == 1, F.lit(None)).otherwise(k % 5000).cast("int").alias("k"), k.alias("v"))


@pytest.mark.parametrize("how", ["left", "inner"])
def test_salted_lookup_equals_the_plain_join_and_spreads_hot_keys(spark, conf, how):
    conf(**{"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "16"})
    fact = _skewed(spark)
    dim = spark.range(0, 4000).select(F.col("id").alias("k"), F.concat(F.lit("n"), "id").alias("nome"))     # a wider type
    got, plain = salted_lookup(fact, dim, "k", how), fact.join(dim, "k", how)
    assert got.columns == plain.columns
    assert got.exceptAll(plain).isEmpty() and plain.exceptAll(got).isEmpty()
    largest = lambda df: df.groupBy(F.spark_partition_id().alias("p")).count().agg(F.max("count")).first()[0]
    even = fact.count() / 16
    assert largest(got) < 2 * even
    if how == "left":
        assert largest(plain) > 4 * even


def test_hot_keys_are_bounded_and_found(spark):
    hot = hot_keys(_skewed(spark), "k", 0.05)
    assert len(hot) == 1 and 0.45 < next(iter(hot.values())) < 0.55       # half of the rows with a key
    assert hot_keys(_skewed(spark).limit(0), "k", 0.05) == {}
    two = spark.createDataFrame([(1, "a")] * 9 + [(None, "a")], "k int, g string")
    assert len(hot_keys(two, ["k", "g"], 0.5)) == 1


def test_lookup_picks_the_salted_way_beyond_the_bound(spark):
    fact = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b"), (None, "c")], "id int, x string")
    dim = spark.createDataFrame([(1, "one"), (3, "three")], "id int, nome string")
    for bound in (0, 1, 10):
        got = sorted(((r.x, r.nome) for r in lookup(fact, dim, "id", max_broadcast_rows=bound).collect()), key=str)
        assert got == [("a", "one"), ("a", "one"), ("b", None), ("c", None)]
    with pytest.raises(ValueError):
        salted_lookup(fact, dim, "id", "full")


def _rules(spark, geo):
    return [q.nulls("n", ["ano", "id_municipio"]), q.duplicates("d", ["ano", "id_aluno"]),
            q.orphans("o", "id_municipio", geo), q.out_of_range("r", "proficiencia", 0, 1000)]


def test_rules_cost_one_scan_and_one_exchange(spark):
    dirty, geo = analogue.dirty_micro(spark, SF), analogue.directory(spark, SF).select("id_municipio")
    report = q.evaluate(dirty, _rules(spark, geo))
    scans = [f for f in report._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Relation" in f and "l_orderkey" in f]
    assert len(scans) == 1
    assert nodes(dirty).count("Scan parquet") == 1
    by_exchange = q.evaluate(dirty, _rules(spark, geo), max_broadcast_rows=0)
    assert sorted(map(tuple, report.collect())) == sorted(map(tuple, by_exchange.collect()))


def test_orphans_by_flag_and_by_anti_join_agree_on_odd_references(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (None, "b"), (2, None), (3, "c")], "k int, g string")
    for ref in ([], [(None,)], [(1,), (1,), (None,)], [(9,)]):
        r = spark.createDataFrame(ref, "other int")
        rules = [q.orphans("o", "k", r, "other"), q.nulls("n", "g"), q.orphans("p", "k", r, "other", severity=q.WARN)]
        a, b = (sorted(map(tuple, q.evaluate(df, rules, m).collect())) for m in (10, 0))
        assert a == b


def test_refresh_scans_only_the_given_periods(spark, scratch):
    write_layer(analogue.micro(spark, SF), f"{scratch}/alunos", "ano")
    micro, store = read_layer(spark, f"{scratch}/alunos"), f"{scratch}/rollup"
    rollups.refresh(spark, micro, store)
    before = {d: sorted(os.listdir(f"{store}/{d}")) for d in os.listdir(store) if d.startswith("ano=")}
    changed = micro.where("ano = 1996 AND proficiencia IS NOT NULL")
    write_layer(spark.createDataFrame(changed.collect(), changed.schema), f"{scratch}/alunos", "ano", dynamic=True)
    part = read_layer(spark, f"{scratch}/alunos")
    plan = part.where(F.col("ano").isin(1996))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "PartitionFilters: []" not in plan
    rollups.refresh(spark, part, store, [1996])
    after = {d: sorted(os.listdir(f"{store}/{d}")) for d in os.listdir(store) if d.startswith("ano=")}
    assert [d for d in before if before[d] != after[d]] == ["ano=1996"]
    whole = f"{scratch}/whole"
    rollups.refresh(spark, part, whole)
    a, b = rollups.read(spark, store), rollups.read(spark, whole)
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()
    rollups.refresh(spark, part, store, [1996, 1890])           # a period that is not there, or no longer
    assert rollups.read(spark, store).exceptAll(b).isEmpty()


def test_mixed_layouts_and_partition_values(spark, scratch):
    base = f"{scratch}/t"
    spark.createDataFrame([(1, "a")], "ano int, x string").write.partitionBy("ano").parquet(f"{base}/p")
    spark.createDataFrame([(5, "b")], "ano int, x string").write.parquet(f"{base}/ano=9/in")       # the file's value stands
    spark.createDataFrame([("c", 2.0)], "x string, y double").write.parquet(f"{base}/rede=rural%20sul/ano=3")
    got = sorted((r.ano, r.x, r.y, r.rede) for r in read_files(spark, base, ["ano", "rede"]).collect())
    assert got == [(1, "a", None, None), (3, "c", 2.0, "rural sul"), (5, "b", None, None)]
    assert read_files(spark, base, ["ano"]).schema["ano"].dataType.typeName() == "integer"


def test_empty_folders_are_an_error_on_any_file_system(spark, scratch):
    os.makedirs(f"{scratch}/empty/ano=1")
    open(f"{scratch}/empty/_SUCCESS", "w").close()
    for path in (f"{scratch}/empty", f"file:{scratch}/empty", f"{scratch}/missing"):
        with pytest.raises(FileNotFoundError):
            read_files(spark, path)


def test_mixed_layout_splits_a_large_year(spark, scratch, monkeypatch):
    from goalpost.plans import registry
    place = {}
    read = registry.read_files
    monkeypatch.setattr(registry, "read_files", lambda s, path, cols: place.update(path=path) or read(s, path, cols))
    spark.read.parquet(f"{SF_MID}/lineitem.parquet").repartition(8).write.parquet(f"{scratch}/lineitem.parquet")
    sizes = ("spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.adaptive.coalescePartitions.minPartitionSize",
             "spark.sql.files.openCostInBytes", "spark.sql.files.maxPartitionBytes")
    for s in sizes:
        spark.conf.set(s, "20k")
    try:
        rows = registry.QUERIES["mixed_layout"](spark, scratch)
        assert rows.count() == spark.read.parquet(f"{SF_MID}/lineitem.parquet").count()
    finally:
        for s in sizes:
            spark.conf.unset(s)
    names = list(files.data_files(spark, f"{place['path']}/lote=2"))
    assert min(sum(n.startswith(f"dir={y}/") for n in names) for y in (1997, 1998)) > 1


def test_publishing_micro_has_one_exchange_of_its_rows(spark):
    from goalpost.plans import chain, silver
    source, geo = analogue.dirty_micro(spark, SF_MID), chain.silver_directory(spark, SF_MID)
    df = silver.micro(source, geo, by_period=True)[0]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION" in plan and plan.count("hashpartitioning(__piece") <= 1
    assert not [x for x in plan.split("\n") if "hashpartitioning(ano" in x]
    plain = silver.micro(source, geo)[0]
    assert df.exceptAll(plain).count() == plain.exceptAll(df).count() == 0
    zero = spark.createDataFrame([(1996, 0.0), (1996, -0.0), (None, float("nan")), (None, float("nan"))], "ano int, v double")
    assert dedup_by_period(zero, "ano", task_rows=1).count() == 2
