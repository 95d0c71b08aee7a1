"""Write, audit, publish: what readers see while versions come, fail and go."""

import os

import pytest
from pyspark.sql import functions as F

from goalpost.operators import quality as q
from goalpost.plans import analogue, pipeline
from goalpost.runs import RunLog
from goalpost.sources import files, snapshots
from goalpost.sources.layers import publish_layer, read_layer

SF = "/root/testdata/sf0.001"


def _rows(spark, *r):
    return spark.createDataFrame(list(r), "ano int, k string")


def _seen(spark, path):
    return sorted((r.ano, r.k) for r in read_layer(spark, path).collect())


def test_failed_gate_leaves_the_old_version_readable(spark, scratch):
    path, log = f"{scratch}/t", RunLog()
    rules = [q.nulls("null key", ["ano", "k"]), q.duplicates("duplicate key", ["ano", "k"])]
    pipeline._gated_write("t", _rows(spark, (2023, "a"), (2024, "b")), rules, path, "ano", log, "silver")
    old = _seen(spark, path)
    reader = read_layer(spark, path)                    # planned before the next versions
    for bad in ([(2023, None)], [(2024, "x"), (2024, "x")], [(None, "x")]):
        with pytest.raises(q.QualityError):
            pipeline._gated_write("t", _rows(spark, *bad), rules, path, "ano", log, "silver")
        assert _seen(spark, path) == old == [(2023, "a"), (2024, "b")]
    assert len([d for d in os.listdir(path) if d.startswith("version-")]) == 1      # nothing of the failed ones is left
    pipeline._gated_write("t", _rows(spark, (2025, "c")), rules, path, "ano", log, "silver")
    assert _seen(spark, path) == [(2025, "c")] and reader.count() == 2              # a running reader ends on its version
    assert [r["status"] for r in log.records] == ["sucesso", "erro", "erro", "erro", "sucesso"]


def test_the_source_is_computed_once(spark, scratch):
    passed = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            passed.add(len(b))
            yield b

    source = analogue.micro(spark, SF).select("ano", "id_aluno", "id_municipio", "proficiencia")
    df = source.mapInPandas(count, source.schema)
    geo = analogue.directory(spark, SF).select("id_municipio")
    rules = [q.nulls("n", ["ano", "id_aluno"]), q.duplicates("d", ["ano", "id_aluno"]),
             q.out_of_range("r", "proficiencia", 0, 2000), q.orphans("o", "id_municipio", geo)]
    pipeline._gated_write("t", df, rules, f"{scratch}/t", "ano", RunLog(), "silver")
    assert passed.value == source.count() == read_layer(spark, f"{scratch}/t").count()


def test_null_periods_are_audited_then_dropped_and_counted(spark, scratch):
    seen = []
    res = publish_layer(_rows(spark, (1, "a"), (None, "b")), f"{scratch}/t", "ano",
                        lambda rows: seen.append(rows.where("ano IS NULL").count()))
    assert seen == [1] and (res.rows, res.dropped_null_partition, res.partitions) == (1, 1, (1,))
    assert _seen(spark, f"{scratch}/t") == [(1, "a")]


def test_empty_and_unpartitioned_versions(spark, scratch):
    publish_layer(_rows(spark, (1, "a")), f"{scratch}/t")
    assert _seen(spark, f"{scratch}/t") == [(1, "a")]
    audited = []
    publish_layer(_rows(spark).limit(0), f"{scratch}/t", "ano", lambda rows: audited.append(rows.count()))
    assert audited == [0]


def test_versions_are_kept_for_readers_and_then_removed(spark, scratch):
    path = f"{scratch}/t"
    for i in range(5):
        publish_layer(_rows(spark, (i, "a")), path, "ano")
    assert len([d for d in os.listdir(path) if d.startswith("version-")]) == snapshots.KEPT
    assert _seen(spark, path) == [(4, "a")]


def test_unfinished_note_and_two_writers(spark, scratch):
    path = f"{scratch}/t"
    publish_layer(_rows(spark, (1, "a")), path, "ano")
    files.write_note(spark, f"{path}/_published/{2:012d}", "version-half")         # no end of line: still being written
    assert _seen(spark, path) == [(1, "a")]
    publish_layer(_rows(spark, (2, "b")), path, "ano")                              # takes the next free number
    assert _seen(spark, path) == [(2, "b")]
    assert not files.write_note(spark, f"{path}/_published/{3:012d}", "again\n")    # notes never change
    assert _seen(spark, path) == [(2, "b")]


def test_failed_write_is_not_published(spark, scratch):
    publish_layer(_rows(spark, (1, "a")), f"{scratch}/t", "ano")
    with pytest.raises(Exception):
        publish_layer(_rows(spark, (2, "b")).withColumn("k", F.raise_error(F.lit("lost"))), f"{scratch}/t", "ano")
    assert _seen(spark, f"{scratch}/t") == [(1, "a")]
