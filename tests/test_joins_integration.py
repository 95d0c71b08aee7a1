import pytest

from goalpost.operators import quality as q
from goalpost.operators.joins import existence_flag, has_at_most, lookup, maybe_broadcast
from goalpost.plans import integration


def test_lookup_keeps_unmatched_rows(spark):
    fact = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "id int, x string")
    dim = spark.createDataFrame([(1, "one")], "id int, nome string")
    got = sorted((r.x, r.nome) for r in lookup(fact, dim, "id").collect())
    assert got == [("a", "one"), ("b", None), ("c", None)]


def test_size_check_bounds(spark):
    df = spark.range(10)
    assert has_at_most(df, 10) and not has_at_most(df, 9)
    assert "BroadcastHashJoin" in spark.range(100).join(maybe_broadcast(df, 10), "id")._jdf.queryExecution() \
        .executedPlan().toString()


def test_existence_flag_never_fans_out(spark):
    df = spark.createDataFrame([(1, 2023), (2, 2023)], "id int, ano int")
    keys = spark.createDataFrame([(1, 2023), (1, 2023), (1, 2023)], "id int, ano int")
    out = {r.id: r.orfao for r in existence_flag(df, keys, ["id", "ano"]).collect()}
    assert out == {1: False, 2: True}


def _ind_meta(spark, meta_rows):
    ind = spark.createDataFrame([(1, "A", "n1", 2023, "3", 50.0, 500.0), (2, "A", "n2", 2023, "3", 60.0, 600.0),
                                 (2, "A", "n2", 2023, "2", 61.0, 610.0)],
                                "id_municipio int, sigla_uf string, nome string, ano int, rede string, "
                                "taxa_alfabetizacao double, media_portugues double")
    meta = spark.createDataFrame(meta_rows, "id_municipio int, ano int, rede string, meta_alfabetizacao_2024 double, "
                                            "meta_alfabetizacao_2026 double, meta_alfabetizacao_2028 double, "
                                            "meta_alfabetizacao_2030 double")
    return ind, meta


def test_integration_keeps_missing_targets_and_filters_network(spark):
    ind, meta = _ind_meta(spark, [(1, 2023, "3", 1.0, 2.0, 3.0, 70.0)])
    out, rep = integration.integrate_fine(ind, meta)
    got = {r.id_municipio: r.meta_alfabetizacao_2030 for r in out.collect()}
    assert got == {1: 70.0, 2: None}
    rows = {r.rule: r.violations for r in rep.collect()}
    assert rows["territory-years without target"] == 1 and rows["target not unique on join key"] == 0
    q.gate("integration", rep)   # a missing target only warns


def test_fan_out_guard_fails_loudly(spark):
    # two networks for one territory in the target table would multiply rows in the join
    ind, meta = _ind_meta(spark, [(1, 2023, "3", 1.0, 2.0, 3.0, 70.0), (1, 2023, "2", 1.0, 2.0, 3.0, 80.0)])
    _, rep = integration.integrate_fine(ind, meta)
    with pytest.raises(q.QualityError, match="target not unique"):
        q.gate("integration", rep)


def test_null_key_on_either_side_fails(spark):
    ind, meta = _ind_meta(spark, [(None, 2023, "3", 1.0, 2.0, 3.0, 70.0)])
    _, rep = integration.integrate_fine(ind, meta)
    with pytest.raises(q.QualityError, match="null target key"):
        q.gate("integration", rep)
