"""Hand-made domain fixture with the edge rows of FIXTURES.md §2, through Silver -> Gold."""

import math

import pytest
from pyspark.sql import functions as F

from goalpost.operators import quality as q
from goalpost.plans import dashboard, gold, integration, silver

IND = "ano int, id_municipio string, serie string, rede string, taxa_alfabetizacao double, media_portugues double"
DIR = ("id_municipio string, nome string, sigla_uf string, nome_uf string, nome_regiao string, "
       "capital_uf string, amazonia_legal string")
META = ("ano int, rede string, id_municipio string, taxa_alfabetizacao double, meta_alfabetizacao_2024 double, "
        "meta_alfabetizacao_2026 double, meta_alfabetizacao_2028 double, meta_alfabetizacao_2030 double")


@pytest.fixture()
def directory(spark):
    rows = [("1", "Alfa", "AA", "Estado A", "N", "1", "0"), ("2", "Beta", "AA", "Estado A", "N", "0", "0"),
            ("3", "Gama", "AA", "Estado A", "N", "0", "0"), ("4", "Delta", "BB", "Estado B", "S", "0", "0"),
            ("5", "Eps", None, None, "S", "0", "0")]
    return spark.createDataFrame(rows, DIR)


def test_silver_fine_rules_on_edge_rows(spark, directory):
    rows = [(2023, "1", "2", "3", 50.0, 700.0), (2023, "1", "2", "3", 50.0, 700.0),      # full duplicate
            (2023, "2", "2", "3", 60.0, 710.0), (2023, "2", "2", "3", 61.0, 711.0),      # key duplicate
            (2023, None, "2", "3", 10.0, 1.0),                                            # null key part
            (2023, "9", "2", "3", 10.0, 1.0),                                             # orphan geo
            (2023, "5", "2", "3", 10.0, 1.0),                                             # geo without parent
            (2023, "3", "2", "3", -1.0, 1.0), (2024, "3", "2", "3", 101.0, 1.0),          # out of range
            (2023, "4", "2", "3", float("nan"), 1.0), (2024, "4", "2", "3", None, 1.0),   # NaN fails, null required
            (2023, "4", "2", "9", 0.0, 1.0), (2024, "1", "2", None, 100.0, 1.0)]          # unknown / null code
    df, rules = silver.indicator_fine(spark.createDataFrame(rows, IND), directory)
    got = {r.rule: r.violations for r in q.evaluate(df, rules).collect()}
    assert got == {"null key": 2, "null required field": 1, "duplicate key": 1, "rate outside 0-100": 3,
                   "territory without parent": 3, "territory missing from directory": 2}
    dec = {(r.id_municipio, r.rede): r.rede_desc for r in df.collect()}
    assert dec[("4", "9")] is None and dec[("1", None)] is None and dec[("1", "3")] == "Municipal"
    with pytest.raises(q.QualityError):
        q.gate("silver_municipio", q.evaluate(df, rules))


def test_targets_null_2030_is_error_except_for_states(spark):
    rows = [(2023, "3", "1", 50.0, 1.0, 2.0, 3.0, None), (2023, "3", "2", None, 1.0, 2.0, 3.0, 70.0)]
    fine = spark.createDataFrame(rows, META)
    df, rules = silver.targets(fine, silver.TARGETS[2])
    rep = {r.rule: (r.violations, r.severity) for r in q.evaluate(df, rules).collect()}
    assert rep["null 2030 target"] == (1, "error") and rep["rate missing at source"] == (1, "warn")
    state = fine.withColumnRenamed("id_municipio", "sigla_uf")
    df2, rules2 = silver.targets(state, silver.TARGETS[1])
    rows2 = q.gate("meta_uf", q.evaluate(df2, rules2))          # only warnings: passes
    assert {r.rule: r.severity for r in rows2}["null 2030 target"] == "warn"


def test_gold_marts_on_edge_rows(spark, directory):
    # tied rates inside one parent, a null rate, a missing middle year, null / zero / absent targets
    ind_rows = [(2023, "1", "2", "3", 80.0, 1.0), (2023, "2", "2", "3", 80.0, 1.0), (2023, "3", "2", "3", None, 1.0),
                (2023, "4", "2", "3", 70.0, 1.0), (2021, "4", "2", "3", 60.0, 1.0)]
    fine, _ = silver.indicator_fine(spark.createDataFrame(ind_rows, IND).na.fill({"taxa_alfabetizacao": 0.0})
                                    .withColumn("taxa_alfabetizacao", F.when(F.col("id_municipio") == "3", None)
                                                .otherwise(F.col("taxa_alfabetizacao"))), directory)
    meta_rows = [(2023, "3", "1", 80.0, 1.0, 2.0, 3.0, 90.0), (2023, "3", "2", 80.0, 1.0, 2.0, 3.0, None),
                 (2023, "3", "4", 70.0, 1.0, 2.0, 3.0, 0.0)]                        # "3" has no target
    meta = spark.createDataFrame(meta_rows, META)
    integ = integration.integrate_level(fine, meta, "id_municipio", ["nome", "sigla_uf"])
    ranked = {(r.id_municipio, r.ano): r for r in gold.indicator_rank(integ).collect()}
    assert (ranked[("1", 2023)].ranking_na_uf, ranked[("2", 2023)].ranking_na_uf,
            ranked[("3", 2023)].ranking_na_uf) == (1, 2, 3)          # tie -> territory key; null rate last
    assert ranked[("1", 2023)].gap_para_meta_2030 == 10.0
    assert ranked[("2", 2023)].gap_para_meta_2030 is None and ranked[("3", 2023)].gap_para_meta_2030 is None
    att = {r.id_municipio: r.atingimento_meta_2030_pct for r in gold.attainment(integ).collect() if r.ano == 2023}
    assert att["1"] == round(80 / 90 * 100, 2) and att["4"] is None and att["2"] is None   # zero target -> null
    evo = {(r.sigla_uf, r.ano): (r.taxa_ano_anterior, r.variacao_pp)
           for r in gold.evolution(integ.filter(F.col("id_municipio") == "4")).collect()}
    assert evo[("BB", 2023)] == (60.0, 10.0)                           # 2022 missing: previous available
    top = [r.id_municipio for r in dashboard.topk_gap(gold.indicator_rank(integ), 20).collect()]
    assert top == ["1", "4"]                                           # null gaps dropped, gap desc
    assert not any(math.isnan(r.gap_para_meta_2030) for r in dashboard.topk_gap(gold.indicator_rank(integ)).collect())
