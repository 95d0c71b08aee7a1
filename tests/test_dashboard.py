from goalpost.plans import dashboard

ATT = "sigla_uf string, ano int, taxa_alfabetizacao double, meta_alfabetizacao_2030 double, atingimento_meta_2030_pct double"
EVO = "sigla_uf string, ano int, taxa_alfabetizacao double, variacao_pp double"
GAP = "id_municipio long, nome string, sigla_uf string, ano int, gap_para_meta_2030 double"


def test_kpis_ties_and_latest_period(spark):
    att = spark.createDataFrame([("BB", 2024, 90.0, 80.0, 112.5), ("AA", 2024, 90.0, 95.0, 94.74),
                                 ("CC", 2024, None, 0.0, None), ("AA", 2023, 99.0, 95.0, 104.21)], ATT)
    evo = spark.createDataFrame([("AA", 2023, 99.0, None), ("AA", 2024, 90.0, -9.0), ("BB", 2023, 80.0, None),
                                 ("BB", 2024, 90.0, 10.0), ("CC", 2024, None, None), ("DD", 2022, 50.0, 10.0)], EVO)
    gap = spark.createDataFrame([(1, "a", "AA", 2024, 5.0), (2, "b", "AA", 2024, None), (1, "a", "AA", 2023, 1.0),
                                 (3, "c", "BB", 2024, -2.0)], GAP)
    k = dashboard.kpis(att, evo, gap).first()
    assert (k.ano, k.ufs_atingiram, k.ufs) == (2024, 1, 3)
    assert (k.melhor_uf, k.melhor_taxa) == ("AA", 90.0)                  # tie at 90.0 -> smallest code
    assert (k.maior_alta_uf, k.maior_alta_pp) == ("BB", 10.0)            # tie at 10.0 over all years -> BB < DD
    assert k.municipios == 3 and k.cartao_meta == "1 de 3" and k.cartao_melhor_taxa == "90,00"
    lp = dashboard.latest_period(att, evo).first()
    assert (lp.ano_max, lp.ano_min) == (2024, 2022)


def test_trend_all_null_changes_count_as_rise(spark):
    evo = spark.createDataFrame([("AA", 2023, 1.0, None), ("AA", 2024, 2.0, 1.0), ("AA", 2025, 3.0, None),
                                 ("BB", 2023, 5.0, None), ("CC", 2023, 5.0, -1.0), ("CC", 2024, 4.0, None)], EVO)
    got = {r.sigla_uf: r.tendencia for r in dashboard.trend_direction(evo).collect()}
    assert got == {"AA": "Subiu", "BB": "Subiu", "CC": "Caiu"}           # last non-null change decides


def test_topk_gap_latest_year_only_and_null_gaps_dropped(spark):
    gap = spark.createDataFrame([(i, f"n{i}", "AA", 2024, float(i % 7)) for i in range(30)]
                                + [(99, "old", "AA", 2023, 100.0), (98, "nul", "AA", 2024, None)], GAP)
    top = dashboard.topk_gap(gap, 5).collect()
    assert [r.id_municipio for r in top] == [6, 13, 20, 27, 5]          # gap desc, ties by key
    assert all(r.ano == 2024 for r in top)


def test_municipal_marts_use_the_attainment_marts_latest_year(spark):
    att = spark.createDataFrame([("AA", 2023, 90.0, 80.0, 112.5)], ATT)
    evo = spark.createDataFrame([("AA", 2023, 90.0, None)], EVO)
    gap = spark.createDataFrame([(1, "a", "AA", 2023, 5.0), (2, "b", "AA", 2024, 9.0), (3, "c", "AA", 2024, 8.0)], GAP)
    top = dashboard.topk_gap(gap, 20, latest=dashboard.latest_of(att)).collect()
    assert [(r.id_municipio, r.ano) for r in top] == [(1, 2023)]
    assert dashboard.kpis(att, evo, gap).first().municipios == 1
