import pytest

from goalpost.plans import analogue
from goalpost.sources.schemas import CONTRACTS, SchemaError, check_schema

SF = "/root/testdata/sf0.001"


def test_analogue_tables_satisfy_their_contracts(spark):
    tables = {"alunos": analogue.micro, "municipio": analogue.indicator_fine, "uf": analogue.indicator_coarse,
              "meta_brasil": analogue.target_country, "meta_uf": analogue.target_coarse,
              "meta_municipio": analogue.target_fine, "diretorio_municipio": analogue.directory}
    assert set(tables) == set(CONTRACTS)
    for name, build in tables.items():
        check_schema(build(spark, SF), name)


def test_string_ids_pass_and_numeric_codes_fail(spark):
    ok = spark.createDataFrame([(2024, "2304400", "2", "3", 50.0, 700.0)],
                               "ano int, id_municipio string, serie string, rede string, "
                               "taxa_alfabetizacao double, media_portugues double")
    check_schema(ok, "municipio")
    bad = ok.withColumn("rede", ok.rede.cast("int")).drop("media_portugues")
    with pytest.raises(SchemaError) as e:
        check_schema(bad, "municipio")
    assert "rede: int" in str(e.value) and "media_portugues: missing" in str(e.value)
