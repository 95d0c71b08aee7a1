"""Silver jobs (C1-C5): dedup -> enrich -> decode -> one-pass rules.

Each builder returns ``(frame, rules)``: the lazy cleaned table and the rule
set that must pass before it is written (``plans.pipeline`` runs the gate
and the write).  Column names are the reference's; keys are parameters
where the reference has variants (targets by geographic level).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goalpost.functions.codes import ALFABETIZADO, PREENCHIMENTO_CADERNO, PRESENCA, REDE, SERIE, decode_all
from goalpost.operators import quality as q
from goalpost.operators.aggregate import dedup_by_period
from goalpost.operators.joins import lookup

@dataclass(frozen=True)
class TargetSpec:
    name: str
    geo_key: str | None
    null_target_is_error: bool = True


# --- fixed values: the directory's columns; the three target tables and their geographic key ---------
DIRECTORY_COLUMNS = ["id_municipio", "nome", "sigla_uf", "nome_uf", "nome_regiao", "capital_uf", "amazonia_legal"]
TARGETS = (
    TargetSpec("meta_brasil", None),
    TargetSpec("meta_uf", "sigla_uf", null_target_is_error=False),
    TargetSpec("meta_municipio", "id_municipio"),
)
# ---------------------------------------------------------------------------


def indicator_coarse(bronze: DataFrame) -> tuple[DataFrame, list[q.Rule]]:
    """C1 (``uf``)."""
    df = bronze.dropDuplicates().withColumns(decode_all({"rede": REDE, "serie": SERIE}))
    key = ["ano", "sigla_uf", "rede"]
    return df, [
        q.nulls("null key", key),
        q.nulls("null required field", ["serie", "taxa_alfabetizacao"]),
        q.duplicates("duplicate key", key),
        q.out_of_range("rate outside 0-100", "taxa_alfabetizacao", 0, 100),
    ]


def indicator_fine(bronze: DataFrame, directory: DataFrame) -> tuple[DataFrame, list[q.Rule]]:
    """C2 (``municipio``): C1 plus the directory lookup and its orphan rules."""
    geo = directory.select("id_municipio", "nome", "sigla_uf")
    df = (lookup(bronze.dropDuplicates(), geo, "id_municipio", "left")
          .withColumns(decode_all({"rede": REDE, "serie": SERIE})))
    key = ["ano", "id_municipio", "rede"]
    return df, [
        q.nulls("null key", key),
        q.nulls("null required field", ["serie", "taxa_alfabetizacao"]),
        q.duplicates("duplicate key", key),
        q.out_of_range("rate outside 0-100", "taxa_alfabetizacao", 0, 100),
        q.count_where("territory without parent", F.col("sigla_uf").isNull()),
        q.orphans("territory missing from directory", "id_municipio", geo),
    ]


def directory(bronze: DataFrame) -> tuple[DataFrame, list[q.Rule]]:
    """C3 (``diretorio_municipio``): 7 columns, dedup, key rules."""
    df = bronze.select(*DIRECTORY_COLUMNS).dropDuplicates()
    return df, [
        q.nulls("null key", ["id_municipio"]),
        q.nulls("null required field", ["nome", "sigla_uf"]),
        q.duplicates("duplicate key", "id_municipio"),
    ]


def targets(bronze: DataFrame, spec: TargetSpec) -> tuple[DataFrame, list[q.Rule]]:
    """C4: one target table; a null 2030 target is an error except where the spec says warn."""
    df = bronze.dropDuplicates()
    key = ["ano", "rede"] + ([spec.geo_key] if spec.geo_key else [])
    rules = [
        q.nulls("null key", key),
        q.duplicates("duplicate key", key),
        q.out_of_range("rate outside 0-100", "taxa_alfabetizacao", 0, 100),
        q.out_of_range("2030 target outside 0-100", "meta_alfabetizacao_2030", 0, 100),
        q.nulls("rate missing at source", ["taxa_alfabetizacao"], severity=q.WARN),
    ]
    rules.append(q.nulls("null 2030 target", ["meta_alfabetizacao_2030"],
                         severity=q.ERROR if spec.null_target_is_error else q.WARN))
    return df, rules


def micro(bronze: DataFrame, directory: DataFrame, by_period: bool = False) -> tuple[DataFrame, list[q.Rule]]:
    """C5 (``alunos``): dedup, five decodes, directory lookup, five rules.

    ``by_period``: the table is written by ``ano`` next, and its rows are brought together for that as they are deduped."""
    geo = directory.select("id_municipio", "nome", "sigla_uf")
    books = {"rede": REDE, "serie": SERIE, "presenca": PRESENCA,
             "preenchimento_caderno": PREENCHIMENTO_CADERNO, "alfabetizado": ALFABETIZADO}
    rows = dedup_by_period(bronze, "ano") if by_period else bronze.dropDuplicates()
    df = lookup(rows.withColumns(decode_all(books)), geo, "id_municipio", "left")
    return df, [
        q.nulls("null key", ["ano", "id_municipio", "id_aluno"]),
        q.nulls("null required field", ["serie", "rede", "presenca", "preenchimento_caderno", "alfabetizado"]),
        q.duplicates("duplicate key", ["ano", "id_aluno"]),
        q.not_in("literate flag invalid", "alfabetizado", ["0", "1"]),
        q.orphans("territory missing from directory", "id_municipio", geo),
    ]
