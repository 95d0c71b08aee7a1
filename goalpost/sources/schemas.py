"""Column contracts of the domain tables and a check on read.

The reference declares no schema; these contracts make the columns each job
touches explicit.  Types are checked by family, so a territory id may be a
string (as in the reference's data) or an integer (as in the analogue), while
code columns must be strings -- a numeric code column would turn the filter
``rede == "3"`` into a cast that fails under ANSI on non-numeric codes.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import types as T

INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
FLOATING = (T.FloatType, T.DoubleType, T.DecimalType)
STRING = (T.StringType,)
KEY = STRING + INTEGRAL
ANY = (T.AtomicType,)

_TARGET = {"ano": INTEGRAL, "rede": STRING, "taxa_alfabetizacao": FLOATING,
           "meta_alfabetizacao_2024": FLOATING, "meta_alfabetizacao_2026": FLOATING,
           "meta_alfabetizacao_2028": FLOATING, "meta_alfabetizacao_2030": FLOATING}

CONTRACTS: dict[str, Mapping[str, tuple]] = {
    "alunos": {"ano": INTEGRAL, "id_municipio": KEY, "id_aluno": KEY, "serie": STRING, "rede": STRING,
               "presenca": STRING, "preenchimento_caderno": STRING, "alfabetizado": STRING,
               "proficiencia": FLOATING},
    "municipio": {"ano": INTEGRAL, "id_municipio": KEY, "serie": STRING, "rede": STRING,
                  "taxa_alfabetizacao": FLOATING, "media_portugues": FLOATING},
    "uf": {"ano": INTEGRAL, "sigla_uf": STRING, "serie": STRING, "rede": STRING,
           "taxa_alfabetizacao": FLOATING, "media_portugues": FLOATING},
    "meta_brasil": dict(_TARGET),
    "meta_uf": {**_TARGET, "sigla_uf": STRING},
    "meta_municipio": {**_TARGET, "id_municipio": KEY},
    "diretorio_municipio": {"id_municipio": KEY, "nome": STRING, "sigla_uf": STRING, "nome_uf": STRING,
                            "nome_regiao": STRING, "capital_uf": ANY, "amazonia_legal": ANY},
}


class SchemaError(ValueError):
    """A table misses contract columns or has them with the wrong type family."""


def check_schema(df: DataFrame, table: str, contract: Mapping[str, tuple] | None = None) -> DataFrame:
    """Return ``df`` unchanged when it satisfies the contract; raise naming every problem otherwise.

    Only the schema is inspected (no Spark job).
    """
    contract = CONTRACTS[table] if contract is None else contract
    fields = {f.name: f.dataType for f in df.schema.fields}
    problems = []
    for col, families in contract.items():
        if col not in fields:
            problems.append(f"{col}: missing")
        elif not isinstance(fields[col], families):
            problems.append(f"{col}: {fields[col].simpleString()} is not {'/'.join(t.__name__ for t in families)}")
    if problems:
        raise SchemaError(f"{table}: " + "; ".join(problems))
    return df
