"""Official code books and the ``decode`` expression.

A code book maps the text of a code to its description.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: code books of the literacy assessment dictionary ---------
REDE = {
    "0": "Total (Federal, Estadual, Municipal e Privada)",
    "1": "Federal",
    "2": "Estadual",
    "3": "Municipal",
    "4": "Privada",
    "5": "Publica (Estadual e Municipal)",
    "6": "Publica (Federal, Estadual e Municipal)",
}
SERIE = {"2": "2o ano do Ensino Fundamental"}
PRESENCA = {"0": "Ausente", "1": "Presente"}
PREENCHIMENTO_CADERNO = {"0": "Prova nao preenchida", "1": "Prova preenchida"}
ALFABETIZADO = {"0": "Nao", "1": "Sim"}
REDE_MUNICIPAL = "3"
# ---------------------------------------------------------------------------

CODEBOOKS: dict[str, Mapping[str, str]] = {
    "rede": REDE,
    "serie": SERIE,
    "presenca": PRESENCA,
    "preenchimento_caderno": PREENCHIMENTO_CADERNO,
    "alfabetizado": ALFABETIZADO,
}


def decode(column: str | Column, mapping: Mapping[str, str], default: str | None = None) -> Column:
    """Code -> description; unknown and null codes give ``default``.

    The result is always a string column, also when ``default`` is None.
    """
    c = F.col(column) if isinstance(column, str) else column
    fallback = F.lit(default).cast("string")
    if not mapping:
        return fallback
    expr = None
    for code, text in mapping.items():
        expr = (F.when(c == code, F.lit(text)) if expr is None
                else expr.when(c == code, F.lit(text)))
    return expr.otherwise(fallback)


def decode_all(columns: Mapping[str, Mapping[str, str]], suffix: str = "_desc") -> dict[str, Column]:
    """``{col + suffix: decode(col, book)}`` for ``DataFrame.withColumns``."""
    return {f"{c}{suffix}": decode(c, book) for c, book in columns.items()}
