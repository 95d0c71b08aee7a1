"""Column expressions (all JVM-side built-ins, no UDFs)."""

from goalpost.functions.codes import (  # noqa: F401
    ALFABETIZADO, CODEBOOKS, PREENCHIMENTO_CADERNO, PRESENCA, REDE, SERIE, decode, decode_all,
)
from goalpost.functions.numeric import (  # noqa: F401
    band, br_number, finite_or_null, pct, safe_div, trend_label,
)
