"""Numeric expressions: safe ratios, rounding, bands, formatting."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def safe_div(num, den) -> Column:
    """``num / den`` as double; null when ``den`` is 0 or null (never raises under ANSI)."""
    return F.try_divide(_c(num).cast("double"), _c(den).cast("double"))


def pct(num, den, scale: int) -> Column:
    """``round(num / den * 100, scale)`` in that operation order; null on a zero denominator."""
    return F.round(safe_div(num, den) * F.lit(100), scale)


def finite_or_null(x) -> Column:
    """NaN and +/-Infinity become null (needed before JSON encoding)."""
    c = _c(x)
    return F.when(F.isnan(c) | (F.abs(c) == F.lit(float("inf"))), F.lit(None)).otherwise(c)


def band(x, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Lower-inclusive bands: ``x < edges[0] -> labels[0]`` ... else ``labels[-1]``.

    ``len(labels) == len(edges) + 1``; a null ``x`` falls in the last band, so
    callers drop nulls first (as the reference does).
    """
    if len(labels) != len(edges) + 1:
        raise ValueError("need one more label than edges")
    c = _c(x)
    expr = F.when(c < F.lit(edges[0]), F.lit(labels[0]))
    for edge, label in zip(edges[1:], labels[1:-1]):
        expr = expr.when(c < F.lit(edge), F.lit(label))
    return expr.otherwise(F.lit(labels[-1]))


def trend_label(delta, up: str = "Subiu", down: str = "Caiu") -> Column:
    """Rise/fall label: a missing delta counts as 0, i.e. as a rise."""
    return F.when(F.coalesce(_c(delta), F.lit(0.0)) >= 0, F.lit(up)).otherwise(F.lit(down))


def br_number(x, decimals: int = 2) -> Column:
    """Brazilian number text: thousands '.', decimals ',' (``1234.5 -> '1.234,50'``)."""
    return F.translate(F.format_number(_c(x), decimals), ",.", ".,")
