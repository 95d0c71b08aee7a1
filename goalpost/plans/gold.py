"""Gold marts (C7-C9): gap + rank, attainment, evolution."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goalpost.functions.numeric import pct
from goalpost.operators.ranking import previous_value, row_number_within


def indicator_rank(integrated: DataFrame, geo: str = "id_municipio", parent: str = "sigla_uf",
                   period: str = "ano", rate: str = "taxa_alfabetizacao",
                   target: str = "meta_alfabetizacao_2030") -> DataFrame:
    """Gap to target (E3) and place inside parent and period by rate.

    Null rates go last; ties are broken by the territory key.
    """
    with_gap = integrated.withColumn("gap_para_meta_2030", F.round(F.col(target) - F.col(rate), 2))
    return row_number_within(with_gap, [parent, period],
                             [F.col(rate).desc_nulls_last(), F.col(geo).asc_nulls_last()], "ranking_na_uf")


def attainment(integrated: DataFrame, rate: str = "taxa_alfabetizacao",
               target: str = "meta_alfabetizacao_2030") -> DataFrame:
    """``round(rate / target * 100, 2)``; null when the target is 0 or null."""
    return integrated.withColumn("atingimento_meta_2030_pct", pct(rate, target, 2))


def evolution(integrated: DataFrame, geo: str = "sigla_uf", period: str = "ano",
              rate: str = "taxa_alfabetizacao") -> DataFrame:
    """Previous available period's rate and the change in points."""
    base = integrated.select(geo, period, rate)
    return previous_value(base, [geo], period, rate, "taxa_ano_anterior", "variacao_pp", 2)
