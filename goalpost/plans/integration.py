"""Integration of indicators with targets (C6) and its consistency rules (Q10)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goalpost.functions.codes import REDE_MUNICIPAL
from goalpost.operators import quality as q
from goalpost.operators.joins import integrate

TARGET_COLUMNS = ["meta_alfabetizacao_2024", "meta_alfabetizacao_2026",
                  "meta_alfabetizacao_2028", "meta_alfabetizacao_2030"]


def _inputs(indicator: DataFrame, target: DataFrame, geo: str, extra: Sequence[str],
            network: str) -> tuple[DataFrame, DataFrame]:
    ind = (indicator.filter(F.col("rede") == F.lit(network))
                    .select(geo, *extra, "ano", "taxa_alfabetizacao", "media_portugues"))
    meta = target.select(geo, "ano", *TARGET_COLUMNS)
    return ind, meta


def consistency(ind: DataFrame, meta: DataFrame, geo: str) -> DataFrame:
    """Q10 report for one integration: null keys fail on both sides; the target
    must be unique on the join key (fan-out guard); missing targets warn."""
    key = [geo, "ano"]
    left = q.evaluate(ind, [q.nulls("null indicator key", key),
                            q.orphans("territory-years without target", key, meta, severity=q.WARN)])
    right = q.evaluate(meta, [q.nulls("null target key", key),
                              q.duplicates("target not unique on join key", key)])
    return (left.withColumn("side", F.lit("indicator"))
                .unionByName(right.withColumn("side", F.lit("target"))
                             .withColumn("position", F.col("position") + F.lit(10))))


def integrate_level(indicator: DataFrame, target: DataFrame, geo: str, extra: Sequence[str] = (),
                    network: str = REDE_MUNICIPAL) -> DataFrame:
    """Integrated table for one geographic level (lazy; no action)."""
    ind, meta = _inputs(indicator, target, geo, extra, network)
    return integrate(ind, meta, [geo, "ano"])


def level_consistency(indicator: DataFrame, target: DataFrame, geo: str, extra: Sequence[str] = (),
                      network: str = REDE_MUNICIPAL) -> DataFrame:
    """The Q10 report for one level, to be gated before ``integrate_level`` is written."""
    return consistency(*_inputs(indicator, target, geo, extra, network), geo)


def integrate_fine(indicator: DataFrame, target: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(integrated, consistency report) -- both lazy."""
    return (integrate_level(indicator, target, "id_municipio", ["nome", "sigla_uf"]),
            level_consistency(indicator, target, "id_municipio", ["nome", "sigla_uf"]))


def integrate_coarse(indicator: DataFrame, target: DataFrame) -> tuple[DataFrame, DataFrame]:
    return (integrate_level(indicator, target, "sigla_uf"),
            level_consistency(indicator, target, "sigla_uf"))
