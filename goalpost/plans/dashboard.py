"""Dashboard marts (C15-C19) computed on the Gold tables, not in the driver.

The latest period is a one-row aggregate joined back by equality, so no
value makes a round trip through the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goalpost.functions.numeric import br_number, trend_label
from goalpost.operators.aggregate import arg_max, last_non_null
from goalpost.sources.layers import union_by_name


def latest_period(attainment: DataFrame, evolution: DataFrame, period: str = "ano") -> DataFrame:
    """Latest period of the attainment mart and first period of the evolution mart."""
    return union_by_name([attainment.agg(F.max(period).alias("ano_max")),
                          evolution.agg(F.min(period).alias("ano_min"))]) \
        .agg(F.max("ano_max").alias("ano_max"), F.max("ano_min").alias("ano_min"))


def latest_of(df: DataFrame, period: str = "ano") -> DataFrame:
    """One-row table holding the latest period of ``df``."""
    return df.agg(F.max(period).alias(period))


def at_latest(df: DataFrame, period: str = "ano", latest: DataFrame | None = None) -> DataFrame:
    """Rows of the latest period -- of ``df`` itself, or the one given by ``latest``
    (the dashboard takes it from the attainment mart for every mart).  The
    one-row table is broadcast: its size is 1 by construction."""
    latest = latest_of(df, period) if latest is None else latest.select(period)
    return df.join(F.broadcast(latest), period)


def rank_latest(attainment: DataFrame) -> DataFrame:
    """States by rate in the latest period, ascending."""
    return at_latest(attainment).select("sigla_uf", "ano", "taxa_alfabetizacao", "atingimento_meta_2030_pct") \
        .orderBy(F.col("taxa_alfabetizacao").asc(), F.col("sigla_uf").asc())


def target_vs_result(attainment: DataFrame) -> DataFrame:
    """Rate and 2030 target per state in the latest period, rate descending."""
    return at_latest(attainment).select("sigla_uf", "ano", "taxa_alfabetizacao", "meta_alfabetizacao_2030") \
        .orderBy(F.col("taxa_alfabetizacao").desc(), F.col("sigla_uf").asc())


def trend_direction(evolution: DataFrame, geo: str = "sigla_uf") -> DataFrame:
    """C17: each state's rows with the sign of its last non-null change ('Subiu' if missing)."""
    last = evolution.groupBy(geo).agg(last_non_null("variacao_pp", "ano").alias("ultima_variacao"))
    return (evolution.join(last, geo, "left")
                     .withColumn("tendencia", trend_label("ultima_variacao"))
                     .select(geo, "ano", "taxa_alfabetizacao", "variacao_pp", "tendencia")
                     .orderBy(geo, "ano"))


def topk_gap(indicator: DataFrame, n: int = 20, latest: DataFrame | None = None) -> DataFrame:
    """The ``n`` territories furthest from the target in the latest period (null gaps removed)."""
    return (at_latest(indicator, latest=latest).dropna(subset=["gap_para_meta_2030"])
            .select("id_municipio", "nome", "sigla_uf", "ano", "gap_para_meta_2030")
            .orderBy(F.col("gap_para_meta_2030").desc(), F.col("id_municipio").asc())
            .limit(n))


def kpis(attainment: DataFrame, evolution: DataFrame, indicator: DataFrame) -> DataFrame:
    """reached/total states, best state, biggest rise (all periods), territories analysed."""
    latest = at_latest(attainment)
    best = arg_max(["sigla_uf", "taxa_alfabetizacao"], "taxa_alfabetizacao", "sigla_uf")
    rise = arg_max(["sigla_uf", "variacao_pp"], "variacao_pp", "sigla_uf")
    parts = [
        latest.agg(F.max("ano").alias("ano"),
                   F.count_if(F.col("atingimento_meta_2030_pct") >= 100).alias("ufs_atingiram"),
                   F.count_distinct("sigla_uf").alias("ufs"),
                   best.alias("melhor")),
        evolution.agg(rise.alias("maior_alta")),
        at_latest(indicator, latest=latest_of(attainment)).agg(F.count_distinct("id_municipio").alias("municipios")),
    ]
    k = union_by_name(parts).agg(*[F.max(c).alias(c) for c in
                                   ("ano", "ufs_atingiram", "ufs", "melhor", "maior_alta", "municipios")])
    return k.select(
        "ano", "ufs_atingiram", "ufs",
        F.col("melhor.sigla_uf").alias("melhor_uf"), F.col("melhor.taxa_alfabetizacao").alias("melhor_taxa"),
        F.col("maior_alta.sigla_uf").alias("maior_alta_uf"), F.col("maior_alta.variacao_pp").alias("maior_alta_pp"),
        "municipios",
        F.concat(F.col("ufs_atingiram").cast("string"), F.lit(" de "), F.col("ufs").cast("string")).alias("cartao_meta"),
        br_number(F.col("melhor.taxa_alfabetizacao"), 2).alias("cartao_melhor_taxa"),
        br_number(F.col("maior_alta.variacao_pp"), 2).alias("cartao_maior_alta"),
        br_number(F.col("municipios"), 0).alias("cartao_municipios"))
