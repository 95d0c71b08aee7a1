"""Lazy end-to-end chains over the analogue tables (no writes, no gates).

``pipeline`` runs the same steps with the quality gate and layer writes; these
lazy versions feed the registered queries and let Catalyst see whole plans.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from goalpost.plans import analogue, gold, integration, silver


def silver_directory(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.directory(analogue.directory(spark, sf_dir))[0]


def silver_fine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.indicator_fine(analogue.indicator_fine(spark, sf_dir), silver_directory(spark, sf_dir))[0]


def silver_coarse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.indicator_coarse(analogue.indicator_coarse(spark, sf_dir))[0]


def silver_target_fine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.targets(analogue.target_fine(spark, sf_dir), silver.TARGETS[2])[0]


def silver_target_coarse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.targets(analogue.target_coarse(spark, sf_dir), silver.TARGETS[1])[0]


def integrated_fine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return integration.integrate_level(silver_fine(spark, sf_dir), silver_target_fine(spark, sf_dir),
                                       "id_municipio", ["nome", "sigla_uf"])


def integrated_coarse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return integration.integrate_level(silver_coarse(spark, sf_dir), silver_target_coarse(spark, sf_dir), "sigla_uf")


def gold_indicator(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.indicator_rank(integrated_fine(spark, sf_dir))


def gold_attainment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.attainment(integrated_coarse(spark, sf_dir))


def gold_evolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.evolution(integrated_coarse(spark, sf_dir))


def silver_micro(spark: SparkSession, sf_dir: str, dirty: bool = False) -> DataFrame:
    src = analogue.dirty_micro(spark, sf_dir) if dirty else analogue.micro(spark, sf_dir)
    return silver.micro(src, silver_directory(spark, sf_dir))[0]


def analysis_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C10 over the lazy Silver tables.  The micro side only needs its own columns: Silver micro is the deduplicated
    micro table plus decodes and a left lookup on a directory whose key is gated unique, which never changes the rows.
    A student is one row of a year there (gated too), so repeats are found on the key and the counted columns alone."""
    from goalpost.plans import analysis
    micro = analogue.micro(spark, sf_dir).select("ano", "id_aluno", "id_municipio", "rede", "proficiencia", "alfabetizado")
    return analysis.base(silver_fine(spark, sf_dir), silver_target_fine(spark, sf_dir), micro.dropDuplicates())


def gold_gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold indicator without the rank column (what the top-k and KPI marts read)."""
    from pyspark.sql import functions as F
    return integrated_fine(spark, sf_dir).withColumn(
        "gap_para_meta_2030", F.round(F.col("meta_alfabetizacao_2030") - F.col("taxa_alfabetizacao"), 2))
