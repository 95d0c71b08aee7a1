"""Missing-target analysis.

``base`` joins the indicator with a has-target flag and with a rollup of the
micro table; the four reports are small aggregates over it.  Averages of
values that carry a fixed number of decimals are taken exactly (integer sum
of the scaled values), so the result does not depend on summation order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goalpost.functions.codes import REDE_MUNICIPAL
from goalpost.functions.numeric import band, pct
from goalpost.operators.aggregate import count_of_counts, micro_rollup
from goalpost.operators.joins import existence_flag

# --- fixed values: participation bands of the analysis --------------------
BAND_EDGES = (60, 70, 80, 90)
BAND_LABELS = ("1: <60%", "2: 60-70%", "3: 70-80%", "4: 80-90%", "5: >=90%")
# ---------------------------------------------------------------------------


def exact_avg(x: str) -> Column:
    """Mean of the unrounded values, summed as decimals so that the order of the sum changes nothing."""
    total = F.sum(F.col(x).cast("decimal(38,18)")).cast("double")
    return F.try_divide(total, F.count(x).cast("double"))


def base(indicator: DataFrame, target: DataFrame, micro: DataFrame, network: str = REDE_MUNICIPAL) -> DataFrame:
    """Indicator + ``orfao`` (no target for that territory-year) + micro counts + participation."""
    return base_from_rollup(indicator, target, micro_rollup(micro.filter(F.col("rede") == F.lit(network)),
                                                            ["id_municipio", "ano", "rede"]), network)


def base_from_rollup(indicator: DataFrame, target: DataFrame, rollup: DataFrame,
                     network: str = REDE_MUNICIPAL) -> DataFrame:
    """C10 over a (territory, period, network) rollup of the micro table, e.g. the stored one (``plans.rollups``)."""
    ind = (indicator.filter(F.col("rede") == F.lit(network))
                    .select("id_municipio", "nome", "sigla_uf", "ano",
                            F.col("taxa_alfabetizacao").alias("taxa_oficial")))
    ind = existence_flag(ind, target, ["id_municipio", "ano"], "orfao")
    counts = (rollup.filter(F.col("rede") == F.lit(network))
                    .select("id_municipio", "ano", "n_matric", "n_prova", "n_alfab"))
    return (ind.join(counts, ["id_municipio", "ano"], "left")
               .withColumn("participacao", pct("n_prova", "n_matric", 1)))


def coverage(b: DataFrame) -> DataFrame:
    """C11: territory-years, orphan territory-years, distinct orphan territories (null counts as one)."""
    o = F.col("orfao")
    return b.agg(
        F.count(F.lit(1)).alias("municipio_anos"),
        F.count_if(o).alias("municipio_anos_orfaos"),
        (F.count_distinct(F.when(o, F.col("id_municipio")))
         + F.max(F.when(o & F.col("id_municipio").isNull(), 1).otherwise(0))).cast("bigint")
        .alias("municipios_orfaos"))


def persistence(b: DataFrame) -> DataFrame:
    """In how many years each orphan territory was orphan, and how many territories per count."""
    return count_of_counts(b.filter(F.col("orfao")), "id_municipio", "anos_como_orfao", "count")


def participation_pattern(b: DataFrame) -> DataFrame:
    """Mean / approximate median participation and mean official rate by orphan flag."""
    return b.groupBy("orfao").agg(
        F.round(exact_avg("participacao"), 1).alias("media_pct"),
        F.percentile_approx("participacao", 0.5).alias("mediana_pct"),
        F.round(exact_avg("taxa_oficial"), 1).alias("media_taxa_oficial"))


def orphan_rate_by_band(b: DataFrame) -> DataFrame:
    """Orphan share per participation band (rows without participation removed first)."""
    banded = b.filter(F.col("participacao").isNotNull()) \
              .withColumn("faixa", band("participacao", BAND_EDGES, BAND_LABELS))
    flag = F.col("orfao").cast("int")
    return banded.groupBy("faixa").agg(
        F.count(F.lit(1)).alias("total"),
        F.sum(flag).cast("bigint").alias("orfaos"),
        F.round(F.avg(flag) * F.lit(100), 1).alias("pct_orfao"))


def counterexamples(b: DataFrame, min_tested: int = 50, n: int = 15) -> DataFrame:
    """Orphans with many tested students, top ``n`` by tested count (ties by key)."""
    return (b.filter(F.col("orfao") & (F.col("n_prova") >= min_tested))
             .select("id_municipio", "nome", "sigla_uf", "ano", "n_matric", "n_prova", "taxa_oficial", "participacao")
             .orderBy(F.col("n_prova").desc(), F.col("id_municipio").asc(), F.col("ano").asc())
             .limit(n))


def denominator_check(b: DataFrame) -> DataFrame:
    """C14: official rate next to the rate over tested and over enrolled students."""
    return (b.filter(~F.col("orfao") & (F.col("n_prova") > 0))
             .select("id_municipio", "nome", "sigla_uf", "ano", "taxa_oficial",
                     pct("n_alfab", "n_prova", 1).alias("taxa_sobre_prova"),
                     pct("n_alfab", "n_matric", 1).alias("taxa_sobre_matric")))


def run_all(indicator: DataFrame, target: DataFrame, micro: DataFrame) -> dict[str, list]:
    """The whole analysis as the reference runs it: one base, kept once (``MEMORY_AND_DISK``,
    one row per territory-year), then the small reports collected from it."""
    from pyspark import StorageLevel
    b = base(indicator, target, micro).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        reports = {
            "coverage": coverage(b),
            "persistence": persistence(b).orderBy("anos_como_orfao"),
            "participation": participation_pattern(b).orderBy("orfao"),
            "bands": orphan_rate_by_band(b).orderBy("faixa"),
            "counterexamples": counterexamples(b),
            "denominator": denominator_check(b).orderBy("id_municipio", "ano").limit(8),
        }
        return {k: [r.asDict() for r in v.collect()] for k, v in reports.items()}
    finally:
        b.unpersist()
