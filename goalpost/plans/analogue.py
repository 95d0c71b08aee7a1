"""Domain-shaped tables derived by Spark from the shared test tables.

The reference works on literacy micro data, published indicators, targets
and a municipality directory.  The test data is TPC-H shaped, so this module
derives tables with the reference's schemas from it (recipe in FIXTURES.md):

* ``micro``      (alunos)               one row per lineitem
* ``directory``  (diretorio_municipio)  supplier ⋈ nation ⋈ region
* ``indicator_fine`` / ``indicator_coarse`` (municipio / uf)  rollups of micro
* ``target_fine`` / ``target_coarse`` / ``target_country`` (meta_*)
* ``dirty_micro``  micro with injected rule violations

Every table is a lazy plan over the given Parquet files, so its work grows
with them.  The same recipe is written as SQL for the DuckDB oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from goalpost.functions.numeric import pct
from goalpost.operators.aggregate import micro_rollup

# --- fixed values of the analogue recipe (FIXTURES.md §4, §5) ----------------
TESTED_DISCOUNT = 0.02        # l_discount above this = took the test
LITERATE_FLAG = "R"           # l_returnflag of a literate student
STATE_NETWORK_TAX = 0.08      # l_tax of students in the state network ("2")
SCORE_PER_UNIT = 20           # proficiency = l_quantity * 20 (integer valued)
MIN_PARTICIPATION = 70.0      # targets exist only for cells at >= 70 % participation
# ----------------------------------------------------------------------------


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The shared input table, listed anew on each use."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _micro_columns() -> list:
    tested = F.col("l_discount") > F.lit(TESTED_DISCOUNT)
    flag = F.when(tested, F.lit("1")).otherwise(F.lit("0"))
    return [
        F.year("l_shipdate").alias("ano"),
        F.col("l_suppkey").alias("id_municipio"),
        F.col("l_partkey").alias("id_escola"),
        # (order, line, part, supplier, ship day) is the unique row key of lineitem
        F.concat_ws("-", *[F.col(c).cast("string") for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")],
                    F.dayofyear("l_shipdate").cast("string")).alias("id_aluno"),
        F.lit("2").alias("serie"),
        F.when(F.col("l_tax") == F.lit(STATE_NETWORK_TAX), F.lit("2")).otherwise(F.lit("3")).alias("rede"),
        flag.alias("presenca"),
        flag.alias("preenchimento_caderno"),
        F.when(tested & (F.col("l_returnflag") == F.lit(LITERATE_FLAG)), F.lit("1"))
         .otherwise(F.lit("0")).alias("alfabetizado"),
        F.when(tested, F.col("l_quantity") * F.lit(SCORE_PER_UNIT)).alias("proficiencia"),
        F.lit(1.0).alias("peso_aluno"),
    ]


def micro(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(*_micro_columns())


def directory(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    return (s.join(n, s.s_nationkey == n.n_nationkey)
             .join(r, n.n_regionkey == r.r_regionkey)
             .select(F.col("s_suppkey").alias("id_municipio"),
                     F.col("s_name").alias("nome"),
                     F.col("n_name").alias("sigla_uf"),
                     F.col("n_name").alias("nome_uf"),
                     F.col("r_name").alias("nome_regiao"),
                     (F.col("s_suppkey") % 100 == 0).cast("int").alias("capital_uf"),
                     (F.col("n_regionkey") == 1).cast("int").alias("amazonia_legal")))


def fine_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts per (territory, year, network, grade) -- the shared base of the fine tables."""
    return micro_rollup(micro(spark, sf_dir), ["id_municipio", "ano", "rede", "serie"])


def _indicator(roll: DataFrame, keys: list[str]) -> DataFrame:
    # an indicator is published only where someone took the test
    return roll.filter(F.col("n_prova") > 0).select(*keys,
                       pct("n_alfab", "n_prova", 2).alias("taxa_alfabetizacao"),
                       F.round(F.try_divide(F.col("soma_proficiencia"), F.col("n_prova").cast("double")), 2)
                        .alias("media_portugues"))


def indicator_fine(spark: SparkSession, sf_dir: str, roll: DataFrame | None = None) -> DataFrame:
    """``municipio``: rate and mean score per (ano, id_municipio, serie, rede).

    ``roll`` (the fine rollup) can be passed in when several tables derive
    from one written rollup, so the micro table is not rolled up again.
    """
    roll = fine_rollup(spark, sf_dir) if roll is None else roll
    return _indicator(roll, ["ano", "id_municipio", "serie", "rede"])


def indicator_coarse(spark: SparkSession, sf_dir: str, roll: DataFrame | None = None) -> DataFrame:
    """``uf``: fine counts summed per (state, year, network, grade).

    Rolled up first, then joined to the directory: the join sees one row per
    cell, not one per student.
    """
    roll = fine_rollup(spark, sf_dir) if roll is None else roll
    geo = directory(spark, sf_dir).select("id_municipio", "sigla_uf")
    per_state = (roll.join(geo, "id_municipio")
                     .groupBy("sigla_uf", "ano", "rede", "serie")
                     .agg(*[F.sum(c).alias(c) for c in ("n_matric", "n_prova", "n_alfab", "soma_proficiencia")]))
    return _indicator(per_state, ["ano", "sigla_uf", "serie", "rede"])


def _target_levels(meta_2030):
    return [F.greatest(meta_2030 - F.lit(d), F.lit(0.0)).alias(f"meta_alfabetizacao_{y}")
            for y, d in ((2024, 15.0), (2026, 10.0), (2028, 5.0))] + [meta_2030.alias("meta_alfabetizacao_2030")]


def target_fine(spark: SparkSession, sf_dir: str, roll: DataFrame | None = None) -> DataFrame:
    """``meta_municipio``: municipal-network cells with participation >= 70 %."""
    roll = (fine_rollup(spark, sf_dir) if roll is None else roll).filter(F.col("rede") == "3")
    geo = F.col("id_municipio")
    meta = F.when(geo % 50 == 49, F.lit(0.0)).otherwise((F.lit(25) + F.lit(5) * (geo % 5)).cast("double"))
    return (roll.filter(pct("n_prova", "n_matric", 1) >= F.lit(MIN_PARTICIPATION))
                .select("ano", "rede", "id_municipio",
                        pct("n_alfab", "n_prova", 2).alias("taxa_alfabetizacao"),
                        *_target_levels(meta)))


def target_coarse(spark: SparkSession, sf_dir: str, roll: DataFrame | None = None) -> DataFrame:
    """``meta_uf``: state targets; some states have none, some a null 2030 target."""
    ind = indicator_coarse(spark, sf_dir, roll).filter(F.col("rede") == "3")
    nation = table(spark, sf_dir, "nation")
    k = F.col("n_nationkey")
    meta = (F.when(k % 9 == 4, F.lit(None).cast("double"))
             .when(k == 24, F.lit(0.0))
             .otherwise((F.lit(30) + F.lit(2) * (k % 4)).cast("double")))
    return (ind.join(nation, ind.sigla_uf == nation.n_name)
               .filter(k % 11 != 0)
               .select("ano", "rede", "sigla_uf", "taxa_alfabetizacao", *_target_levels(meta)))


def target_country(spark: SparkSession, sf_dir: str, roll: DataFrame | None = None) -> DataFrame:
    """``meta_brasil``: one national target per (year, network)."""
    roll = fine_rollup(spark, sf_dir) if roll is None else roll
    per_year = roll.groupBy("ano", "rede").agg(F.sum("n_prova").alias("n_prova"), F.sum("n_alfab").alias("n_alfab"))
    return per_year.select("ano", "rede", pct("n_alfab", "n_prova", 2).alias("taxa_alfabetizacao"),
                           *_target_levels(F.lit(60.0)))


def dirty_micro(spark: SparkSession, sf_dir: str) -> DataFrame:
    """micro with injected violations (FIXTURES.md §5), same CASEs as the oracle.

    Columns change first (a null key wins over the orphan shift), then the
    rows with ``l_orderkey % 101 = 0`` are repeated, so repeats are exact copies.
    """
    m = table(spark, sf_dir, "lineitem").select(*_micro_columns(), F.col("l_orderkey").alias("__ok"),
                                                  F.col("l_partkey").alias("__pk"))
    m = m.select(
        "ano",
        F.when(F.col("__ok") % 97 == 0, F.lit(None).cast("bigint"))
         .when(F.col("__pk") % 89 == 0, F.col("id_municipio") + F.lit(1000000))
         .otherwise(F.col("id_municipio")).alias("id_municipio"),
        "id_escola", "id_aluno", "serie", "rede", "presenca", "preenchimento_caderno",
        F.when(F.col("__ok") % 107 == 0, F.lit("X")).otherwise(F.col("alfabetizado")).alias("alfabetizado"),
        F.when(F.col("__ok") % 103 == 0, F.lit(1500.0)).otherwise(F.col("proficiencia")).alias("proficiencia"),
        "peso_aluno", "__ok")
    # repeated in place: the input is scanned once
    copies = F.when(F.col("__ok") % 101 == 0, F.lit(2)).otherwise(F.lit(1))
    return m.withColumn("__copy", F.explode(F.sequence(F.lit(1), copies))).drop("__ok", "__copy")
