"""Aggregations (A2, A5, A6, A9-A12) -- all partial + final hash aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def micro_rollup(micro: DataFrame, keys: Sequence[str], score: str = "proficiencia",
                 label: str = "alfabetizado", literate: str = "1") -> DataFrame:
    """A2: enrolled rows, tested rows (score not null), literate rows per key.

    ``soma_proficiencia`` (sum of scores) lets coarser levels re-derive the
    mean exactly by summing, so no level ever re-reads the micro table.
    """
    return micro.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_matric"),
        F.count(score).alias("n_prova"),
        F.count_if(F.col(label) == F.lit(literate)).alias("n_alfab"),
        F.sum(score).alias("soma_proficiencia"),
    )


def dedup_full(df: DataFrame) -> DataFrame:
    """Drop exact duplicate rows (null = null, NaN = NaN)."""
    return df.dropDuplicates()


def dedup_by_period(df: DataFrame, period: str, task_rows: int = 1_000_000, spread: int = 4) -> DataFrame:
    """A12 for a table that is written by ``period`` (a whole-number column) next: equal rows meet in the one exchange
    that also brings a period's rows together, so the write needs no other.

    The exchange has ``spread`` groups of partitions, each of one partition for every ``spread * task_rows`` rows of
    ``df`` (counted first); a period's rows stay inside one group, so its files are few and a hot period is still dealt
    to a ``spread``-th of the partitions."""
    width = max(1, -(-df.count() // (spread * task_rows)))
    # equal floating numbers may differ in their bits; the other columns place a row
    plain = [c.name for c in df.schema.fields if not isinstance(c.dataType, (T.FloatType, T.DoubleType))]
    group = F.pmod(F.coalesce(F.col(period), F.lit(0)).cast("long"), F.lit(spread))
    piece = (group * width + F.pmod(F.xxhash64(*plain), F.lit(width))).cast("int")
    return (df.withColumn("__piece", piece).repartitionById(spread * width, F.col("__piece"))
              .dropDuplicates().drop("__piece"))


def count_of_counts(df: DataFrame, key: Sequence[str] | str, count_name: str = "anos_como_orfao",
                    out_name: str = "count") -> DataFrame:
    """Rows per key, then how many keys have each row count."""
    key = [key] if isinstance(key, str) else list(key)
    return (df.groupBy(*key).agg(F.count(F.lit(1)).alias(count_name))
              .groupBy(count_name).agg(F.count(F.lit(1)).alias(out_name)))


def last_non_null(value: str, order: str) -> Column:
    """A10: value at the largest ``order`` among rows where ``value`` is not null."""
    return F.max_by(F.col(value), F.when(F.col(value).isNotNull(), F.col(order)))


def arg_max(columns: Sequence[str], value: str, tie: str) -> Column:
    """Struct of ``columns`` from the row with the largest non-null ``value``.

    Ties go to the smallest ``tie`` key (the reference takes the first row in
    file order, which is not reproducible on a cluster).
    """
    key = F.when(F.col(value).isNotNull(), F.struct((-F.col(value)).alias("v"), F.col(tie).alias("t")))
    return F.min_by(F.struct(*[F.col(c) for c in columns]), key)
