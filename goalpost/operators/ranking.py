"""Rank inside a parent group and previous-period values.

``row_number_within`` is exact ``row_number() OVER (PARTITION BY g ORDER BY o)``
without sending a whole group to one task: the rows are range-partitioned on
``(g, o)`` so a hot group spans many partitions; each row gets its place inside
its partition from ``monotonically_increasing_id`` (rows are sorted there;
the tagged rows are written once to the shared folder), and
the count of the same group's rows in earlier partitions comes from a tiny
per-(partition, group) table.  Only that table -- at most one row per group
and partition -- is windowed and joined back.

The order must be total (end it with a unique key), as the reference's
arbitrary tie order is replaced by a reproducible one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from goalpost.operators.joins import DEFAULT_BROADCAST_ROWS, maybe_broadcast
from goalpost.sources.layers import materialize


def row_number_within(df: DataFrame, group: Sequence[str], order: Sequence[Column], name: str,
                      num_partitions: int | None = None,
                      max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    group = list(group)
    n = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.col(c).asc_nulls_first() for c in group] + list(order)
    # Written once: range bounds come from a sample seeded per evaluation, so
    # the ids must be fixed in a table both branches below read.
    tagged = materialize(df.repartitionByRange(n, *keys)
                           .sortWithinPartitions(*keys)
                           .withColumn("__pid", F.spark_partition_id())
                           .withColumn("__mid", F.monotonically_increasing_id()), "rank-input")
    earlier = Window.partitionBy(*group).orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    starts = (tagged.groupBy("__pid", *group)
                    .agg(F.count(F.lit(1)).alias("__cnt"), F.min("__mid").alias("__first"))
                    .withColumn("__before", F.coalesce(F.sum("__cnt").over(earlier), F.lit(0)))
                    .drop("__cnt"))
    # null-safe on the group keys: a null parent is one group, as in a window
    starts = starts.select(*[F.col(c).alias(f"__g_{c}") for c in group],
                           F.col("__pid").alias("__spid"), "__first", "__before")
    cond = F.col("__pid") == F.col("__spid")
    for c in group:
        cond = cond & F.col(c).eqNullSafe(F.col(f"__g_{c}"))
    joined = tagged.join(maybe_broadcast(starts, max_broadcast_rows), cond, "inner")
    # bigint: a hot group can hold more than 2^31 rows at scale
    return (joined.withColumn(name, (F.col("__mid") - F.col("__first") + F.col("__before") + 1).cast("long"))
                  .select(*df.columns, name))


def row_number_window(df: DataFrame, group: Sequence[str], order: Sequence[Column], name: str) -> DataFrame:
    """Plain window version, for groups known to be bounded (and as a test oracle)."""
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*group).orderBy(*order)))


def previous_value(df: DataFrame, entity: Sequence[str], period: str, value: str,
                   prev_name: str, delta_name: str | None = None, scale: int = 2) -> DataFrame:
    """Value of the previous *available* period of the same entity and the delta.

    A group here is one entity's periods (bounded by the number of periods),
    so a plain window is safe.
    """
    w = Window.partitionBy(*entity).orderBy(F.col(period).asc())
    out = df.withColumn(prev_name, F.lag(value).over(w))
    if delta_name:
        out = out.withColumn(delta_name, F.round(F.col(value) - F.col(prev_name), scale))
    return out
