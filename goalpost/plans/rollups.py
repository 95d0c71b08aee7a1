"""A stored rollup of the micro table, one folder a period, refreshed only for the periods that were ingested again.

The rollup holds one row for each (territory, period, network); the missing-target analysis and coarser rollups read it,
so the micro table is read once for a period however often the analysis runs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from goalpost.operators.aggregate import micro_rollup
from goalpost.sources import files
from goalpost.sources.layers import WriteResult, read_layer, write_layer

KEYS = ("id_municipio", "rede")


def refresh(spark: SparkSession, micro: DataFrame, store: str, periods: Sequence | None = None,
            period: str = "ano", keys: Sequence[str] = KEYS) -> WriteResult:
    """Roll up the given periods of ``micro`` (all of them without ``periods``) into the store; other periods stay.

    ``periods`` is what an ingest reports as written (``WriteResult.partitions``): with ``micro`` partitioned by the
    period only those folders are scanned.  Exact repeats of a micro row are one row.  A period that has no row any
    more loses its folder."""
    part = micro if periods is None else micro.where(F.col(period).isin(*periods))
    result = write_layer(micro_rollup(part.dropDuplicates(), [*keys, period]), store, period, dynamic=periods is not None)
    for gone in set(map(str, periods or ())) - set(map(str, result.partitions)):
        files.remove(spark, f"{store}/{period}={gone}")
    return result


def read(spark: SparkSession, store: str) -> DataFrame:
    return read_layer(spark, store)
