"""Registry-driven ingest into the Bronze layer.

A source is ``name -> loader(spark) -> DataFrame`` plus an optional period
column.  Executors read and write; the driver never holds a table.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from goalpost.sources.layers import WriteResult, write_layer

log = logging.getLogger("goalpost.ingest")


@dataclass(frozen=True)
class Source:
    name: str
    loader: Callable[[SparkSession], DataFrame]
    partition: str | None = "ano"


def select_sources(sources: Sequence[Source], only: Sequence[str] | None) -> list[Source]:
    """Keep the named sources; unknown names beside a known one are ignored,
    no match at all logs the valid names and selects nothing."""
    if not only:
        return list(sources)
    chosen = [s for s in sources if s.name in set(only)]
    if not chosen:
        log.error("no source matches %s; valid: %s", list(only), [s.name for s in sources])
    return chosen


def ingest_source(spark: SparkSession, source: Source, base: str, dynamic: bool = True) -> WriteResult:
    """Full read of one source, written per period (null periods dropped and counted).

    Only the periods that the source holds are replaced; ``dynamic=False`` replaces the whole table.
    """
    df = source.loader(spark)
    path = f"{base.rstrip('/')}/{source.name}"
    result = write_layer(df, path, source.partition, dynamic=dynamic and source.partition is not None)
    if result.dropped_null_partition:
        log.warning("%s: %d rows with null %s not written", source.name,
                    result.dropped_null_partition, source.partition)
    return result


def ingest(spark: SparkSession, sources: Sequence[Source], base: str,
           only: Sequence[str] | None = None, dynamic: bool = True) -> dict[str, WriteResult]:
    """Sources in order; the first failure is re-raised, earlier outputs stay written."""
    done: dict[str, WriteResult] = {}
    for s in select_sources(sources, only):
        try:
            done[s.name] = ingest_source(spark, s, base, dynamic)
        except Exception:
            log.error("ingest of %s failed", s.name)
            raise
    return done
