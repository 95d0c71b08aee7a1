"""Write, audit, publish: a table's new version is written beside the old one and read only after it passed its checks.

A version is a folder ``version-<id>`` inside the table's folder.  What readers see is named by the last note in
``_published``: notes are new, numbered files, never changed, so publishing is the creation of one small file (no
rename, no copy) and a reader sees the old version or the new one, whole.  A version that fails its checks is removed
and was never visible.  Two writers that publish at once get different numbers; the later one stands.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from goalpost.sources import files

#: Versions kept for readers that started before the last publication.
KEPT = 2


def _notes(spark: SparkSession, table: str) -> list[tuple[int, str]]:
    """(number, version) of every whole note, oldest first; a note still being written has no end of line."""
    found = []
    for name, folder in files.children(spark, f"{table}/_published"):
        if not folder and name.isdigit():
            text = files.read_note(spark, f"{table}/_published/{name}")
            if text.endswith("\n"):
                found.append((int(name), text.strip()))
    return sorted(found)


def current(spark: SparkSession, table: str) -> str | None:
    """Folder of the published version; None for a table without versions."""
    notes = _notes(spark, table.rstrip("/"))
    return f"{table.rstrip('/')}/{notes[-1][1]}" if notes else None


def publish(spark: SparkSession, table: str, version: str) -> None:
    """Make ``version`` the one that readers see, and remove versions older than the last ``KEPT``."""
    number = max([n for n, _ in _notes(spark, table)], default=0) + 1
    while not files.write_note(spark, f"{table}/_published/{number:012d}", version + "\n"):
        number += 1
    notes = _notes(spark, table)
    for n, old in notes[:-KEPT]:
        if old not in {v for _, v in notes[-KEPT:]}:
            files.remove(spark, f"{table}/{old}")
        files.remove(spark, f"{table}/_published/{n:012d}")


def write_audited(spark: SparkSession, table: str, write: Callable[[str], object],
                  audit: Callable[[DataFrame], object] | None = None, finish: Callable[[str], object] | None = None,
                  schema: StructType | None = None):
    """``write(folder)`` a new version, ``audit`` the written rows, ``finish(folder)``, publish.  What ``write`` returned
    is returned; an exception of any leaves the published version as it was."""
    table = table.rstrip("/")
    version = f"version-{uuid.uuid4().hex}"
    folder = f"{table}/{version}"
    try:
        result = write(folder)
        if audit is not None:
            audit((spark.read.schema(schema) if schema else spark.read).parquet(folder))
        if finish is not None:
            finish(folder)
    except BaseException:
        files.remove(spark, folder)
        if not files.children(spark, table):
            files.remove(spark, table)
        raise
    publish(spark, table, version)
    return result
