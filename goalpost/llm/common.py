"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import goalpost
from goalpost.session import fresh_path


def _workers_find_package(spark: SparkSession) -> None:
    """Python workers look for this package where the driver found it; a cluster may ship it with --py-files."""
    home = os.path.dirname(os.path.dirname(os.path.abspath(goalpost.__file__)))
    spark.sparkContext.environment.setdefault("PYTHONPATH", home)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    _workers_find_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def saved(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """``df`` written once to the shared folder (``spark.checkpoint.dir``) and read back; without ``compression`` by the
    session's codec.

    Later stages read files that every executor sees, so a lost executor costs only its own tasks."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id's decimal text, modulo ``folds``; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


def held_out(doc_id: Column, folds: int, which: int) -> Column:
    """True for rows no model may learn from.  A null id is in no fold (false) and joins no label."""
    return F.coalesce(fold(doc_id, folds) == which, F.lit(False))


def id_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the two columns an operator reads: extra columns cannot clash with working columns."""
    return docs.select(docs[f"`{id_col}`"].alias("doc_id"), docs[f"`{text_col}`"].alias("text"))


def slices(texts: pa.Array, max_chars: int = 1 << 20) -> Iterator[tuple[int, list[str]]]:
    """(start, texts) pieces of one Arrow column, each of about ``max_chars`` characters or one text; null is ''."""
    start, held, size = 0, [], 0
    for i, t in enumerate(texts):
        s = t.as_py() or ""
        held.append(s)
        size += len(s)
        if size >= max_chars:
            yield start, held
            start, held, size = i + 1, [], 0
    if held:
        yield start, held


def broadcast_if_small(df: DataFrame, rows: int = 200_000) -> DataFrame:
    """``df`` (a written, narrow table) marked for broadcast if it has at most ``rows`` rows; else joined by shuffle."""
    return F.broadcast(df) if df.count() <= rows else df
