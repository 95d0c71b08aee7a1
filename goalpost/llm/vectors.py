"""Integer vectors shared by the exact vector operators: reading, checking and packing them."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goalpost.llm.common import saved

#: Place of a row without an id among ties: after every other.
NO_ID = np.iinfo(np.int64).max
LEAST_BLOCK, MOST_BLOCK = 2048, 65536


def block_rows(rows: int) -> int:
    """Rows that one task holds at a time: it grows with the root of the table, so that what each side of a search is
    copied for stays in balance, and is bounded."""
    return min(MOST_BLOCK, max(LEAST_BLOCK, 16 * math.isqrt(max(rows, 0))))


def usable(vec: Column) -> Column:
    """True for a vector that is not null and holds only finite components."""
    bad = F.exists(vec, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    return vec.isNotNull() & ~bad


def quantised(rows: DataFrame, name: str, id_col: str = "vec_id", vec_col: str = "embedding", scale: int = 256,
              **extra: Column) -> DataFrame:
    """(row, id, *extra, x) of every row with a usable vector, written once: ``row`` names the row itself, so rows that
    repeat an id stay apart, and ``x`` holds floor(scale * component)."""
    vec = rows[f"`{vec_col}`"]
    kept = rows.where(usable(vec)).select(
        F.monotonically_increasing_id().alias("row"), rows[f"`{id_col}`"].cast("long").alias("id"),
        *[c.alias(k) for k, c in extra.items()],
        F.transform(vec, lambda v: F.floor(v.cast("double") * F.lit(scale)).cast("long")).alias("x"))
    return saved(kept, name)


def extent(vectors: DataFrame) -> tuple[int, int, int, int]:
    """(rows, longest length, least component, greatest component); zeros for no rows."""
    r = vectors.agg(F.count(F.lit(1)), F.max(F.size("x")), F.min(F.array_min("x")), F.max(F.array_max("x"))).first()
    return tuple(v or 0 for v in r)


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """A list column as an int64 matrix; a vector shorter than ``width`` ends in zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False)
    length = np.diff(column.offsets.to_numpy())
    if len(length) and (length == width).all():
        return flat.reshape(len(length), width)
    out = np.zeros((len(length), width), np.int64)
    out[np.arange(width) < length[:, None]] = flat
    return out


def ids_of(column: pa.Array) -> np.ndarray:
    """Ids as int64, ``NO_ID`` for null."""
    return column.fill_null(int(NO_ID)).to_numpy(zero_copy_only=False)


def best_places(score: np.ndarray, ids: np.ndarray, rows: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` best: higher score first, then smaller id, then smaller row."""
    if len(score) > 4 * k:
        floor = np.partition(score, len(score) - k)[len(score) - k]
        at = np.flatnonzero(score >= floor)
    else:
        at = np.arange(len(score))
    return at[np.lexsort((rows[at], ids[at], -score[at]))[:k]]
