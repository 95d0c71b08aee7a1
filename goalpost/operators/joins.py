"""Joins with a size-checked broadcast and a skew-proof way beyond it.

Policy: an explicit ``broadcast`` hint is used only where a huge side would
otherwise be shuffled to meet a small one (dimension lookups, rank offsets),
and only after one distributed aggregate proves the small side has at most
``max_rows`` rows and ``max_bytes`` bytes.  Beyond the bound a lookup is a
shuffle join whose hot keys and null keys are spread over many tasks
(``salted_lookup``).  Everywhere else Spark decides from its size estimate
(``autoBroadcastJoinThreshold``) and AQE re-plans from the real shuffle sizes
at run time.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A directory / target row is ~100 bytes: 1M rows stays well under 200 MB.
DEFAULT_BROADCAST_ROWS, DEFAULT_BROADCAST_BYTES = 1_000_000, 200 << 20

#: Keys the sketch may name as hot, its counters, and tasks that a key with all of the rows is spread over.
HOT_KEYS, SKETCH, MOST_SALTS = 256, 4096, 1024


def _row_bytes(df: DataFrame) -> Column:
    """About the bytes of a row: 8 for a number, the text's length for a string, the JSON's for anything nested."""
    def one(f: T.StructField) -> Column:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            return F.coalesce(F.octet_length(c), F.lit(0)) + 8
        if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            return F.coalesce(F.octet_length(F.to_json(c)), F.lit(0)) + 8
        return F.lit(8)
    return reduce(lambda a, b: a + b, [one(f) for f in df.schema.fields], F.lit(8)).cast("long")


def has_at_most(df: DataFrame, max_rows: int, max_bytes: int = DEFAULT_BROADCAST_BYTES) -> bool:
    """True when ``df`` has at most ``max_rows`` rows of about ``max_bytes`` bytes together.

    A plain distributed aggregate (partial per partition, one tiny merge): ``limit(n + 1).count()`` would look cheaper
    but plans a ``SinglePartition`` exchange above the per-partition limits, funnelling up to every row of a huge side
    through one task."""
    r = df.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(_row_bytes(df)), F.lit(0)).alias("b")).first()
    return r["n"] <= max_rows and r["b"] <= max_bytes


def maybe_broadcast(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """``broadcast(df)`` when its size is proven to be within the bounds, else ``df``."""
    return F.broadcast(df) if max_rows > 0 and has_at_most(df, max_rows) else df


def _keys(on: str | Sequence[str]) -> list[str]:
    return [on] if isinstance(on, str) else list(on)


def lookup(fact: DataFrame, dim: DataFrame, on: str | Sequence[str], how: str = "left",
           max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Dimension lookup (J1): ``fact ⟕ dim`` on equal keys; unmatched rows keep null attributes."""
    if max_broadcast_rows > 0 and has_at_most(dim, max_broadcast_rows):
        return fact.join(F.broadcast(dim), _keys(on), how)
    return salted_lookup(fact, dim, on, how)


def hot_keys(df: DataFrame, on: str | Sequence[str], share: float) -> dict[int, float]:
    """Hash of every key that may hold at least ``share`` of the rows of ``df``, and the share: from one pass of a bounded
    frequent-items sketch over the key columns.  Null keys are left out.  At most ``HOT_KEYS`` entries."""
    on = _keys(on)
    key = F.xxhash64(*on)
    known = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in on])
    r = df.where(known).select(key.alias("k")).agg(
        F.count(F.lit(1)).alias("n"), F.expr(f"approx_top_k(k, {HOT_KEYS}, {SKETCH})").alias("top")).first()
    return {t["item"]: t["count"] / r["n"] for t in r["top"] or () if t["count"] >= share * r["n"]} if r["n"] else {}


def salted_lookup(fact: DataFrame, dim: DataFrame, on: str | Sequence[str], how: str = "left",
                  share: float | None = None) -> DataFrame:
    """``fact`` joined to a large ``dim`` in one shuffle that no key overfills.

    Keys with ``share`` of the fact's rows or more (by default a quarter of an even partition's) are spread over as many
    salts as even partitions they would fill; the dimension's rows of those keys, few, are repeated for each salt.  Null
    keys match nothing and are spread too.  The salt comes from the row's columns and its task, so a task that runs
    again gives the same, and equal rows from different tasks part."""
    on = _keys(on)
    if how not in ("left", "inner"):
        raise ValueError("a salted lookup keeps the fact side: left or inner")
    parts = int(fact.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    share = 0.25 / parts if share is None else share
    hot = hot_keys(fact, on, share)
    spread = {k: min(MOST_SALTS, max(2, round(s / share))) for k, s in hot.items()}
    key = F.xxhash64(*on)
    null_key = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in on])
    salts = F.coalesce(F.create_map(*[F.lit(x) for kv in spread.items() for x in kv])[key], F.lit(1)) if spread else F.lit(1)
    row = F.xxhash64(*[F.col(f"`{f.name}`") for f in fact.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))],
                     F.spark_partition_id())
    a = fact.withColumn("__salt", F.when(null_key, F.pmod(row, F.lit(max(parts, 2))))
                                   .otherwise(F.pmod(row, salts)).cast("int"))
    # equal keys must have equal hashes on both sides
    dim = dim.withColumns({c: F.col(c).try_cast(fact.schema[c].dataType) for c in on
                           if fact.schema[c].dataType != dim.schema[c].dataType})
    b = dim.withColumn("__salt", F.explode(F.sequence(F.lit(0), (salts - 1).cast("int"))))
    return a.join(b, [*on, "__salt"], how).drop("__salt")


def existence_flag(df: DataFrame, keys: DataFrame, on: Sequence[str], flag: str = "orfao") -> DataFrame:
    """Keep every row of ``df`` and add ``flag = key absent from keys`` (boolean).

    ``keys`` is reduced to its distinct key tuples first, so the left join
    never fans out; its size is left to Spark's threshold / AQE.
    """
    on = list(on)
    marker = keys.select(*on).distinct().withColumn("__has", F.lit(1))
    return (df.join(marker, on, "left")
              .withColumn(flag, F.col("__has").isNull())
              .drop("__has"))


def integrate(indicator: DataFrame, target: DataFrame, on: Sequence[str], how: str = "left") -> DataFrame:
    """Indicator ⟕ target on (territory, period).  Missing targets stay null.

    The caller checks that ``target`` is unique on ``on`` (see
    ``quality.duplicates``), so this join cannot multiply rows.  Both sides
    grow with the data, so no broadcast is forced; Spark/AQE choose.
    """
    return indicator.join(target, list(on), how)
