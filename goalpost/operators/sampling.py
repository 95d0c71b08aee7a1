"""Seeded uniform sample of exactly ``min(n, rows)`` rows.

Ordering by a seeded hash of the row key (MD5 of ``key || ':' || seed``, hex)
and taking the first ``n`` is a uniform sample without replacement that is
reproducible on a cluster and in any SQL engine with ``md5`` (Spark plans it
as a per-partition top-n, then one merge of n rows per partition -- no full
sort, nothing unbounded on one task).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def sample_exact(df: DataFrame, n: int, key: str, seed: int = 42) -> DataFrame:
    h = F.md5(F.concat(F.col(key).cast("string"), F.lit(f":{seed}")))
    return df.orderBy(h, F.col(key)).limit(n)
