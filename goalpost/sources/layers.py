"""Layered Parquet storage.

A layer table is a Parquet directory, optionally Hive-partitioned by period.
Writes never silently lose rows: rows whose partition value is null are
dropped (as the reference does) but counted and returned.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from goalpost.session import fresh_path
from goalpost.sources import files, snapshots

#: Least pieces that a clustered write deals its rows to before they are joined again.
CLUSTER_PIECES = 128

#: Folder value of rows without a period (Spark's name for it).
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


@dataclass(frozen=True)
class WriteResult:
    path: str
    rows: int
    dropped_null_partition: int = 0
    partitions: tuple = ()      # sorted distinct values written (single partition column)


def read_layer(spark: SparkSession, path: str, schema: StructType | None = None,
               base_path: str | None = None) -> DataFrame:
    """Scan of a table folder (its published version, if it has versions) with partition discovery and an
    optional declared schema."""
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    if base_path:
        reader = reader.option("basePath", base_path)
    return reader.parquet(snapshots.current(spark, path) or path)


def _folder_files(spark: SparkSession, path: str, column: str) -> dict[str, set[str]]:
    """Data files by value folder of the partition column."""
    out: dict[str, set[str]] = {}
    for name in files.data_files(spark, path):
        folder, _, rest = name.partition("/")
        if folder.startswith(f"{column}="):
            out.setdefault(folder.split("=", 1)[1], set()).add(rest)
    return out


def _values(spark: SparkSession, df: DataFrame, column: str, folders) -> tuple:
    """Folder names as values of the column's type, sorted."""
    kept = [f for f in folders if f != NO_VALUE]
    if not kept:
        return ()
    typed = spark.createDataFrame([(unquote(f),) for f in kept], "v string").select(F.col("v").cast(df.schema[column].dataType))
    return tuple(r[0] for r in typed.orderBy("v").collect())


def write_layer(df: DataFrame, path: str, partition_by: str | Sequence[str] | None = None,
                mode: str = "overwrite", dynamic: bool = False, cluster: bool = True,
                keep_null_partition: bool = False) -> WriteResult:
    """One write that also reports its row counts (via ``Observation``).

    ``dynamic=True`` replaces only the partitions present in ``df`` (S4, re-ingest of one period); the default static
    overwrite replaces the table.  ``cluster`` brings the rows of a period together first, so that a period is few
    files; Spark's adaptive execution splits a period beyond ``advisoryPartitionSizeInBytes`` over several tasks and
    joins small ones, so a hot period is no single task.  Without it every task writes a file for each of its periods.
    """
    spark = df.sparkSession
    parts = [partition_by] if isinstance(partition_by, str) else list(partition_by or [])
    obs = Observation()
    before: dict[str, set[str]] = {}
    if parts:
        null_part = F.lit(False)
        for p in parts:
            null_part = null_part | F.col(p).isNull()
        if cluster:
            # many small pieces, which adaptive execution joins: periods seldom share one, so a hot one splits alone
            df = df.hint("rebalance", max(CLUSTER_PIECES, int(spark.conf.get("spark.sql.shuffle.partitions"))), *parts)
        # observed above the exchange: below it, an empty input would take the observation away with it
        df = df.observe(obs, F.count(F.lit(1)).alias("rows"), F.count_if(null_part).alias("dropped"))
        if not keep_null_partition:
            df = df.filter(~null_part)
        if dynamic and len(parts) == 1:
            before = _folder_files(spark, path, parts[0])
    else:
        df = df.observe(obs, F.count(F.lit(1)).alias("rows"), F.lit(0).alias("dropped"))
    writer = df.write.mode(mode)
    if dynamic:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    if parts:
        writer = writer.partitionBy(*parts)
    writer.parquet(path)
    got = obs.get
    rows, dropped = int(got.get("rows", 0)), int(got.get("dropped", 0))
    # The folders whose files are new are the values written (names only, no pass over the rows)
    new = [v for v, names in (_folder_files(spark, path, parts[0]) if len(parts) == 1 else {}).items()
           if names - before.get(v, set())]
    return WriteResult(path, rows - dropped, dropped, _values(spark, df, parts[0], new) if new else ())


def publish_layer(df: DataFrame, path: str, partition_by: str | Sequence[str] | None = None, audit=None,
                  cluster: bool = True) -> WriteResult:
    """Q6: write a new version of the table, audit what was written, publish it (see ``snapshots``).  ``cluster=False``
    is for rows that are brought together by period already (see ``write_layer``).

    ``df`` is computed once: the audit reads the written columns it needs.  The audit sees rows with a null period too;
    if it lets them pass, their folder is removed before the version is published, and they are counted as dropped."""
    spark = df.sparkSession

    def write(folder: str) -> WriteResult:
        return write_layer(df, folder, partition_by, cluster=cluster, keep_null_partition=True)

    def drop_null_period(folder: str) -> None:
        for name, is_folder in files.children(spark, folder):
            if is_folder and name.endswith(f"={NO_VALUE}"):
                files.remove(spark, f"{folder}/{name}")

    return snapshots.write_audited(spark, path, write, audit, drop_null_period, df.schema)


def materialize(df: DataFrame, name: str, partition_by: str | Sequence[str] | None = None) -> DataFrame:
    """Write ``df`` to a fresh table in the shared folder and read it back.

    Cuts the lineage so later multi-pass operators (sampling, size checks)
    re-read a file instead of recomputing the upstream plan.
    """
    path = fresh_path(df.sparkSession, name)
    write_layer(df, path, partition_by)
    return df.sparkSession.read.parquet(path)


def read_all(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Bag union of several tables by column name; missing columns become null.

    Like the reference, a table folder without any Parquet file is an error
    (Spark alone only fails on a missing path).
    """
    if not paths:
        raise FileNotFoundError("no input table")
    for p in paths:
        require_files(spark, p)
    frames = [spark.read.parquet(p) for p in paths]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def union_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    """U1 on DataFrames."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def require_files(spark: SparkSession, path: str) -> None:
    """The reference errors on an empty table folder; Spark only on a missing one.  Any file system."""
    if next(files.data_files(spark, path), None) is None:
        raise FileNotFoundError(f"no data file under {path}")


def read_files(spark: SparkSession, path: str, partition_columns: Sequence[str] = ()) -> DataFrame:
    """Every Parquet file below ``path``, whatever the folders between: schemas merged by name, and each partition
    column taken from the file where the file holds it, else from its ``column=value`` folder (digits become integers,
    other values strings), else null.  An empty or missing folder is an error, on any file system.

    Spark's own partition discovery lets the folder win and refuses folders of different depth."""
    path = snapshots.current(spark, path) or path
    require_files(spark, path)
    df = spark.read.option("mergeSchema", "true").option("recursiveFileLookup", "true").parquet(path)
    where = F.col("_metadata.file_path")
    out = df
    plain = lambda t: F.try_url_decode(F.replace(t, F.lit("+"), F.lit("%2B")))
    for c in partition_columns:
        text = F.regexp_extract(where, f"/{re.escape(c)}=([^/]+)/", 1)
        # written once as a folder name, and once more as part of an address
        once = plain(text)
        text = F.when((text != "") & (text != NO_VALUE), F.coalesce(plain(once), once))
        if c in df.columns:
            out = out.withColumn(c, F.coalesce(F.col(c), text.try_cast(df.schema[c].dataType)))
        else:
            values = {m.group(1) for n in files.data_files(spark, path) if (m := re.search(f"(?:^|/){re.escape(c)}=([^/]+)/", n))}
            whole = bool(values) and all(v.isdigit() for v in values - {NO_VALUE})
            out = out.withColumn(c, text.cast("int") if whole else text)
    return out


def profile(df: DataFrame, parent: str = "sigla_uf",
            preview: Sequence[str] = ("id_municipio", "nome", "sigla_uf", "rede", "rede_desc",
                                      "taxa_alfabetizacao"),
            order_by: Sequence[str] | None = None, n: int = 5) -> tuple[DataFrame, DataFrame]:
    """(one-row counts, preview).  The parent-null count only when the column exists;
    the preview keeps the wanted columns that exist, ordered by key so it is reproducible."""
    counts = [F.count(F.lit(1)).alias("total_linhas")]
    if parent in df.columns:
        counts.append(F.count_if(F.col(parent).isNull()).alias("linhas_sem_pai"))
    cols = [c for c in preview if c in df.columns]
    keys = list(order_by) if order_by else cols
    return df.agg(*counts), df.orderBy(*keys).select(*cols).limit(n)
