"""Files of a table on any file system Spark reaches, through Hadoop's FileSystem (driver side: names and small notes only)."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _at(spark, path)
    return fs.exists(p)


def children(spark: SparkSession, path: str) -> list[tuple[str, bool]]:
    """(name, is a folder) of what lies directly in ``path``; nothing if it is not there."""
    fs, p = _at(spark, path)
    if not fs.exists(p):
        return []
    return sorted((s.getPath().getName(), s.isDirectory()) for s in fs.listStatus(p))


def data_files(spark: SparkSession, path: str) -> Iterator[str]:
    """Names below ``path`` of the files a table scan reads: no part of the name starts with ``_`` or ``.``."""
    stack = [""]
    while stack:
        at = stack.pop()
        for name, folder in children(spark, f"{path}/{at}" if at else path):
            if name.startswith(("_", ".")):
                continue
            if folder:
                stack.append(f"{at}{name}/")
            else:
                yield f"{at}{name}"


def remove(spark: SparkSession, path: str) -> None:
    fs, p = _at(spark, path)
    fs.delete(p, True)


def write_note(spark: SparkSession, path: str, text: str) -> bool:
    """Create a small new file; False if one of that name is there already (it is left as it is)."""
    fs, p = _at(spark, path)
    if fs.exists(p):
        return False
    try:
        out = fs.create(p, False)
    except Exception:       # another writer was first
        if fs.exists(p):
            return False
        raise
    out.write(bytearray(text.encode()))
    out.close()
    return True


def read_note(spark: SparkSession, path: str) -> str:
    fs, p = _at(spark, path)
    size = int(fs.getFileStatus(p).getLen())
    if not size:
        return ""
    stream = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
