"""Small files next to tables, on whatever storage Spark reads (Hadoop paths)."""

from __future__ import annotations

import json

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def names(spark: SparkSession, folder: str) -> list[str]:
    """The names in a folder (none if there is no folder), in order."""
    fs, p = _fs(spark, folder)
    if not fs.exists(p):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(p))


def delete(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.delete(p, True)


def create_json(spark: SparkSession, path: str, value) -> bool:
    """Writes a new file, whole or not at all; False if it exists already.

    The content goes to a name of its own first.  ``rename`` does not replace
    a file on the storages Spark ships with, so of two writers one wins.
    """
    fs, p = _fs(spark, path)
    if fs.exists(p):
        return False
    jvm = spark.sparkContext._jvm
    part = jvm.org.apache.hadoop.fs.Path(p.getParent(), f".{p.getName()}.{jvm.java.util.UUID.randomUUID()}")
    out = fs.create(part, False)
    try:
        out.write(json.dumps(value, sort_keys=True).encode())
    finally:
        out.close()
    try:
        won = not fs.exists(p) and fs.rename(part, p)
    except Exception:  # some storages raise where others return false
        if not fs.exists(p):
            raise
        won = False
    if not won:
        fs.delete(part, False)
    return won


def read_json(spark: SparkSession, path: str):
    fs, p = _fs(spark, path)
    jvm = spark.sparkContext._jvm
    source = fs.open(p)
    try:
        return json.loads(bytes(jvm.org.apache.commons.io.IOUtils.toByteArray(source)).decode())
    finally:
        source.close()
