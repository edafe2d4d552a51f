"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import gc
import os

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerspark.session import fresh_path

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

#: Arrow's own allocator, and the system's with its defaults, keep tens of
#: megabytes of freed blocks in each worker; so large ones go back at once
WORKER_MEMORY = {"ARROW_DEFAULT_MEMORY_POOL": "system", "MALLOC_MMAP_THRESHOLD_": str(1 << 20)}


def ready() -> None:
    """Lets Python workers look for this package where the driver found it (on
    a cluster it is installed, or shipped with --py-files) and settles how they
    take memory.  Every operator that runs Python calls it; what is set already
    stays."""
    spark = SparkSession.getActiveSession()
    if spark is not None:
        for name, value in {"PYTHONPATH": ROOT, **WORKER_MEMORY}.items():
            spark.sparkContext.environment.setdefault(name, value)


def give_back() -> None:
    """Hands memory that this Python worker no longer uses back to the system.

    A worker serves many tasks, one after the other, and what its allocators
    keep counts against the executor's memory."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library: nothing to trim
        pass


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables.

    Texts can be long, so Python workers are sent a thousand rows at a time
    instead of ten thousand, unless the session says otherwise.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(key) == "10000":
        spark.conf.set(key, "1000")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: bytes of values that a stored file is to have at least
FILE_BYTES = 4 << 20


def files_for(spark: SparkSession, size: int) -> int:
    """Into how many files ``size`` bytes go: one for each core, more from
    ``FILE_BYTES`` a core on."""
    return max(spark.sparkContext.defaultParallelism, -(-int(size) // FILE_BYTES))


def stored(df: DataFrame, kind: str, size: int | None = None) -> DataFrame:
    """``df`` written once to the shared folder and read back.

    Cuts the lineage, so a lost executor costs a re-read and nothing is
    computed twice.  ``size``: an upper bound of its bytes, where known; a
    small frame is then not written as one file for each shuffle partition.
    (Every file costs a task, and Hadoop without its native library starts a
    ``chmod`` process for each.)
    """
    path = fresh_path(df.sparkSession, kind)
    if size is not None:
        df = df.coalesce(files_for(df.sparkSession, size))
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stored_by(df: DataFrame, kind: str, column: str, values: list[int]) -> dict[int, DataFrame]:
    """``df`` written once, a folder for each value of ``column``; the rows of
    each of ``values`` as a frame of its own (without the column)."""
    spark = df.sparkSession
    path = fresh_path(spark, kind)
    df.write.partitionBy(column).parquet(path)
    schema = df.drop(column).schema
    out = {}
    for v in values:
        folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{column}={v}")
        there = folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)
        out[v] = spark.read.schema(schema).parquet(folder.toString()) if there else spark.createDataFrame([], schema)
    return out


def discard(df: DataFrame) -> None:
    """Deletes the files of a stored frame that nothing reads any more, and
    lets Spark drop the shuffle files of plans that are gone (it does so when
    the driver collects garbage)."""
    spark = df.sparkSession
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(conf).delete(path, True)
    jvm.System.gc()


#: measured bytes up to which one side of a join is sent to every task
BROADCAST_BYTES = 8 << 20


def data_bytes(df: DataFrame) -> int:
    """The size of a stored frame's values: strings and binaries by length,
    arrays by elements, everything else 16 bytes, and 32 bytes a row."""
    size = F.lit(32)
    for f in df.schema.fields:
        kind = f.dataType.typeName()
        if kind in ("string", "binary"):
            size += F.coalesce(F.octet_length(f.name), F.lit(0))
        elif kind == "array":
            size += 16 * F.greatest(F.size(f.name), F.lit(1))
        else:
            size += F.lit(16)
    return df.agg(F.sum(size.cast("long"))).first()[0] or 0


def broadcast_if_small(df: DataFrame) -> DataFrame:
    """A stored frame, marked for broadcasting if its measured size allows."""
    return F.broadcast(df) if data_bytes(df) <= BROADCAST_BYTES else df


def whole_numbers(spark: SparkSession, rows: list[tuple[int, ...]], names: list[str]) -> DataFrame:
    """A few rows of whole numbers as a frame.  They go as Arrow: rows of
    Python objects would start workers of another kind on the executors."""
    columns = np.array(rows, np.int64).reshape(-1, len(names)).T
    return spark.createDataFrame(pa.table([pa.array(c) for c in columns], names=names))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_of(col: str = "text") -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def crc_mod(col: str, mod: int) -> Column:
    """crc32 of the value's decimal text, modulo ``mod`` (null id: its text is
    empty)."""
    return F.crc32(F.coalesce(F.col(col).cast("string"), F.lit("")).cast("binary")) % F.lit(mod)


def row_key() -> Column:
    """64 bits that stand for a row's doc_id and text."""
    return F.xxhash64(F.col("doc_id").cast("long"), text_of())
