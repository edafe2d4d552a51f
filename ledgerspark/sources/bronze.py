"""Bronze tables: namespaces, create-or-append, batch ingest of one topic."""

from __future__ import annotations

import logging
import threading
import uuid
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerspark.sources.catalog import table_exists
from ledgerspark.sources.compaction import BATCH_COLUMN, is_merged
from ledgerspark.sources.kafka import parse_records, read_kafka
from ledgerspark.sources.schemas import NAMESPACES, Topic, select_topics, topic

log = logging.getLogger(__name__)

# Table properties of the bronze layer.
ICEBERG_PROPERTIES = {
    "format-version": "2",
    "write.format.default": "parquet",
    "write.parquet.compression-codec": "snappy",
}


def create_namespaces(
    spark: SparkSession, catalog: str | None = None, location: str | None = None, extra: tuple[str, ...] = ()
) -> None:
    """``bronze``, ``silver``, ``gold`` and ``extra``; with ``location``, each under it."""
    prefix = f"{catalog}." if catalog else ""
    for ns in dict.fromkeys((*NAMESPACES, *extra)):
        loc = f" LOCATION '{location.rstrip('/')}/{ns}.db'" if location else ""
        spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {prefix}{ns}{loc}")


def has_file_log(spark: SparkSession, table: str) -> bool:
    """Whether a file stream sink keeps the list of the table's files.

    Readers of such a table see the listed files only, so rows that a batch
    job appends would be invisible.
    """
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'").collect()
    if not rows:
        return False
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(rows[0]["data_type"], "_spark_metadata")
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)


def create_bronze(spark: SparkSession, schema: StructType, table: str, fmt: str = "parquet", path: str | None = None) -> None:
    """An empty bronze table in a file format, unless it exists.

    Its one partition column names the batch that wrote a row, so that a
    repeated batch can replace its own rows and nothing else.
    """
    empty = spark.createDataFrame([], schema.add(BATCH_COLUMN, "string") if BATCH_COLUMN not in schema.names else schema)
    w = empty.write.format(fmt).mode("ignore").partitionBy(BATCH_COLUMN)
    (w.option("path", path) if path else w).saveAsTable(table)


OVERWRITE_MODE = "spark.sql.sources.partitionOverwriteMode"
_lock = threading.Lock()
_writers: dict[int, tuple[int, str]] = {}  # session -> writers at work, mode before them


@contextmanager
def dynamic_overwrite(spark: SparkSession):
    """An overwrite replaces the partitions it has rows for, and no others.

    Several threads may write at a time: the first sets the session's mode,
    the last restores it."""
    key = id(spark._jsparkSession)
    with _lock:
        n, before = _writers.get(key, (0, spark.conf.get(OVERWRITE_MODE)))
        _writers[key] = (n + 1, before)
        spark.conf.set(OVERWRITE_MODE, "dynamic")
    try:
        yield
    finally:
        with _lock:
            n, before = _writers[key]
            if n > 1:
                _writers[key] = (n - 1, before)
            else:
                del _writers[key]
                spark.conf.set(OVERWRITE_MODE, before)


def append_bronze(
    df: DataFrame,
    table: str,
    fmt: str = "parquet",
    path: str | None = None,
    properties: dict[str, str] | None = None,
    batch: str | None = None,
) -> None:
    """Create the table from ``df`` if missing, else append to it.

    Running it twice on the same input appends the rows twice: there is no
    dedup in bronze.  ``iceberg`` tables are created with
    ``writeTo().create()`` and ``properties``.  In file formats every call
    lands in a partition of its own (``_batch``): a new one, or the one named
    by ``batch``, which then replaces what an earlier attempt left there.  A
    named batch that compaction has already merged is left as it is.
    Batch jobs and streams can share such a table.  A table that holds the
    file log of a streaming file sink is refused.
    """
    spark = df.sparkSession
    if fmt == "iceberg":
        writer = df.writeTo(table)
        if table_exists(spark, table):
            writer.append()
            return
        for k, v in {**ICEBERG_PROPERTIES, **(properties or {})}.items():
            writer = writer.tableProperty(k, v)
        writer.using("iceberg").create()
        return
    if not table_exists(spark, table):
        create_bronze(spark, df.schema, table, fmt, path)
    elif has_file_log(spark, table):
        raise RuntimeError(f"{table} belongs to a streaming file sink; rows appended to it would not be visible")
    columns = spark.table(table).columns
    if BATCH_COLUMN not in columns:  # a table from elsewhere
        if batch:
            raise RuntimeError(f"{table} has no column {BATCH_COLUMN}: a repeated batch could not replace its rows")
        df.write.format(fmt).mode("append").saveAsTable(table)
        return
    if batch and is_merged(spark, table, batch):
        log.info("%s holds batch %s already", table, batch)
        return
    tagged = df.withColumn(BATCH_COLUMN, F.lit(batch or f"batch-{uuid.uuid4().hex}"))
    with dynamic_overwrite(spark):
        tagged.select(*columns).write.mode("overwrite").insertInto(table)


def ingest_frame(
    raw: DataFrame,
    topic: Topic,
    table: str,
    fmt: str = "parquet",
    path: str | None = None,
    properties: dict[str, str] | None = None,
) -> int:
    """Parse a Kafka-shaped frame and append it to ``table``.

    An empty source writes nothing and returns 0 (``isEmpty`` reads at most
    one row).  The written row count comes from an ``Observation`` on the
    same pass as the write, so the source is read once for data.
    """
    if raw.isEmpty():
        log.warning("no messages for topic %s", topic.name)
        return 0
    obs = Observation(f"ingest_{topic.table}")
    parsed = parse_records(raw, topic.schema).observe(obs, F.count(F.lit(1)).alias("rows"))
    append_bronze(parsed, table, fmt=fmt, path=path, properties=properties)
    return int(obs.get["rows"])


def ingest_frames(
    frames: dict[str, DataFrame],
    database: str = "bronze",
    fmt: str = "parquet",
    properties: dict[str, str] | None = None,
    at_once: int = 5,
) -> dict[str, int]:
    """Batch ingest of Kafka-shaped frames, one per topic name; rows written
    per bronze table.  ``at_once`` topics are ingested at a time, so a small
    topic does not wait for a large one.  A failing topic does not stop the
    others; the failures are raised together at the end (the reference only
    logged them)."""
    errors: dict[str, Exception] = {}

    def one(name: str, raw: DataFrame) -> int | None:
        t = topic(name)
        try:
            return ingest_frame(raw, t, f"{database}.{t.table}", fmt=fmt, properties=properties)
        except Exception as exc:  # keep going, report at the end
            log.error("topic %s failed: %s", name, exc)
            errors[name] = exc
            return None

    with ThreadPoolExecutor(max(1, min(at_once, len(frames)))) as pool:
        rows = dict(zip(frames, pool.map(lambda item: one(*item), frames.items()), strict=True))
    if errors:
        raise RuntimeError(f"ingest failed for topics {sorted(errors)}") from next(iter(errors.values()))
    return {topic(name).table: n for name, n in rows.items()}


def ingest_kafka_batch(
    spark: SparkSession,
    options: dict[str, str],
    topic_name: str | None = None,
    database: str = "bronze",
    fmt: str = "parquet",
    properties: dict[str, str] | None = None,
) -> dict[str, int]:
    """Batch ingest of one topic or all registered ones from Kafka (bounded
    read from the earliest offsets, appended: a re-run appends again)."""
    frames = {t.name: read_kafka(spark, options, t.name) for t in select_topics(topic_name)}
    return ingest_frames(frames, database, fmt, properties)
