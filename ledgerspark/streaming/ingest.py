"""Structured Streaming ingest: topic stream -> parse -> append to bronze.

Stateless and map-only (no watermark, window or state): each micro-batch is
a narrow projection.  The checkpoint (one folder per topic, on shared storage)
makes a restart resume after the last committed batch.

In file formats a micro-batch goes through ``append_bronze`` into a partition
named by the query's id and the batch's number, so a batch that is repeated
after a failure replaces its own rows, and batch jobs may write to the same
table.  (A file sink would keep its own list of files, and readers would not
see anybody else's.)  Iceberg tables are written by their own sink.
"""

from __future__ import annotations

import logging
import os
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener
from pyspark.sql.types import (
    BinaryType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

from ledgerspark.sources.bronze import append_bronze, create_bronze, has_file_log
from ledgerspark.sources.catalog import table_exists
from ledgerspark.sources.compaction import BATCH_COLUMN, FAN_IN, compact, is_merged
from ledgerspark.sources.kafka import parse_records, read_kafka
from ledgerspark.sources.schemas import Topic, select_topics

log = logging.getLogger(__name__)

# the job property in which Spark names the running query; it is kept in the checkpoint
QUERY_ID = "sql.streaming.queryId"

# the name of the row count that every ingest stream reports with its progress
OBSERVED = "ingested"

KAFKA_SCHEMA = StructType(
    [
        StructField("key", BinaryType()),
        StructField("value", BinaryType()),
        StructField("topic", StringType()),
        StructField("partition", IntegerType()),
        StructField("offset", LongType()),
        StructField("timestamp", TimestampType()),
        StructField("timestampType", IntegerType()),
    ]
)


def stream_batch(query: str, number: int) -> str:
    """The partition that a stream's micro-batch is written to."""
    return f"stream-{query}-{number:010d}"


def file_source(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """A folder of Kafka-shaped Parquet files as a stream (new files are new
    messages); stands in for the Kafka source where no broker is reachable."""
    reader = spark.readStream.schema(KAFKA_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.parquet(path)


def start_stream(
    raw: DataFrame,
    topic: Topic,
    table: str,
    checkpoint: str,
    fmt: str = "parquet",
    trigger: dict | None = None,
    path: str | None = None,
    compact_every: int | None = None,
) -> StreamingQuery:
    """Start the append stream of one topic into ``table``.

    ``compact_every``: after so many micro-batches, merge the closed ones
    (``sources.compaction``; at least 2, file formats only).

    ``trigger`` is passed to ``DataStreamWriter.trigger`` (default: micro-
    batches as fast as data arrives; ``{"availableNow": True}`` drains what is
    there and stops).  Iceberg gets its fan-out writer option.
    """
    spark = raw.sparkSession
    parsed = parse_records(raw, topic.schema).observe(OBSERVED, F.count(F.lit(1)).alias("rows"))
    w = (
        parsed.writeStream.outputMode("append")
        .option("checkpointLocation", checkpoint)
        # one name per target table: two streams of one topic into different
        # tables may run side by side
        .queryName("ingest_" + table.replace(".", "_").replace("`", ""))
    )
    if trigger:
        w = w.trigger(**trigger)
    if fmt == "iceberg":
        w = w.format(fmt).option("fanout-enabled", "true")
        return (w.option("path", path) if path else w).toTable(table)
    if table_exists(spark, table) and has_file_log(spark, table):
        raise RuntimeError(f"{table} belongs to a streaming file sink; other writers' rows would not be visible")
    create_bronze(spark, parsed.schema, table, fmt, path)

    def land(rows: DataFrame, number: int) -> None:
        session = rows.sparkSession
        query = session.sparkContext.getLocalProperty(QUERY_ID)
        append_bronze(rows, table, fmt=fmt, batch=stream_batch(query, number))
        if compact_every and (number + 1) % compact_every == 0:
            compact(session, table, fan_in=min(compact_every, FAN_IN))
        spark.catalog.refreshTable(table)  # the stream runs in a session of its own

    return w.foreachBatch(land).start()


class RowCheck(StreamingQueryListener):
    """Compares, batch by batch, what a stream read with what its table holds.

    The rows of a micro-batch are counted on their way (an observed metric of
    the stream, reported with its progress); the table's are counted in the
    batch's own partition, from the files' footers.  A batch that compaction
    has merged since is no longer countable alone; it was when it was written,
    and ``compact`` compares counts itself.

    Only the streams registered with ``watch`` are checked.  The listener is
    told after a batch was committed, so a lost batch is found at once, but
    has to be ingested again (``verify`` raises; ``await_streams`` stops all).
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.tables: dict[str, str] = {}  # query id -> table
        self.read: dict[tuple[str, int], int] = {}
        self.ended: set[str] = set()
        self.problems: list[str] = []

    def watch(self, query: StreamingQuery, table: str) -> None:
        self.tables[str(query.id)] = table

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        metric = p.observedMetrics.get(OBSERVED)
        if metric is not None:  # a trigger without data reports none
            self.read[(str(p.id), p.batchId)] = int(metric["rows"])

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.ended.add(str(event.id))

    def verify(self) -> dict[tuple[str, int], int]:
        """Checks the batches reported since the last call; the rows of each.
        ``RuntimeError`` if a table holds fewer or more than were read."""
        checked = {}
        for key in sorted(k for k in list(self.read) if k[0] in self.tables):  # the listener's thread adds
            query, number = key
            table, rows = self.tables[query], self.read.pop(key)
            batch = stream_batch(query, number)
            if is_merged(self.spark, table, batch):
                checked[key] = rows
                continue
            held = self.spark.read.table(table).where(F.col(BATCH_COLUMN) == batch).count()
            checked[key] = held
            if held != rows:
                self.problems.append(f"{table}: batch {number} read {rows} rows, the table holds {held}")
        if self.problems:
            raise RuntimeError("; ".join(self.problems))
        return checked

    def finish(self, queries: list[StreamingQuery], seconds: float = 30.0) -> None:
        """``verify`` once the last progress of ended queries was reported
        (listeners are told a little later)."""
        until = time.monotonic() + seconds
        watched = {str(q.id) for q in queries} & self.tables.keys()
        while not watched <= self.ended and time.monotonic() < until:
            time.sleep(0.05)
        self.verify()


def start_kafka_streams(
    spark: SparkSession,
    options: dict[str, str],
    checkpoint_root: str,
    topic_name: str | None = None,
    database: str = "bronze",
    fmt: str = "parquet",
    trigger: dict | None = None,
    compact_every: int | None = None,
    check: RowCheck | None = None,
) -> list[StreamingQuery]:
    """One stream per topic (or just ``topic_name``), checkpoint per topic.

    If a stream fails to start, the ones already started are stopped."""
    queries: list[StreamingQuery] = []
    try:
        for t in select_topics(topic_name):
            raw = read_kafka(spark, options, t.name, streaming=True)
            cp = os.path.join(checkpoint_root, t.name)
            table = f"{database}.{t.table}"
            queries.append(
                start_stream(raw, t, table, cp, fmt=fmt, trigger=trigger, compact_every=compact_every)
            )
            if check and fmt != "iceberg":
                check.watch(queries[-1], table)
    except BaseException:
        for q in queries:
            q.stop()
        raise
    return queries


def await_streams(
    queries: list[StreamingQuery], poll_seconds: float = 1.0, check: RowCheck | None = None
) -> None:
    """Block until all of ``queries`` end; the first failure among them stops
    the others and is raised, and an interrupt stops them all.  With
    ``check``, rows that a micro-batch read and its table does not show are
    such a failure.

    Only these queries are watched: the session-wide ``awaitAnyTermination``
    would also report streams of other callers (and keeps reporting an old
    failure until reset).
    """
    try:
        while True:
            for q in queries:
                if not q.isActive and q.exception() is not None:
                    raise q.exception()
            if check:
                check.verify()
            active = [q for q in queries if q.isActive]
            if not active:
                if check:
                    check.finish(queries)
                return
            # raises at once if this one fails; wakes up to look at the others
            active[0].awaitTermination(poll_seconds)
    except BaseException:
        for q in queries:
            if q.isActive:
                q.stop()
        raise
