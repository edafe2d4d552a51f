"""Bounded batch reads between stored offsets.

A ledger (a folder of small files on shared storage, one folder a topic) says
up to which offset each topic partition was ingested.  ``ingest_new`` reads
what lies between there and the topic's present end, with explicit start and
end offsets, and records the new end:

1. a run is planned: its start (the end of the last run) and its end (the
   topic's present end) are written to the ledger;
2. exactly these messages are read and appended to bronze under the run's name;
3. the run is marked as done.

A run that failed after 1 is taken up again with the same bounds and the same
name, so what it had written is replaced and not added.  Two runs in a row
without new messages write nothing the second time.  The plain batch ingest
(everything from the earliest offsets, appended) stays as it is.
"""

from __future__ import annotations

import json
import logging
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ledgerspark.sources import shared_fs
from ledgerspark.sources.bronze import append_bronze
from ledgerspark.sources.compaction import is_merged
from ledgerspark.sources.kafka import parse_records, read_kafka
from ledgerspark.sources.schemas import Topic, select_topics

log = logging.getLogger(__name__)

#: partition -> offset, as Spark's Kafka source writes it: the first message to
#: read (start), or the one after the last (end)
Offsets = dict[str, int]
EARLIEST = -2  # Spark's number for "from the first message there is"


def bounded(raw: DataFrame, start: Offsets, end: Offsets) -> DataFrame:
    """The messages of ``raw`` with start <= offset < end; a partition that
    ``end`` does not name is left out."""
    inside = F.lit(False)
    for p, to in end.items():
        inside |= (F.col("partition") == int(p)) & (F.col("offset") >= start.get(p, 0)) & (F.col("offset") < to)
    return raw.where(inside)


def ends(raw: DataFrame) -> Offsets:
    """For each partition of ``raw`` the offset after its last message; one
    row for each partition reaches the driver."""
    found = raw.groupBy("partition").agg(F.max("offset").alias("last")).collect()
    return {str(r["partition"]): r["last"] + 1 for r in found}


class Source:
    """A topic's messages between offsets."""

    def latest(self, start: Offsets) -> Offsets:
        """The present end of every partition that has messages after ``start``."""
        raise NotImplementedError

    def read(self, start: Offsets, end: Offsets) -> DataFrame:
        raise NotImplementedError


class KafkaSource(Source):
    """A topic of a Kafka cluster, by Spark's batch source.

    The end of the partitions that the ledger knows is found by reading from
    their last end on.  Partitions that were added to the topic later are
    looked for with ``discover``, which reads the offsets of the whole topic
    once (as the first run does).
    """

    def __init__(self, spark: SparkSession, options: dict[str, str], topic: str, discover: bool = False):
        self.spark, self.options, self.topic, self.discover = spark, options, topic, discover

    def bounds(self, start: Offsets, end: Offsets | None = None) -> dict[str, str]:
        """The options of a read of the partitions of ``end`` (none: those of
        ``start``, to their present end)."""
        known = {p: start.get(p, EARLIEST) for p in (start if end is None else end)}
        return {
            "startingOffsets": json.dumps({self.topic: known}, sort_keys=True),
            "endingOffsets": "latest" if end is None else json.dumps({self.topic: end}, sort_keys=True),
        }

    def latest(self, start: Offsets) -> Offsets:
        if not start or self.discover:
            raw = read_kafka(self.spark, {**self.options, "startingOffsets": "earliest"}, self.topic)
        else:
            raw = read_kafka(self.spark, {**self.options, **self.bounds(start)}, self.topic, partitions=list(start))
        return ends(raw.select("partition", "offset"))

    def read(self, start: Offsets, end: Offsets) -> DataFrame:
        return read_kafka(self.spark, {**self.options, **self.bounds(start, end)}, self.topic, partitions=list(end))


class DumpSource(Source):
    """A topic kept as Kafka-shaped files (``partition``, ``offset``, ``value``):
    the bounds are conditions that reach the scan."""

    def __init__(self, frame: Callable[[], DataFrame]):
        self.frame = frame  # called anew for each read: files may have been added

    def latest(self, start: Offsets) -> Offsets:
        raw = self.frame().select("partition", "offset")
        after = F.lit(True)
        for p, at in start.items():
            after &= (F.col("partition") != int(p)) | (F.col("offset") >= at)
        return ends(raw.where(after))

    def read(self, start: Offsets, end: Offsets) -> DataFrame:
        return bounded(self.frame(), start, end)


class Ledger:
    """The runs of one topic: ``<folder>/<topic>/<run>.plan.json`` and, once a
    run is done, ``<run>.done.json``."""

    def __init__(self, spark: SparkSession, folder: str, topic: str):
        self.spark, self.folder = spark, f"{folder.rstrip('/')}/{topic}"
        self.topic = topic

    def _path(self, run: int, what: str) -> str:
        return f"{self.folder}/{run:010d}.{what}.json"

    def _runs(self, what: str) -> list[int]:
        end = f".{what}.json"
        return [int(n.removesuffix(end)) for n in shared_fs.names(self.spark, self.folder) if n.endswith(end)]

    def plan(self, latest: Callable[[Offsets], Offsets]) -> dict | None:
        """The run to do next: an unfinished one as it was planned, else a
        new one up to the present end; None if there is nothing new."""
        planned, done = self._runs("plan"), self._runs("done")
        if planned and planned[-1] not in done:
            return shared_fs.read_json(self.spark, self._path(planned[-1], "plan"))
        start = shared_fs.read_json(self.spark, self._path(done[-1], "plan"))["end"] if done else {}
        new = {p: at for p, at in latest(start).items() if at > start.get(p, 0)}
        if not new:
            return None
        number = (planned[-1] if planned else 0) + 1
        # every partition known so far: what has no news ends where it starts
        run = {"run": number, "start": start, "end": {**start, **new}, "batch": f"offsets-{self.topic}-{number:010d}"}
        if not shared_fs.create_json(self.spark, self._path(number, "plan"), run):
            raise RuntimeError(f"another ingest of {self.topic} has planned run {number}")
        return run

    def finish(self, run: dict, rows: int) -> None:
        shared_fs.create_json(self.spark, self._path(run["run"], "done"), {"rows": rows})

    def position(self) -> Offsets:
        """Up to where the topic was ingested."""
        done = self._runs("done")
        return shared_fs.read_json(self.spark, self._path(done[-1], "plan"))["end"] if done else {}


def ingest_new(
    source: Source, topic: Topic, table: str, ledger: Ledger, fmt: str = "parquet", path: str | None = None
) -> int:
    """Appends the topic's new messages to ``table``; the rows written."""
    run = ledger.plan(source.latest)
    if run is None:
        log.info("no new messages for topic %s", topic.name)
        return 0
    if is_merged(ledger.spark, table, run["batch"]):  # written and compacted, but not marked
        ledger.finish(run, 0)
        return 0
    seen = Observation(f"run_{topic.table}_{run['run']}")
    parsed = parse_records(source.read(run["start"], run["end"]), topic.schema)
    counted = parsed.observe(seen, F.count(F.lit(1)).alias("rows"))
    append_bronze(counted, table, fmt=fmt, path=path, batch=run["batch"])
    rows = int(seen.get["rows"])
    ledger.finish(run, rows)
    return rows


def ingest_kafka_new(
    spark: SparkSession,
    options: dict[str, str],
    ledger_folder: str,
    topic_name: str | None = None,
    database: str = "bronze",
    fmt: str = "parquet",
    discover: bool = False,
) -> dict[str, int]:
    """``ingest_new`` for one topic or all registered ones; rows by table.  A
    failing topic does not stop the others; failures are raised at the end."""
    if fmt == "iceberg":
        raise ValueError("the offset ledger needs a file format: a repeated run replaces its partition")
    written: dict[str, int] = {}
    errors: dict[str, Exception] = {}
    for t in select_topics(topic_name):
        try:
            source = KafkaSource(spark, options, t.name, discover)
            written[t.table] = ingest_new(source, t, f"{database}.{t.table}", Ledger(spark, ledger_folder, t.name), fmt)
        except Exception as exc:  # keep going, report at the end
            log.error("topic %s failed: %s", t.name, exc)
            errors[t.name] = exc
    if errors:
        raise RuntimeError(f"ingest failed for topics {sorted(errors)}") from next(iter(errors.values()))
    return written
