"""Kafka source and sink, and the parse of Kafka-shaped frames.

The connector jar is not bundled; ``read_kafka``/``write_kafka`` only build
the reader/writer, and everything downstream (``parse_records``) takes any
frame with a binary or text ``value`` column, e.g. a Parquet dump of a topic.
"""

from __future__ import annotations

import json
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# The columns of a Kafka source frame.
KAFKA_COLUMNS = ("key", "value", "topic", "partition", "offset", "timestamp", "timestampType")

SOURCE_TAG = "kafka"


def kafka_options(
    bootstrap: str | None = None,
    username: str | None = None,
    password: str | None = None,
    protocol: str | None = None,
    mechanism: str | None = None,
    starting_offsets: str = "earliest",
    fail_on_data_loss: bool = False,
    max_offsets_per_trigger: int | None = None,
    min_partitions: int | None = None,
    env: dict[str, str] | None = None,
) -> dict[str, str]:
    """Source options for a SASL/SCRAM cluster.

    Arguments win over the environment (``KAFKA_BOOTSTRAP_SERVERS``,
    ``KAFKA_USERNAME``, ``KAFKA_PASSWORD``, ``KAFKA_SECURITY_PROTOCOL``,
    ``KAFKA_SASL_MECHANISM``).  There is no default for credentials: without
    them no SASL options are emitted.

    Sizing for large topics: ``max_offsets_per_trigger`` caps each streaming
    micro-batch (a stream starting at ``earliest`` would otherwise take the
    whole backlog in its first batch); ``min_partitions`` splits large Kafka
    partitions over more Spark tasks.
    """
    e = os.environ if env is None else env
    bootstrap = bootstrap or e.get("KAFKA_BOOTSTRAP_SERVERS")
    if not bootstrap:
        raise ValueError("Kafka bootstrap servers are required (KAFKA_BOOTSTRAP_SERVERS)")
    opts = {
        "kafka.bootstrap.servers": bootstrap,
        "startingOffsets": starting_offsets,
        "failOnDataLoss": str(fail_on_data_loss).lower(),
    }
    username = username or e.get("KAFKA_USERNAME")
    password = password or e.get("KAFKA_PASSWORD")
    protocol = protocol or e.get("KAFKA_SECURITY_PROTOCOL")
    mechanism = mechanism or e.get("KAFKA_SASL_MECHANISM")
    if max_offsets_per_trigger:
        opts["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    if min_partitions:
        opts["minPartitions"] = str(min_partitions)
    if protocol:
        opts["kafka.security.protocol"] = protocol
    if username and password:
        mech = mechanism or "SCRAM-SHA-512"
        opts["kafka.sasl.mechanism"] = mech
        opts["kafka.sasl.jaas.config"] = (
            "org.apache.kafka.common.security.scram.ScramLoginModule required "
            f'username="{_quoted(username)}" password="{_quoted(password)}";'
        )
    return opts


def _quoted(text: str) -> str:
    """Text inside the double quotes of a JAAS option."""
    return text.replace("\\", "\\\\").replace('"', '\\"')


def producer_options() -> dict[str, str]:
    """Producer settings of the reference publisher, as Kafka sink options."""
    # Producer batching and durability settings.
    return {
        "kafka.acks": "all",
        "kafka.retries": "3",
        "kafka.batch.size": "32768",
        "kafka.linger.ms": "10",
        "kafka.compression.type": "gzip",
    }


def read_kafka(
    spark: SparkSession,
    options: dict[str, str],
    topic: str,
    streaming: bool = False,
    partitions: list[str] | None = None,
) -> DataFrame:
    """Bounded (batch) or unbounded (stream) read of one topic, or of some of
    its partitions."""
    reader = (spark.readStream if streaming else spark.read).format("kafka").options(**options)
    if partitions is None:
        return reader.option("subscribe", topic).load()
    return reader.option("assign", json.dumps({topic: sorted(map(int, partitions))})).load()


def sink_options(options: dict[str, str], topic: str) -> dict[str, str]:
    """Kafka sink options: the connection settings of ``options`` (source-only
    settings such as offsets dropped), the producer settings, the topic."""
    out = {k: v for k, v in options.items() if k.startswith("kafka.")}
    out.update(producer_options())
    out["topic"] = topic
    return out


def write_kafka(envelope: DataFrame, options: dict[str, str], topic: str) -> None:
    """Publish a ``key, value`` frame (see ``publish_envelope``) to a topic.

    The Kafka sink is at-least-once: a retried task may publish a message
    twice, which the append-only bronze layer keeps (no dedup), as before.
    """
    envelope.write.format("kafka").options(**sink_options(options, topic)).save()


def parse_records(raw: DataFrame, schema: StructType, source: str = SOURCE_TAG) -> DataFrame:
    """Kafka frame -> bronze records.

    The value is decoded as UTF-8 and parsed against the fixed text schema
    (permissive: unknown fields are dropped, missing ones are NULL, nested
    values keep their JSON text, malformed messages become an all-NULL row
    that is kept).  The key and the Kafka metadata are not kept.  Adds
    ``_ingestion_ts`` (one instant per batch / micro-batch) and ``_source``.
    Narrow: no shuffle, works on batch and streaming frames alike.
    """
    return (
        raw.select(F.from_json(F.col("value").cast("string"), schema).alias("data"))
        .select("data.*")
        .withColumn("_ingestion_ts", F.current_timestamp())
        .withColumn("_source", F.lit(source))
    )
