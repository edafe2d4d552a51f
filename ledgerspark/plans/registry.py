"""Every analytic and rule as ``(spark, sf_dir) -> DataFrame`` over the given
tables.

Each query reads whole tables (``events``, ``orders``, ``customer``), derives
the bronze-shaped records from them (``sources.fixtures``) and applies one
operator.  Queries that write tables do so under the session's scratch folder;
``drop_scratch`` removes their namespaces once the results are no longer read.
Queries over the same ingested topic share one ingest per session and input.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerspark import operators as op
from ledgerspark.plans import gold, silver
from ledgerspark.session import fresh_path
from ledgerspark.sources import catalog, fixtures
from ledgerspark.sources.bronze import append_bronze, ingest_frame, ingest_frames
from ledgerspark.sources.compaction import BATCH_COLUMN, live
from ledgerspark.sources.kafka import parse_records
from ledgerspark.sources.offsets import DumpSource, Ledger, ingest_new
from ledgerspark.sources.schemas import TOPICS
from ledgerspark.streaming.ingest import RowCheck, await_streams, file_source, start_stream, stream_batch

Query = Callable[[SparkSession, str], DataFrame]

TXN_TOPIC = TOPICS["finacle-transactions"]


def _txn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.transactions(fixtures.load(spark, sf_dir, "events"))


def _txnf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.flagged_transactions(fixtures.load(spark, sf_dir, "events"))


def _alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.aml_alerts(fixtures.load(spark, sf_dir, "events"))


def _npa(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.npa_report(fixtures.load(spark, sf_dir, "orders"))


def _cibil(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.cibil_bureau(fixtures.load(spark, sf_dir, "customer"))


def _customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.customers(fixtures.load(spark, sf_dir, "customer"))


def bronze_frames(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The five bronze record tables, by table name."""
    return {
        "finacle_transactions": _txnf(spark, sf_dir),
        "finacle_customers": _customers(spark, sf_dir),
        "aml_alerts": _alerts(spark, sf_dir),
        "cibil_bureau": _cibil(spark, sf_dir),
        "npa_report": _npa(spark, sf_dir),
    }


def _on_txn(fn) -> Query:
    return lambda spark, sf_dir: fn(_txn(spark, sf_dir))


# per application: namespaces made here, and the shared ingest of each input
_SCRATCH: dict[str, list[str]] = {}
_SHARED: dict[tuple[str, str], tuple[str, dict[str, int]]] = {}
_GOLD: dict[tuple[str, str], str] = {}


def scratch_database(spark: SparkSession) -> str:
    """A new namespace located under the scratch folder."""
    name = f"bronze_{uuid.uuid4().hex[:10]}"
    spark.sql(f"CREATE NAMESPACE {name} LOCATION '{fresh_path(spark, name)}'")
    _SCRATCH.setdefault(spark.sparkContext.applicationId, []).append(name)
    return name


def drop_scratch(spark: SparkSession) -> int:
    """Drop the namespaces (and their tables) that queries of this session
    made; returns their number.  Results are lazy: call it when none of them
    will be read any more."""
    app = spark.sparkContext.applicationId
    names = _SCRATCH.pop(app, [])
    for shared in (_SHARED, _GOLD):
        for key in [k for k in shared if k[0] == app]:
            del shared[key]
    for name in names:
        spark.sql(f"DROP NAMESPACE IF EXISTS {name} CASCADE")
    return len(names)


def shared_bronze(spark: SparkSession, sf_dir: str, *tables: str) -> str:
    """A namespace that holds ``tables`` (none: all five) of ``sf_dir``, each
    ingested once per session."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _SHARED:
        _SHARED[key] = (scratch_database(spark), {})
    db, written = _SHARED[key]
    wanted = [t for t in tables or TABLE_TOPICS if t not in written]
    frames = bronze_frames(spark, sf_dir) if wanted else {}
    written.update(
        ingest_frames({TABLE_TOPICS[t]: fixtures.kafka_records(frames[t], TABLE_TOPICS[t]) for t in wanted}, database=db)
    )
    return db


def _without_ingestion_ts(df: DataFrame) -> DataFrame:
    # the ingestion instant and the batch differ per run; everything else is compared
    return df.drop("_ingestion_ts", BATCH_COLUMN)


def ingest_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kafka-shaped messages (1 in 61 broken) -> parsed bronze records."""
    raw = fixtures.kafka_records(_txnf(spark, sf_dir))
    return _without_ingestion_ts(parse_records(raw, TXN_TOPIC.schema))


def ingest_append_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batch ingest of the same messages twice: create, then append (rows
    double, as bronze has no dedup)."""
    db = scratch_database(spark)
    table = f"{db}.{TXN_TOPIC.table}"
    raw = fixtures.kafka_records(_txnf(spark, sf_dir))
    for _ in range(2):
        ingest_frame(raw, TXN_TOPIC, table)
    return _without_ingestion_ts(spark.table(table))


def _dumped(spark: SparkSession, raw: DataFrame) -> str:
    dump = fresh_path(spark, "topic-dump")
    raw.write.parquet(dump)
    return dump


def _drain(spark: SparkSession, dump: str, table: str, files: int | None = None, **options) -> StreamingQuery:
    """Stream a folder of messages into ``table`` until it is read, ``files``
    at a time."""
    q = start_stream(
        file_source(spark, dump, files),
        TXN_TOPIC,
        table,
        checkpoint=fresh_path(spark, "stream-checkpoint"),
        trigger={"availableNow": True},
        **options,
    )
    await_streams([q])
    return q


def ingest_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages dumped to a folder, ingested by a stream until drained."""
    dump = _dumped(spark, fixtures.kafka_records(_txnf(spark, sf_dir)))
    table = f"{scratch_database(spark)}.{TXN_TOPIC.table}"
    _drain(spark, dump, table)
    return _without_ingestion_ts(spark.table(table))


def ingest_mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A third of the messages by batch, a third by a stream, the last third
    by batch again, all into one table: every message is there once."""
    raw = fixtures.kafka_records(_txnf(spark, sf_dir))
    part = F.pmod(F.col("offset"), F.lit(3))
    table = f"{scratch_database(spark)}.{TXN_TOPIC.table}"
    ingest_frame(raw.where(part == 0), TXN_TOPIC, table)
    _drain(spark, _dumped(spark, raw.where(part == 1)), table)
    ingest_frame(raw.where(part == 2), TXN_TOPIC, table)
    return _without_ingestion_ts(spark.table(table))


def ingest_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream of many micro-batches whose table is compacted as it grows; an
    old micro-batch that comes again changes nothing.  Every batch's rows are
    checked against what the stream read."""
    raw = fixtures.kafka_records(_txnf(spark, sf_dir))
    dump = fresh_path(spark, "topic-dump")
    raw.repartition(MICRO_BATCHES, "offset").write.parquet(dump)
    table = f"{scratch_database(spark)}.{TXN_TOPIC.table}"
    check = RowCheck(spark)
    spark.streams.addListener(check)
    try:
        q = _drain(spark, dump, table, files=1, compact_every=4)
        check.watch(q, table)
        check.finish([q])
    finally:
        spark.streams.removeListener(check)
    first = parse_records(spark.read.parquet(dump).limit(10), TXN_TOPIC.schema)
    append_bronze(first, table, batch=stream_batch(str(q.id), 0))
    return _without_ingestion_ts(live(spark, table))


#: files of the stream above, one a micro-batch
MICRO_BATCHES = 9


def ingest_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batch ingest between stored offsets: half of the messages, again
    without news, then what was added; every message is there once."""
    raw = fixtures.kafka_records(_txnf(spark, sf_dir))
    half = raw.agg(F.expr("max(offset) div 2").alias("half")).first()["half"] or 0
    dump = _dumped(spark, raw.where(F.col("offset") <= half))
    table = f"{scratch_database(spark)}.{TXN_TOPIC.table}"
    ledger = Ledger(spark, fresh_path(spark, "ledger"), TXN_TOPIC.name)
    source = DumpSource(lambda: spark.read.parquet(dump))
    for _ in range(2):
        ingest_new(source, TXN_TOPIC, table, ledger)
    raw.where(F.col("offset") > half).write.mode("append").parquet(dump)
    for _ in range(2):
        ingest_new(source, TXN_TOPIC, table, ledger)
    return _without_ingestion_ts(spark.table(table))


def gold_namespace(spark: SparkSession, sf_dir: str) -> str:
    """A gold namespace over the transactions of ``sf_dir``, which arrived in
    three increments; bronze is compacted after the second."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _GOLD:
        db = scratch_database(spark)
        bronze = f"{db}.{TXN_TOPIC.table}"
        txn = _txn(spark, sf_dir)
        part = F.pmod(F.xxhash64("txn_id"), F.lit(3))
        for k in range(3):
            append_bronze(txn.where(part == k), bronze)
            gold.refresh(spark, bronze, db)
            if k == 1:
                gold.compact_covered(spark, bronze, db, fan_in=2)
        _GOLD[key] = db
    return _GOLD[key]


def _on_gold(report: Callable[[SparkSession, str], DataFrame]) -> Query:
    return lambda spark, sf_dir: report(spark, gold_namespace(spark, sf_dir))


def volume_daily_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily volume from a silver layer, of which only the newest days are
    read."""
    path = fresh_path(spark, "silver")
    silver.write_silver(_txn(spark, sf_dir), path)
    return silver.newest_volume_daily(spark, path)


# record table -> topic it is published on
TABLE_TOPICS = {t.table: t.name for t in TOPICS.values()}


def ingest_all_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All five registered topics, batch-ingested as Kafka messages into one
    bronze namespace, then counted per table."""
    return catalog.bronze_counts_in(spark, shared_bronze(spark, sf_dir))


def _ingested(table: str) -> Query:
    """The rows of one topic's bronze table."""
    return lambda spark, sf_dir: _without_ingestion_ts(spark.table(f"{shared_bronze(spark, sf_dir, table)}.{table}"))


def ingest_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alert messages (keyed by alert id, as published) parsed against the
    19-field alert schema."""
    t = TOPICS["aml-alerts"]
    raw = fixtures.kafka_records(_alerts(spark, sf_dir), t.name)
    return _without_ingestion_ts(parse_records(raw, t.schema))


def bronze_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tables of the namespace that the shared ingest wrote."""
    return catalog.bronze_tables(spark, shared_bronze(spark, sf_dir))


def bronze_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Column listing of the ingested transactions table."""
    return catalog.bronze_schema(spark, f"{shared_bronze(spark, sf_dir, TXN_TOPIC.table)}.{TXN_TOPIC.table}")


def bronze_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.bronze_counts(bronze_frames(spark, sf_dir))


QUERIES: dict[str, Query] = {
    # live analytics
    "kpi_overall": _on_txn(op.kpi_overall),
    "volume_daily": _on_txn(op.volume_daily),
    "volume_hourly": _on_txn(op.volume_hourly),
    "pattern_channel": _on_txn(op.pattern_channel),
    "pattern_txn_type": _on_txn(op.pattern_txn_type),
    "pattern_branch_top15": _on_txn(op.pattern_branch_top15),
    "risk_high_value_cash": _on_txn(op.risk_high_value_cash),
    "risk_structuring": _on_txn(op.risk_structuring),
    "risk_high_velocity": _on_txn(op.risk_high_velocity),
    # documented analytics
    "bronze_tables": bronze_tables,
    "bronze_counts": bronze_counts,
    "bronze_schema": bronze_schema,
    "txn_channel_distribution": _on_txn(op.txn_channel_distribution),
    "txn_branch_type_top15": _on_txn(op.txn_branch_type_top15),
    "txn_hourly": _on_txn(op.txn_hourly),
    "txn_data_quality": _on_txn(op.txn_data_quality),
    "risk_high_value_cash_channel": _on_txn(op.risk_high_value_cash_channel),
    "risk_open_aml_alerts": lambda s, d: op.risk_open_aml_alerts(_alerts(s, d)),
    "risk_npa_summary": lambda s, d: op.risk_npa_summary(_npa(s, d)),
    "risk_low_cibil": lambda s, d: op.risk_low_cibil(_cibil(s, d)),
    # generator rules
    "derive_flag": lambda s, d: op.derive_flag(_txn(s, d)).drop("_ingestion_ts"),
    "derive_aml_alerts": _alerts,
    "publish_envelope": lambda s, d: op.transactions_envelope(_txnf(s, d)),
    "derive_ref_number": _on_txn(op.derive_ref_number),
    # ingest
    "ingest_json": ingest_json,
    "ingest_append_twice": ingest_append_twice,
    "ingest_stream": ingest_stream,
    "ingest_mixed": ingest_mixed,
    "ingest_alerts": ingest_alerts,
    "ingest_customers": _ingested("finacle_customers"),
    "ingest_cibil": _ingested("cibil_bureau"),
    "ingest_npa": _ingested("npa_report"),
    "ingest_all_topics": ingest_all_topics,
    "ingest_compacted": ingest_compacted,
    "ingest_offsets": ingest_offsets,
    # layers above bronze
    "volume_daily_silver": volume_daily_silver,
    "gold_kpi_overall": _on_gold(gold.kpi_overall),
    "gold_volume_daily": _on_gold(gold.volume_daily),
    "gold_volume_hourly": _on_gold(gold.volume_hourly),
    "gold_pattern_channel": _on_gold(gold.pattern_channel),
    "gold_pattern_txn_type": _on_gold(gold.pattern_txn_type),
}

# Queries that only read (no table writes): the analytics benchmark set.
WRITERS = {
    "bronze_tables",
    "bronze_schema",
    "ingest_append_twice",
    "ingest_stream",
    "ingest_mixed",
    "ingest_all_topics",
    "ingest_customers",
    "ingest_cibil",
    "ingest_npa",
    "ingest_compacted",
    "ingest_offsets",
    "volume_daily_silver",
    "gold_kpi_overall",
    "gold_volume_daily",
    "gold_volume_hourly",
    "gold_pattern_channel",
    "gold_pattern_txn_type",
}
READ_ONLY = [n for n in QUERIES if n not in WRITERS]
