"""Parse of Kafka-shaped frames, bronze create/append, streaming restart."""

import json
import os

import pytest
from pyspark.sql import functions as F

from paths import SF_SMALL
from frames import rows, txn_rows
from ledgerspark.operators.alerts import transactions_envelope
from ledgerspark.plans.registry import scratch_database
from ledgerspark.session import fresh_path, scratch_dir
from ledgerspark.sources import fixtures
from ledgerspark.sources.bronze import append_bronze, create_namespaces, ingest_frame
from ledgerspark.sources.kafka import kafka_options, parse_records
from ledgerspark.sources.schemas import TOPICS, select_topics, topic
from ledgerspark.streaming.ingest import KAFKA_SCHEMA, file_source, start_stream

TXN = TOPICS["finacle-transactions"]


def kafka_frame(spark, values):
    rows = [(None, None if v is None else v.encode(), "t", 0, i, None, 0) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, KAFKA_SCHEMA)


def test_json_edge_cases(spark):
    values = [
        json.dumps({"txn_id": "A", "amount": "1.00", "unknown_field": "x"}),  # unknown dropped
        json.dumps({"txn_id": "B"}),  # missing -> NULL
        json.dumps({"txn_id": "C", "narration": {"nested": [1, 2]}}),  # nested -> JSON text
        json.dumps([{"txn_id": "D"}]),  # top-level array
        None,  # NULL value
        '{"txn_id": "E", "amount": ',  # truncated
    ]
    out = parse_records(kafka_frame(spark, values), TXN.schema).collect()
    assert len(out) == 6  # malformed rows are kept
    by_id = {r.txn_id: r for r in out}
    assert "unknown_field" not in out[0].asDict()
    assert by_id["A"].amount == "1.00"
    assert by_id["B"].amount is None
    assert json.loads(by_id["C"].narration) == {"nested": [1, 2]}
    rest = [r for r in out if r.txn_id not in ("A", "B", "C")]
    assert len(rest) == 3
    for r in rest:
        d = r.asDict()
        assert all(d[f] is None for f in TXN.schema.fieldNames())
        assert d["_source"] == "kafka" and d["_ingestion_ts"] is not None


def test_envelope_round_trip(spark):
    df = txn_rows(spark, [{"narration": 'quote " and / slash'}, {"customer_id": None}])
    env = transactions_envelope(df)
    assert env.columns == ["key", "value"]
    back = parse_records(env, TXN.schema).drop("_ingestion_ts", "_source")
    assert rows(back) == rows(df.drop("_ingestion_ts"))
    assert '"customer_id"' not in env.collect()[1].value  # NULL fields omitted


def test_batch_rerun_doubles_and_empty_source_writes_nothing(spark):
    db = scratch_database(spark)
    table = f"{db}.{TXN.table}"
    raw = fixtures.kafka_records(fixtures.flagged_transactions(fixtures.load(spark, SF_SMALL, "events")))
    assert ingest_frame(raw, TXN, table) == 1000
    assert ingest_frame(raw, TXN, table) == 1000
    assert spark.table(table).count() == 2000
    assert ingest_frame(raw.limit(0), TXN, f"{db}.empty") == 0
    assert not spark.catalog.tableExists(f"{db}.empty")
    broken = spark.table(table).where(F.col("txn_id").isNull()).count()
    assert broken == 2 * 17  # ids 0..999 hold 17 multiples of 61


def test_stream_restart_adds_nothing_then_new_files(spark):
    src = fresh_path(spark, "dump")
    txn = fixtures.flagged_transactions(fixtures.load(spark, SF_SMALL, "events"))
    fixtures.kafka_records(txn).write.parquet(src)
    db = scratch_database(spark)
    table = f"{db}.{TXN.table}"
    cp = fresh_path(spark, "cp")

    def drain():
        q = start_stream(file_source(spark, src), TXN, table, cp, trigger={"availableNow": True})
        q.awaitTermination()
        assert q.exception() is None
        return spark.table(table).count()

    assert drain() == 1000
    assert drain() == 1000  # same checkpoint, no new input
    fixtures.kafka_records(txn.limit(5)).write.mode("append").parquet(src)
    assert drain() == 1005
    batch = parse_records(spark.read.parquet(src), TXN.schema).drop("_ingestion_ts")
    assert rows(spark.table(table).drop("_ingestion_ts", "_batch")) == rows(batch)


def test_append_bronze_creates_then_appends(spark):
    db = scratch_database(spark)
    df = txn_rows(spark, [{}, {}])
    append_bronze(df, f"{db}.t")
    append_bronze(df, f"{db}.t")
    assert spark.table(f"{db}.t").count() == 4


def test_namespaces(spark):
    loc = fresh_path(spark, "ns")
    create_namespaces(spark, location=loc)
    for ns in ("bronze", "silver", "gold"):
        assert spark.catalog.databaseExists(ns)


def test_topic_registry():
    assert [t.table for t in select_topics()] == [
        "finacle_transactions", "finacle_customers", "aml_alerts", "cibil_bureau", "npa_report"
    ]
    assert topic("aml-alerts").key_field == "alert_id"
    assert len(topic("npa-report").schema) == 25
    with pytest.raises(KeyError, match="known"):
        topic("nope")


def test_kafka_options_have_no_default_secrets():
    with pytest.raises(ValueError):
        kafka_options(env={})
    plain = kafka_options(env={"KAFKA_BOOTSTRAP_SERVERS": "b:9092"})
    assert plain == {"kafka.bootstrap.servers": "b:9092", "startingOffsets": "earliest", "failOnDataLoss": "false"}
    env = {
        "KAFKA_BOOTSTRAP_SERVERS": "b:9092",
        "KAFKA_USERNAME": "u",
        "KAFKA_PASSWORD": "p",
        "KAFKA_SECURITY_PROTOCOL": "SASL_PLAINTEXT",
    }
    opts = kafka_options(env=env)
    assert opts["kafka.security.protocol"] == "SASL_PLAINTEXT"
    assert opts["kafka.sasl.mechanism"] == "SCRAM-SHA-512"
    assert 'username="u" password="p";' in opts["kafka.sasl.jaas.config"]


def test_scratch_dir_from_session(spark):
    d = scratch_dir(spark)
    assert d and os.path.isabs(d.replace("file:", ""))
    assert fresh_path(spark, "x") != fresh_path(spark, "x")


def test_two_topic_streams_run_together(spark):
    from ledgerspark.streaming.ingest import await_streams

    events = fixtures.load(spark, SF_SMALL, "events")
    txn_dump, alert_dump = fresh_path(spark, "txn-dump"), fresh_path(spark, "alert-dump")
    fixtures.kafka_records(fixtures.flagged_transactions(events)).write.parquet(txn_dump)
    fixtures.kafka_records(fixtures.aml_alerts(events), "aml-alerts").write.parquet(alert_dump)
    db = scratch_database(spark)
    root = fresh_path(spark, "cp")
    queries = [
        start_stream(file_source(spark, src), t, f"{db}.{t.table}", os.path.join(root, t.name),
                     trigger={"availableNow": True})
        for src, t in ((txn_dump, TXN), (alert_dump, TOPICS["aml-alerts"]))
    ]
    await_streams(queries)
    assert not any(q.isActive for q in queries)
    assert spark.table(f"{db}.finacle_transactions").count() == 1000
    alerts = spark.table(f"{db}.aml_alerts")
    assert alerts.count() == 147
    assert alerts.where(F.col("sar_filed").isNotNull()).count() == 0


def test_sink_options():
    from ledgerspark.sources.kafka import sink_options

    opts = sink_options(kafka_options(env={"KAFKA_BOOTSTRAP_SERVERS": "b:9092"}), "aml-alerts")
    assert opts["topic"] == "aml-alerts" and opts["kafka.bootstrap.servers"] == "b:9092"
    assert "startingOffsets" not in opts and "failOnDataLoss" not in opts
    assert (opts["kafka.acks"], opts["kafka.compression.type"], opts["kafka.retries"]) == ("all", "gzip", "3")


def test_json_number_lands_as_text(spark):
    out = parse_records(kafka_frame(spark, ['{"txn_id": "N", "amount": 1.50, "balance_after": 7}']), TXN.schema)
    r = out.collect()[0]
    assert (r.amount, r.balance_after) == ("1.5", "7")


def test_failing_topic_does_not_stop_the_others(spark):
    from ledgerspark.sources.bronze import ingest_frames

    db = scratch_database(spark)
    good = kafka_frame(spark, [json.dumps({"alert_id": "A1", "status": "OPEN"})])
    bad = good.select(F.raise_error(F.lit("broker gone")).cast("binary").alias("value"))
    with pytest.raises(RuntimeError, match="finacle-transactions"):
        ingest_frames({"finacle-transactions": bad, "aml-alerts": good}, database=db)
    assert spark.table(f"{db}.aml_alerts").count() == 1


def test_kafka_sizing_options():
    opts = kafka_options(env={"KAFKA_BOOTSTRAP_SERVERS": "b:9092"}, max_offsets_per_trigger=5_000_000, min_partitions=4000)
    assert (opts["maxOffsetsPerTrigger"], opts["minPartitions"]) == ("5000000", "4000")
    from ledgerspark.sources.kafka import sink_options

    assert "maxOffsetsPerTrigger" not in sink_options(opts, "t")


def test_failing_stream_is_raised_and_stops_the_others(spark):
    from pyspark.errors import StreamingQueryException

    from ledgerspark.streaming.ingest import await_streams

    events = fixtures.load(spark, SF_SMALL, "events")
    dump = fresh_path(spark, "dump")
    fixtures.kafka_records(fixtures.flagged_transactions(events)).write.parquet(dump)
    db = scratch_database(spark)
    root = fresh_path(spark, "cp")
    healthy = start_stream(file_source(spark, dump), TXN, f"{db}.ok", os.path.join(root, "ok"))  # runs until stopped
    broken_src = file_source(spark, dump).withColumn("value", F.raise_error(F.lit("broker gone")).cast("binary"))
    broken = start_stream(broken_src, TXN, f"{db}.bad", os.path.join(root, "bad"))
    with pytest.raises(StreamingQueryException):
        await_streams([healthy, broken])
    assert not healthy.isActive and not broken.isActive


def _topic_dumps(spark):
    """One Kafka-shaped dump folder per registered topic, from the given tables."""
    from ledgerspark.plans.registry import TABLE_TOPICS, bronze_frames

    dumps = {}
    for table, frame in bronze_frames(spark, SF_SMALL).items():
        t = TABLE_TOPICS[table]
        dumps[t] = fresh_path(spark, "dump")
        fixtures.kafka_records(frame, t).write.parquet(dumps[t])
    return dumps


EXPECTED = {"finacle_transactions": 1000, "finacle_customers": 150, "aml_alerts": 147,
            "cibil_bureau": 150, "npa_report": 1500}


def test_kafka_batch_ingest_of_all_topics(spark, monkeypatch):
    import ledgerspark.sources.bronze as bronze
    from ledgerspark.sources.catalog import bronze_counts_in

    dumps = _topic_dumps(spark)
    monkeypatch.setattr(bronze, "read_kafka", lambda s, o, name, streaming=False: s.read.parquet(dumps[name]))
    db = scratch_database(spark)
    assert bronze.ingest_kafka_batch(spark, {"kafka.bootstrap.servers": "x"}, database=db) == EXPECTED
    assert {r.table_name: r.row_count for r in bronze_counts_in(spark, db).collect()} == EXPECTED


def test_kafka_streams_for_all_topics(spark, monkeypatch):
    import ledgerspark.streaming.ingest as streaming

    dumps = _topic_dumps(spark)
    monkeypatch.setattr(streaming, "read_kafka", lambda s, o, name, streaming=False: file_source(s, dumps[name]))
    db = scratch_database(spark)
    root = fresh_path(spark, "cp")
    qs = streaming.start_kafka_streams(spark, {}, root, database=db, trigger={"availableNow": True})
    assert len(qs) == 5
    streaming.await_streams(qs)
    assert {t: spark.table(f"{db}.{t}").count() for t in EXPECTED} == EXPECTED
    assert sorted(os.listdir(root.replace("file:", ""))) == sorted(dumps)  # one checkpoint per topic


def _drain(spark, src, table, cp):
    q = start_stream(file_source(spark, src), TXN, table, cp, trigger={"availableNow": True})
    q.awaitTermination()
    assert q.exception() is None


@pytest.mark.parametrize("order", ["batch first", "stream first"])
def test_batch_and_stream_share_a_table(spark, order):
    raw = fixtures.kafka_records(fixtures.flagged_transactions(fixtures.load(spark, SF_SMALL, "events")))
    src = fresh_path(spark, "dump")
    raw.where("offset % 5 < 2").write.parquet(src)  # 400 messages
    rest = raw.where("offset % 5 >= 2")
    table = f"{scratch_database(spark)}.{TXN.table}"
    seen = 0

    def batch():
        nonlocal seen
        written = ingest_frame(rest, TXN, table)
        now = spark.table(table).count()
        assert written == 600 == now - seen  # rows written are rows visible
        seen = now

    def stream():
        nonlocal seen
        _drain(spark, src, table, fresh_path(spark, "cp"))
        now = spark.table(table).count()
        assert now - seen == 400
        seen = now

    for step in (batch, stream) if order == "batch first" else (stream, batch):
        step()
    got = spark.table(table).drop("_ingestion_ts", "_batch")
    assert rows(got) == rows(parse_records(raw, TXN.schema).drop("_ingestion_ts"))
    batch()
    assert spark.table(table).count() == 1600


def test_restart_after_a_failed_batch_neither_loses_nor_doubles(spark, monkeypatch):
    import ledgerspark.streaming.ingest as streaming
    from pyspark.errors import StreamingQueryException

    txn = fixtures.flagged_transactions(fixtures.load(spark, SF_SMALL, "events"))
    src, cp = fresh_path(spark, "dump"), fresh_path(spark, "cp")
    fixtures.kafka_records(txn).write.parquet(src)
    table = f"{scratch_database(spark)}.{TXN.table}"
    land, calls = streaming.append_bronze, []

    def dies_after_writing(df, *args, **kw):
        calls.append(kw["batch"])
        land(df, *args, **kw)
        if len(calls) == 1:
            raise RuntimeError("lost before the checkpoint knew")

    monkeypatch.setattr(streaming, "append_bronze", dies_after_writing)
    with pytest.raises(StreamingQueryException):
        _drain(spark, src, table, cp)
    assert spark.table(table).count() == 1000  # written, but not committed
    _drain(spark, src, table, cp)
    assert calls[0] == calls[1]  # the same batch again
    assert spark.table(table).count() == 1000
    # a new checkpoint is another ingest: its batch 0 replaces nothing
    _drain(spark, src, table, fresh_path(spark, "cp"))
    assert spark.table(table).count() == 2000 and len(set(calls)) == 2


def test_table_of_a_file_sink_is_refused(spark):
    src = fresh_path(spark, "dump")
    raw = fixtures.kafka_records(fixtures.flagged_transactions(fixtures.load(spark, SF_SMALL, "events"))).limit(10)
    raw.write.parquet(src)
    table = f"{scratch_database(spark)}.{TXN.table}"
    parsed = parse_records(file_source(spark, src), TXN.schema)
    q = parsed.writeStream.option("checkpointLocation", fresh_path(spark, "cp")).trigger(availableNow=True).toTable(table)
    q.awaitTermination()
    with pytest.raises(RuntimeError, match="streaming file sink"):
        ingest_frame(raw, TXN, table)
    with pytest.raises(RuntimeError, match="streaming file sink"):
        start_stream(file_source(spark, src), TXN, table, fresh_path(spark, "cp"))


def test_appending_to_a_table_without_the_batch_column(spark):
    table = f"{scratch_database(spark)}.t"
    df = txn_rows(spark, [{}, {}])
    df.write.saveAsTable(table)
    append_bronze(df, table)
    assert spark.table(table).count() == 4
    with pytest.raises(RuntimeError, match="_batch"):
        append_bronze(df, table, batch="stream-x-0")


def test_credentials_are_escaped():
    env = {"KAFKA_BOOTSTRAP_SERVERS": "b", "KAFKA_USERNAME": 'u"x', "KAFKA_PASSWORD": 'p\\q"'}
    jaas = kafka_options(env=env)["kafka.sasl.jaas.config"]
    assert jaas.endswith(r'username="u\"x" password="p\\q\"";')


def test_iceberg_settings_come_from_the_environment_only():
    from ledgerspark.session import iceberg_conf

    with pytest.raises(ValueError, match="ICEBERG_WAREHOUSE"):
        iceberg_conf(env={})
    plain = iceberg_conf("lake", env={"ICEBERG_WAREHOUSE": "s3://b/w"})
    assert plain == {
        "spark.sql.extensions": "org.apache.iceberg.spark.extensions.IcebergSparkSessionExtensions",
        "spark.sql.catalog.lake": "org.apache.iceberg.spark.SparkCatalog",
        "spark.sql.defaultCatalog": "lake",
        "spark.sql.catalog.lake.warehouse": "s3://b/w",
    }
    full = iceberg_conf(
        env={
            "ICEBERG_WAREHOUSE": "w",
            "ICEBERG_CATALOG_IMPL": "x.Catalog",
            "ICEBERG_CATALOG_URI": "http://c/api",
            "ICEBERG_CATALOG_REF": "main",
            "ICEBERG_IO_IMPL": "x.IO",
            "S3_ENDPOINT": "http://s",
            "S3_REGION": "r",
            "S3_ACCESS_KEY": "a",
            "S3_SECRET_KEY": "k",
        }
    )
    own = {k.removeprefix("spark.sql.catalog.lakehouse."): v for k, v in full.items() if k.startswith("spark.sql.catalog.lakehouse.")}
    assert own == {
        "warehouse": "w",
        "catalog-impl": "x.Catalog",
        "uri": "http://c/api",
        "ref": "main",
        "io-impl": "x.IO",
        "s3.endpoint": "http://s",
        "s3.region": "r",
        "s3.access-key-id": "a",
        "s3.secret-access-key": "k",
        "s3.path-style-access": "true",
    }
    assert full["spark.hadoop.fs.s3a.endpoint"] == "http://s" and full["spark.hadoop.fs.s3a.secret.key"] == "k"
