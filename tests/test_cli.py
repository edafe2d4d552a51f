"""The command line over bronze tables written from the given data."""

import pytest

from paths import SF_SMALL
from ledgerspark.__main__ import main
from ledgerspark.plans.registry import bronze_frames, scratch_database
from ledgerspark.session import fresh_path
from ledgerspark.sources.bronze import append_bronze


@pytest.fixture(scope="module")
def db(spark):
    name = scratch_database(spark)
    for table, frame in bronze_frames(spark, SF_SMALL).items():
        append_bronze(frame, f"{name}.{table}")
    return name


def test_report_sections(spark, db, capsys):
    assert main(["report", "--database", db, "--section", "risk"], spark=spark) == 0
    out = capsys.readouterr().out
    assert "risk_structuring" in out and "risk_high_velocity" in out
    assert main(["report", "--database", db], spark=spark) == 0
    assert "kpi_overall" in capsys.readouterr().out


def test_report_exit_codes(spark, db):
    assert main(["report", "--database", db, "--section", "counts_v0"], spark=spark) == 1
    assert main(["report", "--database", "no_such_db"], spark=spark) == 1
    assert main(["report", "--database", db, "--catalog", "no_such_catalog"], spark=spark) == 1
    assert main(["report", "--database", db, "--catalog", "spark_catalog", "--section", "kpi"], spark=spark) == 0


def test_silver_command(spark, db):
    path = fresh_path(spark, "silver-cli")
    assert main(["silver", "--table", f"{db}.finacle_transactions", "--path", path], spark=spark) == 0
    assert spark.read.parquet(path).count() == 1000


def test_ingest_without_broker_settings_fails_cleanly(spark, monkeypatch):
    monkeypatch.delenv("KAFKA_BOOTSTRAP_SERVERS", raising=False)
    assert main(["ingest", "--topic", "finacle-transactions"], spark=spark) == 2
    monkeypatch.setenv("KAFKA_BOOTSTRAP_SERVERS", "localhost:9")
    assert main(["ingest", "--topic", "nope"], spark=spark) == 1


def test_publish_reaches_the_kafka_writer(spark, db, monkeypatch, caplog):
    monkeypatch.setenv("KAFKA_BOOTSTRAP_SERVERS", "localhost:9")
    # no connector jar here: everything up to the sink runs, the sink itself is missing
    assert main(["publish", "--table", f"{db}.finacle_transactions"], spark=spark) == 2
    assert "kafka" in caplog.text.lower() and "data source" in caplog.text.lower()


def test_incremental_ingest_reads_only_new_messages(spark, monkeypatch):
    import os

    import ledgerspark.streaming.ingest as streaming
    from ledgerspark.sources import fixtures
    from ledgerspark.streaming.ingest import file_source

    events = fixtures.load(spark, SF_SMALL, "events")
    dump = fresh_path(spark, "dump")
    txn = fixtures.flagged_transactions(events)
    fixtures.kafka_records(txn).write.parquet(dump)
    monkeypatch.setattr(streaming, "read_kafka", lambda s, o, name, streaming=False: file_source(s, dump))
    monkeypatch.setenv("KAFKA_BOOTSTRAP_SERVERS", "localhost:9")
    db, cp = scratch_database(spark), fresh_path(spark, "cp")
    args = ["ingest", "--mode", "incremental", "--topic", "finacle-transactions", "--database", db, "--checkpoint-root", cp]
    assert main(args, spark=spark) == 0
    assert main(args, spark=spark) == 0  # nothing new: nothing appended
    fixtures.kafka_records(txn.limit(7)).write.mode("append").parquet(dump)
    assert main(args, spark=spark) == 0
    assert spark.table(f"{db}.finacle_transactions").count() == 1007
    assert os.listdir(cp.replace("file:", "")) == ["finacle-transactions"]


def test_stream_modes_need_a_lasting_checkpoint(spark, monkeypatch, caplog):
    from ledgerspark.__main__ import checkpoint_root

    monkeypatch.setenv("KAFKA_BOOTSTRAP_SERVERS", "localhost:9")
    if not spark.sparkContext.getConf().get("spark.checkpoint.dir", None):
        for mode in ("incremental", "streaming"):
            assert main(["ingest", "--mode", mode, "--topic", "finacle-transactions"], spark=spark) == 2
        assert "checkpoint" in caplog.text
    assert checkpoint_root(spark, "/shared/cp") == "/shared/cp"


def test_ingest_into_a_chosen_catalog_and_database(spark, monkeypatch):
    import ledgerspark.sources.bronze as bronze
    from ledgerspark.sources import fixtures

    dump = fresh_path(spark, "dump")
    fixtures.kafka_records(fixtures.flagged_transactions(fixtures.load(spark, SF_SMALL, "events"))).write.parquet(dump)
    monkeypatch.setattr(bronze, "read_kafka", lambda s, o, name, streaming=False: s.read.parquet(dump))
    monkeypatch.setenv("KAFKA_BOOTSTRAP_SERVERS", "localhost:9")
    args = ["ingest", "--topic", "finacle-transactions", "--catalog"]
    name = scratch_database(spark)
    spark.sql(f"DROP NAMESPACE {name}")  # the command creates it
    assert main([*args, "spark_catalog", "--database", name], spark=spark) == 0
    assert spark.table(f"spark_catalog.{name}.finacle_transactions").count() == 1000
    assert main([*args, "no_such_catalog"], spark=spark) == 1
    spark.sql(f"DROP NAMESPACE {name} CASCADE")


def test_table_properties_reach_the_iceberg_writer(spark, monkeypatch):
    import ledgerspark.sources.bronze as bronze

    seen = {}

    class Writer:
        def tableProperty(self, k, v):  # noqa: N802
            seen[k] = v
            return self

        def using(self, fmt):
            seen["using"] = fmt
            return self

        def create(self):
            seen["created"] = True

    df = spark.range(1)
    monkeypatch.setattr(type(df), "writeTo", lambda self, table: Writer())
    bronze.append_bronze(df, "no_such_db.t", fmt="iceberg", properties={"write.target-file-size-bytes": "1"})
    assert seen["using"] == "iceberg" and seen["created"] and seen["format-version"] == "2"
    assert seen["write.target-file-size-bytes"] == "1"


def test_launcher_runs_the_documented_command(tmp_path):
    import os
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    submit = os.path.join(os.path.dirname(__import__("pyspark").__file__), "bin", "spark-submit")
    done = subprocess.run(
        [submit, "--master", "local[1]", "--conf", "spark.ui.enabled=false", os.path.join(root, "run_ledgerspark.py"),
         "report", "--database", "no_such_db"],
        cwd=tmp_path, env=os.environ | {"PYSPARK_PYTHON": sys.executable, "PYSPARK_DRIVER_PYTHON": sys.executable},
        capture_output=True, text=True, timeout=300,
    )
    assert done.returncode == 1 and "no_such_db" in done.stdout + done.stderr


def test_bounded_ingest_then_gold_then_compaction(spark, monkeypatch):
    import ledgerspark.sources.offsets as offsets
    from ledgerspark.plans import gold
    from ledgerspark.sources import fixtures
    from ledgerspark.sources.compaction import partitions

    dump, ledger = fresh_path(spark, "dump"), fresh_path(spark, "ledger")
    raw = fixtures.kafka_records(fixtures.flagged_transactions(fixtures.load(spark, SF_SMALL, "events")), broken=False)

    def read(s, options, name, streaming=False, partitions=None):
        return s.read.parquet(dump)

    monkeypatch.setattr(offsets, "read_kafka", read)
    # what the broker would do with the offsets in the options
    monkeypatch.setattr(
        offsets.KafkaSource, "read", lambda self, start, end: offsets.bounded(read(spark, {}, self.topic), start, end)
    )
    monkeypatch.setenv("KAFKA_BOOTSTRAP_SERVERS", "localhost:9")
    db = scratch_database(spark)
    table = f"{db}.finacle_transactions"
    args = ["ingest", "--mode", "bounded", "--topic", "finacle-transactions", "--database", db, "--ledger", ledger]
    for k in range(3):
        raw.where(f"offset % 3 = {k}").write.mode("append" if k else "overwrite").parquet(dump)
        if k == 1:  # offsets rise with time in a topic: let the rest wait for its turn
            break
    assert main(args, spark=spark) == 0
    first = spark.table(table).count()
    assert main(args, spark=spark) == 0 and spark.table(table).count() == first > 0
    assert main(["gold", "--table", table, "--gold", db], spark=spark) == 0
    assert gold.kpi_overall(spark, db).first().total_transactions == first
    for n in range(20):
        append_bronze(spark.table(table).drop("_batch").limit(1), table)
    assert main(["compact", "--table", table, "--gold", db], spark=spark) == 0
    assert len(partitions(spark, table)) == 21  # gold has one of them
    assert main(["gold", "--table", table, "--gold", db], spark=spark) == 0
    assert main(["compact", "--table", table, "--gold", db], spark=spark) == 0
    assert len(partitions(spark, table)) == 1 and spark.table(table).count() == first + 20
    assert gold.kpi_overall(spark, db).first().total_transactions == first + 20
