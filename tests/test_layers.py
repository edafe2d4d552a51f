"""Compaction, row checks of streams, the offset ledger, gold, newest days."""

import json
import os

import pytest
from pyspark.sql import functions as F

from frames import rows, txn_rows
from paths import SF_SMALL
from ledgerspark import operators as op
from ledgerspark.functions import with_typed
from ledgerspark.plans import gold
from ledgerspark.plans.registry import scratch_database
from ledgerspark.plans.silver import listed_days, newest_volume_daily, write_silver
from ledgerspark.session import fresh_path
from ledgerspark.sources import fixtures, shared_fs
from ledgerspark.sources.bronze import append_bronze, create_bronze
from ledgerspark.sources.compaction import Manifest, compact, live, location, manifest, partitions, settle
from ledgerspark.sources.offsets import DumpSource, KafkaSource, Ledger, bounded, ends, ingest_kafka_new, ingest_new
from ledgerspark.sources.schemas import TOPICS
from ledgerspark.streaming.ingest import RowCheck, await_streams, file_source, start_stream, stream_batch

TXN = TOPICS["finacle-transactions"]


def messages(spark):
    return fixtures.kafka_records(fixtures.flagged_transactions(fixtures.load(spark, SF_SMALL, "events")))


def numbered(spark, lo, hi):
    return txn_rows(spark, [{"narration": str(i)} for i in range(lo, hi)])


def narrations(df):
    return sorted(int(r.narration) for r in df.select("narration").collect())


def new_table(spark):
    table = f"{scratch_database(spark)}.t"
    create_bronze(spark, numbered(spark, 0, 1).schema, table)
    return table


# --- small files


def test_a_file_is_created_once(spark):
    path = fresh_path(spark, "fs") + "/a/b.json"
    assert not shared_fs.exists(spark, path) and shared_fs.names(spark, path) == []
    assert shared_fs.create_json(spark, path, {"x": [1, "é"]})
    assert not shared_fs.create_json(spark, path, {"x": 2})
    assert shared_fs.read_json(spark, path) == {"x": [1, "é"]}
    assert shared_fs.names(spark, os.path.dirname(path)) == ["b.json"]
    assert shared_fs.delete(spark, path) and not shared_fs.exists(spark, path)


# --- compaction


def test_manifest_remembers_ranges_not_names():
    m = Manifest()
    for n in [*range(0, 500), *range(600, 1000), 550]:
        m.add(stream_batch("q", n))
    m.add("batch-" + "0" * 32)
    m.add("merged-1-ab")
    m.add("mine")
    m.add("mine")
    assert m.ranges == {"stream-q": [[0, 499], [550, 550], [600, 999]]} and m.names == ["mine"]
    assert m.holds(stream_batch("q", 499)) and not m.holds(stream_batch("q", 500)) and not m.holds(stream_batch("p", 1))
    assert m.holds("mine") and not m.holds("batch-" + "0" * 32)


def test_partitions_stay_bounded(spark):
    table = new_table(spark)
    most, fan = 0, 4
    for n in range(41):
        append_bronze(numbered(spark, 3 * n, 3 * n + 3), table, batch=stream_batch("q", n))
        compact(spark, table, fan_in=fan)
        most = max(most, len(partitions(spark, table)))
    assert most <= 3 * (fan - 1) + 2  # three tiers, the newest batch, the one before
    assert narrations(spark.table(table)) == narrations(live(spark, table)) == list(range(123))
    files = [f for f in spark.table(table).inputFiles()]
    assert len(files) <= 2 * len(partitions(spark, table))
    m = manifest(spark, table)
    assert len(m.ranges["stream-q"]) == 1
    assert sum(e["rows"] for e in m.merged.values()) == 3 * (m.ranges["stream-q"][0][1] + 1)
    # folders of replaced partitions are gone
    root = location(spark, table)
    held = {n for n in shared_fs.names(spark, root) if n.startswith("_batch=")}
    held |= {f"_batch={n}" for n in shared_fs.names(spark, f"{root}/_compaction/data")}
    assert {h for h in held} == {f"_batch={b}" for b in partitions(spark, table)}


def test_a_repeated_old_batch_changes_nothing(spark):
    table = new_table(spark)
    for n in range(5):
        append_bronze(numbered(spark, n, n + 1), table, batch=stream_batch("q", n))
    assert len(compact(spark, table, fan_in=4)) == 1
    assert len(partitions(spark, table)) == 2  # the newest batch may still be repeated
    append_bronze(numbered(spark, 0, 1), table, batch=stream_batch("q", 0))
    append_bronze(numbered(spark, 4, 5), table, batch=stream_batch("q", 4))
    assert narrations(spark.table(table)) == [0, 1, 2, 3, 4]


def test_rows_are_there_once_at_every_moment(spark):
    table = new_table(spark)
    for n in range(6):
        append_bronze(numbered(spark, n, n + 1), table)
    whole = list(range(6))
    made = compact(spark, table, fan_in=6, crash_before_swap=True)
    # committed, the catalog knows nothing yet
    assert len(partitions(spark, table)) == 6 and narrations(live(spark, table)) == whole
    assert narrations(spark.table(table)) == whole
    # half of the swap
    path = manifest(spark, table).merged[made[0]]["path"]
    spark.sql(f"ALTER TABLE {table} ADD PARTITION (_batch='{made[0]}') LOCATION '{path}'")
    spark.catalog.refreshTable(table)
    assert narrations(live(spark, table)) == whole and spark.table(table).count() == 12
    settle(spark, table)
    assert partitions(spark, table) == made
    assert narrations(spark.table(table)) == narrations(live(spark, table)) == whole
    settle(spark, table)
    assert compact(spark, table, fan_in=6) == []


def test_two_compactions_at_once(spark, monkeypatch):
    import ledgerspark.sources.compaction as compaction

    table = new_table(spark)
    for n in range(4):
        append_bronze(numbered(spark, n, n + 1), table)
    create, seen = shared_fs.create_json, []

    def late(s, path, value):
        if not seen:
            seen.append(path)
            monkeypatch.setattr(compaction.shared_fs, "create_json", create)
            assert len(compact(spark, table, fan_in=4)) == 1  # the other one commits first
        return create(s, path, value)

    monkeypatch.setattr(compaction.shared_fs, "create_json", late)
    assert compact(spark, table, fan_in=4) == []
    assert narrations(spark.table(table)) == [0, 1, 2, 3]
    assert len(shared_fs.names(spark, f"{location(spark, table)}/_compaction/data")) == 1


def test_only_given_partitions_are_merged(spark):
    table = new_table(spark)
    for n in range(4):
        append_bronze(numbered(spark, n, n + 1), table, batch=f"b{n}")
    assert compact(spark, table, fan_in=3, only={"b0", "b1"}) == []
    compact(spark, table, fan_in=2, only={"b0", "b1"})
    assert {"b2", "b3"} <= set(partitions(spark, table)) and len(partitions(spark, table)) == 3
    with pytest.raises(ValueError):
        compact(spark, table, fan_in=1)


def test_reading_a_table_without_batches(spark):
    table = f"{scratch_database(spark)}.plain"
    numbered(spark, 0, 2).write.saveAsTable(table)
    assert live(spark, table).count() == 2


# --- streams


def test_stream_compacts_and_counts(spark):
    raw = messages(spark)
    src = fresh_path(spark, "dump")
    raw.repartition(10, "offset").write.parquet(src)
    table = f"{scratch_database(spark)}.{TXN.table}"
    check = RowCheck(spark)
    spark.streams.addListener(check)
    try:
        q = start_stream(
            file_source(spark, src, 1), TXN, table, fresh_path(spark, "cp"), trigger={"availableNow": True}, compact_every=3
        )
        check.watch(q, table)
        await_streams([q], check=check)
    finally:
        spark.streams.removeListener(check)
    assert live(spark, table).count() == 1000
    assert len(partitions(spark, table)) < 8
    assert not check.problems and not check.read


def test_lost_rows_are_raised(spark, monkeypatch):
    import ledgerspark.streaming.ingest as streaming

    src = fresh_path(spark, "dump")
    messages(spark).repartition(3, "offset").write.parquet(src)
    table = f"{scratch_database(spark)}.{TXN.table}"
    land = streaming.append_bronze
    # rows are read, counted and lost on their way into the table
    monkeypatch.setattr(streaming, "append_bronze", lambda df, *a, **kw: land(df.where("txn_id > 'TXN000000000100'"), *a, **kw))
    check = RowCheck(spark)
    spark.streams.addListener(check)
    try:
        q = start_stream(file_source(spark, src, 1), TXN, table, fresh_path(spark, "cp"), trigger={"availableNow": True})
        check.watch(q, table)
        with pytest.raises(RuntimeError, match="the table holds"):
            await_streams([q], check=check)
    finally:
        spark.streams.removeListener(check)
    assert not q.isActive


# --- offsets


def test_bounds_are_half_open(spark):
    raw = messages(spark)
    got = bounded(raw, {"0": 8, "1": 1}, {"0": 24, "1": 17, "2": 10})
    found = {}
    for r in got.select("partition", "offset").collect():
        found.setdefault(r.partition, []).append(r.offset)
    assert {p: sorted(o) for p, o in found.items()} == {0: [8, 16], 1: [1, 9], 2: [2]}
    assert ends(got) == {"0": 17, "1": 10, "2": 3}


def test_ledger_ingests_each_message_once(spark, monkeypatch):
    import ledgerspark.sources.offsets as offsets

    raw = messages(spark)
    src = fresh_path(spark, "dump")
    raw.where("offset < 400").write.parquet(src)
    table = f"{scratch_database(spark)}.{TXN.table}"
    folder = fresh_path(spark, "ledger")
    ledger = lambda: Ledger(spark, folder, TXN.name)  # noqa: E731  a new process each time
    source = DumpSource(lambda: spark.read.parquet(src))

    assert ledger().position() == {}
    assert ingest_new(source, TXN, table, ledger()) == 400
    assert ingest_new(source, TXN, table, ledger()) == 0
    assert ledger().position() == {str(p): 392 + p + 1 for p in range(8)}

    # written, but the run was not marked; meanwhile more messages arrive
    raw.where("offset >= 400 and offset < 700").write.mode("append").parquet(src)
    monkeypatch.setattr(offsets.Ledger, "finish", lambda self, run, n: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        ingest_new(source, TXN, table, ledger())
    monkeypatch.undo()
    raw.where("offset >= 700").write.mode("append").parquet(src)
    assert spark.table(table).count() == 700
    assert ingest_new(source, TXN, table, ledger()) == 300  # the same run again, no more
    assert spark.table(table).count() == 700
    assert ingest_new(source, TXN, table, ledger()) == 300
    assert ingest_new(source, TXN, table, ledger()) == 0
    assert spark.table(table).count() == 1000
    # a message that was ingested is not read again: only the last run's range reaches the scan
    plan = source.read({"0": 5}, {"0": 9})._jdf.queryExecution().toString()
    assert "PushedFilters: [" in plan and "offset" in plan.split("PushedFilters: [")[1].split("]")[0]


def test_a_run_that_was_compacted_before_it_was_marked(spark):
    raw = messages(spark)
    table = f"{scratch_database(spark)}.{TXN.table}"
    ledger = Ledger(spark, fresh_path(spark, "ledger"), TXN.name)
    ledger.plan(lambda start: ends(raw))
    for n in range(2):
        append_bronze(numbered(spark, n, n + 1).drop("_ingestion_ts"), table, batch=f"offsets-{TXN.name}-{n + 1:010d}")
    compact(spark, table, fan_in=2)
    assert ingest_new(DumpSource(lambda: raw), TXN, table, ledger) == 0
    assert spark.table(table).count() == 2 and len(ledger.position()) == 8


def test_kafka_bounds_name_partitions_and_offsets(spark, monkeypatch):
    import ledgerspark.sources.offsets as offsets

    asked = []
    raw = messages(spark)

    def read(s, options, topic, streaming=False, partitions=None):
        asked.append((options, partitions))
        return raw

    monkeypatch.setattr(offsets, "read_kafka", read)
    source = KafkaSource(spark, {"kafka.bootstrap.servers": "b"}, "t")
    source.latest({})
    source.latest({"0": 7})
    source.read({"0": 7}, {"0": 9, "1": 3})
    assert asked[0] == ({"kafka.bootstrap.servers": "b", "startingOffsets": "earliest"}, None)
    assert asked[1][1] == ["0"] and json.loads(asked[1][0]["startingOffsets"]) == {"t": {"0": 7}}
    assert asked[1][0]["endingOffsets"] == "latest"
    assert asked[2][1] == ["0", "1"] and json.loads(asked[2][0]["startingOffsets"]) == {"t": {"0": 7, "1": -2}}
    assert json.loads(asked[2][0]["endingOffsets"]) == {"t": {"0": 9, "1": 3}}
    with pytest.raises(ValueError, match="file format"):
        ingest_kafka_new(spark, {}, "x", fmt="iceberg")


# --- gold


def test_gold_equals_the_reports_after_each_increment(spark):
    txn = fixtures.transactions(fixtures.load(spark, SF_SMALL, "events"))
    db = scratch_database(spark)
    bronze = f"{db}.bronze_txn"
    part = F.pmod(F.xxhash64("txn_id"), F.lit(5))
    for k in range(5):
        append_bronze(txn.where(part == k), bronze)
        assert gold.refresh(spark, bronze, db, merge_at=3) > 0
        so_far = spark.table(bronze).drop("_batch")
        for name, of in (
            ("kpi_overall", op.kpi_overall),
            ("volume_daily", op.volume_daily),
            ("volume_hourly", op.volume_hourly),
            ("pattern_channel", op.pattern_channel),
            ("pattern_txn_type", op.pattern_txn_type),
        ):
            got = getattr(gold, name)(spark, db)
            assert rows(got) == rows(of(so_far)), (k, name)
            assert got.columns == of(so_far).columns
    assert gold.refresh(spark, bronze, db) == 0
    assert len(gold.state(spark, db).updates) < 3


def test_gold_reads_no_bronze(spark):
    txn = fixtures.transactions(fixtures.load(spark, SF_SMALL, "events"))
    db = scratch_database(spark)
    append_bronze(txn, f"{db}.bronze_txn")
    gold.refresh(spark, f"{db}.bronze_txn", db)
    for name in ("kpi_overall", "volume_daily", "volume_hourly", "pattern_channel", "pattern_txn_type"):
        files = getattr(gold, name)(spark, db).inputFiles()
        assert files and not any("bronze_txn" in f for f in files), name


def test_numbers_are_dense_and_kept(spark):
    db = scratch_database(spark)
    bronze = f"{db}.bronze_txn"
    for lo, hi in ((0, 40), (20, 70)):
        append_bronze(
            txn_rows(spark, [{"customer_id": f"C{i}", "account_id": None} for i in range(lo, hi)]).repartition(4), bronze
        )
        gold.refresh(spark, bronze, db)
    ids = sorted(r.id for r in spark.table(f"{db}.ids_customer").collect())
    assert ids == list(range(1, 71))
    assert gold.kpi_overall(spark, db).first().active_customers == 70
    assert gold.kpi_overall(spark, db).first().unique_accounts == 0


def test_a_failed_update_does_not_count(spark, monkeypatch):
    db = scratch_database(spark)
    bronze = f"{db}.bronze_txn"
    append_bronze(txn_rows(spark, [{}] * 3), bronze)
    gold.refresh(spark, bronze, db)
    append_bronze(txn_rows(spark, [{"customer_id": "X"}] * 2), bronze)
    commit = gold._commit
    monkeypatch.setattr(gold, "_commit", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        gold.refresh(spark, bronze, db)
    assert gold.kpi_overall(spark, db).first().total_transactions == 3
    monkeypatch.setattr(gold, "_commit", commit)
    assert gold.refresh(spark, bronze, db) == 2
    found = gold.kpi_overall(spark, db).first()
    assert (found.total_transactions, found.active_customers) == (5, 2)


def test_gold_over_compacted_bronze(spark):
    db = scratch_database(spark)
    bronze = f"{db}.bronze_txn"
    for n in range(3):
        append_bronze(txn_rows(spark, [{}] * 2), bronze)
    gold.refresh(spark, bronze, db)
    append_bronze(txn_rows(spark, [{}] * 2), bronze)
    assert len(gold.compact_covered(spark, bronze, db, fan_in=3)) == 1
    assert gold.refresh(spark, bronze, db) == 2
    assert gold.kpi_overall(spark, db).first().total_transactions == 8
    # merged before gold had taken it in: noticed, not lost in silence
    for n in range(2):
        append_bronze(txn_rows(spark, [{}]), bronze)
    compact(spark, bronze, fan_in=2)
    append_bronze(txn_rows(spark, [{}]), bronze)
    with pytest.raises(RuntimeError, match="would hold"):
        gold.refresh(spark, bronze, db)


def test_empty_gold(spark):
    db = scratch_database(spark)
    bronze = f"{db}.bronze_txn"
    create_bronze(spark, txn_rows(spark, [{}]).schema, bronze)
    assert gold.refresh(spark, bronze, db) == 0


# --- newest days of silver


def day_filters(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [p.split("]")[0] for p in plan.split("PartitionFilters: [")[1:]]


def test_newest_days_are_chosen_from_the_listing(spark):
    txn = fixtures.transactions(fixtures.load(spark, SF_SMALL, "events"))
    path = fresh_path(spark, "silver")
    write_silver(txn, path)
    listed = listed_days(spark, path)
    assert listed == sorted({str(r[0]) for r in with_typed(txn).select("_day").collect() if r[0]}, reverse=True)
    for days in (1, 5, 30, 10_000):
        got = newest_volume_daily(spark, path, days=days)
        assert rows(got) == rows(op.volume_daily(txn, days))
    plan = day_filters(newest_volume_daily(spark, path, days=5))
    assert any(listed[4] in p for p in plan)  # nothing older is listed for the scan


def test_days_without_valid_amounts_widen_the_choice(spark):
    made = [{"txn_date": f"2026-01-{d:02d}T10:00:00", "amount": "N/A" if d > 20 else "1.00"} for d in range(1, 31)]
    made.append({"txn_date": "bad"})
    txn = txn_rows(spark, made)
    table = f"{scratch_database(spark)}.silver_txn"
    write_silver(txn, table=table)
    got = newest_volume_daily(spark, table=table, days=4)
    assert rows(got) == rows(op.volume_daily(txn, 4)) and got.count() == 4
    empty = fresh_path(spark, "silver")
    write_silver(txn.where("txn_date = 'bad'"), empty)
    assert newest_volume_daily(spark, empty).count() == 0
