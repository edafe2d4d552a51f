"""Command line: ``spark-submit run_ledgerspark.py <command>`` or ``python -m ledgerspark``.

    ingest  [--topic T] [--mode batch|bounded|incremental|streaming] [--checkpoint-root DIR]
            [--ledger DIR] [--compact-every N]
            [--catalog NAME] [--database bronze] [--format parquet]
            [--property KEY=VALUE ...]
            [--max-offsets-per-trigger N] [--min-partitions N]
    report  [--section kpi|volume|pattern|risk|counts|txn|risk_tables] [--database bronze]
            [--catalog NAME]
    publish --table DB.TABLE        flag rule + alerts, published to both topics
    silver  --table DB.TABLE [--path DIR] [--table-out DB.TABLE] [--mode append|refresh]
    compact --table DB.TABLE [--gold DB]    merge closed bronze batches
    gold    --table DB.TABLE [--gold DB]    take new bronze batches into gold

The stream modes need a checkpoint folder that outlives the process:
``--checkpoint-root``, or ``spark.checkpoint.dir``.
Kafka connection settings come from the environment (see
``sources.kafka.kafka_options``).  Exit codes: 0 done (or nothing to do),
1 missing catalog object or unknown topic/section, 2 any other failure.
"""

from __future__ import annotations

import argparse
import logging
import os
import sys

from pyspark.sql import SparkSession

log = logging.getLogger("ledgerspark")


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="ledgerspark")
    sub = p.add_subparsers(dest="command", required=True)

    ing = sub.add_parser("ingest", help="Kafka topics -> bronze tables")
    ing.add_argument("--topic", default=os.environ.get("KAFKA_TOPIC") or None)
    # batch: bounded re-read from the earliest offsets (re-runs append again);
    # bounded: a batch between the offsets of a ledger and the present end;
    # incremental: drain only what arrived since the last run, then stop;
    # streaming: run until stopped
    ing.add_argument("--mode", choices=["batch", "bounded", "incremental", "streaming"], default="batch")
    ing.add_argument("--checkpoint-root", default=None)
    ing.add_argument("--ledger", default=None, help="folder of the offset ledger (bounded mode)")
    ing.add_argument("--compact-every", type=int, default=None, help="merge a stream's closed batches")
    ing.add_argument("--catalog", default=None)
    ing.add_argument("--database", default="bronze")
    ing.add_argument("--format", default="parquet")
    # table properties of a new Iceberg table
    ing.add_argument("--property", action="append", default=[], metavar="KEY=VALUE")
    ing.add_argument("--max-offsets-per-trigger", type=int, default=None)
    ing.add_argument("--min-partitions", type=int, default=None)

    rep = sub.add_parser("report", help="run analytics sections over bronze tables")
    rep.add_argument("--section", default=None)
    rep.add_argument("--database", default="bronze")
    rep.add_argument("--catalog", default=None)

    pub = sub.add_parser("publish", help="flag a transactions table, publish it and its alerts")
    pub.add_argument("--table", required=True)

    sil = sub.add_parser("silver", help="write the typed silver layer of a transactions table")
    sil.add_argument("--table", required=True)
    sil.add_argument("--path", default=None)
    sil.add_argument("--mode", choices=["append", "refresh"], default="append")
    sil.add_argument("--table-out", default=None, help="catalog table to write, e.g. silver.finacle_transactions")

    com = sub.add_parser("compact", help="merge the closed batches of a bronze table")
    com.add_argument("--table", required=True)
    com.add_argument("--gold", default=None, help="only batches that this gold namespace has taken in")

    gol = sub.add_parser("gold", help="take the new batches of a transactions table into gold")
    gol.add_argument("--table", required=True)
    gol.add_argument("--gold", default="gold")
    return p


def checkpoint_root(spark: SparkSession, given: str | None) -> str:
    """Where the streams keep their progress; an error if that is nowhere
    lasting (a folder of this process would make every run start over)."""
    base = given or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not base:
        raise ValueError("streaming and incremental ingest need --checkpoint-root or spark.checkpoint.dir")
    return given or os.path.join(base, "ingest-checkpoints")


def _ingest(spark: SparkSession, a) -> int:
    from ledgerspark.sources.bronze import create_namespaces, ingest_kafka_batch
    from ledgerspark.sources.catalog import MissingObject, bronze_counts_in, has_catalog
    from ledgerspark.sources.kafka import kafka_options
    from ledgerspark.sources.schemas import select_topics
    from ledgerspark.streaming.ingest import RowCheck, await_streams, start_kafka_streams

    select_topics(a.topic)  # unknown topic: exit 1 before touching the catalog
    if a.catalog and not has_catalog(spark, a.catalog):
        raise MissingObject(f"catalog {a.catalog!r} not found")
    root = checkpoint_root(spark, a.checkpoint_root) if a.mode in ("incremental", "streaming") else None
    ledger = a.ledger or (os.path.join(checkpoint_root(spark, None), "ledger") if a.mode == "bounded" else None)
    opts = kafka_options(max_offsets_per_trigger=a.max_offsets_per_trigger, min_partitions=a.min_partitions)
    create_namespaces(spark, a.catalog, extra=(a.database,))
    database = f"{a.catalog}.{a.database}" if a.catalog else a.database
    if a.mode == "batch":
        properties = dict(p.split("=", 1) for p in a.property)
        written = ingest_kafka_batch(spark, opts, a.topic, database, a.format, properties)
        log.info("rows written: %s", written)
        # verification: total rows per bronze table, one job over all of them
        totals = {r.table_name: r.row_count for r in bronze_counts_in(spark, database, list(written)).toLocalIterator()}
        for table, n in written.items():
            log.info("  %s: %d rows", table, totals.get(table, 0))
            if totals.get(table, 0) < n:
                raise RuntimeError(f"{table} shows {totals.get(table, 0)} rows after {n} were written")
        return 0
    if a.mode == "bounded":
        from ledgerspark.sources.offsets import ingest_kafka_new

        log.info("rows written: %s", ingest_kafka_new(spark, opts, ledger, a.topic, database, a.format))
        return 0
    trigger = {"availableNow": True} if a.mode == "incremental" else None
    check = RowCheck(spark)
    spark.streams.addListener(check)
    try:
        queries = start_kafka_streams(
            spark, opts, root, a.topic, database, a.format, trigger=trigger, compact_every=a.compact_every, check=check
        )
        await_streams(queries, check=check)
    finally:
        spark.streams.removeListener(check)
    return 0


def _report(spark: SparkSession, a) -> int:
    from ledgerspark.plans.sections import BronzeTables, run_sections

    # no section: the four live sections, each failure reported at the end
    run_sections(spark, a.section, BronzeTables(namespace=a.database, catalog=a.catalog))
    return 0


def _publish(spark: SparkSession, a) -> int:
    from ledgerspark import operators as op
    from ledgerspark.sources.kafka import kafka_options, write_kafka
    from ledgerspark.sources.schemas import TOPICS

    opts = kafka_options()
    flagged = op.derive_flag(spark.table(a.table))
    # rows of malformed messages carry no record; there is nothing to publish
    broken = flagged.where("txn_id IS NULL").count()
    if broken:
        log.warning("%d rows without a transaction id are not published", broken)
    flagged = flagged.where("txn_id IS NOT NULL")
    txn, alerts = TOPICS["finacle-transactions"], TOPICS["aml-alerts"]
    write_kafka(op.publish_envelope(flagged, txn.key_field, txn.schema.fieldNames()), opts, txn.name)
    write_kafka(op.publish_envelope(op.derive_aml_alerts(flagged), alerts.key_field), opts, alerts.name)
    return 0


def _silver(spark: SparkSession, a) -> int:
    from ledgerspark.plans.silver import write_silver

    write_silver(spark.table(a.table), a.path, mode=a.mode, table=a.table_out)
    return 0


def _compact(spark: SparkSession, a) -> int:
    from ledgerspark.plans.gold import compact_covered
    from ledgerspark.sources.compaction import compact

    made = compact_covered(spark, a.table, a.gold) if a.gold else compact(spark, a.table)
    log.info("%s: merged into %s", a.table, made or "nothing")
    return 0


def _gold(spark: SparkSession, a) -> int:
    from ledgerspark.plans.gold import refresh
    from ledgerspark.sources.bronze import create_namespaces

    create_namespaces(spark, extra=(a.gold,))
    log.info("%s: %d rows", a.gold, refresh(spark, a.table, a.gold))
    return 0


COMMANDS = {
    "ingest": _ingest,
    "report": _report,
    "publish": _publish,
    "silver": _silver,
    "compact": _compact,
    "gold": _gold,
}


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    from ledgerspark.session import build_session
    from ledgerspark.sources.catalog import MissingObject

    a = _parser().parse_args(argv)
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(levelname)s %(name)s: %(message)s")
    try:
        spark = spark or build_session()
        return COMMANDS[a.command](spark, a)
    except (MissingObject, KeyError) as exc:
        log.error("%s", exc)
        return 1
    except Exception:
        log.exception("failed")
        return 2


if __name__ == "__main__":
    sys.exit(main())
