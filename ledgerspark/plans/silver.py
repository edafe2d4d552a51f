"""Typed silver layer: bronze rows plus their parsed columns, stored once.

Bronze keeps text, so every analytic re-parses amounts and dates and its
filters (``try_cast(...) IS NOT NULL``, ``upper(trim(channel)) = 'CASH'``)
cannot reach the Parquet reader.  Silver stores ``_amt``, ``_tts``, ``_chn``
and ``_day`` next to the text columns; the analytics pick them up unchanged
(``functions.with_typed`` only adds what is missing), so their filters become
plain column predicates pushed to the scan, and the ``_day`` partitioning
lets day filters skip whole folders.

Rows are rebalanced by day before the write, so a day is written by few tasks
into few files; a day that holds a third of all rows is split over tasks by
AQE (rebalanced partitions may be divided, unlike hash partitions).

``mode="append"`` adds rows.  ``mode="refresh"`` replaces the days present in
the given rows and leaves the others alone, so a repeated run changes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerspark.functions import with_typed
from ledgerspark.operators.volume import volume_daily
from ledgerspark.sources import shared_fs
from ledgerspark.sources.catalog import table_exists

PARTITION_COLUMN = "_day"


def to_silver(bronze: DataFrame) -> DataFrame:
    return with_typed(bronze)


def write_silver(
    bronze: DataFrame,
    path: str | None = None,
    mode: str = "append",
    max_records_per_file: int = 5_000_000,
    table: str | None = None,
) -> None:
    """Write the silver layer to ``path``, or as catalog ``table`` (e.g.
    ``silver.finacle_transactions``; stored at ``path`` when both are given).

    ``append`` adds a new batch of bronze rows; re-appending the same rows
    duplicates them, as in bronze.  ``refresh`` replaces every day that occurs
    in ``bronze`` (give it whole days)."""
    if not path and not table:
        raise ValueError("write_silver needs a path or a table")
    if mode not in ("append", "refresh"):
        raise ValueError(f"unknown mode {mode!r}")
    spark = bronze.sparkSession
    rows = to_silver(bronze)
    rows = rows.select(*[c for c in rows.columns if c not in (PARTITION_COLUMN, "_batch")], PARTITION_COLUMN)
    rows = rows.hint("rebalance", PARTITION_COLUMN).sortWithinPartitions(PARTITION_COLUMN, "_chn")
    w = rows.write.format("parquet").option("maxRecordsPerFile", str(max_records_per_file))
    setting = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "dynamic")  # an overwrite touches the days it holds only
    try:
        if table and mode == "refresh" and table_exists(spark, table):
            w.mode("overwrite").insertInto(table)
            return
        w = w.mode("overwrite" if mode == "refresh" and not table else "append").partitionBy(PARTITION_COLUMN)
        if table:
            (w.option("path", path) if path else w).saveAsTable(table)
        else:
            w.save(path)
    finally:
        spark.conf.set(setting, before)


def read_silver(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def listed_days(spark: SparkSession, path: str | None = None, table: str | None = None) -> list[str]:
    """The days a silver layer has, newest first, from its partition listing:
    one name for each day, no file is opened.  Rows without a day are not in it."""
    if table:
        found = [r[0].split("=", 1)[1] for r in spark.sql(f"SHOW PARTITIONS {table}").collect()]
    else:
        found = [n.split("=", 1)[1] for n in shared_fs.names(spark, path) if n.startswith(f"{PARTITION_COLUMN}=")]
    return sorted((d for d in found if d[:1].isdigit()), reverse=True)


def newest_volume_daily(
    spark: SparkSession, path: str | None = None, table: str | None = None, days: int = 30
) -> DataFrame:
    """``operators.volume_daily`` over a silver layer, reading the newest days
    only.

    The days come from the partition listing.  A day may hold no transaction
    that counts (no valid amount), so the choice is widened, doubling, until
    ``days`` days count or all are chosen; usually the first one does.
    """
    listed = listed_days(spark, path, table)
    silver = spark.table(table) if table else read_silver(spark, path)
    take = days
    while True:
        chosen = silver.where(F.col(PARTITION_COLUMN) >= F.lit(listed[:take][-1]).cast("date")) if listed else silver
        if take >= len(listed):
            break
        counts = chosen.where(F.col("_amt").isNotNull() & F.col("_tts").isNotNull())
        if counts.select(PARTITION_COLUMN).distinct().count() >= days:
            break
        take *= 2
    return volume_daily(chosen, days)
