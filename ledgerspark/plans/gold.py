"""Gold layer: mergeable partial aggregates of the transactions, kept up to
date batch by batch.

Tables of the gold namespace (all partitioned by ``_batch``, an update each):

* ``txn_cells``: per day, hour, channel, type and branch the counts, exact
  money sums, extremes and times.  They add up, so reports sum them.
* ``txn_members``: who occurred, as bitmaps of 32,768 numbers each: every
  customer, every account, and the customers of each day.  Bitmaps of several
  updates are joined by a bitwise or, so distinct counts stay exact.
* ``ids_customer``, ``ids_account``: the number of each customer and account,
  dense from 1, so bitmaps are full ones.

``refresh`` takes in the bronze batches that gold does not cover yet and reads
nothing else of bronze.  What is covered, and which updates count, is said by
a state file that is created last: an update that failed before it leaves
partitions that no report looks at.  After every refresh the rows in gold are
compared with bronze (by the files' footers).  After ``MERGE_AT`` updates
their partial aggregates are merged into one.

One refresh at a time: of two, one fails to create the state file and its
update does not count.
"""

from __future__ import annotations

import logging
import re
import uuid
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerspark.functions import MONEY, money_avg, money_sum, norm, pct_of, txn_hour, with_typed
from ledgerspark.session import fresh_path
from ledgerspark.sources import shared_fs
from ledgerspark.sources.bronze import append_bronze
from ledgerspark.sources.catalog import table_exists
from ledgerspark.sources.compaction import BATCH_COLUMN, Manifest, compact, live, location, partitions

log = logging.getLogger(__name__)

CELLS, MEMBERS = "txn_cells", "txn_members"
DICTIONARIES = {"customer": "customer_id", "account": "account_id"}
KEYS = ("txn_day", "txn_hour", "channel", "txn_type", "branch_code")
MERGE_AT = 16
STATE_FOLDER = "_state"  # under txn_cells


@dataclass
class State:
    """What the reports may read, and which bronze batches that is."""

    generation: int = 0
    updates: list[str] = field(default_factory=list)
    rows: int = 0
    covered: dict = field(default_factory=lambda: asdict(Manifest()))
    unnamed: list[str] = field(default_factory=list)  # covered batches that bronze still lists

    def covers(self, batch: str) -> bool:
        # only covered batches are merged (``compact_covered``)
        return batch.startswith("merged-") or batch in self.unnamed or Manifest(**self.covered).holds(batch)


def state(spark: SparkSession, gold: str = "gold") -> State:
    if not table_exists(spark, f"{gold}.{CELLS}"):
        return State()
    folder = f"{location(spark, f'{gold}.{CELLS}')}/{STATE_FOLDER}"
    files = [n for n in shared_fs.names(spark, folder) if re.fullmatch(r"\d{10}\.json", n)]
    return State(**shared_fs.read_json(spark, f"{folder}/{files[-1]}")) if files else State()


def _commit(spark: SparkSession, gold: str, new: State) -> None:
    folder = f"{location(spark, f'{gold}.{CELLS}')}/{STATE_FOLDER}"
    if not shared_fs.create_json(spark, f"{folder}/{new.generation:010d}.json", asdict(new)):
        raise RuntimeError(f"{gold}: another refresh was first; this one does not count")
    old = f"{folder}/{new.generation - 2:010d}.json"
    if shared_fs.exists(spark, old):
        shared_fs.delete(spark, old)


def _numbered(spark: SparkSession, new: DataFrame, base: int) -> DataFrame:
    """``value`` with ``id``: base + 1, base + 2, ... without gaps.  Each task
    numbers its rows; the rows of the tasks before it are added."""
    path = fresh_path(spark, "gold-new")
    new.withColumn("_place", F.monotonically_increasing_id()).write.parquet(path)
    placed = spark.read.schema("value string, _place long").parquet(path).withColumn("_part", F.shiftright("_place", 33))
    counts = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # one row for each task
    first = counts.select("_part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    inside = F.col("_place").bitwiseAND((1 << 33) - 1)
    return placed.join(F.broadcast(first), "_part").select("value", (F.lit(base + 1) + F.col("first") + inside).alias("id"))


def _dictionary(spark: SparkSession, rows: DataFrame, gold: str, name: str, batch: str) -> DataFrame:
    """The dictionary of a column, with the values that ``rows`` add to it.

    Numbers are given before anything uses them; a number that a failed
    update gave stays given."""
    table, column = f"{gold}.ids_{name}", DICTIONARIES[name]
    seen = rows.where(F.col(column).isNotNull()).select(F.col(column).alias("value")).distinct()
    base = 0
    if table_exists(spark, table):
        known = spark.table(table)
        base = known.agg(F.max("id")).first()[0] or 0
        seen = seen.join(known.select("value"), "value", "left_anti")
    append_bronze(_numbered(spark, seen, base), table, batch=batch)
    return spark.table(table).select("value", "id")


def cells(rows: DataFrame) -> DataFrame:
    """Partial aggregates of bronze or silver transactions."""
    t = with_typed(rows)
    return t.groupBy(
        F.col("_day").alias("txn_day"),
        txn_hour(F.col("_tts")).alias("txn_hour"),
        F.col("_chn").alias("channel"),
        norm("txn_type").alias("txn_type"),
        F.col("branch_code").alias("branch_code"),
    ).agg(
        F.count(F.lit(1)).alias("txn_count"),
        F.count("_amt").alias("amount_count"),
        money_sum("_amt").alias("total_amount"),
        F.min("_amt").alias("min_amount"),
        F.max("_amt").alias("max_amount"),
        F.min("_tts").alias("first_time"),
        F.max("_tts").alias("last_time"),
        F.max("_ingestion_ts").alias("last_ingested"),
    )


def _merged_cells(parts: DataFrame) -> DataFrame:
    return parts.groupBy(*KEYS).agg(
        F.sum("txn_count").alias("txn_count"),
        F.sum("amount_count").alias("amount_count"),
        money_sum("total_amount").alias("total_amount"),
        F.min("min_amount").alias("min_amount"),
        F.max("max_amount").alias("max_amount"),
        F.min("first_time").alias("first_time"),
        F.max("last_time").alias("last_time"),
        F.max("last_ingested").alias("last_ingested"),
    )


def _bitmaps(numbers: DataFrame) -> DataFrame:
    """measure, txn_day, id -> bitmaps; built in each task, then joined."""
    return (
        numbers.withColumn("bucket", F.bitmap_bucket_number("id"))
        .groupBy("measure", "txn_day", "bucket")
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("id")).alias("bits"))
    )


def members(rows: DataFrame, dictionaries: dict[str, DataFrame]) -> DataFrame:
    """The bitmaps of ``rows``.  Rows are first reduced to one for each value
    and day, so a hot customer meets the dictionary once a day."""
    t = with_typed(rows)
    out = None
    for name, column in DICTIONARIES.items():
        daily = name == "customer"
        counted = F.col("_tts").isNotNull() & F.col("_amt").isNotNull() if daily else F.lit(False)
        each = (
            t.where(F.col(column).isNotNull())
            .select(F.col(column).alias("value"), F.when(counted, F.col("_day")).alias("day"))
            .distinct()
            .join(dictionaries[name], "value")
        )
        entries = F.array(F.struct(F.lit(name).alias("measure"), F.lit(None).cast("date").alias("txn_day")))
        by_day = F.array(F.struct(F.lit("day_customer").alias("measure"), F.col("day").alias("txn_day")))
        entries = F.when(F.col("day").isNotNull(), F.concat(entries, by_day)).otherwise(entries)
        made = _bitmaps(each.select("id", F.inline(entries)))
        out = made if out is None else out.unionByName(made)
    return out


def _merged_members(parts: DataFrame) -> DataFrame:
    return parts.groupBy("measure", "txn_day", "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def update(spark: SparkSession, rows: DataFrame, gold: str, batch: str) -> int:
    """Writes the partial aggregates of ``rows`` as ``batch``; their number of
    rows.  Reports see them once a state names the batch."""
    dictionaries = {name: _dictionary(spark, rows, gold, name, batch) for name in DICTIONARIES}
    append_bronze(members(rows, dictionaries), f"{gold}.{MEMBERS}", batch=batch)
    append_bronze(cells(rows), f"{gold}.{CELLS}", batch=batch)
    own = spark.table(f"{gold}.{CELLS}").where(F.col(BATCH_COLUMN) == batch)
    return own.agg(F.sum("txn_count")).first()[0] or 0


def refresh(spark: SparkSession, bronze: str, gold: str = "gold", merge_at: int = MERGE_AT) -> int:
    """Takes the bronze batches in that gold does not cover; their rows.

    A micro-batch that its stream may still repeat is taken in like any
    other: a repetition replaces it by the same messages."""
    now = state(spark, gold)
    listed = partitions(spark, bronze)
    fresh = [b for b in listed if not now.covers(b)]
    if not fresh:
        return 0
    rows = spark.table(bronze).where(F.col(BATCH_COLUMN).isin(fresh))
    batch = f"update-{now.generation + 1:010d}-{uuid.uuid4().hex[:8]}"
    added = update(spark, rows, gold, batch)
    covered = Manifest(**now.covered)
    for b in fresh:
        covered.add(b)
    unnamed = [b for b in listed if (b in fresh or b in now.unnamed) and not covered.holds(b)]
    after = State(now.generation + 1, [*now.updates, batch], now.rows + added, asdict(covered), unnamed)
    held = live(spark, bronze).count()  # from the files' footers
    if held != after.rows:
        raise RuntimeError(f"{bronze} holds {held} rows, {gold} would hold {after.rows}")
    _commit(spark, gold, after)
    log.info("%s: %d rows of %d batches", gold, added, len(fresh))
    if len(after.updates) >= merge_at:
        merge(spark, gold)
    return added


def merge(spark: SparkSession, gold: str = "gold") -> None:
    """Makes one update of all that count."""
    now = state(spark, gold)
    batch = f"update-{now.generation + 1:010d}-{uuid.uuid4().hex[:8]}"
    append_bronze(_merged_members(_counting(spark, gold, MEMBERS)), f"{gold}.{MEMBERS}", batch=batch)
    append_bronze(_merged_cells(_counting(spark, gold, CELLS)), f"{gold}.{CELLS}", batch=batch)
    _commit(spark, gold, State(now.generation + 1, [batch], now.rows, now.covered, now.unnamed))
    for table in (f"{gold}.{CELLS}", f"{gold}.{MEMBERS}"):  # what no state names any more
        old = [b for b in partitions(spark, table) if b != batch]
        if old:
            spark.sql(f"ALTER TABLE {table} DROP IF EXISTS " + ", ".join(f"PARTITION ({BATCH_COLUMN}='{b}')" for b in old))


def compact_covered(spark: SparkSession, bronze: str, gold: str = "gold", **options) -> list[str]:
    """``compact`` for a bronze table under gold: batches that gold does not
    cover stay apart."""
    now = state(spark, gold)
    return compact(spark, bronze, only={b for b in partitions(spark, bronze) if now.covers(b)}, **options)


def _counting(spark: SparkSession, gold: str, table: str) -> DataFrame:
    """The partial aggregates that count (by partition, nothing else is read)."""
    return spark.table(f"{gold}.{table}").where(F.col(BATCH_COLUMN).isin(state(spark, gold).updates)).drop(BATCH_COLUMN)


def _distinct(spark: SparkSession, gold: str, measure: str) -> DataFrame:
    """txn_day, n: exact distinct counts from the bitmaps."""
    parts = _counting(spark, gold, MEMBERS).where(F.col("measure") == measure)
    return _merged_members(parts).groupBy("txn_day").agg(F.sum(F.bitmap_count("bits")).alias("n"))


def kpi_overall(spark: SparkSession, gold: str = "gold") -> DataFrame:
    """The report of ``operators.kpi_overall``, from gold alone."""
    count = lambda m: _distinct(spark, gold, m).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).select("n").scalar()
    agg = _counting(spark, gold, CELLS).agg(
        F.coalesce(F.sum("txn_count"), F.lit(0)).alias("total_transactions"),
        F.count_distinct("branch_code").alias("unique_branches"),
        money_sum("total_amount").alias("total_volume_inr"),
        F.sum("amount_count").alias("_n"),
        F.min("first_time").alias("earliest_txn"),
        F.max("last_time").alias("latest_txn"),
        F.max("last_ingested").alias("last_ingested"),
    )
    return agg.select(
        "total_transactions",
        count("customer").alias("active_customers"),
        count("account").alias("unique_accounts"),
        "unique_branches",
        "total_volume_inr",
        money_avg("total_volume_inr", "_n").alias("avg_amount_inr"),
        "earliest_txn",
        "latest_txn",
        "last_ingested",
    )


def _dated(spark: SparkSession, gold: str) -> DataFrame:
    return _counting(spark, gold, CELLS).where("txn_day IS NOT NULL AND amount_count > 0")


def volume_daily(spark: SparkSession, gold: str = "gold", days: int = 30) -> DataFrame:
    """The report of ``operators.volume_daily``, from gold alone."""
    newest = (
        _dated(spark, gold)
        .groupBy("txn_day")
        .agg(F.sum("amount_count").alias("txn_count"), money_sum("total_amount").alias("total_amount"))
        .orderBy(F.col("txn_day").desc())
        .limit(days)
    )
    people = _distinct(spark, gold, "day_customer").withColumnRenamed("n", "active_customers")
    return (
        newest.join(people, "txn_day", "left")
        .select("txn_day", "txn_count", "total_amount", F.coalesce("active_customers", F.lit(0)).alias("active_customers"))
        .orderBy(F.col("txn_day").desc())
    )


def volume_hourly(spark: SparkSession, gold: str = "gold") -> DataFrame:
    """The report of ``operators.volume_hourly``, from gold alone."""
    return (
        _dated(spark, gold)
        .groupBy("txn_hour")
        .agg(F.sum("amount_count").alias("txn_count"), money_sum("total_amount").alias("total_amount"))
        .select("txn_hour", "txn_count", money_avg("total_amount", "txn_count").alias("avg_amount"), "total_amount")
        .orderBy("txn_hour")
    )


def pattern_channel(spark: SparkSession, gold: str = "gold") -> DataFrame:
    """The report of ``operators.pattern_channel``, from gold alone."""
    agg = (
        _counting(spark, gold, CELLS)
        .where("amount_count > 0 AND channel IS NOT NULL")
        .groupBy("channel")
        .agg(F.sum("amount_count").alias("txn_count"), money_sum("total_amount").alias("total_amount"))
    )
    whole = agg.agg(F.struct(F.sum("txn_count").alias("n"), F.sum("total_amount").alias("amount")).alias("w")).scalar()
    return (
        agg.withColumn("_whole", whole)
        .select(
            "channel",
            "txn_count",
            "total_amount",
            money_avg("total_amount", "txn_count").alias("avg_amount"),
            pct_of("txn_count", F.col("_whole").getField("n")).alias("pct_of_total"),
        )
        .orderBy(F.col("txn_count").desc())
    )


def pattern_txn_type(spark: SparkSession, gold: str = "gold") -> DataFrame:
    """The report of ``operators.pattern_txn_type``, from gold alone."""
    return (
        _counting(spark, gold, CELLS)
        .where("amount_count > 0 AND txn_type IS NOT NULL")
        .groupBy("txn_type")
        .agg(
            F.sum("amount_count").alias("txn_count"),
            money_sum("total_amount").alias("total_amount"),
            F.min("min_amount").cast(MONEY).alias("min_amount"),
            F.max("max_amount").cast(MONEY).alias("max_amount"),
        )
        .orderBy(F.col("total_amount").desc())
    )
