"""Compaction of bronze tables: many small batches become few large ones.

Every batch and micro-batch of a bronze table is a partition (``_batch``) of
its own, so a stream adds one for good with every trigger.  ``compact`` merges
closed ones into tiers: as soon as ``fan_in`` partitions of a tier exist they
become one partition of the next tier.  After n batches a table has at most
about ``fan_in * log(n) / log(fan_in)`` partitions, and each row has been
copied at most ``log(n) / log(fan_in)`` times.

Closed means: no writer will replace it any more.  Of a stream every
micro-batch but the newest is closed (Spark records a batch before it starts
the next one).  A batch job's partition is closed once it is listed, as it is
added to the catalog after its files are complete.

The swap.  Merged rows are first written where readers do not look.  Then a
manifest, a new small file that names the merged partition and what it
replaces, is created: this is the commit, and of two compactions that run at
the same time only one creates it.  Last, the catalog follows (one partition
added, the replaced ones dropped).  ``live`` reads a table by its newest
manifest, so it sees the rows once at every moment, also between the commit
and the catalog's change or after a crash there; ``settle`` finishes such a
change and runs before every compaction.

The manifest also remembers which named batches were merged (per stream as
ranges of numbers, so it stays small).  A repeated old batch is recognised by
that and changes nothing.  Names that ``append_bronze`` makes up itself never
come back and are not remembered.
"""

from __future__ import annotations

import logging
import re
import uuid
from dataclasses import asdict, dataclass, field
from urllib.parse import unquote

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ledgerspark.sources import shared_fs
from ledgerspark.sources.catalog import table_exists

log = logging.getLogger(__name__)

BATCH_COLUMN = "_batch"
FOLDER = "_compaction"  # under the table; readers skip names that begin with _
FAN_IN = 16

_STREAM = re.compile(r"(stream-.+)-(\d{10,})")
_MERGED = re.compile(r"merged-(\d+)-[0-9a-f]+")
_UNNAMED = re.compile(r"batch-[0-9a-f]{32}")


@dataclass
class Manifest:
    """What compaction has done to a table so far."""

    generation: int = 0
    merged: dict[str, dict] = field(default_factory=dict)  # live merged partitions: rows, path
    replaced: list[str] = field(default_factory=list)  # partitions the last swap takes out
    ranges: dict[str, list[list[int]]] = field(default_factory=dict)  # stream -> merged numbers
    names: list[str] = field(default_factory=list)  # other merged batches with a given name

    def holds(self, batch: str) -> bool:
        """Whether this batch's rows are in a merged partition."""
        m = _STREAM.fullmatch(batch)
        if m:
            return any(a <= int(m[2]) <= b for a, b in self.ranges.get(m[1], []))
        return batch in self.names

    def add(self, batch: str) -> None:
        if _MERGED.fullmatch(batch) or _UNNAMED.fullmatch(batch):
            return
        m = _STREAM.fullmatch(batch)
        if not m:
            if batch not in self.names:
                self.names = sorted([*self.names, batch])
            return
        number = int(m[2])
        out: list[list[int]] = []
        for a, b in sorted([*self.ranges.get(m[1], []), [number, number]]):
            if out and a <= out[-1][1] + 1:
                out[-1][1] = max(out[-1][1], b)
            else:
                out.append([a, b])
        self.ranges[m[1]] = out


def location(spark: SparkSession, table: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'").collect()
    if not rows:
        raise RuntimeError(f"{table} has no location")
    return rows[0]["data_type"].rstrip("/")


def manifest(spark: SparkSession, table: str, root: str | None = None) -> Manifest:
    """The newest manifest (an empty one before the first compaction)."""
    folder = f"{root or location(spark, table)}/{FOLDER}"
    files = [n for n in shared_fs.names(spark, folder) if re.fullmatch(r"\d{10}\.json", n)]
    return Manifest(**shared_fs.read_json(spark, f"{folder}/{files[-1]}")) if files else Manifest()


def partitions(spark: SparkSession, table: str) -> list[str]:
    """The table's batches, from the catalog (no file is read)."""
    listed = spark.sql(f"SHOW PARTITIONS {table}").collect()
    return sorted(unquote(r[0].split("=", 1)[1]) for r in listed)


def live(spark: SparkSession, table: str) -> DataFrame:
    """The table's rows, each once, whatever a compaction is about to do.

    The condition is on the partition column, so nothing is read for it.
    """
    df = spark.table(table)
    if BATCH_COLUMN not in df.columns:
        return df
    root = location(spark, table)
    m = manifest(spark, table, root)
    gone = set(m.replaced)
    listed = partitions(spark, table)
    shown = [b for b in listed if b not in gone and (not _MERGED.fullmatch(b) or b in m.merged)]
    if len(shown) != len(listed):
        df = df.where(F.col(BATCH_COLUMN).isin(shown))
    late = [b for b in m.merged if b not in listed]  # committed, but not yet in the catalog
    for b in late:
        rows = spark.read.schema(df.drop(BATCH_COLUMN).schema).parquet(m.merged[b]["path"])
        df = df.unionByName(rows.withColumn(BATCH_COLUMN, F.lit(b)))
    return df


def settle(spark: SparkSession, table: str) -> None:
    """Bring the catalog in line with the newest manifest (after a crash
    between commit and swap; nothing to do otherwise)."""
    root = location(spark, table)
    m = manifest(spark, table, root)
    if not m.generation:
        return
    have = set(partitions(spark, table))
    for b, entry in m.merged.items():
        if b not in have:
            spark.sql(
                f"ALTER TABLE {table} ADD IF NOT EXISTS PARTITION ({BATCH_COLUMN}='{b}') LOCATION '{entry['path']}'"
            )
    gone = sorted(have & set(m.replaced))
    if gone:
        listed = ", ".join(f"PARTITION ({BATCH_COLUMN}='{b}')" for b in gone)
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {listed}")
        for b in gone:  # a table that only refers to its files keeps them otherwise
            for path in (f"{root}/{BATCH_COLUMN}={b}", f"{root}/{FOLDER}/data/{b}"):
                shared_fs.delete(spark, path)
    if gone or set(m.merged) - have:
        spark.catalog.refreshTable(table)


def _closed(batches: list[str]) -> dict[int, list[str]]:
    """Tier -> closed partitions, oldest first."""
    newest: dict[str, int] = {}
    for b in batches:
        if m := _STREAM.fullmatch(b):
            newest[m[1]] = max(newest.get(m[1], -1), int(m[2]))
    tiers: dict[int, list[str]] = {}
    for b in batches:
        if m := _MERGED.fullmatch(b):
            tiers.setdefault(int(m[1]), []).append(b)
        elif not (m := _STREAM.fullmatch(b)) or int(m[2]) < newest[m[1]]:
            tiers.setdefault(0, []).append(b)
    return tiers


def compact(
    spark: SparkSession,
    table: str,
    fan_in: int = FAN_IN,
    only: set[str] | None = None,
    max_records_per_file: int = 5_000_000,
    crash_before_swap: bool = False,
) -> list[str]:
    """Merge every tier that has ``fan_in`` closed partitions; the merged
    partitions' names.  ``only``: leave partitions out that are not in it
    (e.g. batches that a layer above has not taken in yet).

    ``crash_before_swap`` stops after the commit, for tests.
    """
    if fan_in < 2:
        raise ValueError("fan_in must be at least 2")
    made = []
    while True:
        settle(spark, table)
        root = location(spark, table)
        m = manifest(spark, table, root)
        tiers = _closed(partitions(spark, table))
        allowed = {t: [b for b in bs if only is None or b in only or b in made] for t, bs in tiers.items()}
        full = sorted(t for t, bs in allowed.items() if len(bs) >= fan_in)
        if not full:
            return made
        name = _merge(spark, table, root, m, full[0], allowed[full[0]], max_records_per_file)
        if name is None:  # another compaction was first
            return made
        made.append(name)
        if crash_before_swap:
            return made


def _merge(
    spark: SparkSession, table: str, root: str, m: Manifest, tier: int, batches: list[str], max_records_per_file: int
) -> str | None:
    name = f"merged-{tier + 1}-{uuid.uuid4().hex}"
    path = f"{root}/{FOLDER}/data/{name}"
    rows = spark.table(table).where(F.col(BATCH_COLUMN).isin(batches)).drop(BATCH_COLUMN)
    seen = Observation(f"compact-{name}")
    counted = rows.observe(seen, F.count(F.lit(1)).alias("rows"))
    # rebalanced: files of the advised size, however small the batches were
    counted.hint("rebalance").write.option("maxRecordsPerFile", str(max_records_per_file)).parquet(path)
    written = spark.read.schema(rows.schema).parquet(path).count()  # from the files' footers
    if written != seen.get["rows"]:
        shared_fs.delete(spark, path)
        raise RuntimeError(f"{table}: {seen.get['rows']} rows read, {written} rows merged")
    after = Manifest(
        m.generation + 1,
        {b: e for b, e in m.merged.items() if b not in batches} | {name: {"rows": written, "path": path}},
        sorted(batches),
        m.ranges,
        m.names,
    )
    for b in batches:
        after.add(b)
    folder = f"{root}/{FOLDER}"
    if not shared_fs.create_json(spark, f"{folder}/{after.generation:010d}.json", asdict(after)):
        shared_fs.delete(spark, path)
        return None
    log.info("%s: %d partitions merged into %s (%d rows)", table, len(batches), name, written)
    old = f"{folder}/{m.generation - 1:010d}.json"  # the one before is kept for readers that hold it
    if m.generation > 1 and shared_fs.exists(spark, old):
        shared_fs.delete(spark, old)
    return name


def is_merged(spark: SparkSession, table: str, batch: str) -> bool:
    """Whether a batch of this name was merged already."""
    return table_exists(spark, table) and manifest(spark, table).holds(batch)
