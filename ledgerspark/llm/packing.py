"""Best-fit packing of tokenised documents into fixed-size sequences.

Lengths are whole numbers up to the capacity, so the packing is decided on
the histogram of lengths, at most ``capacity`` rows however large the corpus:

1. every document is tokenised and cut into pieces of at most ``capacity``;
2. pieces longer than a third of the capacity are matched greedily: the
   longest remaining one with the longest other large one that still fits,
   so a sequence holds at most two of them;
3. the smaller pieces, longest first, go where they leave the smallest gap
   (best fit), and open new sequences only when no gap takes them.

The result of 2 and 3 is a list of intervals "pieces of length L ranked lo to
hi go to sequences s, s+1, ... at offset o".  Spark ranks the pieces within
their length and looks their place up in that list.  Ranks come from salted
groups plus group offsets, so a length that holds a third of all pieces is
spread over many tasks.

Null texts count as empty; an empty document is its closing id alone.  Null
ids and repeated rows are packed like any other row.  An empty table gives an
empty result.  Other columns of the input are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerspark.llm.common import ready, shuffle_partitions, stored, text_of, whole_numbers
from ledgerspark.llm.tokens import tokenized

PIECES = "doc_id long, row long, piece int, start long, length long, ids_crc32 long, ids binary"
INTERVALS = ["length", "lo", "hi", "copies", "first_sequence", "at"]


def tokenized_pieces(
    docs: DataFrame, tokenizer_path: str, capacity: int = 2048, end_id: int = 0, keep_ids: bool = True
) -> DataFrame:
    """One row per piece: doc_id, row (a number of the document's row), piece,
    start, length, ids_crc32 and, with ``keep_ids``, the ids as little-endian
    unsigned 32-bit numbers."""
    ready()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, ids, offsets in tokenized(batches, tokenizer_path, end_id):
            lengths = np.diff(offsets)
            pieces = -(-lengths // capacity)  # at least one: the closing id
            owner = np.repeat(np.arange(len(lengths)), pieces)
            piece = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            start = piece * capacity
            size = np.minimum(lengths[owner] - start, capacity)
            begin = offsets[owner] + start
            flat = memoryview(np.ascontiguousarray(ids)).cast("B")
            parts = [flat[a:b] for a, b in zip((4 * begin).tolist(), (4 * (begin + size)).tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(pa.array(owner)),
                    batch.column("row").take(pa.array(owner)),
                    pa.array(piece, pa.int32()),
                    pa.array(start, pa.int64()),
                    pa.array(size, pa.int64()),
                    pa.array(list(map(zlib.crc32, parts)), pa.int64()),
                    pa.array(map(bytes, parts) if keep_ids else [None] * len(parts), pa.binary()),
                ],
                ["doc_id", "row", "piece", "start", "length", "ids_crc32", "ids"],
            )

    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.monotonically_increasing_id().alias("row"),
        text_of().alias("text"),
    )
    return rows.mapInArrow(cut, PIECES)


def plan_sequences(histogram: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """The packing of ``histogram`` (length -> pieces) as intervals.

    A row (length, lo, hi, copies, first_sequence, at): the pieces of that
    length ranked lo (inclusive) to hi (exclusive), ``copies`` to a sequence,
    the first of each sequence at offset ``at``.  Groups of equal sequences
    are handled as one, so time and size follow the number of distinct
    lengths and not the number of pieces.
    """
    left = {length: n for length, n in histogram.items() if n}
    if any(not 0 < length <= capacity for length in left):
        raise ValueError(f"lengths must lie between 1 and {capacity}")
    done: list[tuple[int, list[tuple[int, int]]]] = []  # (sequences, [(length, copies)])
    gaps: list[list[tuple[int, list[tuple[int, int]]]]] = [[] for _ in range(capacity + 1)]

    def put(n: int, gap: int, items: list[tuple[int, int]]) -> None:
        if n:
            (gaps[gap] if gap else done).append((n, items))

    large = sorted((x for x in left if 3 * x > capacity), reverse=True)
    for length in large:
        while left[length]:
            mate = next((x for x in large if x <= capacity - length and left[x] >= 1 + (x == length)), None)
            if mate is None:
                put(left[length], capacity - length, [(length, 1)])
                left[length] = 0
            elif mate == length:
                pairs = left[length] // 2
                put(pairs, capacity - 2 * length, [(length, 2)])
                left[length] -= 2 * pairs
            else:
                pairs = min(left[length], left[mate])
                put(pairs, capacity - length - mate, [(length, 1), (mate, 1)])
                left[length] -= pairs
                left[mate] -= pairs

    for length in sorted((x for x in left if 3 * x <= capacity), reverse=True):
        n = left[length]
        for gap in range(length, capacity + 1):
            fit = gap // length  # best fit goes on filling the sequence it has begun
            while n and gaps[gap]:
                group, items = gaps[gap].pop()
                full = min(group, n // fit)
                rest = n - full * fit if full < group and n - full * fit < fit else 0
                put(full, gap - fit * length, [*items, (length, fit)])
                put(1 if rest else 0, gap - rest * length, [*items, (length, rest)])
                untouched = group - full - (1 if rest else 0)
                n -= full * fit + rest
                if untouched:
                    gaps[gap].append((untouched, items))
        if n:
            fit = capacity // length
            put(n // fit, capacity - fit * length, [(length, fit)])
            if n % fit:
                put(1, capacity - n % fit * length, [(length, n % fit)])

    out, used, sequence = [], dict.fromkeys(left, 0), 0
    for n, items in done + [g for groups in gaps for g in groups]:
        at = 0
        for length, copies in items:
            lo = used[length]
            used[length] = hi = lo + n * copies
            out.append((length, lo, hi, copies, sequence, at))
            at += length * copies
        sequence += n
    return out


def ranked(pieces: DataFrame, histogram: dict[int, int]) -> DataFrame:
    """``pieces`` with ``rank``: 0, 1, ... within each length.

    A length with many pieces is dealt over salted groups of about an eighth
    of an even share of a task; the rank is the place in the group plus the
    rows of the groups before it.
    """
    spark = pieces.sparkSession
    target = max(1, sum(histogram.values()) // (8 * shuffle_partitions(spark)))
    salts = whole_numbers(spark, [(length, -(-n // target)) for length, n in histogram.items()], ["length", "n_salts"])
    dealt = pieces.join(F.broadcast(salts), "length").withColumn(
        "salt", F.pmod(F.xxhash64("row", "piece"), F.col("n_salts"))
    )
    groups = dealt.groupBy("length", "salt").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    base = groups.select("length", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("length", "salt").orderBy("row", "piece")
    return (
        dealt.withColumn("place", F.row_number().over(inside) - 1)
        .join(base, ["length", "salt"])
        .withColumn("rank", F.col("base") + F.col("place"))
        .drop("salt", "n_salts", "base", "place")
    )


def pack(pieces: DataFrame, capacity: int = 2048) -> DataFrame:
    """``pieces`` (stored: it is read twice) with sequence_id and offset."""
    spark = pieces.sparkSession
    # at most `capacity` rows
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    plan = whole_numbers(spark, plan_sequences(histogram, capacity), INTERVALS)
    columns = [c for c in pieces.columns if c != "row"]
    p, r = F.broadcast(plan).alias("plan"), ranked(pieces, histogram).alias("r")
    step = F.col("r.rank") - F.col("plan.lo")
    return r.join(
        p,
        (F.col("r.length") == F.col("plan.length"))
        & (F.col("r.rank") >= F.col("plan.lo"))
        & (F.col("r.rank") < F.col("plan.hi")),
    ).select(
        *[F.col(f"r.{c}") for c in columns],
        (F.col("plan.first_sequence") + F.expr("(r.rank - plan.lo) div plan.copies")).alias("sequence_id"),
        (F.col("plan.at") + F.pmod(step, F.col("plan.copies")) * F.col("r.length")).alias("offset"),
    )


def pack_documents(
    docs: DataFrame, tokenizer_path: str, capacity: int = 2048, end_id: int = 0, keep_ids: bool = True
) -> DataFrame:
    """Every piece of ``docs`` with its place: doc_id, piece, start, length,
    ids_crc32, ids (null without ``keep_ids``), sequence_id, offset."""
    return pack(stored(tokenized_pieces(docs, tokenizer_path, capacity, end_id, keep_ids), "pieces"), capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """Packed pieces as one row per sequence: its ids (at most ``capacity``)
    and the documents in it, in order."""
    entry = F.struct("offset", "doc_id", "piece", "length", "ids")
    return (
        packed.groupBy("sequence_id")
        .agg(F.array_sort(F.collect_list(entry)).alias("parts"))
        .select(
            "sequence_id",
            F.expr("aggregate(parts, cast('' as binary), (a, x) -> concat(a, x.ids))").alias("ids"),
            F.col("parts.doc_id").alias("doc_ids"),
            F.col("parts.length").alias("lengths"),
        )
    )
