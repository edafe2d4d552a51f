"""Benchmark decontamination with DataFrame functions only.

A document is contaminated by an item when one of its *item-sized windows*
(as many words as the item; the whole document if that is shorter) has a
weighted-shingle similarity of ``percent`` or more with the item.  Words are
runs of letters and digits, lower-cased; shingles are five consecutive words
(items under five words: one shingle of all words); the weight of a shingle
is how often it occurs, so the similarity is sum(min) / sum(max) of counts.

1. Anchors.  A window that similar shares at least ``percent * (n + m) /
   (100 + percent)`` of its shingles with the item (n, m: their shingles).
   Documents' shingles are looked up among the benchmark's, and only windows
   that hold so many hits go on; this loses none.
2. Fingerprints.  Each distinct window gets a 64-bit SimHash.
3. Multi-index.  The fingerprint is cut into ``radius + 1`` blocks; two
   fingerprints within ``radius`` bits agree in one block at least, so a join
   on (window size, block, value) finds all of them, then bits are counted.
   At similarity 0.8 the expected distance is 10 bits and its deviation 3;
   the radius of 24 leaves a miss probability of about one in a million.
4. The exact similarity confirms each candidate.

Equal windows are handled once, so a passage that many documents share costs
one row per document and one comparison.  Null or empty texts hold no window;
items without words match nothing; repeated rows give one result row; a null
doc_id is reported as null.  Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerspark.llm.common import row_key, stored, text_of

SHINGLE = 5
#: benchmark shingles, or documents with candidate windows, that are broadcast (16 to 32 bytes each)
BROADCAST_ROWS = 1_000_000


def _words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def _shingles(words: str, size: str) -> Column:
    """Shingles of the array column ``words``, ``size`` words each."""
    return F.expr(
        f"CASE WHEN size({words}) < {size} OR {size} = 0 THEN cast(array() AS array<bigint>) ELSE "
        f"transform(sequence(1, size({words}) - {size} + 1), i -> xxhash64(slice({words}, i, {size}))) END"
    )


def _simhash(shingles: str) -> Column:
    """64 bits: bit j is set where more than half of the shingles have it.

    Two counters of 32 bits share a long, so 32 sums give all 64 bits.
    """
    return F.expr(
        f"""aggregate(
          transform(sequence(0, 31), j -> named_struct('j', j, 'sums',
            aggregate({shingles}, 0L, (a, x) -> a + (shiftrightunsigned(x, j) & 4294967297L)))),
          0L,
          (bits, v) -> bits
            | IF(2 * (v.sums & 4294967295L) > size({shingles}), shiftleft(1L, v.j), 0L)
            | IF(2 * shiftrightunsigned(v.sums, 32) > size({shingles}), shiftleft(1L, v.j + 32), 0L))"""
    )


def _blocks(fingerprint: str, radius: int) -> Column:
    """One (number, value) per block of the fingerprint."""
    n = radius + 1
    cuts = [64 * k // n for k in range(n + 1)]
    return F.array(
        *[
            F.expr(
                f"named_struct('block', {k}, 'value', "
                f"shiftrightunsigned({fingerprint}, {a}) & {(1 << (b - a)) - 1}L)"
            )
            for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False))
        ]
    )


def _sized(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def _documents(docs: DataFrame) -> DataFrame:
    text = text_of()
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text")).withColumn(
        "rid", F.xxhash64("doc_id", "text")
    )


def contaminated(docs: DataFrame, benchmark: DataFrame, percent: int = 80, radius: int = 24) -> DataFrame:
    """doc_id, item_id, similarity, hamming, window_start (word, from 0) and
    window_words of the best window of each contaminated pair, plus ``rid``,
    the row key that ``decontaminate`` removes."""
    items = stored(
        benchmark.select("item_id", _words(text_of()).alias("words"))
        .withColumn("k", F.least(F.lit(SHINGLE), F.size("words")))
        .select("item_id", F.size("words").alias("n_words"), "k", _shingles("words", "k").alias("item"))
        .where(F.size("item") > 0)
        .withColumn("bits", _simhash("item")),
        "items",
    )
    anchors = stored(
        items.select("n_words", "k", F.explode(F.array_distinct("item")).alias("h"), "item_id").distinct(), "anchors"
    )
    n_anchors = anchors.count()
    sizes = sorted(r["k"] for r in anchors.select("k").distinct().collect())  # five values at most

    base = _documents(docs)
    words = base.select("rid", _words(F.col("text")).alias("words"))
    by_size = F.array(*[F.struct(F.lit(k).alias("k"), _shingles("words", str(k)).alias("all")) for k in sizes])
    if not sizes:
        by_size = F.expr("cast(array() AS array<struct<k: int, all: array<bigint>>>)")
    shingled = words.select("rid", F.explode(by_size).alias("s")).select("rid", "s.k", "s.all")
    found = (
        shingled.select("rid", "k", F.size("all").alias("total"), F.posexplode("all").alias("pos", "h"))
        .join(_sized(anchors, n_anchors), ["k", "h"])
        .groupBy("rid", "k", "total", "item_id", "n_words")
        .agg(F.sort_array(F.collect_set("pos")).alias("hits"))
        .withColumn("n", F.col("n_words") - F.col("k") + 1)
        .withColumn("m", F.least("n", "total"))
        .withColumn("need", F.ceil(F.lit(percent) * (F.col("n") + F.col("m")) / F.lit(100 + percent)).cast("int"))
        .where(F.size("hits") >= F.col("need"))
    )
    starts = F.expr(
        """array_distinct(flatten(transform(sequence(1, size(hits) - need + 1), i ->
             IF(greatest(element_at(hits, i + need - 1) - m + 1, 0) <= least(element_at(hits, i), total - m),
                sequence(greatest(element_at(hits, i + need - 1) - m + 1, 0), least(element_at(hits, i), total - m)),
                cast(array() AS array<int>)))))"""
    )
    spots = stored(
        found.select("rid", "k", "n", "m", starts.alias("starts"))
        .where(F.size("starts") > 0)
        .groupBy("rid", "k", "n", "m")
        .agg(F.array_distinct(F.flatten(F.collect_set("starts"))).alias("starts")),
        "spots",
    )
    rids = spots.select("rid").distinct()
    n_rids = rids.count()
    chosen = shingled.join(_sized(spots, n_rids), ["rid", "k"])
    windows = stored(
        chosen.select("rid", "k", "n", "m", "all", F.explode("starts").alias("start"))
        .select("rid", "k", "n", "start", F.expr("slice(all, start + 1, m)").alias("w"))
        .withColumn("content", F.xxhash64("w")),
        "windows",
    )
    distinct = (
        windows.groupBy("k", "n", "content").agg(F.first("w").alias("w")).withColumn("bits", _simhash("w"))
    )
    indexed = distinct.select("k", "n", "content", "w", "bits", F.explode(_blocks("bits", radius)).alias("b"))
    index = items.select(
        "k",
        (F.col("n_words") - F.col("k") + 1).alias("n"),
        "item_id",
        "item",
        F.col("bits").alias("item_bits"),
        F.explode(_blocks("bits", radius)).alias("b"),
    )
    common = F.expr(
        """aggregate(array_intersect(w, item), 0, (a, x) -> a + least(
             size(filter(w, y -> y = x)), size(filter(item, y -> y = x))))"""
    )
    confirmed = (
        indexed.join(index, ["k", "n", "b"])
        .withColumn("hamming", F.bit_count(F.col("bits").bitwiseXOR(F.col("item_bits"))))
        .where(F.col("hamming") <= radius)
        .dropDuplicates(["k", "n", "content", "item_id"])
        .withColumn("common", common)
        .withColumn("union", F.size("w") + F.size("item") - F.col("common"))
        .where(100 * F.col("common") >= percent * F.col("union"))
        .select("k", "n", "content", "item_id", "hamming", (F.col("common") / F.col("union")).alias("similarity"))
    )
    best = F.max(F.struct("similarity", -F.col("start"), -F.col("hamming"), F.col("n") + F.col("k") - 1))
    per_row = (
        windows.join(confirmed, ["k", "n", "content"]).groupBy("rid", "item_id").agg(best.alias("b"))
    )
    ids = base.join(_sized(rids, n_rids), "rid", "left_semi").select("rid", "doc_id").distinct()
    return per_row.join(ids, "rid").select(
        "doc_id",
        "item_id",
        F.col("b.similarity").alias("similarity"),
        F.col("b.col3").alias("hamming"),
        F.col("b.col2").alias("window_start"),
        F.col("b.col4").alias("window_words"),
        "rid",
    ).withColumns({"hamming": -F.col("hamming"), "window_start": -F.col("window_start")})


def decontaminate(docs: DataFrame, benchmark: DataFrame, percent: int = 80, radius: int = 24) -> DataFrame:
    """``docs`` without the contaminated rows; all other rows and columns as
    they are."""
    bad = stored(contaminated(docs, benchmark, percent, radius).select("rid").distinct(), "leaks")
    key = row_key()
    return docs.join(_sized(bad, bad.count()), key == bad.rid, "left_anti")
