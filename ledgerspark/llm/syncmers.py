"""Document fingerprints from closed syncmers, DataFrame functions only.

A text is a sequence of units: the words between white space, and of a run of
more than ``UNIT`` characters (writing without spaces) each character.  Of the
``K`` consecutive units of a k-mer every ``S`` consecutive ones form an inner
substring; the k-mer is a *closed syncmer* when the smallest hash among its
inner substrings is the first or the last.  Whether a k-mer is chosen depends
on nothing around it, so text that two documents share gives the same anchors
in both, wherever it stands.  About 2 / (K - S + 1) of all k-mers are chosen.

The fingerprint is the list of distinct anchors in text order, eight hex
digits each; the likeness of two fingerprints is the Jaccard index of their
anchors.  Equal texts have equal fingerprints.  Texts with fewer than ``K``
units have one anchor, all units together; null, empty and blank texts have
none.  Two empty fingerprints have likeness 1, an empty and another one 0.

Null ids come last in descending order, and rows with equal ids follow a hash
of their text; either may be many, they are spread over tasks by that hash.
Rows equal in id and text are each other's next; they share a task.  In a
table of one row the row is its own next.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerspark.llm.common import shuffle_partitions, text_of

K, S, UNIT = 5, 2, 24
_SPACE = r" \\t\\n\\x0B\\f\\r"
# a whole run of at most UNIT characters, or one character of a longer run
_UNITS = f"(?<![^{_SPACE}])[^{_SPACE}]{{1,{UNIT}}}(?![^{_SPACE}])|[^{_SPACE}]"
#: quantiles asked for at most when ids are cut into ranges
CUTS = 1000
LOWEST = -(2**63)


def with_anchors(df: DataFrame, text: str, out: str) -> DataFrame:
    """``df`` with array<int> column ``out``: anchors of ``text`` in order."""
    u, sub, at = f"{out}_units", f"{out}_sub", f"{out}_at"
    n_sub = K - S + 1
    edges = f"least(element_at({sub}, i), element_at({sub}, i + {n_sub - 1}))"
    inner = ", ".join(f"element_at({sub}, i + {j})" for j in range(1, n_sub - 1))
    kmer = ", ".join(f"element_at({u}, i + {j})" for j in range(K))
    inside = ", ".join(f"element_at({u}, i + {j})" for j in range(S))
    return (
        df.withColumn(
            u, F.expr(f"transform(regexp_extract_all({text}, '{_UNITS}', 0), x -> xxhash64(x))")
        )
        .withColumn(
            sub,
            F.expr(
                f"IF(size({u}) < {K}, cast(array() AS array<bigint>), "
                f"transform(sequence(1, size({u}) - {S - 1}), i -> xxhash64({inside})))"
            ),
        )
        .withColumn(
            at,
            F.expr(
                f"IF(size({u}) < {K}, cast(array() AS array<int>), "
                f"filter(sequence(1, size({u}) - {K - 1}), i -> {edges} <= least({inner})))"
            ),
        )
        .withColumn(
            out,
            F.expr(
                f"CASE WHEN size({u}) = 0 THEN cast(array() AS array<int>) "
                f"WHEN size({u}) < {K} THEN array(hash({u})) "
                f"ELSE transform({at}, i -> hash({kmer})) END"
            ),
        )
        .drop(sub)
    )


def anchors(docs: DataFrame) -> DataFrame:
    """doc_id, unit (position of the anchor's first unit, from 0), anchor:
    the table to match documents on by position."""
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    found = with_anchors(source, "text", "a")
    first = F.expr("IF(size(a_at) = 0, transform(a, x -> 1), a_at)")
    return found.select("doc_id", F.explode(F.arrays_zip(first.alias("unit"), F.col("a").alias("anchor"))).alias("x")).select(
        "doc_id", (F.col("x.unit") - 1).alias("unit"), F.col("x.anchor").alias("anchor")
    )


def fingerprint(anchors_: str) -> Column:
    return F.expr(f"array_join(transform({anchors_}, x -> lpad(lower(hex(cast(x AS bigint) & 4294967295L)), 8, '0')), '')")


def likeness(a: str, b: str) -> Column:
    return F.expr(
        f"CASE WHEN size({a}) = 0 AND size({b}) = 0 THEN 1D "
        f"ELSE cast(size(array_intersect({a}, {b})) AS double) / size(array_union({a}, {b})) END"
    )


def _ranged(docs: DataFrame) -> DataFrame:
    """``docs`` with ``bucket``, a number that rises with ``ord`` and, among
    equal ones, falls with ``tie``.

    Quantiles of the ids (CUTS at most) cut them into ranges of about equal
    counts; where more buckets are wanted each range is divided evenly.  An id
    that several quantiles fall on has as many shares of the rows; they are
    dealt by their tie.
    """
    wanted = 4 * shuffle_partitions(docs.sparkSession)
    n = min(wanted, CUTS)
    quantiles = docs.select(
        F.percentile_approx("ord", [k / n for k in range(n + 1)], 10 * CUTS).alias("q")
    ).first()["q"]
    if not quantiles:
        return docs.withColumn("bucket", F.lit(0).cast("long"))
    each = -(-wanted // n)
    cuts = sorted({int(c) for c in quantiles})
    shares = [each * (m if (m := sum(int(q) == c for q in quantiles)) > 1 else 0) for c in cuts]
    first, at = [], 0
    for s in shares:
        first.append(at)
        at += s + each

    def listed(values: list[int]) -> Column:
        return F.array(*[F.lit(v).cast("long") for v in values])

    k = F.greatest(F.size(F.filter(listed(cuts), lambda c: c <= F.col("ord"))), F.lit(1))
    placed = docs.withColumn("_k", k).withColumns(
        {
            "_low": F.element_at(listed(cuts), F.col("_k")),
            "_high": F.element_at(listed(cuts), F.least(F.col("_k") + 1, F.lit(len(cuts)))),
            "_first": F.element_at(listed(first), F.col("_k")),
            "_shares": F.element_at(listed(shares), F.col("_k")),
        }
    )
    # the tie's place between the lowest and the highest number, from the end
    fraction = 0.5 - F.col("tie") / F.lit(2.0**64)
    share = F.least(F.floor(fraction * F.col("_shares")), F.col("_shares") - 1)
    part = F.floor(
        (F.col("ord").cast("double") - F.col("_low"))
        * each
        / F.greatest(F.col("_high").cast("double") - F.col("_low"), F.lit(1.0))
    )
    part = F.greatest(F.least(part, F.lit(each - 1)), F.lit(0))
    shared = (F.col("ord") == F.col("_low")) & (F.col("_shares") > 0)
    bucket = F.col("_first") + F.when(shared, F.greatest(share, F.lit(0))).otherwise(F.col("_shares") + part)
    return placed.withColumn("bucket", bucket.cast("long")).drop("_k", "_low", "_high", "_first", "_shares")


def with_next(docs: DataFrame) -> DataFrame:
    """doc_id, text, a (anchors), next_text, next_a: each row with the next
    one by descending doc_id; the last row's next is the first.

    Rows go to ranges of ids; the first row of each range is copied to the end
    of the range before it, so no step orders all rows in one task.
    """
    source = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        text_of().alias("text"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(LOWEST)).alias("ord"),
    ).withColumn("tie", F.xxhash64("text"))
    placed = _ranged(source)
    # one row per bucket
    top = F.max(F.struct("ord", F.bitwise_not("tie").alias("tie")))
    heads = placed.groupBy("bucket").agg(top.alias("top")).select("bucket", "top.ord", F.bitwise_not("top.tie").alias("tie"))
    order = Window.orderBy(F.col("bucket").desc())
    last = Window.orderBy(F.col("bucket").desc()).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    guests = heads.select(
        "ord", "tie", F.coalesce(F.lag("bucket").over(order), F.min("bucket").over(last)).alias("host")
    )
    copies = placed.join(F.broadcast(guests), ["ord", "tie"], "left")
    dealt = copies.select(
        "doc_id",
        "text",
        "ord",
        "tie",
        F.explode(
            F.when(F.col("host").isNull(), F.array(F.struct(F.col("bucket").alias("b"), F.lit(0).alias("guest")))).otherwise(
                F.array(
                    F.struct(F.col("bucket").alias("b"), F.lit(0).alias("guest")),
                    F.struct(F.col("host").alias("b"), F.lit(1).alias("guest")),
                )
            )
        ).alias("to"),
    ).select("doc_id", "text", "ord", "tie", F.col("to.b").alias("bucket"), F.col("to.guest").alias("guest"))
    spread = dealt.repartition(shuffle_partitions(docs.sparkSession), "bucket")
    within = Window.partitionBy("bucket").orderBy("guest", F.col("ord").desc(), "tie")
    return (
        with_anchors(spread, "text", "a")
        .drop("a_units", "a_at")
        .withColumn("next_text", F.lead("text").over(within))
        .withColumn("next_a", F.lead("a").over(within))
        .where("guest = 0")
        .select("doc_id", "text", "a", "next_text", "next_a")
    )


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprint of each text and of its edited text (the last third
    replaced by the start of the next document), and their likenesses."""
    n, cut = F.char_length("text"), F.expr("cast(floor(char_length(text) / 3) AS int)")
    edited = with_next(docs).select(
        "doc_id",
        n.cast("long").alias("n_chars"),
        "a",
        "next_a",
        F.concat(F.substring("text", F.lit(1), n - cut), F.substring("next_text", F.lit(1), cut)).alias("edited"),
    )
    both = (
        with_anchors(edited, "edited", "e")
        .drop("e_units", "e_at")
        .withColumns({c: F.array_distinct(c) for c in ("a", "e", "next_a")})
    )
    return both.select(
        "doc_id",
        "n_chars",
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        fingerprint("a").alias("fingerprint"),
        fingerprint("e").alias("edited_fingerprint"),
        likeness("a", "e").alias("near_edited"),
        likeness("a", "next_a").alias("near_next"),
    )
