"""A Merkle manifest of a table, with an inclusion proof for every row.

A row's leaf is the SHA-256 of its columns.  Within a group (``lang``) the
leaves stand in order of their key; every two neighbours become one node until
one is left, the subroot.  The subroots, in order of their groups, become the
root in the same way.  An odd last node becomes a node of itself alone.

* Places: rows are dealt to ranges of (group, key, leaf), so a partition
  numbers its rows and adds the rows of the partitions before it.
* Tree: aligned blocks of 2^``BLOCK`` neighbours make all their levels in one
  step, so a tree of n leaves takes log(n) / ``BLOCK`` shuffles of digests.
* Proofs: pointer jumping.  Every node holds the segment of siblings towards
  its ancestor 1 level up.  A self-join appends the ancestor's own segment,
  so nodes reach 2, 4, 8 ... levels; nodes between are no longer needed and
  leave, until every leaf holds all siblings up to the subroot.  The trees of
  all groups jump at once; the tree of subroots is a second, smaller job of
  the same kind, whose segments are appended.

A segment is a string of 33-byte entries from the leaf upwards: on which side
the sibling stands (0 left, 1 right, 2 none), and its digest.

Null columns hash as ``-``; a null key comes first, as does a null group.
Rows of equal key are ordered by their leaves; equal rows are interchangeable,
and each has its own proof.  An empty table gives an empty result.  Other
columns are ignored.  A group, key or row that holds a third of the table is
split like any other rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerspark.llm.common import broadcast_if_small, crc_mod, data_bytes, discard, ready, stored

COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
#: levels made in one step, by blocks of 2^BLOCK nodes
BLOCK = 10

_NODE = pa.schema(
    [
        ("g", pa.int64()),
        ("n", pa.int64()),
        ("level", pa.int32()),
        ("idx", pa.int64()),
        ("seg", pa.binary()),
        ("digest", pa.binary()),
        ("row", pa.struct([("doc_id", pa.int64()), ("leaf", pa.binary()), ("changed", pa.binary())])),
    ]
)
NODES = (
    "g long, n long, level int, idx long, seg binary, digest binary, "
    "row struct<doc_id: long, leaf: binary, changed: binary>"
)


def canonical(value: Column) -> Column:
    """``-`` for null, else UTF-8 byte count, colon, value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(values: list[Column]) -> Column:
    return F.unhex(F.sha2(F.concat(*map(canonical, values)).cast("binary"), 256))


def as_hex(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def leaves(docs: DataFrame, columns: tuple[str, ...] = COLUMNS, group: str = "lang", key: str = "doc_id") -> DataFrame:
    """grp, doc_id (the key), leaf, and ``changed``: the leaf of the row as
    tampered with (n_chars + 1), null where it is left alone."""
    values = {c: F.col(c).cast("long") if c in ("doc_id", "n_chars") else F.col(c) for c in columns}
    tampered = [v + F.lit(1) if c == "n_chars" else v for c, v in values.items()]
    return docs.select(
        F.col(group).cast("string").alias("grp"),
        F.col(key).cast("long").alias("doc_id"),
        leaf_digest(list(values.values())).alias("leaf"),
        F.when(crc_mod(key, 7) == 0, leaf_digest(tampered)).alias("changed"),
    )


def numbered(df: DataFrame, order: list[str]) -> DataFrame:
    """``df`` (stored) with ``position``: 0, 1, ... in the given order, nulls
    first.  Ties may be dealt to several tasks; which goes first is fixed by
    the stored result."""
    ranges = (
        df.withColumn("_row", F.monotonically_increasing_id())
        .repartitionByRange(*order, "_row")
        .sortWithinPartitions(*order, "_row")
        .drop("_row")
        .withColumn("_place", F.monotonically_increasing_id())
    )
    # one number is added to each row
    placed = stored(ranges, "numbered", 2 * data_bytes(df)).withColumn("_part", F.shiftright("_place", 33))
    counts = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    # one row for each partition
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    return placed.join(F.broadcast(base), "_part").select(
        *df.columns, (F.col("_base") + F.col("_place").bitwiseAND((1 << 33) - 1)).alias("position")
    )


def _blocks(batches: Iterator[pa.RecordBatch], base: int) -> Iterator[pa.RecordBatch]:
    """The nodes of each block, from level ``base`` up to the block's top."""
    for batch in batches:
        for i in range(len(batch)):  # one block at a time as Python objects
            block = batch.slice(i, 1).to_pylist()[0]
            g, n, out = block["g"], block["n"], []
            at = block["block"] << BLOCK
            nodes = [(m["digest"], m["row"]) for m in block["members"]]
            for level in range(base, base + BLOCK):
                width = -(-n >> level)  # nodes of the whole group on this level
                if width <= 1:
                    break
                above = []
                for k in range(0, len(nodes), 2):
                    (left, row), other = nodes[k], nodes[k + 1 : k + 2]
                    node = {"g": g, "n": n, "level": level}
                    if other:
                        right = other[0][0]
                        out.append(node | {"idx": at + k, "seg": b"\1" + right, "row": row})
                        out.append(node | {"idx": at + k + 1, "seg": b"\0" + left, "row": other[0][1]})
                        joined = left.hex() + right.hex()
                    else:
                        out.append(node | {"idx": at + k, "seg": b"\2" + bytes(32), "row": row})
                        joined = left.hex()
                    above.append((hashlib.sha256(joined.encode()).digest(), None))
                nodes, at = above, at >> 1
            # the top of the block: a member of the next step, or the subroot
            top = min(base + BLOCK, (n - 1).bit_length())
            out.append({"g": g, "n": n, "level": top, "idx": at, "digest": nodes[0][0]})
            yield pa.RecordBatch.from_pylist(out, _NODE)


#: bytes of a node, without its segment, at most
NODE_BYTES = 200


def tree(members: DataFrame, largest: int, total: int) -> tuple[DataFrame, DataFrame]:
    """(nodes, subroots) over the ``total`` ``members``: g, n (members of the
    group), idx, digest, row.  nodes: every node under a subroot with its
    1-level segment; subroots: g, digest."""
    ready()
    lone = members.where("n = 1")
    parts = [
        lone.select("g", "n", F.lit(0).alias("level"), "idx", F.unhex(F.lit("")).alias("seg"), "digest", "row")
    ]
    tops = [lone.select("g", "digest")]
    current, base = members.where("n > 1"), 0
    while largest > 1 << base:
        grouped = (
            current.withColumn("block", F.shiftright("idx", BLOCK))
            .groupBy("g", "n", "block")
            .agg(F.array_sort(F.collect_list(F.struct("idx", "digest", "row"))).alias("members"))
        )
        step = base
        nodes = stored(grouped.mapInArrow(lambda b, step=step: _blocks(b, step), NODES), "tree", 2 * total * (NODE_BYTES + 33))
        base += BLOCK
        parts.append(nodes.where("digest is null"))
        up = nodes.where("digest is not null")
        tops.append(up.where(F.col("n") <= F.shiftleft(F.lit(1).cast("long"), base)).select("g", "digest"))
        current = up.where(F.col("n") > F.shiftleft(F.lit(1).cast("long"), base))
    return reduce(DataFrame.unionAll, parts), reduce(DataFrame.unionAll, tops)


def jumped(nodes: DataFrame, largest: int, total: int) -> DataFrame:
    """Every one of the ``total`` leaves (level 0) with all siblings up to its
    subroot."""
    current, old = nodes.drop("n", "digest"), None
    step = 1
    while step < (largest - 1).bit_length():
        aligned = F.col("level") % (2 * step)
        low = current.where(aligned == 0).alias("low")
        high = (
            current.where(aligned == step)
            .select("g", (F.col("level") - step).alias("level"), F.col("idx").alias("up"), F.col("seg").alias("more"))
            .alias("high")
        )
        k = step.bit_length() - 1  # the ancestor 2^k levels up
        joined = low.join(
            high,
            (F.col("low.g") == F.col("high.g"))
            & (F.col("low.level") == F.col("high.level"))
            & (F.shiftright("low.idx", step) == F.col("high.up")),
            "left",
        ).select(
            "low.g",
            "low.level",
            "low.idx",
            F.concat("low.seg", F.coalesce("high.more", F.unhex(F.lit("")))).alias("seg"),
            "low.row",
        )
        current = stored(joined, f"jump-{k}", 2 * total * (NODE_BYTES + 2 * step * 33))
        if old is not None:
            discard(old)
        old, step = current, 2 * step
    return current.where("level = 0")


def _fold(leaf: Column, seg: Column) -> Column:
    """The root that a leaf and its siblings give."""
    entries = F.expr("sequence(0, length(seg) div 33 - 1)")

    def step(h: Column, i: Column) -> Column:
        side, other = F.substring(seg, 33 * i + 1, 1), as_hex(F.substring(seg, 33 * i + 2, 32))
        both = (
            F.when(side == F.unhex(F.lit("00")), F.concat(other, h))
            .when(side == F.unhex(F.lit("01")), F.concat(h, other))
            .otherwise(h)
        )
        return F.sha2(both.cast("binary"), 256)

    return F.when(F.length(seg) == 0, as_hex(leaf)).otherwise(F.aggregate(entries, as_hex(leaf), step))


def _proof(seg: Column) -> Column:
    """The siblings' digests, from the leaf upwards, hashed as one text."""
    entries = F.expr("sequence(0, length(seg) div 33 - 1)")

    def digest(i: Column) -> Column:
        none = F.substring(seg, 33 * i + 1, 1) == F.unhex(F.lit("02"))
        return F.when(none, F.lit("")).otherwise(as_hex(F.substring(seg, 33 * i + 2, 32)))

    listed = F.when(F.length(seg) == 0, F.lit("")).otherwise(F.array_join(F.transform(entries, digest), ""))
    return F.sha2(listed.cast("binary"), 256)


def manifest(
    docs: DataFrame, columns: tuple[str, ...] = COLUMNS, group: str = "lang", key: str = "doc_id"
) -> DataFrame:
    """Every row's doc_id, leaf, subroot, root, proof (the segment of
    siblings), proof_sha256, folded_root (from the tampered leaf where there
    is one) and verified."""
    spark = docs.sparkSession
    hashed = stored(leaves(docs, columns, group, key), "leaves")
    rows = numbered(hashed, ["grp", "doc_id", "leaf"])
    # a group is named by the position of its first leaf; their order is the groups'
    named = rows.groupBy("grp").agg(F.min("position").alias("g"), F.count(F.lit(1)).alias("n"))
    groups = stored(named, "groups", data_bytes(hashed))
    largest, n_groups, total = groups.agg(F.max("n"), F.count(F.lit(1)), F.sum("n")).first()
    members = rows.join(broadcast_if_small(groups), rows["grp"].eqNullSafe(groups["grp"])).select(
        "g",
        "n",
        (F.col("position") - F.col("g")).alias("idx"),
        F.col("leaf").alias("digest"),
        F.struct("doc_id", "leaf", "changed").alias("row"),
    )
    nodes, subroots = tree(members, largest or 0, total or 0)
    paths = jumped(nodes, largest or 0, total or 0)

    tops = numbered(stored(subroots, "subroots", n_groups * NODE_BYTES), ["g"]).select(
        F.lit(0).cast("long").alias("g"),
        F.lit(n_groups).cast("long").alias("n"),
        F.col("position").alias("idx"),
        "digest",
        F.struct(
            F.col("g").alias("doc_id"), F.col("digest").alias("leaf"), F.lit(None).cast("binary").alias("changed")
        ).alias("row"),
    )
    top_nodes, roots = tree(tops, n_groups, n_groups)
    top_paths = jumped(top_nodes, n_groups, n_groups)
    above = stored(
        top_paths.join(F.broadcast(roots.withColumnRenamed("digest", "root")), "g").select(  # one root
            F.col("row.doc_id").alias("g"), F.col("row.leaf").alias("subroot"), "root", F.col("seg").alias("upper")
        ),
        "above",
        n_groups * (NODE_BYTES + 33 * 64),
    )
    proofs = paths.join(broadcast_if_small(above), "g").select(
        F.col("row.doc_id").alias("doc_id"),
        F.col("row.leaf").alias("leaf"),
        F.col("row.changed").alias("changed"),
        "subroot",
        "root",
        F.concat("seg", "upper").alias("seg"),
    )
    seg = F.col("seg")
    return proofs.select(
        "doc_id",
        as_hex(F.col("leaf")).alias("leaf"),
        as_hex(F.col("subroot")).alias("subroot"),
        as_hex(F.col("root")).alias("root"),
        seg.alias("proof"),
        _proof(seg).alias("proof_sha256"),
        _fold(F.coalesce("changed", "leaf"), seg).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
