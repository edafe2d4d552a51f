"""Near-duplicate groups: MinHash bands, sequential Bayesian verification,
exact check, connected components.

1. Every text becomes its set of word shingles, a MinHash signature and a
   128-bit key of the set.  Texts with equal sets are one *class*; everything
   below works on classes, so exact copies cost one row each.
2. Classes that agree in a band of the signature share a bucket.  Nothing
   pairs up a bucket's members: in the first round each class is compared
   with one member, the pivot, of each of its buckets only; in the next ones
   what is not in its bucket's largest component with pivots of that.
3. A comparison reads the signatures in batches and stops as soon as the
   posterior probability that the similarity reaches the threshold falls
   under ``miss`` (uniform prior, binomial matches).  Survivors are checked
   on the full shingle sets, recomputed from the texts of the classes they
   name.
4. Links are contracted to components.  A bucket whose members are in one
   component is done.  In the others every class outside the bucket's largest
   component is compared with the bucket's members of other components, block
   by block inside the tasks, and each pair in the first bucket it shares only.
   Signatures come first; shingle sets are sent for classes that still have a
   partner.  Only links that join components leave a block.  So the work on a
   large group of copies is linear in its size plus, for each class that did
   not link, one comparison with each member of its buckets.

Texts that are null, empty or white space have no shingles and are linked
with nothing.  Rows that repeat a doc_id are one document; different texts
under one doc_id are linked.  A null doc_id never becomes a component_id; a
component of null ids only has a null component_id, and its rows are all
marked as kept; ``deduplicate`` leaves one of them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerspark.llm.common import (
    give_back,
    BROADCAST_BYTES,
    broadcast_if_small,
    data_bytes,
    files_for,
    ready,
    row_key,
    shuffle_partitions,
    stored,
    text_of,
)
from ledgerspark.llm.shingles import U, shingle_set, words

BANDS, ROWS = 32, 4
PERMS = BANDS * ROWS
BATCH = 16  # hashes compared between two looks at the posterior
PER_HUB = 64  # partners that share one copy of a hub's shingle set
GROUP_BYTES = 16_000_000  # shingle sets in one task group
BLOCK = 256  # classes in a block
LARGE = 1_000_000  # bytes; what smaller groups leave behind is not worth a whole collection

_rng = np.random.default_rng(20240229)
_MULTIPLY = _rng.integers(1, 2**63, PERMS, dtype=U) * U(2) + U(1)
_ADD = _rng.integers(0, 2**63, PERMS, dtype=U)


def signature(shingles: np.ndarray) -> np.ndarray:
    """Minimum of each of PERMS hash functions over the set."""
    low = np.full(PERMS, np.iinfo(np.uint32).max, dtype=np.uint32)
    for k in range(0, len(shingles), 256):
        part = shingles[k : k + 256, None] * _MULTIPLY + _ADD
        np.minimum(low, (part.min(axis=0) >> U(32)).astype(np.uint32), out=low)
    return low


def least_matches(threshold: float, miss: float) -> list[tuple[int, int]]:
    """(n, m): after n compared hashes, fewer than m matches leave less than
    ``miss`` posterior probability for a similarity of ``threshold`` or more."""
    s = (np.arange(20_000) + 0.5) / 20_000
    log_s, log_r = np.log(s), np.log1p(-s)
    out = []
    for n in range(BATCH, PERMS + 1, BATCH):
        for m in range(n + 1):
            log_p = m * log_s + (n - m) * log_r
            p = np.exp(log_p - log_p.max())
            if p[s >= threshold].sum() / p.sum() >= miss:
                break
        out.append((n, m))
    return out


def survivors_of(
    signatures: np.ndarray, x: np.ndarray, y: np.ndarray, bounds: list[tuple[int, int]]
) -> tuple[np.ndarray, np.ndarray]:
    """Which of the pairs of rows (x[i], y[i]) pass every bound, and their matches."""
    alive, matches = np.arange(len(x)), np.zeros(len(x), dtype=np.int64)
    for n, m in bounds:
        if not len(alive):
            break
        matches = matches + (signatures[x[alive], n - BATCH : n] == signatures[y[alive], n - BATCH : n]).sum(axis=1)
        keep = matches >= m
        alive, matches = alive[keep], matches[keep]
    return alive, matches


def survivors(a: np.ndarray, b: np.ndarray, bounds: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """The same for pairs (a[i], b[i]) of signatures."""
    at = np.arange(len(a))
    return survivors_of(np.concatenate([a, b]), at, at + len(a), bounds)


def _signatures(column: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(column), dtype=np.uint32).reshape(-1, PERMS)


def sketches(docs: DataFrame, ngram: int) -> DataFrame:
    """rid (row key), doc_id, n_shingles, cls (key of the shingle set) and
    signature; the last two are null without shingles."""
    ready()

    def sketch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for rid, doc_id, text in zip(batch["rid"], batch["doc_id"], batch["text"], strict=True):
                s = shingle_set(words(text), ngram)
                key = hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None
                out.append((rid, doc_id, len(s), key, signature(s).tobytes() if len(s) else None))
            frame = pd.DataFrame(out, columns=["rid", "doc_id", "n_shingles", "cls", "sig"])
            frame["doc_id"] = frame["doc_id"].astype("Int64")
            yield frame
        give_back()

    source = docs.select(row_key().alias("rid"), F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    return source.mapInPandas(sketch, "rid long, doc_id long, n_shingles long, cls binary, sig binary")


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of ``edges`` (a, b): the label is the
    smallest node reachable.  Minimum over neighbours, then one jump along
    the labels, until nothing changes.  Labels are broadcast while their
    measured size allows, and joined by a shuffle beyond."""
    size = 2 * data_bytes(edges)
    both = stored(edges.select("a", "b").union(edges.select("b", "a")).distinct(), "edges", size)
    labels = both.groupBy(F.col("a").alias("node")).agg(F.min(F.least("a", "b")).alias("label"))
    labels = stored(labels, "labels", size)
    sent = F.broadcast if data_bytes(labels) <= BROADCAST_BYTES else (lambda df: df)
    while True:
        near = both.join(sent(labels), both.b == labels.node).groupBy("a").agg(F.min("label").alias("near"))
        step = labels.join(sent(near), labels.node == near.a).select(
            "node", F.least("label", "near").alias("next"), F.col("label").alias("old")
        )
        to = sent(labels.select(F.col("node").alias("at"), F.col("label").alias("there")))
        jumped = step.join(to, step.next == to.at).select("node", F.least("next", "there").alias("label"), "old")
        moved = stored(jumped, "labels", 2 * size)
        labels = moved.select("node", "label")
        if moved.where(F.col("label") != F.col("old")).isEmpty():
            return labels


def shingle_sets(docs: DataFrame, classes: DataFrame, ngram: int) -> DataFrame:
    """(cls, members): the full shingle set of each of ``classes``, from the
    text of one of its rows."""
    ready()
    wanted = classes.select("cls", F.col("any_rid").alias("rid"))
    source = docs.select(row_key().alias("rid"), text_of().alias("text"))

    def sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [shingle_set(words(t), ngram) for t in batch["text"]]
            keys = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in found]
            rows = [(c, s.tobytes()) for c, s, k in zip(batch["cls"], found, keys, strict=True) if bytes(c) == k]
            yield pd.DataFrame(rows, columns=["cls", "members"])
        give_back()

    return (
        source.join(broadcast_if_small(wanted), "rid")
        .select("cls", "text")
        .mapInPandas(sets, "cls binary, members binary")
    )


def exact_links(pairs: DataFrame, full: DataFrame, threshold: float) -> DataFrame:
    """The (a, b) of the stored ``pairs`` whose shingle sets reach ``threshold``.

    ``b`` is the column whose values repeat more, the hub.  Its set travels once for
    every ``PER_HUB`` partners, each partner's set once per pair.
    """
    ready()
    spark = pairs.sparkSession
    degree = pairs.groupBy("b").agg(F.count(F.lit(1)).alias("degree"))
    dealt = stored(
        pairs.select("a", "b")
        .join(degree, "b")
        .select(
            F.col("b").alias("hub"),
            F.col("a").alias("other"),
            F.pmod(F.xxhash64("a"), F.ceil(F.col("degree") / PER_HUB)).alias("salt"),
        ),
        "dealt",
        2 * data_bytes(pairs),
    )
    known = full.select("cls", "members")
    hubs = known.join(broadcast_if_small(dealt.select("hub", "salt").distinct()), F.col("cls") == F.col("hub")).select(
        "hub", "salt", F.lit(None).cast("binary").alias("other"), "members"
    )
    others = known.join(broadcast_if_small(dealt), F.col("cls") == F.col("other")).select("hub", "salt", "other", "members")
    size = full.agg(F.avg(F.octet_length("members"))).first()[0] or 0
    sent = int(2 * dealt.count() * size)
    groups = max(shuffle_partitions(spark), sent // GROUP_BYTES)
    per = int(round(threshold * 1_000_000))

    def check(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        keep = []
        centre = rows["other"].isna().to_numpy()
        ids = list(zip(rows["hub"], rows["salt"], strict=True))
        sets = [np.frombuffer(m, dtype=U) for m in rows["members"]]
        of = {ids[k]: sets[k] for k in np.flatnonzero(centre)}
        for k in np.flatnonzero(~centre):
            x, y = of[ids[k]], sets[k]
            both = len(np.intersect1d(x, y, assume_unique=True))
            if 1_000_000 * both >= per * (len(x) + len(y) - both):
                keep.append((rows["other"].iat[k], rows["hub"].iat[k]))
        held = sum(s.nbytes for s in sets)
        del rows, sets, of
        if held >= LARGE:
            give_back()
        return pd.DataFrame(keep, columns=["a", "b"])

    return (
        hubs.union(others)
        .withColumn("g", F.pmod(F.xxhash64("hub", "salt"), F.lit(groups)))
        .groupBy("g")
        .applyInPandas(check, "a binary, b binary")
        .coalesce(files_for(spark, sent))
    )


def near_duplicates(
    docs: DataFrame, ngram: int = 5, threshold: float = 0.8, miss: float = 1e-6
) -> DataFrame:
    """One row per row of ``docs``: rid, doc_id, n_shingles, component_id, kept."""
    return _grouped(docs, ngram, threshold, miss).drop("label")


def _grouped(docs: DataFrame, ngram: int, threshold: float, miss: float) -> DataFrame:
    """``near_duplicates`` with the class that stands for the group (label)."""
    ready()
    bounds = least_matches(threshold, miss)
    spark = docs.sparkSession
    sketch = stored(sketches(docs, ngram), "sketches")
    size = data_bytes(sketch)
    classes = stored(
        sketch.where(F.col("cls").isNotNull())
        .groupBy("cls")
        .agg(
            F.min("doc_id").alias("low_id"),
            F.min("rid").alias("any_rid"),
            F.min(F.struct("sig")).getField("sig").alias("sig"),
        ),
        "classes",
        size,
    )

    # buckets with at least two classes
    each = classes.select(
        "cls",
        F.posexplode(
            F.transform(
                F.sequence(F.lit(0), F.lit(BANDS - 1)),
                lambda k: F.xxhash64(k, F.substring(F.col("sig"), k * (4 * ROWS) + 1, F.lit(4 * ROWS))),
            )
        ).alias("band", "key"),
    )
    number = F.xxhash64("cls")
    shared = each.select("key", number.alias("h")).groupBy("key").agg(F.min("h").alias("low"), F.max("h").alias("high"))
    shared = stored(shared.where("low != high").select("key"), "shared", 2 * size)
    # a class has BANDS numbers in its signature, and as many rows here at most
    buckets = stored(each.join(broadcast_if_small(shared), "key").select("band", "key", "cls"), "buckets", 8 * size)
    bucketed = data_bytes(buckets)
    near = stored(classes.join(broadcast_if_small(buckets.select("cls").distinct()), "cls", "left_semi"), "near", size)
    sig = near.select("cls", "sig")

    in_sets = size + 8 * (sketch.agg(F.sum("n_shingles")).first()[0] or 0)
    full = stored(shingle_sets(docs, near, ngram).dropDuplicates(["cls"]), "sets", in_sets)

    def against(asked: DataFrame, pivots: DataFrame) -> DataFrame:
        """Links of the classes in ``asked`` (key, cls) to their buckets'
        pivots: of those that pass the bounds the best one, verified."""
        tasks = files_for(spark, asked.count() * 2 * (4 * PERMS + 64))
        tried = (
            asked.join(broadcast_if_small(pivots), "key")
            .where(F.col("cls") != F.col("pivot"))
            .select(F.col("cls").alias("a"), F.col("pivot").alias("b"))
            .distinct()
            .join(sig.select(F.col("cls").alias("a"), F.col("sig").alias("x")), "a")
            .join(sig.select(F.col("cls").alias("b"), F.col("sig").alias("y")), "b")
            .coalesce(tasks)
            .mapInPandas(_compared(bounds), "a binary, b binary, matches long")
        )
        best = tried.groupBy("a").agg(F.max(F.struct("matches", "b")).getField("b").alias("b"))
        return stored(exact_links(stored(best, "pairs", size), full, threshold), "links")

    def pivots_of(rows: DataFrame, number: int) -> DataFrame:
        """Any one class of each bucket; another one in each round and bucket."""
        return stored(
            rows.groupBy("key").agg(F.min_by("cls", F.xxhash64("key", "cls", F.lit(number))).alias("pivot")), "pivots", bucketed
        )

    # first round: each class against the pivots of its buckets
    links = against(buckets.select("key", "cls"), pivots_of(buckets, 0))

    # different texts under one doc_id belong together
    named = sketch.where(F.col("cls").isNotNull() & F.col("doc_id").isNotNull()).select("doc_id", "cls")
    repeated = named.groupBy("doc_id").agg(F.min("cls").alias("a"), F.max("cls").alias("z")).where(F.col("a") != F.col("z"))
    repeated = stored(repeated.select("doc_id", "a"), "repeated", size)
    if not repeated.isEmpty():
        links = links.union(named.join(repeated, "doc_id").where("cls != a").select("a", F.col("cls").alias("b")))

    # more rounds, for what is not in its bucket's largest component, against
    # pivots of that component, as long as each round settles half of it
    number, left = 0, None
    while True:
        labels = components(links)
        members, open_ = _opened(buckets, labels, 2 * bucketed)
        inside = members.join(broadcast_if_small(open_), "key")
        outside = stored(inside.where("label != main").select("key", "cls"), "outside", bucketed)
        n = outside.count()
        if not n or left is not None and 2 * n > left:
            break
        number, left = number + 1, n
        found = against(outside, pivots_of(inside.where("label = main"), number))
        if found.isEmpty():
            break
        links = links.union(found)

    # what is left in such buckets against everything in them
    grouped = _labelled(classes.select("cls", "low_id"), labels, "cls", "label")
    if n:
        found = stored(_open_links(members, open_, near, full, bounds, threshold), "links")
        if not found.isEmpty():
            whole = F.col("whole").alias("label")
            grouped = _labelled(grouped, components(found), "label", "whole").select("cls", "low_id", whole)
    lowest = grouped.groupBy("label").agg(F.min("low_id").alias("component_id"))
    by_class = grouped.join(lowest, "label").select("cls", "label", "component_id")
    return (
        sketch.select("rid", "doc_id", "n_shingles", "cls")
        .join(by_class, "cls", "left")
        .select(
            "rid",
            "doc_id",
            "n_shingles",
            F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
            "label",
        )
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
    )


def deduplicate(docs: DataFrame, ngram: int = 5, threshold: float = 0.8, miss: float = 1e-6) -> DataFrame:
    """``docs`` with one row of each near-duplicate group: one with the
    group's smallest doc_id, or any one where the group has no doc_id.  Rows
    without words all stay."""
    decided = stored(_grouped(docs, ngram, threshold, miss), "groups")
    linked = decided.where("n_shingles > 0")
    chosen = linked.where("kept").groupBy("label").agg(F.min("rid").alias("chosen"))
    drop = linked.join(chosen, "label").where("rid != chosen").select("rid").distinct()
    size = data_bytes(decided)
    drop = stored(drop, "copies", size)
    again = linked.groupBy("rid").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("rid")
    again = stored(again.join(drop, "rid", "left_anti"), "repeats", size)
    # the row as one column: its own column names cannot clash with ours
    columns = [F.col(f"`{c}`") for c in docs.columns]
    rows = docs.select(F.struct(*columns).alias("row"), row_key().alias("own"))
    left = rows.join(broadcast_if_small(drop), F.col("own") == F.col("rid"), "left_anti")
    if again.isEmpty():
        return left.select("row.*")
    once = left.join(broadcast_if_small(again), F.col("own") == F.col("rid"), "left_anti")
    many = left.join(broadcast_if_small(again), F.col("own") == F.col("rid"), "left_semi")
    return once.union(many.dropDuplicates(["own"])).select("row.*")


def _labelled(df: DataFrame, labels: DataFrame, node: str, name: str) -> DataFrame:
    """``df`` with the component label of ``node`` (itself if it has no link)."""
    known = labels.select(F.col("node").alias(node), F.col("label").alias("_label"))
    return df.join(known, node, "left").withColumn(name, F.coalesce("_label", node)).drop("_label")


def _compared(bounds: list[tuple[int, int]]):
    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            at, matches = survivors(_signatures(batch["x"]), _signatures(batch["y"]), bounds)
            yield batch[["a", "b"]].iloc[at].assign(matches=matches)
        give_back()

    return compare


def _opened(buckets: DataFrame, labels: DataFrame, size: int) -> tuple[DataFrame, DataFrame]:
    """The buckets' members (of ``size`` bytes at most) with their component,
    and the buckets that hold several: key, main (the largest one), n (members), n_main (of those in it)."""
    members = stored(_labelled(buckets, labels, "cls", "label"), "members", size)
    sizes = members.groupBy("key", "label").agg(F.count(F.lit(1)).alias("n"))
    bucket = sizes.groupBy("key").agg(
        F.max(F.struct("n", "label")).getField("label").alias("main"), F.sum("n").alias("n"), F.max("n").alias("n_main")
    )
    return members, stored(bucket.where("n > n_main"), "open", size)


def _open_links(
    members: DataFrame, open_: DataFrame, near: DataFrame, full: DataFrame, bounds: list[tuple[int, int]], threshold: float
) -> DataFrame:
    """Links (a, b) between components, as labels; none that could join two
    components is missing.

    The members of a bucket that holds several components are dealt over
    blocks of about BLOCK, and so are those outside its largest component;
    every pair of blocks is compared once.
    """
    ready()
    spark = members.sparkSession
    inside = members.join(broadcast_if_small(open_), "key").select(
        "key",
        "band",
        "cls",
        "label",
        (F.col("label") == F.col("main")).alias("is_main"),
        F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"),
        F.ceil((F.col("n") - F.col("n_main")) / BLOCK).cast("int").alias("others"),
    )
    each = F.transform(
        F.sequence(F.lit(0), F.col("others") - 1),
        lambda k: F.struct(
            F.lit(False).alias("outside"), F.pmod(F.xxhash64("cls"), F.col("blocks")).cast("int").alias("x"), k.alias("y")
        ),
    )
    copies = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1),
        lambda k: F.struct(
            F.lit(True).alias("outside"), k.alias("x"), F.pmod(F.xxhash64("cls"), F.col("others")).cast("int").alias("y")
        ),
    )
    to = F.when(F.col("is_main"), each).otherwise(F.concat(each, copies))
    placed = stored(
        inside.withColumn("to", F.explode(to)).select("key", "band", "cls", "label", "is_main", "to.outside", "to.x", "to.y"),
        "placed",
    )
    sig = near.select(F.col("cls").alias("own"), "sig")

    def dealt(rows: DataFrame, size: float) -> DataFrame:
        """``rows`` in groups of about GROUP_BYTES, blocks kept together."""
        groups = max(8 * shuffle_partitions(spark), int(placed.count() * size // GROUP_BYTES))
        return rows.drop("own").withColumn("g", F.pmod(F.xxhash64("key", "x", "y"), F.lit(groups))).groupBy("g")

    def candidates(rows: pd.DataFrame) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For each pair of blocks the rows (x[i], y[i]) that pass the bounds."""
        signatures, cls, label = _signatures(rows["sig"]), rows["cls"].to_numpy(), rows["label"].to_numpy()
        is_main, outside, band = rows["is_main"].to_numpy(), rows["outside"].to_numpy(), rows["band"].to_numpy()
        for at in rows.groupby(["key", "x", "y"]).indices.values():
            m, o = at[~outside[at]], at[outside[at]]
            if not len(m) or not len(o):
                continue
            # all of the largest component; of the rest, each pair once
            ask = (label[o][:, None] != label[m]) & (is_main[m] | (cls[m] < cls[o][:, None]))
            x, y = np.nonzero(ask)
            x, y = o[x], m[y]
            for k in range(int(band[at[0]])):  # an earlier bucket that the pair shares too
                if not len(x):
                    break
                rows_of = slice(k * ROWS, (k + 1) * ROWS)
                apart = (signatures[x, rows_of] != signatures[y, rows_of]).any(axis=1)
                x, y = x[apart], y[apart]
            kept, _ = survivors_of(signatures, x, y, bounds)
            if len(kept):
                yield x[kept], y[kept]

    def partnered(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        found = [np.concatenate(pair) for pair in candidates(rows)]
        at = np.unique(np.concatenate(found)) if found else []
        out = rows.iloc[at].drop(columns=["sig", "g"])
        held = 4 * PERMS * len(rows)
        del rows, found
        if held >= LARGE:
            give_back()
        return out

    schema = "key long, band int, cls binary, label binary, is_main boolean, outside boolean, x int, y int"
    asked = placed.join(sig, F.col("own") == F.col("cls"))
    paired = stored(dealt(asked, 4 * PERMS).applyInPandas(partnered, schema), "partnered")
    per = int(round(threshold * 1_000_000))

    def match(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        out = []
        names, label = np.unique(rows["label"].to_numpy(), return_inverse=True)
        sets = [np.frombuffer(m, dtype=U) for m in rows["members"]]
        for x, y in candidates(rows):
            joined: dict[int, int] = {}  # components that the links of this block join already

            def root(k: int) -> int:
                while joined.get(k, k) != k:
                    k = joined[k]
                return k

            m = np.unique(y)
            length = np.array([len(sets[k]) for k in m])
            distinct, number = np.unique(np.concatenate([sets[k] for k in m]), return_inverse=True)
            begins = np.r_[0, np.cumsum(length)[:-1]]
            for i in np.unique(x):
                own = sets[i]
                place = np.minimum(np.searchsorted(distinct, own), len(distinct) - 1)
                mark = np.zeros(len(distinct), dtype=np.int64)
                mark[place[distinct[place] == own]] = 1
                both = np.add.reduceat(mark[number], begins)
                for k in np.searchsorted(m, y[x == i]):
                    if 1_000_000 * both[k] >= per * (len(own) + length[k] - both[k]):
                        p, q = root(label[i]), root(label[m[k]])
                        if p != q:
                            joined[p] = q
                            out.append((names[label[i]], names[label[m[k]]]))
        return pd.DataFrame(out, columns=["a", "b"])

    size = full.agg(F.avg(F.octet_length("members"))).first()[0] or 0
    known = full.select(F.col("cls").alias("own"), "members").join(sig, "own")
    with_sets = known.join(broadcast_if_small(paired), F.col("own") == F.col("cls"))
    return dealt(with_sets, size + 4 * PERMS).applyInPandas(match, "a binary, b binary")
