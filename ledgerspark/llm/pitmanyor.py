"""Hierarchical Pitman-Yor language model, trained and applied on Spark.

Two levels of Chinese restaurants: one per context (the word before, as a
64-bit number), all sharing one parent, the root, whose base is uniform over
the training words and one unknown word.  A token is a customer of its
context's restaurant; each table there sends one customer to the root.

    p(w | u) = (c_uw - d t_uw + (s + d T_u) p0(w)) / (s + c_u)
    p0(w)    = (t_w - d0 t0_w + (s0 + d0 T0) / (V + 1)) / (s0 + C0)

with t_w the sum of t_uw over contexts, T_u and T0 the numbers of tables, C0
the customers of the root.  Seating is sampled by Gibbs: all customers of one
word in one restaurant stand up and are seated again one after the other,
with their own tables taken out of T_u and their own customers out of the
root; then each word's customers in the root.  Predictive probabilities are
averages over the last ``SAMPLES`` of ``SWEEPS + BURN_IN + SAMPLES`` seatings
of one chain, each with the totals of that same seating, so they sum to one.
A context's customers are the word's own training count (what follows a word
is a word or the end), so they need no exchange; and a word that follows
another one once has one table there, so only pairs that occur twice or more
are ever seated anew.

Distribution.  Words are ranges of the hash: each has a home.  Pairs (word,
context) are cells of a grid of word and context ranges, the buckets, so the
contexts of a frequent word are spread over many of them.

1. Chunks.  Each task turns its documents into chunks and asks the buckets for
   its pairs and the homes for its words, once for each.
2. Counts.  A bucket adds up the pairs of all chunks; it keeps the repeated
   ones, answers each chunk with their counts, and tells the homes its sums.
   The buckets take turns, ``PASSES`` shares of them, so that the pairs are on
   their way a share at a time; files that were read are deleted.
3. Sweeps.  Buckets seat their repeated pairs and send table sums for their
   words and contexts, in an order both sides know; homes add them up, seat
   the root, and answer with totals.  What other buckets do in the same sweep
   is seen in the next one, as is usual for distributed Gibbs sampling.  Files
   of a sweep that no sample needs any more are deleted.
4. Scores.  Homes and buckets answer the chunks with the samples' tables, and
   each chunk adds up its documents.

Every exchange goes between parts that have something to say to each other,
and its size follows the pairs there are.

Null and empty texts are the end token alone.  Repeated rows count again and
are scored again; null ids are kept.  With nothing to learn from every token
has probability 1 under base and model (the only outcome is the unknown word).
An empty table gives an empty result.  Other columns are ignored.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerspark.llm.common import discard, give_back, ready, stored, stored_by, text_of
from ledgerspark.llm.shingles import U, word_numbers, words

BUCKET_BYTES = 12_000_000  # text per bucket
PASSES = 4  # the buckets are counted a share at a time, so a share of the pairs is being dealt at a time
LEAST_BUCKETS = 16
CHUNK_TOKENS = 2_000_000
CHUNK_DOCS = 60_000
SWEEPS, BURN_IN, SAMPLES = 2, 1, 3
END = U(1)  # the number of the end token
STRENGTH = 1.0
ONE_BY_ONE = 16  # customers seated in single steps; then from candidate to candidate


# --- arrays as bytes

_RAW, _SORTED, _TABLE = range(3)


def _pack(*arrays: np.ndarray) -> bytes:
    """Arrays, one after the other, compressed.  Whole numbers that are not
    negative take the width they need; sorted hashes (64 bits, unsigned) go as
    differences, and hashes that repeat as a table and places in it."""
    head: list[int] = []
    body: list[bytes] = []

    def put(a: np.ndarray, how: int) -> None:
        if how != _RAW:
            a = np.diff(a, prepend=U(0))
        if a.dtype.kind in "iu" and len(a) and a.min() >= 0:
            a = a.astype(np.min_scalar_type(a.max()))
        head.extend((how, ord(a.dtype.kind), a.itemsize, len(a)))
        # bytes of equal weight side by side: the high ones are mostly zero
        body.append(np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.itemsize).T.tobytes())

    for a in arrays:
        if a.dtype == np.uint64 and len(a) > 1:
            if (a[1:] > a[:-1]).all():
                put(a, _SORTED)
                continue
            table, at = np.unique(a, return_inverse=True)
            if 4 * len(table) <= 3 * len(a):
                put(table, _TABLE)
                put(at, _RAW)
                continue
        put(a, _RAW)
    raw = np.array([len(head), *head], dtype="<i8").tobytes() + b"".join(body)
    return zstandard.ZstdCompressor(level=1).compress(raw)


def _unpack(data: bytes, *types: str) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(bytes(data))
    n_head = int(np.frombuffer(raw, dtype="<i8", count=1)[0])
    head = np.frombuffer(raw, dtype="<i8", count=n_head, offset=8).reshape(-1, 4)
    out, at, table = [], 8 * (n_head + 1), None
    for how, kind, width, n in head.tolist():
        planes = np.frombuffer(raw, dtype=np.uint8, count=n * width, offset=at).reshape(width, n)
        a = np.ascontiguousarray(planes.T).reshape(-1).view(f"<{chr(kind)}{width}")
        at += n * width
        if how != _RAW:
            a = np.cumsum(a.astype(np.uint64), dtype=np.uint64)
        if how == _TABLE:
            table = a
            continue
        out.append((a if table is None else table[a]).astype(types[len(out)]))
        table = None
    return out


def _range(numbers: np.ndarray, n: int) -> np.ndarray:
    """Which of ``n`` equal ranges of 64-bit numbers each is in; rises with it."""
    return ((numbers >> U(32)) * U(n) >> U(32)).astype(np.int64)


def _runs(x: np.ndarray) -> np.ndarray:
    """Where runs of equal values begin, and the end."""
    if not len(x):
        return np.zeros(1, np.int64)
    return np.flatnonzero(np.r_[True, x[1:] != x[:-1], True])


@dataclass(frozen=True)
class Grid:
    """``homes`` ranges of words; ``rows`` x ``columns`` buckets of pairs."""

    rows: int
    columns: int

    @property
    def homes(self) -> int:
        return self.rows * self.columns

    def bucket(self, word: np.ndarray, context: np.ndarray) -> np.ndarray:
        return _range(word, self.rows) * self.columns + _range(context, self.columns)


def grid_for(text_bytes: int) -> Grid:
    n = max(LEAST_BUCKETS, -(-text_bytes // BUCKET_BYTES))
    columns = math.isqrt(n)
    return Grid(-(-n // columns), columns)


# --- 1. chunks

OWN, NAMES, PAIRS = range(3)  # kinds of rows that a chunk makes; PAIRS + k: for the buckets of pass k
CHUNKS = "kind int, chunk long, part int, payload binary"
# own: ids, null ids, training, lengths; per pair its word and its context (0:
# none, else 1 + a word of the chunk), documents; per (pair, document) the
# document and the count
_OWN = ("<i8", "<u1", "<u1", "<i8", "<u4", "<u4", "<u4", "<u4", "<u4")
_PAIRS = ("<u8", "<u4", "<u8", "<u4")  # words, pairs per word, then per pair context and training count
_NAMES = ("<u8",)


def chunks(docs: DataFrame, grid: Grid, training: Column) -> DataFrame:
    """Rows of CHUNKS: what a chunk keeps (OWN), and what it asks homes
    (NAMES, part: the home) and buckets (PAIRS + pass, part: the bucket)."""
    ready()

    def flush(held: list[tuple]) -> pd.DataFrame:
        chunk = uuid.uuid4().int >> 65
        lengths = np.array([len(x[2]) for x in held], dtype="<i8")
        trained = np.array([x[1] for x in held], dtype="<u1")
        numbers, word = np.unique(np.concatenate([x[2] for x in held]), return_inverse=True)
        before = np.r_[0, word[:-1] + 1].astype(np.uint64)
        before[np.cumsum(lengths) - lengths] = 0
        contexts = np.r_[U(0), numbers]
        key = word.astype(np.uint64) * U(len(contexts)) + before
        order = np.argsort(key, kind="stable")  # documents stay in order
        key, doc = key[order], np.repeat(np.arange(len(held), dtype="<u4"), lengths)[order]
        first = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]) | (doc[1:] != doc[:-1]), True])
        count = np.diff(first).astype("<u4")
        key, doc = key[first[:-1]], doc[first[:-1]]
        pairs = _runs(key)
        learned = np.add.reduceat(count * trained[doc], pairs[:-1]).astype("<u4")
        documents = np.diff(pairs)
        word, before = np.divmod(key[pairs[:-1]], U(len(contexts)))
        word, before = word.astype(np.int64), before.astype(np.int64)
        # pairs by bucket, then word, then context
        bucket = grid.bucket(numbers[word], contexts[before])
        order = np.argsort(bucket.astype(np.min_scalar_type(grid.homes)), kind="stable")
        at = np.repeat(pairs[:-1][order], documents[order])
        at += np.arange(len(at)) - np.repeat(np.cumsum(documents[order]) - documents[order], documents[order])
        bucket, word, before, learned = bucket[order], word[order], before[order], learned[order]
        ids = np.array([0 if pd.isna(x[0]) else x[0] for x in held], dtype="<i8")
        null = np.array([pd.isna(x[0]) for x in held], dtype="<u1")
        steps = np.diff(word, prepend=0).astype("<u4")  # mostly 0 and 1; falls wrap around
        own = _pack(ids, null, trained, lengths, steps, before.astype("<u4"), documents[order], doc[at], count[at])
        rows = [(OWN, chunk, 0, own)]
        cuts = _runs(bucket)
        for a, b in zip(cuts, cuts[1:], strict=False):
            own_words = _runs(word[a:b])
            payload = _pack(
                numbers[word[a:b][own_words[:-1]]], np.diff(own_words).astype("<u4"), contexts[before[a:b]], learned[a:b]
            )
            rows.append((PAIRS + int(bucket[a]) % PASSES, chunk, int(bucket[a]), payload))
        home = _range(numbers, grid.homes)
        cuts = _runs(home)
        rows += [(NAMES, chunk, int(home[a]), _pack(numbers[a:b])) for a, b in zip(cuts, cuts[1:], strict=False)]
        return pd.DataFrame(rows, columns=["kind", "chunk", "part", "payload"])

    def chunked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[tuple] = []
        size = 0
        for batch in batches:
            for doc_id, train, text in zip(batch["doc_id"], batch["train"], batch["text"], strict=True):
                w = np.append(word_numbers(words(text)), END)
                held.append((doc_id, bool(train), w))
                size += len(w)
                if size >= CHUNK_TOKENS or len(held) >= CHUNK_DOCS:
                    yield flush(held)
                    held, size = [], 0
        if held:
            yield flush(held)
        held = []
        give_back()

    source = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(training, F.lit(False)).alias("train"), text_of().alias("text")
    )
    return source.mapInPandas(chunked, CHUNKS)


# --- 2. counts

REPLY, REPEATED, SUMS = range(3)  # kinds of rows that a bucket makes
COUNTED = "kind int, chunk long, bucket int, home int, payload binary"
_REPLY = ("<i8", "<i8")  # per pair asked for its count, and 1 + its place among the repeated ones
_REPEATED = ("<u8", "<u8", "<i8")  # word, context, count; by word, then context
# words, count, pairs that occur once; contexts, such pairs; words and contexts of repeated pairs
_SUMS = ("<u8", "<i8", "<i8", "<u8", "<i8", "<u8", "<u8")


def _cut(numbers: np.ndarray, grid: Grid) -> tuple[np.ndarray, np.ndarray]:
    """Sorted numbers by home: the homes and where each begins (and the end)."""
    home = _range(numbers, grid.homes)
    cuts = _runs(home)
    return home[cuts[:-1]], cuts


def counted(asked: DataFrame, grid: Grid) -> DataFrame:
    """Rows of COUNTED from the chunks' PAIRS."""
    ready()

    def count(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("chunk")
        lists = [_unpack(p, *_PAIRS) for p in part["payload"]]
        words_, w = np.unique(np.concatenate([np.repeat(x[0], x[1]) for x in lists]), return_inverse=True)
        contexts, u = np.unique(np.concatenate([x[2] for x in lists]), return_inverse=True)
        pair, inverse = np.unique(w.astype(np.int64) * len(contexts) + u, return_inverse=True)
        total = np.bincount(inverse, weights=np.concatenate([x[3] for x in lists]), minlength=len(pair)).astype(np.int64)
        w, u = np.divmod(pair, len(contexts))
        many = total > 1
        place = np.where(many, np.cumsum(many), 0)
        bucket = int(key[0])
        rows = []
        at = 0
        for chunk, x in zip(part["chunk"], lists, strict=True):
            own = inverse[at : at + len(x[2])]
            at += len(x[2])
            rows.append((REPLY, chunk, bucket, -1, _pack(total[own], place[own])))
        rows.append((REPEATED, 0, bucket, -1, _pack(words_[w[many]], contexts[u[many]], total[many])))
        # what each home must know, for words and contexts that were trained on
        n, m = len(words_), len(contexts)
        tokens = np.bincount(w, weights=total, minlength=n).astype(np.int64)
        once_w = np.bincount(w[total == 1], minlength=n)
        once_u = np.bincount(u[total == 1], minlength=m)
        lists = [
            (words_[tokens > 0], tokens[tokens > 0], once_w[tokens > 0]),
            (contexts[once_u > 0], once_u[once_u > 0]),
            (words_[np.unique(w[many])],),
            (contexts[np.unique(u[many])],),
        ]
        found: dict[int, list] = {}
        for k, arrays in enumerate(lists):
            homes, cuts = _cut(arrays[0], grid)
            for home, a, b in zip(homes.tolist(), cuts, cuts[1:], strict=False):
                found.setdefault(home, [None] * len(lists))[k] = [x[a:b] for x in arrays]
        for home, parts in found.items():
            flat = [x for own, like in zip(parts, lists, strict=True) for x in (own or [x[:0] for x in like])]
            rows.append((SUMS, 0, bucket, home, _pack(*flat)))
        del lists, found, inverse, pair, total, w, u
        give_back()
        return pd.DataFrame(rows, columns=["kind", "chunk", "bucket", "home", "payload"])

    return asked.select("part", "chunk", "payload").groupBy("part").applyInPandas(count, COUNTED)


# a home: its numbers, their counts, once-pairs as word and as context; then
# how many repeated words and contexts each of its buckets has, and which
_HOME = ("<u8", "<i8", "<i8", "<i8", "<i8", "<u4", "<u4", "<u4", "<u4")


def homes(sums: DataFrame) -> DataFrame:
    """home, payload: the static part of every home."""
    ready()

    def build(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("bucket")
        lists = [_unpack(p, *_SUMS) for p in part["payload"]]
        numbers = np.unique(np.concatenate([np.concatenate((x[0], x[3], x[5], x[6])) for x in lists]))

        def add(k: int, value: int) -> np.ndarray:
            out = np.zeros(len(numbers), dtype="<i8")
            for x in lists:
                out[np.searchsorted(numbers, x[k])] += x[value]  # a bucket names each once
            return out

        many_w = [np.searchsorted(numbers, x[5]).astype("<u4") for x in lists]
        many_u = [np.searchsorted(numbers, x[6]).astype("<u4") for x in lists]
        payload = _pack(
            numbers,
            add(0, 1),
            add(0, 2),
            add(3, 4),
            part["bucket"].to_numpy().astype("<i8"),
            np.array([len(x) for x in many_w], dtype="<u4"),
            np.array([len(x) for x in many_u], dtype="<u4"),
            np.concatenate(many_w),
            np.concatenate(many_u),
        )
        return pd.DataFrame({"home": [int(key[0])], "payload": [payload]})

    return sums.select("home", "bucket", "payload").groupBy("home").applyInPandas(build, "home int, payload binary")


# --- 3. sweeps


@dataclass(frozen=True)
class Totals:
    """What every restaurant knows of the whole seating."""

    tokens: int = 0  # N
    words: int = 0  # V
    customers: float = 0.0  # C0
    tables: float = 0.0  # T0
    discount: float = 0.5
    root_discount: float = 0.5

    def base(self, removed: np.ndarray | float = 0.0) -> np.ndarray | float:
        """The root's weight of a new table for one word, with ``removed`` of
        its tables away."""
        return (STRENGTH + self.root_discount * (self.tables - removed)) / (self.words + 1)


def seat(
    count: np.ndarray, discount: float, weight: Callable[[np.ndarray, np.ndarray], np.ndarray], rng: np.random.Generator
) -> np.ndarray:
    """Tables after seating ``count`` customers of each dish one by one.

    The first opens a table.  With n seated at t tables the next one opens a
    table with probability ``w / (n - discount * t + w)``, where
    ``w = weight(dishes, t)``.  After ``ONE_BY_ONE`` customers this is done by
    thinning: as the probability only falls until a table opens, the next
    customer who would open one at the present probability is drawn at once,
    and opens it with the ratio of the probability at his turn to this one.
    """
    tables = np.minimum(count, 1).astype(np.float64)
    active = np.flatnonzero(count > 1)
    active = active[np.argsort(count[active], kind="stable")]
    sizes = count[active]
    for seated in range(1, ONE_BY_ONE):
        lo = np.searchsorted(sizes, seated, side="right")
        active, sizes = active[lo:], sizes[lo:]
        if not len(active):
            return tables
        t = tables[active]
        w = weight(active, t)
        tables[active] = t + (rng.random(len(active)) * (seated - discount * t + w) < w)
    lo = np.searchsorted(sizes, ONE_BY_ONE, side="right")
    active, sizes = active[lo:], sizes[lo:].astype(np.float64)
    seated = np.full(len(active), float(ONE_BY_ONE))
    while len(active):
        t = tables[active]
        w, rest = weight(active, t), seated - discount * t
        # customers at old tables before the candidate; 1 - random is never 0
        gap = np.floor(np.log(1 - rng.random(len(active))) / -np.log1p(w / rest))
        there = seated + gap < sizes
        opens = there & (rng.random(len(active)) * (rest + gap + w) < rest + w)
        tables[active] += opens
        active, sizes, seated = active[there], sizes[there], (seated + gap + 1)[there]
    return tables


# up: table sums of a bucket's repeated words and contexts, one home's part
_UP = ("<i8", "<i8")
# down: of the same words t_w and t0_w, of the same contexts T_u
_DOWN = ("<i8", "<i8", "<i8")
STATES, UP, DOWN = range(3)  # kinds of rows of a sweep
SWEPT = "kind int, bucket int, home int, payload binary"
_SEATED = ("<i8",)  # a bucket's tables
_ROOT = ("<i8", "<i8", "<i8")  # of a home's numbers t_w, t0_w, T_u
_STATS = ("customers", "tables", "once", "twice")
HOME_SWEPT = f"{SWEPT}, " + ", ".join(f"{x} double" for x in _STATS)


def _ups(bucket: int, words_: np.ndarray, contexts: np.ndarray, tables: np.ndarray, grid: Grid) -> list[tuple]:
    """The UP rows of a bucket."""
    found: dict[int, list[np.ndarray]] = {}
    for k, x in enumerate((words_, contexts)):
        distinct, at = np.unique(x, return_inverse=True)
        total = np.bincount(at, weights=tables, minlength=len(distinct)).astype("<i8")
        own, cuts = _cut(distinct, grid)
        for home, a, b in zip(own.tolist(), cuts, cuts[1:], strict=False):
            found.setdefault(home, [total[:0], total[:0]])[k] = total[a:b]
    return [(UP, bucket, home, _pack(*sums)) for home, sums in found.items()]


def first_seating(repeated: DataFrame, grid: Grid) -> DataFrame:
    """One table for each repeated pair."""
    ready()

    def sit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for bucket, payload in zip(batch["bucket"], batch["payload"], strict=True):
                w, u, c = _unpack(payload, *_REPEATED)
                ones = np.ones(len(c), dtype="<i8")
                rows = [(STATES, bucket, -1, _pack(ones)), *_ups(bucket, w, u, ones, grid)]
                yield pd.DataFrame(rows, columns=["kind", "bucket", "home", "payload"])

    return repeated.select("bucket", "payload").mapInPandas(sit, SWEPT)


def root_seating(
    static: DataFrame, ups: DataFrame, before: DataFrame | None = None, totals: Totals | None = None, sweep: int = 0
) -> DataFrame:
    """Homes add up the tables, seat the root (``before``, ``totals``: the
    seating before; none yet: one table a word) and answer."""
    ready()

    def sit(key: tuple, own: pd.DataFrame, told: pd.DataFrame) -> pd.DataFrame:
        numbers, _, once_w, once_u, buckets, n_w, n_u, many_w, many_u = _unpack(own["payload"].iloc[0], *_HOME)
        t_w, t_u = once_w.copy(), once_u.copy()
        sums = {b: p for b, p in zip(told["bucket"].tolist(), told["payload"], strict=True)}
        old = sums.pop(-1, None)
        sums = {b: _unpack(p, *_UP) for b, p in sums.items()}
        at_w, at_u = np.r_[0, np.cumsum(n_w, dtype=np.int64)], np.r_[0, np.cumsum(n_u, dtype=np.int64)]
        parts = []
        for k, b in enumerate(buckets.tolist()):
            w, u = many_w[at_w[k] : at_w[k + 1]], many_u[at_u[k] : at_u[k + 1]]
            if b in sums:
                t_w[w] += sums[b][0]
                t_u[u] += sums[b][1]
                parts.append((b, w, u))
        if old is None:
            t0 = np.minimum(t_w, 1)
        else:
            rng = np.random.default_rng([int(key[0]), sweep, 1])
            own_t0 = _unpack(old, *_ROOT)[1].astype(np.float64)  # taken out of T0 first
            t0 = seat(t_w, totals.root_discount, lambda k, t: totals.base(own_t0[k] - t), rng).astype(np.int64)
        home = int(key[0])
        stats = [t_w.sum(), t0.sum(), (t_w == 1).sum(), (t_w == 2).sum()]
        rows = [(STATES, -1, home, _pack(t_w, t0, t_u), *map(float, stats))]
        for b, w, u in parts:
            payload = _pack(t_w[w], t0[w], t_u[u])
            rows.append((DOWN, b, home, payload, 0.0, 0.0, 0.0, 0.0))
        return pd.DataFrame(rows, columns=["kind", "bucket", "home", "payload", *_STATS])

    told = ups.where(F.col("kind") == UP).select("home", "bucket", "payload")
    if before is not None:
        told = told.unionAll(before.where(F.col("kind") == STATES).select("home", "bucket", "payload"))
    return static.groupBy("home").cogroup(told.groupBy("home")).applyInPandas(sit, HOME_SWEPT)


def pair_seating(
    repeated: DataFrame, tables: DataFrame, downs: DataFrame, totals: Totals, sweep: int, grid: Grid
) -> DataFrame:
    """Buckets seat their repeated pairs anew, and send their sums up."""
    ready()
    kinds = {"pairs": 0, "tables": 1, "down": 2}
    of = lambda df, kind: df.select("bucket", "home", "payload", F.lit(kinds[kind]).alias("is"))
    rows = (
        of(repeated, "pairs")
        .unionAll(of(tables.where(F.col("kind") == STATES), "tables"))
        .unionAll(of(downs.where(F.col("kind") == DOWN), "down"))
    )

    def sit(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        bucket = int(key[0])
        kind = part["is"].to_numpy()
        payload = part["payload"].to_numpy()
        w, u, c = _unpack(payload[kind == kinds["pairs"]][0], *_REPEATED)
        t = _unpack(payload[kind == kinds["tables"]][0], *_SEATED)[0].astype(np.float64)
        told = part[kind == kinds["down"]].sort_values("home")
        down = [_unpack(p, *_DOWN) for p in told["payload"]]
        none = np.zeros(0, "<i8")
        t_w, t0, t_u = (np.concatenate([none, *(x[k] for x in down)]).astype(np.float64) for k in range(3))
        # homes rise with the number, so their parts make up the sorted lists
        own_w, own_u = np.unique(w, return_inverse=True)[1], np.unique(u, return_inverse=True)[1]
        others_u = t_u[own_u] - t
        others_w = t_w[own_w] - t
        # the word's tables in the root: those its other customers can have, one with this pair's
        root = np.maximum(np.minimum(t0[own_w], others_w), 1.0)
        customers = totals.customers - t
        d, d0 = totals.discount, totals.root_discount
        base = totals.base(t0[own_w] - root)

        def weight(k: np.ndarray, tables_: np.ndarray) -> np.ndarray:
            at_root = others_w[k] + tables_ - d0 * root[k] + base[k]
            return (STRENGTH + d * (others_u[k] + tables_)) * at_root / (STRENGTH + customers[k] + tables_)

        rng = np.random.default_rng([bucket, sweep, 0])
        new = seat(c, d, weight, rng)
        rows = [(STATES, bucket, -1, _pack(new.astype("<i8"))), *_ups(bucket, w, u, new, grid)]
        return pd.DataFrame(rows, columns=["kind", "bucket", "home", "payload"])

    return rows.groupBy("bucket").applyInPandas(sit, SWEPT)


def _discount(once: float, twice: float) -> float:
    return float(np.clip(once / (once + 2 * twice) if once else 0.5, 0.1, 0.95))


def _totals(known: Totals, seated: DataFrame) -> Totals:
    s = seated.where(F.col("kind") == STATES).agg(*(F.sum(x).alias(x) for x in _STATS)).first().asDict()
    s = {k: v or 0.0 for k, v in s.items()}
    return Totals(
        known.tokens, known.words, s["customers"], s["tables"], known.discount, _discount(s["once"], s["twice"])
    )


@dataclass
class Chain:
    """Stored samples: the buckets' tables, the homes' root and sums, totals."""

    tables: list[DataFrame]
    roots: list[DataFrame]
    totals: list[Totals]


def known_totals(static: DataFrame, repeated: DataFrame) -> Totals:
    """Tokens, words and the restaurants' discount, which no sweep changes."""
    ready()

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for payload in batch["payload"]:
                _, count, once, *_ = _unpack(payload, *_HOME)
                out.append((int(count.sum()), int((count > 0).sum()), int(once.sum())))
            yield pd.DataFrame(out, columns=["tokens", "words", "once"])

    def twos(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"twice": [int((_unpack(p, *_REPEATED)[2] == 2).sum()) for p in batch["payload"]]})

    a = static.select("payload").mapInPandas(sums, "tokens long, words long, once long").groupBy().sum().first()
    b = repeated.select("payload").mapInPandas(twos, "twice long").groupBy().sum().first()
    return Totals(a[0] or 0, a[1] or 0, discount=_discount(a[2] or 0, b[0] or 0))


def trained(static: DataFrame, repeated: DataFrame, grid: Grid) -> Chain:
    """The last SAMPLES seatings of the chain.  Files of older ones are deleted."""
    known = known_totals(static, repeated)
    tables = stored(first_seating(repeated, grid), "py-seating")
    roots = stored(root_seating(static, tables), "py-root")
    chain = Chain([tables], [roots], [_totals(known, roots)])
    for sweep in range(1, 1 + SWEEPS + BURN_IN + SAMPLES if known.tokens else 0):
        tables = stored(
            pair_seating(repeated, chain.tables[-1], chain.roots[-1], chain.totals[-1], sweep, grid), "py-seating"
        )
        roots = stored(root_seating(static, tables, chain.roots[-1], chain.totals[-1], sweep), "py-root")
        chain.tables.append(tables)
        chain.roots.append(roots)
        chain.totals.append(_totals(known, roots))
        if len(chain.totals) > SAMPLES:
            for old in (chain.tables.pop(0), chain.roots.pop(0)):
                discard(old)
            chain.totals.pop(0)
    return chain


# --- 4. scores

# a home's answer: of each name asked for its count, then per sample t_w, t0_w, T_u
# a bucket's answer: per sample the tables of the pair (0: not seated)


def name_replies(names: DataFrame, static: DataFrame, chain: Chain) -> DataFrame:
    """chunk, home, payload: what the homes know of each chunk's words."""
    ready()
    n = len(chain.roots)
    rows = static.select("home", F.lit(-1).alias("sample"), "payload")
    for k, roots in enumerate(chain.roots):
        rows = rows.unionAll(roots.where(F.col("kind") == STATES).select("home", F.lit(k).alias("sample"), "payload"))

    def answer(key: tuple, asked: pd.DataFrame, own: pd.DataFrame) -> pd.DataFrame:
        own = own.sort_values("sample")
        known, values = np.zeros(1, "<u8"), [np.zeros(1, "<i8")] * (1 + 3 * n)
        if len(own):
            static_ = _unpack(own["payload"].iloc[0], *_HOME)
            known = static_[0]
            values = [static_[1], *(x for p in own["payload"].iloc[1:] for x in _unpack(p, *_ROOT))]
        out = []
        for payload in asked["payload"]:
            numbers = _unpack(payload, *_NAMES)[0]
            at = np.minimum(np.searchsorted(known, numbers), len(known) - 1)
            there = known[at] == numbers
            out.append(_pack(*(np.where(there, x[at], 0).astype("<i8") for x in values)))
        return pd.DataFrame({"chunk": asked["chunk"].to_numpy(), "home": int(key[0]), "payload": out})

    return (
        names.select(F.col("part").alias("home"), "chunk", "payload")
        .groupBy("home")
        .cogroup(rows.groupBy("home"))
        .applyInPandas(answer, "chunk long, home int, payload binary")
    )


def pair_replies(replies: DataFrame, chain: Chain) -> DataFrame:
    """chunk, bucket, payload: per pair its count and per sample its tables."""
    ready()
    rows = None
    for k, tables in enumerate(chain.tables):
        own = tables.where(F.col("kind") == STATES).select("bucket", F.lit(k).alias("sample"), "payload")
        rows = own if rows is None else rows.unionAll(own)

    def answer(key: tuple, asked: pd.DataFrame, own: pd.DataFrame) -> pd.DataFrame:
        samples = [np.r_[0, _unpack(p, *_SEATED)[0]] for p in own.sort_values("sample")["payload"]]
        out = []
        for payload in asked["payload"]:
            count, place = _unpack(payload, *_REPLY)
            once = (count == 1).astype("<i8")
            out.append(_pack(count, *(x[place] + once for x in samples)))
        return pd.DataFrame({"chunk": asked["chunk"].to_numpy(), "bucket": int(key[0]), "payload": out})

    return (
        replies.select("bucket", "chunk", "payload")
        .groupBy("bucket")
        .cogroup(rows.groupBy("bucket"))
        .applyInPandas(answer, "chunk long, bucket int, payload binary")
    )


def probabilities(
    totals: list[Totals], word: np.ndarray, context: np.ndarray, names: list[np.ndarray], pairs: list[np.ndarray]
) -> np.ndarray:
    """p(word | context) of each pair, averaged over the samples.

    ``names``: per word of the chunk its count, then t_w, t0_w and T_u of each
    sample, for the words and, first of all, for "nothing before" as a context;
    ``pairs``: per pair its count, then its tables in each sample."""
    customers = names[0][context].astype(np.float64)  # c_u: what follows a word is counted with the word
    out = np.zeros(len(word))
    for k, s in enumerate(totals):
        t_w, t0, t_u = (x.astype(np.float64) for x in names[1 + 3 * k : 4 + 3 * k])
        p0 = (t_w - s.root_discount * t0 + s.base()) / (STRENGTH + s.customers) if s.words else np.ones(len(t_w))
        own = pairs[0] - s.discount * pairs[1 + k].astype(np.float64)
        out += own + (STRENGTH + s.discount * t_u[context]) * p0[word]
    return out / (len(totals) * (STRENGTH + customers))


def chunk_scores(own: DataFrame, names: DataFrame, pairs: DataFrame, chain: Chain, starts: int) -> DataFrame:
    """The result rows.  ``starts``: training documents, the customers of the
    context "nothing before"."""
    ready()
    totals = chain.totals
    start_tables = [_start_tables(roots) for roots in chain.roots]
    rows = names.select("chunk", F.lit(0).alias("kind"), F.col("home").alias("part"), "payload").unionAll(
        pairs.select("chunk", F.lit(1).alias("kind"), F.col("bucket").alias("part"), "payload")
    )

    def total(key: tuple, part: pd.DataFrame, told: pd.DataFrame) -> pd.DataFrame:
        ids, null, train, lengths, steps, context, documents, doc, count = _unpack(part["payload"].iloc[0], *_OWN)
        word = np.cumsum(steps, dtype="<u4").astype(np.int64)
        told = told.sort_values(["kind", "part"])
        n = 1 + 3 * len(totals)
        lists = [_unpack(p, *["<i8"] * n) for p in told.loc[told["kind"] == 0, "payload"]]
        start = [starts, *(x for t in start_tables for x in (0, 0, t))]
        # place 0: nothing before; then the chunk's words
        of = [np.concatenate([[start[k]], *(x[k] for x in lists)]) for k in range(n)]
        lists = [_unpack(p, *["<i8"] * (1 + len(totals))) for p in told.loc[told["kind"] == 1, "payload"]]
        asked = [np.concatenate([x[k] for x in lists]) for k in range(1 + len(totals))]
        p = probabilities(totals, word + 1, context.astype(np.int64), of, asked)
        seen = of[0][word + 1]
        base = np.log10((seen + 1) / (totals[-1].tokens + totals[-1].words + 1))
        each = lambda x: np.bincount(doc, weights=count * np.repeat(x, documents), minlength=len(ids))
        frame = pd.DataFrame(
            {
                "doc_id": pd.array(ids, dtype="Int64"),
                "training": train.astype(bool),
                "n_tokens": lengths,
                "n_known": each(seen > 0).astype(np.int64),
                "train_tokens": totals[-1].tokens,
                "base_score": each(base),
                "score": each(np.log10(p)),
            }
        )
        frame.loc[null.astype(bool), "doc_id"] = pd.NA
        return frame

    schema = (
        "doc_id long, training boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    )
    return own.select("chunk", "payload").groupBy("chunk").cogroup(rows.groupBy("chunk")).applyInPandas(total, schema)


def _start_tables(roots: DataFrame) -> int:
    """T_u of the context 0, the first number of home 0 if it was trained on."""
    row = roots.where((F.col("kind") == STATES) & (F.col("home") == 0)).select("payload").first()
    return int(_unpack(row["payload"], *_ROOT)[2][0]) if row is not None else 0


def scores(docs: DataFrame, training: Column) -> DataFrame:
    """doc_id, training, n_tokens, n_known, train_tokens, base_score, score of
    every row; the model learns from the rows where ``training`` holds."""
    size, starts = docs.agg(
        F.sum(F.octet_length(text_of())), F.sum(F.coalesce(training, F.lit(False)).cast("long"))
    ).first()
    grid = grid_for(size or 0)
    made = stored_by(chunks(docs, grid, training), "py-chunks", "kind", [OWN, NAMES, *range(PAIRS, PAIRS + PASSES)])
    parts = []
    for k in range(PAIRS, PAIRS + PASSES):
        parts.append(stored_by(counted(made[k], grid), "py-counts", "kind", [REPLY, REPEATED, SUMS]))
        discard(made[k])
    found = {kind: reduce(DataFrame.unionAll, [p[kind] for p in parts]) for kind in (REPLY, REPEATED, SUMS)}
    static = stored(homes(found[SUMS]), "py-homes")
    discard(found[SUMS])
    chain = trained(static, found[REPEATED], grid)
    names = name_replies(made[NAMES], static, chain)
    return chunk_scores(made[OWN], names, pair_replies(found[REPLY], chain), chain, int(starts or 0))
