"""Periodic runs of words, by a dictionary of basic factors.

A run is a stretch of consecutive words with smallest period q (words q apart
are equal), at least ``max(min_words, 3 q)`` long, that no neighbouring word
extends.  For every power of two h the dictionary names all stretches of h
words: equal names, equal words.  Names of 2 h words are pairs of names of h
words, so each level costs one pass.

Where a stretch of h words occurs again p <= 2 h words later, p is proposed as
a period; consecutive places with the same p form one progression and one
proposal.  A run of period q proposes q on the level h with h / 2 < q <= h:
there a stretch of h words inside it recurs first after q words, as a nearer
copy would make q no smallest period, and 3 q words leave room for h + q.  Each
proposal is extended both ways by descending through the levels (equal names
skip h words at once).  Of equal stretches the smallest period stays, which
removes multiples of q.

Documents are taken together, about ``BATCH_WORDS`` words at a time, with a
sign of its own after each, so no run leaves its document.  A stretch that
occurs once gets a name of its own and is left out of the next level; the
dictionary ends at the first level without a repeated stretch.  Nothing is
shuffled: every document is a matter of one task, and memory is bounded by
the batch or the longest document.

Null texts count as empty.  Repeated rows, null ids and other columns change
nothing; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerspark.llm.common import ready, text_of

#: words taken together
BATCH_WORDS = 200_000
MIN_WORDS = 24


def dictionary(names: np.ndarray) -> list[np.ndarray]:
    """Level k: a name of the 2^k words that start at each place, -1 - place
    where these words occur nowhere else (or end beyond the text)."""
    n = len(names)
    place = np.arange(n, dtype=np.int64)

    def singled(at: np.ndarray, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        level = -1 - place
        repeated = np.bincount(code)[code] > 1 if len(code) else np.zeros(0, bool)
        level[at[repeated]] = code[repeated]
        return level, at[repeated]

    level, at = singled(place, pd.factorize(names)[0])
    levels = []
    h = 1
    while len(at):
        levels.append(level)
        at = at[at + 2 * h <= n]
        at = at[level[at + h] >= 0]
        pairs = level[at] * (level.max() + 1) + level[at + h]
        level, at = singled(at, pd.factorize(pairs)[0])
        h *= 2
    return levels


def proposals(levels: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(place, period): one for each progression of successor occurrences."""
    starts, periods = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for k, level in enumerate(levels):
        at = np.flatnonzero(level >= 0)
        at = at[np.argsort(level[at], kind="stable")]
        same = level[at[1:]] == level[at[:-1]]
        gap = at[1:] - at[:-1]
        near = same & (gap <= 2 << k)
        i, p = at[:-1][near], gap[near]
        order = np.argsort(i, kind="stable")
        i, p = i[order], p[order]
        first = np.ones(len(i), bool)
        first[1:] = (i[1:] != i[:-1] + 1) | (p[1:] != p[:-1])
        starts.append(i[first])
        periods.append(p[first])
    return np.concatenate(starts), np.concatenate(periods)


def extended(levels: list[np.ndarray], i: np.ndarray, p: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end (exclusive) of the longest stretch around place i whose
    words p apart are equal."""
    n = len(levels[0])
    right, left = i.copy(), i.copy()
    for k in reversed(range(len(levels))):
        level, h = levels[k], 1 << k
        # a stretch longer than the highest level takes several of its steps
        while True:
            ok = right + p + h <= n
            ok[ok] = level[right[ok]] == level[right[ok] + p[ok]]
            if not ok.any():
                break
            right[ok] += h
            if k < len(levels) - 1:
                break
        while True:
            ok = left >= h
            ok[ok] = level[left[ok] - h] == level[left[ok] - h + p[ok]]
            if not ok.any():
                break
            left[ok] -= h
            if k < len(levels) - 1:
                break
    return left, right + p


def find_runs(names: np.ndarray, min_words: int = MIN_WORDS) -> np.ndarray:
    """Rows (start, end, period) of all runs, by start, then period."""
    levels = dictionary(names)
    none = np.empty((0, 3), np.int64)
    if not levels:
        return none
    i, p = proposals(levels)
    if not len(i):
        return none
    start, end = extended(levels, i, p)
    long = end - start >= np.maximum(min_words, 3 * p)
    found = np.unique(np.stack([start[long], end[long], p[long]], axis=1), axis=0)
    if not len(found):
        return none
    first = np.ones(len(found), bool)
    first[1:] = (found[1:, :2] != found[:-1, :2]).any(axis=1)
    found = found[first]
    return found[np.lexsort((found[:, 2], found[:, 0]))]


def kept_words(n: int, runs: np.ndarray) -> np.ndarray:
    """True for words outside every run's part after its first period."""
    steps = np.zeros(n + 1, np.int64)
    np.add.at(steps, runs[:, 0] + runs[:, 2], 1)
    np.add.at(steps, runs[:, 1], -1)
    return np.cumsum(steps[:-1]) == 0


def planted(n: int, doc_id: int | None) -> np.ndarray | None:
    """Which word stands at each place once a repetition is planted, by the
    number of the document; None where nothing changes."""
    h = zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
    if h % 10 or not n:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    out = np.arange(n)
    out[a:] = a + (out[a:] - a) % p
    return out


def _strongest(runs: list[list[int]]) -> tuple[int, int, int] | None:
    best = None
    for start, end, period in runs:  # by start, then period: ties keep the first
        if best is None or (end - start) * best[2] > best[1] * period:
            best = (start, end - start, period)
    return best


RESULT = (
    "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, "
    "runs_sha256 string, collapsed_sha256 string, runs array<struct<start: long, length: long, period: long>>, "
    "collapsed string"
)


def periodic_runs(
    docs: DataFrame, min_words: int = MIN_WORDS, plant: bool = False, keep_text: bool = True
) -> DataFrame:
    """Every document's runs: doc_id, n_runs, the strongest run (greatest
    length / period; ties: smallest start, then period), digests, and the runs
    themselves and the text without repetitions (null without ``keep_text``).

    ``plant`` first repeats a stretch of some documents (``planted``), chosen
    by crc32 of the id; a null id counts as empty text there.
    """
    ready()
    schema = pa.schema(
        [
            *[(c, pa.int64()) for c in ("doc_id", "n_runs", "start", "length", "period", "exponent_milli")],
            ("runs_sha256", pa.string()),
            ("collapsed_sha256", pa.string()),
            ("runs", pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))),
            ("collapsed", pa.string()),
        ]
    )

    def some(doc_ids: list[int | None], texts: pa.Array) -> pa.RecordBatch:
        split = pc.ascii_split_whitespace(texts)
        coded = pc.dictionary_encode(split.flatten())
        words = np.array(coded.dictionary.cast(pa.binary()).to_pylist() or [b""], dtype=object)
        codes, cuts = np.asarray(coded.indices, dtype=np.int64), np.asarray(split.offsets, dtype=np.int64)
        cuts = cuts - cuts[0]
        blank = words == b""  # what splitting leaves at the ends
        names, begins, at = [], [], 0
        for k, doc_id in enumerate(doc_ids):
            own = codes[cuts[k] : cuts[k + 1]]
            own = own[~blank[own]]
            if plant and (which := planted(len(own), doc_id)) is not None:
                own = own[which]
            names += [own, [-1 - k]]  # a sign that occurs once
            begins.append(at)
            at += len(own) + 1
        begins.append(at)
        flat = np.concatenate(names) if names else np.empty(0, np.int64)
        found = find_runs(flat, min_words)
        owner = np.searchsorted(begins, found[:, 0], side="right") - 1
        rows = []
        for k, doc_id in enumerate(doc_ids):
            lo, hi = np.searchsorted(owner, (k, k + 1))
            own = flat[begins[k] : begins[k + 1] - 1]
            runs = found[lo:hi] - [begins[k], begins[k], 0]
            kept = own[kept_words(len(own), runs)] if len(runs) else own
            text = b" ".join(words[kept].tolist())
            listed = runs.tolist()
            best = _strongest(listed)
            rows.append(
                {
                    "doc_id": doc_id,
                    "n_runs": len(listed),
                    "start": best and best[0],
                    "length": best and best[1],
                    "period": best and best[2],
                    "exponent_milli": best and 1000 * best[1] // best[2],
                    "runs_sha256": hashlib.sha256(
                        "".join(f"{a},{b - a},{q}\n" for a, b, q in listed).encode()
                    ).hexdigest(),
                    "collapsed_sha256": hashlib.sha256(text).hexdigest(),
                    "runs": [{"start": a, "length": b - a, "period": q} for a, b, q in listed],
                    "collapsed": text.decode() if keep_text else None,
                }
            )
        return pa.RecordBatch.from_pylist(rows, schema)

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text")
            doc_ids = batch.column("doc_id").to_pylist()
            # blanks and tabs bound the number of words well enough
            sizes = np.cumsum(np.asarray(pc.binary_length(texts), dtype=np.int64))
            at = 0
            while at < len(texts):
                before = sizes[at - 1] if at else 0
                to = max(at + 1, int(np.searchsorted(sizes, before + 6 * BATCH_WORDS, side="right")))
                yield some(doc_ids[at:to], texts.slice(at, to - at))
                at = to

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text")).mapInArrow(found, RESULT)
