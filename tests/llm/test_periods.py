import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerspark.llm.periods import find_runs, periodic_runs
from ledgerspark.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def runs_of(words, least=24):
    """Period by period, stretch by stretch."""
    n, out = len(words), {}
    for q in range(1, n // 3 + 1):
        start = 0
        for i in range(n - q + 1):
            if i == n - q or words[i] != words[i + q]:
                if i + q - start >= max(least, 3 * q):
                    out.setdefault((start, i + q), q)  # a shorter period came first
                start = i + 1
    return sorted((a, b, q) for (a, b), q in out.items())


def words_of(doc_id, text, plant=True):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())
    h = zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
    n, g = len(words), h // 10
    if plant and h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    return words


def brute_force(doc_id, text, plant=True):
    words = words_of(doc_id, text, plant)
    runs = sorted(runs_of(words), key=lambda r: (r[0], r[2]))
    dropped = {i for a, b, q in runs for i in range(a + q, b)}
    kept = b" ".join(w for i, w in enumerate(words) if i not in dropped)
    listed = "".join(f"{a},{b - a},{q}\n" for a, b, q in runs)
    best = min(runs, key=lambda r: (-Fraction(r[1] - r[0], r[2]), r[0], r[2]), default=None)
    four = (None,) * 4
    if best:
        a, b, q = best
        four = (a, b - a, q, 1000 * (b - a) // q)
    digests = (hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())
    return (doc_id, len(runs), *four, *digests)


NAMES = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def rows(df):
    return sorted((tuple(r) for r in df.select(*NAMES).collect()), key=str)


def test_query(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    got = rows(QUERIES["op12_periodic_runs"](spark, SF))
    assert got == sorted((brute_force(r.doc_id, r.text) for r in docs), key=str)
    assert sum(r[1] > 0 for r in got) > 10


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(0, 2), min_size=1, max_size=6), st.integers(1, 9)), max_size=9))
def test_any_text(blocks):
    words = [w for block, times in blocks for w in block * times]
    got = find_runs(np.array(words, np.int64), 6)
    assert got.tolist() == [list(r) for r in sorted(runs_of(words, 6), key=lambda r: (r[0], r[2]))]


@pytest.mark.parametrize("seed", range(20))
def test_long_and_nested_runs(seed):
    rng = random.Random(seed)
    words = []
    while len(words) < 700:
        unit = [rng.randrange(rng.choice([2, 50])) for _ in range(rng.randint(1, 40))]
        if rng.random() < 0.3:
            unit = unit * 4 + [99]
        words += unit * rng.randint(1, 8) + unit[: rng.randint(0, len(unit))]
    got = find_runs(np.array(words, np.int64))
    assert got.tolist() == [list(r) for r in sorted(runs_of(words), key=lambda r: (r[0], r[2]))]


def test_odd_rows(spark, odd_docs, no_docs):
    one = "tick " * 5000
    cases = [(r.doc_id, r.text) for r in odd_docs.collect()]
    cases += [(20, one), (21, one + "x"), (21, one + "x"), (22, "a b c " * 8 + "a b"), (23, "a b c " * 7)]
    df = spark.createDataFrame(cases, "doc_id long, text string")
    got = rows(periodic_runs(df))
    want = [brute_force(i, t, False) for i, t in cases if i not in (7, 9, 20, 21)]
    assert [r for r in got if r[0] not in (7, 9, 20, 21)] == sorted(want, key=str)
    by = {r[0]: r for r in got}
    assert by[20][1:6] == by[21][1:6] == (1, 0, 5000, 1, 5_000_000)
    assert by[22][1:6] == (1, 0, 26, 3, 8666) and by[23][1] == 0
    whole = periodic_runs(df.where("doc_id = 22")).first()
    assert whole.collapsed == "a b c" and [tuple(r) for r in whole.runs] == [(0, 26, 3)]
    assert len(rows(periodic_runs(odd_docs, plant=True))) == odd_docs.count()
    assert periodic_runs(no_docs).collect() == []


def test_equal_documents_side_by_side_are_no_run(spark):
    text = " ".join(f"w{i}" for i in range(40))
    df = spark.createDataFrame([(i, text) for i in range(30)], "doc_id long, text string").coalesce(1)
    assert {r.n_runs for r in periodic_runs(df).collect()} == {0}
