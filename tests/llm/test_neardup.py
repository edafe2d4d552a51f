import collections
import random

import numpy as np
from pyspark.sql import functions as F

from ledgerspark.llm import neardup
from ledgerspark.llm.neardup import PERMS, components, deduplicate, least_matches, near_duplicates, survivors
from ledgerspark.llm.queries import QUERIES


def shingles(text, n):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[i : i + n]) for i in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)] if w else [])


def brute_force(docs, n, percent=80):
    """doc_id -> smallest id reachable, by comparing all documents that share a shingle."""
    sets = {i: shingles(t, n) for i, t in docs}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    inverted = collections.defaultdict(list)
    for i in sorted(sets):
        shared = collections.Counter(j for s in sets[i] for j in inverted[s])
        for j, both in shared.items():
            if 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
        for s in sets[i]:
            inverted[s].append(i)
    return {i: (len(sets[i]), find(i)) for i in sets}


def agree(found, docs, n):
    want = brute_force(docs, n)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in found)


def test_query_against_brute_force(spark, small):
    found = QUERIES["op5_minhash_near_dedup"](spark, "/root/testdata/sf0.001").collect()
    agree(found, list(zip(small.doc_id, small.text, strict=True)), 4)


def test_group_that_pivots_cannot_settle(spark, monkeypatch):
    """A chain and a cloud of copies around a base that is not there: many
    members are not similar to their buckets' pivots."""
    monkeypatch.setattr(neardup, "BLOCK", 16)
    rng = random.Random(5)
    words = [f"w{i}" for i in range(2000)]
    base = [rng.choice(words) for _ in range(120)]
    docs = []
    for i in range(90):
        t = list(base)
        for _ in range(rng.randint(1, 6)):
            t[rng.randrange(len(t))] = rng.choice(words)
        docs.append((i, " ".join(t)))
    drift = [rng.choice(words) for _ in range(120)]
    for i in range(60):
        drift = drift[2:] + [rng.choice(words) for _ in range(2)]
        docs.append((1000 + i, " ".join(drift)))
    docs += [(2000 + i, docs[3][1]) for i in range(30)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(7)
    agree(near_duplicates(df, 4).collect(), docs, 4)


def test_bounds_keep_similar_pairs():
    bounds = least_matches(0.8, 1e-6)
    assert bounds[-1][0] == PERMS and all(0 < m < n for n, m in bounds)
    rng = np.random.default_rng(0)
    a = rng.integers(0, 2**32, (4000, PERMS), dtype=np.uint32)
    for s, kept in ((0.8, 4000), (0.3, 0)):
        b = np.where(rng.random(a.shape) < s, a, a + 1)
        assert len(survivors(a, b, bounds)[0]) == kept


def test_components(spark):
    rng = random.Random(9)
    edges = [(k, k + 1) for k in range(100, 160)] + [(rng.randint(200, 260), rng.randint(200, 260)) for _ in range(40)]
    edges += [(7, k) for k in range(300, 340)]
    df = spark.createDataFrame(edges, "a long, b long")
    parent = {x: x for e in edges for x in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    assert {r.node: r.label for r in components(df).collect()} == {x: find(x) for x in parent}


def test_odd_rows(spark, odd_docs, no_docs):
    rows = near_duplicates(odd_docs, 4).collect()
    assert len(rows) == odd_docs.count()
    by = {r.doc_id: r for r in rows}
    assert all((by[k].n_shingles, by[k].component_id, by[k].kept) == (0, k, True) for k in (1, 2, 3))
    assert (by[None].component_id, by[None].kept) == (None, True)
    assert by[6].component_id == 5 and not by[6].kept and by[5].kept
    assert by[4].n_shingles == 1
    assert near_duplicates(no_docs).count() == 0
    same_id = spark.createDataFrame([(1, "a b c d e f"), (1, "g h i j k l"), (3, "g h i j k l"), (None, "a b c d e f")], "doc_id long, text string")
    assert {r.component_id for r in near_duplicates(same_id, 4).collect()} == {1}


def test_deduplicate(spark, odd_docs, no_docs):
    left = deduplicate(odd_docs)
    assert left.columns == odd_docs.columns
    ids = sorted((r.doc_id is None, r.doc_id or 0) for r in left.collect())
    assert ids == [(False, k) for k in (1, 2, 3, 4, 5, 7, 8, 9, 10)] + [(True, 0)]
    assert deduplicate(no_docs).count() == 0


def test_rows_without_id(spark):
    """One text a class is read, and one row of each group stays."""
    words = [[f"g{g}w{k}" for k in range(60)] for g in range(20)]
    rows = [(None, " ".join(w)) for w in words for _ in range(2)]
    rows += [(None, " ".join([*w[:-1], "other"])) for w in words]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    left = [r.text.split()[0] for r in deduplicate(docs).collect()]
    assert sorted(left) == sorted(w[0] for w in words)
    classes = neardup.sketches(docs, 5).groupBy("cls").agg(F.max("doc_id").alias("any_id"), F.min("rid").alias("any_rid"))
    assert classes.count() == 40
    joins = neardup.shingle_sets(docs, classes, 5)._jdf.queryExecution().optimizedPlan().toString()
    assert "doc_id" not in joins.split("Join", 1)[1].split("\n")[0]
    assert neardup.shingle_sets(docs, classes, 5).count() == 60


def test_small_frames_are_few_files(spark, monkeypatch):
    """Not one file for each shuffle partition: each costs a task and a process."""
    files = collections.defaultdict(list)
    whole = neardup.stored

    def counted(df, kind, *size):
        out = whole(df, kind, *size)
        files[kind].append(len(out.inputFiles()))
        return out

    monkeypatch.setattr(neardup, "stored", counted)
    base = [f"w{k}" for k in range(100)]
    docs = [(i, " ".join([*base[: 99 - i % 5], f"own{i}"])) for i in range(200)]
    docs += [(1000 + i, f"alone {i} " + " ".join(f"x{i}y{k}" for k in range(30))) for i in range(50)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    few = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in few}
    try:
        for k, v in few.items():
            spark.conf.set(k, v)
        agree(near_duplicates(df, 4).collect(), docs, 4)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    cores = spark.sparkContext.defaultParallelism
    assert {k: n for k, n in files.items() if max(n) > cores and k != "sketches"} == {}
