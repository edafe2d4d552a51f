import collections
import random
import re

from ledgerspark.llm.decontamination import contaminated, decontaminate
from ledgerspark.llm.queries import QUERIES

Count = collections.Counter


def words(t):
    return re.findall(r"[^\W_]+", (t or "").lower())


def cut(w, k):
    return [tuple(w[i : i + k]) for i in range(len(w) - k + 1)]


def brute_force(docs, items, percent=80):
    """(doc_id, item_id) -> best similarity over all item-sized windows."""
    out = {}
    known = [(i, words(t)) for i, t in items]
    for d, text in docs:
        w = words(text)
        for i, x in known:
            k = min(5, len(x))
            own, item = cut(w, k) if k else [], Count(cut(x, k) if k else [])
            n = sum(item.values())
            m = min(n, len(own))
            best = 0
            for at in range(len(own) - m + 1) if n and own else ():
                both = sum((Count(own[at : at + m]) & item).values())
                if 100 * both >= percent * (n + m - both):
                    best = max(best, both / (n + m - both))
            if best:
                out[d, i] = best
    return out


def test_query_against_brute_force(spark, small):
    sf = "/root/testdata/sf0.001"
    items = spark.read.parquet(f"{sf}/benchmark.parquet").toPandas()
    found = QUERIES["op10_benchmark_decontamination"](spark, sf).collect()
    # documents that share five words with an item are enough: others have similarity 0
    five = {s for t in items.text for s in cut(words(t), min(5, len(words(t))))}
    docs = [(d, t) for d, t in zip(small.doc_id, small.text, strict=True) if five & set(cut(words(t), 5))]
    want = brute_force(docs, list(zip(items.item_id, items.text, strict=True)))
    assert want and {(r.doc_id, r.item_id): r.similarity for r in found} == want
    assert len(found) == len(want)


def test_edited_passages(spark):
    rng = random.Random(4)
    vocabulary = [f"v{i}" for i in range(400)]
    text = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    items = [(i, " ".join(text(rng.choice([3, 4, 5, 6, 9, 20, 40, 60])))) for i in range(25)]
    docs = []
    for d in range(120):
        i, passage = rng.choice(items)
        p = passage.split()
        for _ in range(rng.randint(0, 2)):
            at = rng.randrange(len(p))
            p[at : at + 1] = rng.choice([[], ["new"], ["two", "new"]])
        p = p if rng.random() < 0.9 else p[: len(p) * 9 // 10]
        joined = [x.upper() + "," if rng.random() < 0.2 else x for x in p]
        docs.append((d, " ".join(text(rng.choice([0, 0, 30])) + joined + text(rng.choice([0, 30])))))
    docs.append((500, "v1 " * 300))
    items.append((99, "v1 " * 12))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.similarity for r in contaminated(df, bench).collect()}
    want = brute_force(docs, items)
    assert got == want and len(want) > 30 and min(want.values()) < 0.95
    left = {r.doc_id for r in decontaminate(df, bench).collect()}
    assert left == {d for d, _ in docs} - {d for d, _ in want}


def test_odd_rows(spark, odd_docs, no_docs):
    bench = spark.createDataFrame(
        [(None, "number of with words"), (1, None), (2, ""), (3, "one"), (4, "Two equal rows with the VERY same words!"), (4, "?!")],
        "item_id long, text string",
    )
    rows = contaminated(odd_docs, bench).collect()
    assert sorted((r.doc_id, r.item_id) for r in rows) == [(4, 3), (5, 4), (6, 4)]
    left = decontaminate(odd_docs, bench)
    assert left.columns == odd_docs.columns and left.count() == odd_docs.count() - 4
    assert contaminated(no_docs, bench).count() == 0
    assert contaminated(odd_docs, bench.limit(0)).count() == 0
    assert decontaminate(odd_docs, bench.limit(0)).count() == odd_docs.count()


def test_no_python_in_the_plan(spark, odd_docs):
    bench = spark.createDataFrame([(1, "one two three four five six")], "item_id long, text string")
    plan = contaminated(odd_docs, bench)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan
