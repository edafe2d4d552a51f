import hashlib
import random

from ledgerspark.llm.queries import QUERIES
from ledgerspark.llm.syncmers import K, LOWEST, S, _ranged, anchors, edited_fingerprints, with_anchors, with_next


def edited(docs):
    """doc_id -> (n_chars, edited text), by plain Python."""
    rows = [("" if t is None else t, i) for i, t in docs]
    out = {}
    for k, (t, i) in enumerate(rows):
        cut, following = len(t) // 3, rows[(k + 1) % len(rows)][0]
        out[i] = (len(t), t[: len(t) - cut] + following[:cut])
    return out


def test_query_against_plain_python(spark, small):
    found = QUERIES["op2_document_fingerprints"](spark, "/root/testdata/sf0.001").collect()
    docs = sorted(zip(small.doc_id, small.text, strict=True), reverse=True)
    want = edited(docs)
    assert len(found) == len(docs)
    for r in found:
        n, text = want[r.doc_id]
        assert (r.n_chars, r.edited_sha256) == (n, hashlib.sha256(text.encode()).hexdigest())
        a, b = ({f[k : k + 8] for k in range(0, len(f), 8)} for f in (r.fingerprint, r.edited_fingerprint))
        assert r.near_edited == (len(a & b) / len(a | b) if a | b else 1.0)
        assert 0 <= r.near_next <= 1
    by_text = {}
    for i, t in docs:
        by_text.setdefault(t, set()).add(next(r.fingerprint for r in found if r.doc_id == i))
    assert all(len(f) == 1 for f in by_text.values())
    long = [r for r in found if r.n_chars > 300]
    assert sum(r.near_edited for r in long) / len(long) > 0.4
    assert sum(r.near_next for r in long) / len(long) < 0.05


def test_anchors_are_closed_syncmers(spark):
    rng = random.Random(1)
    texts = [" ".join(rng.choice("abcdefgh") * 3 for _ in range(rng.randint(0, 60))) for _ in range(40)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    units = df.selectExpr("doc_id", "transform(filter(split(text, ' '), x -> x != ''), x -> xxhash64(x)) u")
    inner = units.selectExpr(
        "doc_id", "u", f"IF(size(u) < {S}, array(), transform(sequence(1, size(u) - {S} + 1), i -> xxhash64(u[i - 1], u[i]))) s"
    )
    want = {}
    for r in inner.collect():
        at = [i for i in range(len(r.u) - K + 1) for w in [r.s[i : i + K - S + 1]] if min(w) in (w[0], w[-1])]
        want[r.doc_id] = at if len(r.u) >= K else [0] * bool(r.u)
    got = {i: [] for i in want}
    for r in anchors(df).collect():
        got[r.doc_id].append(r.unit)
    assert got == want


def test_shared_text_shares_anchors(spark):
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    common = " ".join(word() for _ in range(50))
    df = spark.createDataFrame(
        [(k, f"{' '.join(word() for _ in range(7 * k + 1))} {common} {word()}") for k in range(2)], "doc_id long, text string"
    )
    a, b = (set(r.a) for r in with_anchors(df, "text", "a").orderBy("doc_id").collect())
    alone = with_anchors(spark.createDataFrame([(common,)], "text string"), "text", "a").first().a
    assert set(alone) <= a and set(alone) <= b


def test_odd_rows(odd_docs, no_docs):
    rows = edited_fingerprints(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    by = {r.doc_id: r for r in rows}
    assert all(by[k].fingerprint == "" for k in (1, 2, 3))
    assert len({r.fingerprint for r in rows if r.doc_id in (5, 6)}) == 1
    assert by[7].n_chars > 100_000 and 0.3 < by[7].near_edited < 1
    assert len(by[9].fingerprint) == 8 and by[4].n_chars == 3  # a run of one letter: equal anchors
    assert edited_fingerprints(no_docs).count() == 0


def test_single_row_is_its_own_next(spark):
    one = spark.createDataFrame([(5, "abcdef")], "doc_id long, text string")
    r = edited_fingerprints(one).first()
    assert r.edited_sha256 == hashlib.sha256(b"abcdab").hexdigest() and r.near_next == 1.0


def test_writing_without_spaces(spark):
    rng = random.Random(7)
    run = "".join(rng.choice("abcdefghijklmnop日本語漢字") for _ in range(3000))
    texts = [run, "x" + run, "some words before " + run, run[:1500] + "Z" + run[1500:]]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = [set(r.a) for r in with_anchors(df, "text", "a").orderBy("doc_id").collect()]
    for other in got[1:]:
        assert len(got[0] & other) >= 0.9 * len(got[0] | other)


def _chain(df):
    """doc_id and text -> next text, by the same order in plain Python."""
    rows = df.selectExpr("doc_id", "coalesce(text, '') t", "xxhash64(coalesce(text, '')) tie").collect()
    rows.sort(key=lambda r: (r.doc_id is None, -(r.doc_id or 0), r.tie))
    return sorted((str(r.doc_id), r.t, rows[(k + 1) % len(rows)].t) for k, r in enumerate(rows))


def test_hot_ids_are_split_and_keep_their_order(spark):
    rng = random.Random(8)
    ids = [None] * 1000 + [7] * 800 + list(range(-500, 700))
    rng.shuffle(ids)
    df = spark.createDataFrame([(i, f"text {k}") for k, i in enumerate(ids)], "doc_id long, text string").repartition(6)
    got = with_next(df)
    assert sorted((str(r.doc_id), r.text, r.next_text) for r in got.select("doc_id", "text", "next_text").collect()) == _chain(df)
    source = df.selectExpr("doc_id", "text", f"coalesce(doc_id, {LOWEST}) ord", "xxhash64(text) tie")
    sizes = sorted(r["count"] for r in _ranged(source).groupBy("bucket").count().collect())
    assert sizes[-1] <= 4 * 3000 / 32  # of 32 wanted buckets
    single = spark.createDataFrame([(None, "only")], "doc_id long, text string")
    assert [(r.text, r.next_text) for r in with_next(single).collect()] == [("only", "only")]


def test_many_buckets_keep_the_order(spark):
    df = spark.createDataFrame([(i * i * (-1) ** i, f"t{i % 90}") for i in range(700)] + [(5, "x")] * 40, "doc_id long, text string")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "600")  # more buckets than quantiles
    try:
        rows = with_next(df).select("doc_id", "text", "next_text").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert sorted((str(r.doc_id), r.text, r.next_text) for r in rows) == _chain(df)
