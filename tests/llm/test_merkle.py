import hashlib
import random
import zlib

import pytest

from ledgerspark.llm.merkle import BLOCK, manifest
from ledgerspark.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def part(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def leaf_of(r, more=0):
    n = None if r["n_chars"] is None else r["n_chars"] + more
    return sha("".join(map(part, (r["doc_id"], r["source"], r["lang"], n, r["text"]))))


def climb(level):
    """(root, siblings and sides of each member, from the leaf upwards)."""
    paths, at = [[] for _ in level], list(range(len(level)))
    while len(level) > 1:
        for k, i in enumerate(at):
            if i % 2:
                paths[k].append(("left", level[i - 1]))
            elif i + 1 < len(level):
                paths[k].append(("right", level[i + 1]))
            else:
                paths[k].append(("none", ""))
        level = [sha("".join(level[i : i + 2])) for i in range(0, len(level), 2)]
        at = [i // 2 for i in at]
    return level[0], paths


def fold(h, path):
    for side, other in path:
        h = sha(other + h if side == "left" else h + other)
    return h


def brute_force(rows):
    """The rows of the manifest, one tree at a time."""
    by = {}
    for r in rows:
        by.setdefault(r["lang"], []).append(r)
    order = sorted(by, key=lambda x: (x is not None, (x or "").encode()))
    trees = []
    for lang in order:
        own = sorted(by[lang], key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf_of(r)))
        trees.append((own, *climb([leaf_of(r) for r in own])))
    if not trees:
        return []
    root, tops = climb([t[1] for t in trees])
    out = []
    for (own, subroot, paths), top in zip(trees, tops, strict=True):
        for r, path in zip(own, paths, strict=True):
            whole = path + top
            h = zlib.crc32(b"" if r["doc_id"] is None else str(r["doc_id"]).encode())
            folded = fold(leaf_of(r, 1 if h % 7 == 0 else 0), whole)
            proof = sha("".join(x for _, x in whole))
            out.append((r["doc_id"], leaf_of(r), subroot, root, proof, folded, folded == root))
    return sorted(out, key=str)


def found(df):
    names = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted((tuple(r) for r in df.select(*names).collect()), key=str)


def test_query(spark):
    docs = [r.asDict() for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = found(QUERIES["op11_merkle_manifest"](spark, SF))
    assert got == brute_force(docs)
    bad = [r for r in got if not r[-1]]
    assert len(bad) == sum(zlib.crc32(str(r["doc_id"]).encode()) % 7 == 0 for r in docs)


@pytest.mark.parametrize("sizes", [[1], [2], [3, 1], [1, 1, 1], [2049, 5, 1, 1025], [3 << BLOCK]])
def test_sizes_around_block_borders(spark, sizes):
    rng = random.Random(len(sizes))
    rows, i = [], 0
    for k, n in enumerate(sizes):
        for _ in range(n):
            rows.append({"doc_id": i, "source": "s", "lang": f"l{k}" if k else None, "n_chars": 3, "text": "é" * (i % 4)})
            i += 1
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    assert found(manifest(df.repartition(5))) == brute_force(rows)


def test_odd_rows(spark, odd_docs, no_docs):
    rows = [r.asDict() for r in odd_docs.collect()]
    rows += [rows[0]] * 5 + [rows[3] | {"n_chars": None, "source": None}] * 2
    df = spark.createDataFrame([tuple(r.values()) for r in rows], odd_docs.schema)
    assert found(manifest(df)) == brute_force(rows)
    assert manifest(no_docs).collect() == []


def test_any_changed_value_fails_the_proof(spark):
    rows = [(i, "s", "en", 4, f"text {i}") for i in range(50)]
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    for r in manifest(df).collect():
        tampered = zlib.crc32(str(r.doc_id).encode()) % 7 == 0
        assert r.verified != tampered
        assert len(r.proof) == 33 * 6


def test_small_frames_are_few_files(spark, monkeypatch):
    """Not one file for each shuffle partition: each costs a task and a process."""
    from ledgerspark.llm import common, merkle

    files = {}

    def counted(df, kind, *size):
        out = common.stored(df, kind, *size)
        files[kind] = max(files.get(kind, 0), len(out.inputFiles()))
        return out

    monkeypatch.setattr(merkle, "stored", counted)
    rows = [{"doc_id": i, "source": "s", "lang": f"l{i % 5}", "n_chars": 3, "text": f"t{i}"} for i in range(5000)]
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    few = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in few}
    try:
        for k, v in few.items():
            spark.conf.set(k, v)
        got = found(manifest(df))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert got == brute_force(rows)
    assert max(files.values()) <= spark.sparkContext.defaultParallelism
