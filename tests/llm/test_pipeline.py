import os
import re

import pyarrow as pa
import pytest

import corpus_pipeline
from ledgerspark.llm.common import ready, stored, whole_numbers
from ledgerspark.llm.pii import base_spans
from ledgerspark.llm.queries import CAPACITY

from test_decontamination import brute_force as leaks
from test_neardup import brute_force as groups

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out.append(stored(stage(spark, out[-1], SF), f"test-{name}"))
    return out


def texts(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_names_and_columns(steps):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_dedup", "decontamination", "personal_data", "packing"]
    assert all(s.columns == steps[0].columns for s in steps[1:-1])


def test_quality_keeps_good_documents(spark, steps):
    kept = texts(steps[1])
    labels = spark.read.parquet(f"{SF}/labels.parquet").collect()
    good = [r.doc_id for r in labels if r.quality == 1]
    bad = [r.doc_id for r in labels if r.quality == 0]
    assert sum(i in kept for i in good) >= 0.95 * len(good)
    assert sum(i in kept for i in bad) <= 0.5 * len(bad)


def test_one_document_of_each_group_stays(steps):
    docs = texts(steps[1])
    want = {i for i, (n, root) in groups(list(docs.items()), 5).items() if i == root or not n}
    assert texts(steps[2]).keys() == want


def test_contaminated_documents_go(spark, steps):
    before, after = texts(steps[2]), texts(steps[3])
    gone = before.keys() - after.keys()
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    joined = {i: " ".join(re.findall(r"[^\W_]+", t.lower())) for i, t in before.items()}
    held = {i for i, t in joined.items() for _, x in items if " ".join(re.findall(r"[^\W_]+", x.lower())) in t}
    assert held <= gone
    assert {d for d, _ in leaks([(i, before[i]) for i in gone], items)} == gone


def test_personal_data_is_replaced(steps):
    before, after = texts(steps[3]), texts(steps[4])
    assert before.keys() == after.keys()
    assert not any(base_spans(t) for t in after.values())
    assert all(before[i] == t for i, t in after.items() if "[" not in t)


def test_packing_holds_every_document(spark, steps):
    rows = steps[5].collect()
    assert {r.doc_id for r in rows} == texts(steps[4]).keys()
    sums = {}
    for r in rows:
        sums[r.sequence_id] = sums.get(r.sequence_id, 0) + r.length
    assert max(sums.values()) <= CAPACITY
    again = corpus_pipeline.run(spark, SF)
    assert again.columns == steps[5].columns and again.count() == len(rows)


def test_packing_delivers_the_token_ids(spark, steps):
    import zlib

    rows = steps[5].collect()
    assert rows and all(len(r.ids) == 4 * r.length and zlib.crc32(r.ids) == r.ids_crc32 for r in rows)


@pytest.mark.parametrize("empty", [False, True])
def test_odd_tables_go_through_every_stage(spark, odd_docs, no_docs, empty):
    """Nulls, empty and very long texts, repeated rows, clashing names, no rows."""
    docs = no_docs if empty else odd_docs.withColumnsRenamed({"rid": "own", "cls": "extra", "bucket": "row", "a": "_rid"})
    stages = dict(corpus_pipeline.STAGES)
    counts = []
    # the quality of so few rows is not learnt; every other stage on all of them
    scored = stages["quality"](spark, docs, SF)
    assert scored.columns == docs.columns and scored.count() <= docs.count()
    for name in ("near_dedup", "decontamination", "personal_data"):
        out = stored(stages[name](spark, docs, SF), f"odd-{name}")
        assert out.columns == docs.columns
        counts.append(out.count())
        docs = out
    rows = stages["packing"](spark, docs, SF).collect()
    if empty:
        assert counts == [0, 0, 0] and rows == []
        return
    # of the three texts that are equal two go; the row without id and those without words stay
    assert counts == [odd_docs.count() - 2] * 3
    assert sorted({(r.doc_id is None, r.doc_id or 0) for r in rows}) == [(False, k) for k in (1, 2, 3, 4, 5, 7, 8, 9, 10)] + [(True, 0)]
    left = {r.doc_id: r for r in docs.collect()}
    assert left[1].text is None and left[10].text.startswith("mail me: [EMAIL]") and left[10].row == 9  # the column passes through


def test_workers_take_arrow_memory_from_the_system(spark):
    """Arrow's own allocator keeps what it has freed, in every worker."""
    ready()

    def pools(batches):
        for _ in batches:
            yield pa.RecordBatch.from_pydict({"pool": [pa.default_memory_pool().backend_name]})

    rows = spark.range(1).mapInArrow(pools, "pool string").collect()
    assert [r.pool for r in rows] == [os.environ.get("ARROW_DEFAULT_MEMORY_POOL", "system")]


def test_small_tables_start_no_python_workers(spark, capsys):
    rows = [(1, 2**40), (-3, 0)]
    frame = whole_numbers(spark, rows, ["a", "b"])
    assert frame.dtypes == [("a", "bigint"), ("b", "bigint")]
    assert sorted(map(tuple, frame.collect())) == sorted(rows)
    assert whole_numbers(spark, [], ["a", "b"]).collect() == []
    frame.explain()
    assert "LocalTableScan" in capsys.readouterr().out
