import os
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from ledgerspark.llm import tokens
from ledgerspark.llm.packing import pack_documents, plan_sequences, sequences
from ledgerspark.llm.queries import CAPACITY, QUERIES, tokenizer_path


def reference_ids(texts):
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(tokenizer_path())
    return [model.encode(t or "", add_special_tokens=False).ids + [0] for t in texts]


def unroll(plan):
    """sequence -> [(offset, length)] of a plan."""
    out = {}
    for length, lo, hi, copies, first, at in plan:
        for rank in range(lo, hi):
            out.setdefault(first + (rank - lo) // copies, []).append((at + (rank - lo) % copies * length, length))
    return out


def best_fit(lengths, capacity):
    """The same rule piece by piece."""
    bins = []
    large = sorted((x for x in lengths if 3 * x > capacity), reverse=True)
    while large:
        x = large.pop(0)
        mate = next((y for y in large if y <= capacity - x), None)
        if mate is not None:
            large.remove(mate)
        bins.append(capacity - x - (mate or 0))
    for x in sorted((x for x in lengths if 3 * x <= capacity), reverse=True):
        fits = [g for g in bins if g >= x]
        if fits:
            bins[bins.index(min(fits))] -= x
        else:
            bins.append(capacity - x)
    return sorted(bins)


@pytest.mark.parametrize("seed", range(30))
def test_plan_is_best_fit_piece_by_piece(seed):
    rng = random.Random(seed)
    capacity = rng.choice([7, 30, 64])
    lengths = [rng.randint(1, rng.choice([3, capacity])) for _ in range(rng.randint(0, 200))]
    histogram = {x: lengths.count(x) for x in set(lengths)}
    found = unroll(plan_sequences(histogram, capacity))
    for parts in found.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
        assert sum(3 * length > capacity for _, length in parts) <= 2
    assert sorted(length for p in found.values() for _, length in p) == sorted(lengths)
    gaps = sorted(capacity - sum(length for _, length in p) for p in found.values())
    assert gaps == best_fit(lengths, capacity)


def test_plan_size_follows_distinct_lengths():
    plan = plan_sequences({x: 10**9 + x for x in range(1, 2049)}, 2048)
    assert len(plan) < 40_000


TEXTS = [
    "don't WE'RE é É.́ İ ΣΑΣ ß ﬁ x\x1cy a\xa0b <|endoftext|>x 12a3 日本語.",
    "",
    None,
    " \n",
    "a" * 3000,
    "ſ K Å ǅ",
    "\x0bA\x0c b\x85c  d. É!?é ×÷ Ünïcode; ...",
    "same words, same words; Same Words.",
]


@pytest.mark.parametrize("table", [0, 1000, 32 << 20])
def test_tokenizer_equals_the_library(table, monkeypatch):
    """Whatever the table of known words has room for."""
    monkeypatch.setattr(tokens, "TABLE_BYTES", table)
    monkeypatch.setattr(tokens, "SLICE", 60)
    model = tokens.WordTokenizer(tokenizer_path())
    for _ in range(2):
        ids, offsets = model.ids(pa.array(TEXTS * 3))
        assert model.size <= table
        for k, want in enumerate(reference_ids(TEXTS * 3)):
            assert ids[offsets[k] : offsets[k + 1]].tolist() == want[:-1]
    ids, offsets = tokens.closed_ids(model, pa.array(TEXTS), 0)
    assert ids.tolist() == [x for own in reference_ids(TEXTS) for x in own]
    assert tokens.closed_ids(model, pa.array([], pa.string()), 0)[1].tolist() == [0]


def test_words_are_tokenised_many_at_a_time():
    """New words, with whatever ASCII punctuation follows them, take few calls
    of the tokenizer; known ones take none and little room in the table."""
    model = tokens.WordTokenizer(tokenizer_path())
    calls = []

    class Counted:
        def __init__(self, tokenizer):
            self.tokenizer = tokenizer

        def encode(self, text, **options):
            calls.append(text)
            return self.tokenizer.encode(text, **options)

    model.model, model.runs = Counted(model.model), Counted(model.runs)
    letters = "abcdefghijklmnopqrstuvwxyzßàéñÿ"
    words = [a + b + c + d for a in letters for b in letters for c in letters[:20] for d in ("", "e")]
    texts = [" ".join(w + t for w, t in zip(words, ["", "$$$", "''", "_%", "***,"] * len(words), strict=False))]
    ids, _ = model.ids(pa.array(texts))
    assert ids.tolist() == reference_ids(texts)[0][:-1]
    assert len(calls) <= len(words) // tokens.AT_ONCE + 5
    assert model.size <= 100 * len(words)
    calls.clear()
    again, _ = model.ids(pa.array(texts))
    assert again.tolist() == ids.tolist() and not calls


def test_small_batches_are_tokenised_together():
    texts = [f"word{i} and {i % 7} more" if i % 5 else None for i in range(300)]
    batches = [
        pa.RecordBatch.from_arrays([pa.array(range(k, k + 30)), pa.array(texts[k : k + 30], pa.string())], ["at", "text"])
        for k in range(0, 300, 30)
    ]
    batches.insert(3, batches[0].slice(0, 0))
    found, got = [], []
    for batch, ids, offsets in tokens.tokenized(iter(batches), tokenizer_path(), 0):
        found.append(batch)
        got += [ids[a:b].tolist() for a, b in zip(offsets, offsets[1:], strict=False)]
    assert len(found) == 1 and found[0].column("at").to_pylist() == list(range(300))
    assert got == reference_ids(texts)
    assert list(tokens.tokenized(iter([]), tokenizer_path(), 0)) == []


def held_mb():
    with open("/proc/self/smaps_rollup") as f:
        return sum(int(x.split()[1]) for x in f if x.startswith("Pss_Anon")) / 1024


@pytest.mark.skipif(not os.path.exists("/proc/self/smaps_rollup"), reason="no such figure on this system")
def test_a_task_leaves_no_memory_behind():
    """A worker serves many tasks; what each left would add up."""
    rng = random.Random(1)
    words = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=9)) for _ in range(60_000)]
    batch = pa.RecordBatch.from_arrays([pa.array([" ".join(words)])], ["text"])

    def task():
        for _ in tokens.tokenized(iter([batch]), tokenizer_path(), 0):
            pass

    for _ in range(3):
        task()
    before = held_mb()
    for _ in range(8):
        task()
    assert held_mb() - before < 10


def check(rows, docs):
    """Pieces, checksums and places against the library's ids."""
    want = sorted(
        (-1 if i is None or i != i else int(i), k, at, len(part), zlib.crc32(np.array(part, "<u4").tobytes()))
        for i, ids in zip(docs["doc_id"], reference_ids(docs["text"]), strict=True)
        for k, at in enumerate(range(0, len(ids), CAPACITY))
        for part in [ids[at : at + CAPACITY]]
    )
    got = sorted((-1 if r.doc_id is None else r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows)
    assert got == want
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= CAPACITY
    return len(by)


def test_query(spark, small):
    rows = QUERIES["op1_best_fit_packing"](spark, "/root/testdata/sf0.001").collect()
    n = check(rows, small)
    assert n <= 1.01 * sum(r.length for r in rows) / CAPACITY + 1


def test_odd_rows_and_ids(spark, odd_docs, no_docs):
    packed = pack_documents(odd_docs, tokenizer_path(), CAPACITY)
    rows = packed.collect()
    check(rows, odd_docs.toPandas())
    assert {r.doc_id: r.length for r in rows if r.doc_id in (1, 2, 3)} == {1: 1, 2: 1, 3: 1}
    whole = {r.sequence_id: r for r in sequences(packed).collect()}
    for r in rows:
        ids = np.frombuffer(whole[r.sequence_id].ids, "<u4")[r.offset : r.offset + r.length]
        assert zlib.crc32(ids.tobytes()) == r.ids_crc32
    assert pack_documents(no_docs, tokenizer_path(), CAPACITY).count() == 0
