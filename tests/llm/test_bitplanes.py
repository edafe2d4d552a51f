import zlib

import numpy as np
import pytest

from ledgerspark.llm.bitplanes import Segment, decoded, encoded, export_segments, from_planes, to_planes, write_segment
from ledgerspark.llm.common import stored
from ledgerspark.llm.queries import QUERIES, tokenizer_path

SF = "/root/testdata/sf0.001"


def reference(docs):
    """(doc_id, ids with the end id) in order, by the library."""
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(tokenizer_path())
    order = sorted(docs, key=lambda d: (d[0] is not None, d[0] or 0))
    return [(i, model.encode(t or "", add_special_tokens=False).ids + [1]) for i, t in order]


@pytest.mark.parametrize("bits", [1, 8])
@pytest.mark.parametrize("n", [0, 1, 7, 8, 1000])
def test_planes_round_trip(bits, n):
    rng = np.random.default_rng(n)
    for top in (1, 2, 49_408, 1 << 32):
        ids = rng.integers(0, top, n, dtype=np.uint64).astype("<u4")
        planes = to_planes(ids, bits)
        assert len(planes) == 32 // bits
        assert from_planes([p if any(p) else None for p in planes], n, bits).tolist() == ids.tolist()


def test_bit_plane_holds_one_bit_of_every_id():
    planes = to_planes(np.array([1, 2, 3, 0, 0, 0, 0, 0, 1 << 31], "<u4"), 1)
    assert planes[0] == b"\x05\x00" and planes[1] == b"\x06\x00" and planes[31] == b"\x00\x01"


@pytest.mark.parametrize("bits", [1, 8])
def test_segment_and_its_chunk_index(bits):
    ids = np.arange(10_000, dtype="<u4") * 7 % 49_408
    lengths = np.array([1, 4_000, 0, 5_999])
    image = Segment(write_segment(ids, lengths, [None, -3, 5, 2**40], bits, chunk_ids=1024))
    assert image.doc_ids == [None, -3, 5, 2**40] and image.lengths.tolist() == lengths.tolist()
    assert [n for _, n, *_ in image.index] == [1024] * 9 + [784]
    assert image.read_ids(0, 10_000).tolist() == ids.tolist()
    for lo, hi in ((0, 1), (1023, 1025), (5_000, 9_999), (9_990, 20_000), (4, 4)):
        assert image.read_ids(lo, hi).tolist() == ids[lo:hi].tolist()
    read = []
    image.chunk = lambda k, chunk=image.chunk: read.append(k) or chunk(k)
    image.read_ids(2048, 3000)
    assert read == [2]
    with pytest.raises(ValueError):
        Segment(b"XXXX" + image.image[4:])


def check(rows, docs):
    want, start = [], 0
    for i, ids in reference(docs):
        want.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted((r.start, r.doc_id, r.n_tokens, r.ids_crc32) for r in rows) == [(s, i, n, c) for i, s, n, c in want]


def test_query(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    check(QUERIES["op13_binary_output"](spark, SF).collect(), docs)


@pytest.mark.parametrize("bits", [1, 8])
def test_small_segments_give_the_same_documents(spark, bits):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    segments = stored(encoded(docs, tokenizer_path(), 1, bits, chunk_ids=512, segment_ids=5_000), "test-segments")
    assert segments.count() > 20
    check(decoded(segments).collect(), [(r.doc_id, r.text) for r in docs.collect()])


def test_odd_rows(spark, odd_docs, no_docs):
    got = decoded(stored(encoded(odd_docs.repartition(4), tokenizer_path()), "test-segments")).collect()
    docs = [(r.doc_id, r.text) for r in odd_docs.collect()]
    want = {}
    for i, ids in reference(docs):
        want.setdefault(i, []).append((len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    for i, parts in want.items():
        assert sorted((r.n_tokens, r.ids_crc32) for r in got if r.doc_id == i) == sorted(parts)
    got = sorted(got, key=lambda r: r.start)
    assert [r.start for r in got] == [0, *np.cumsum([r.n_tokens for r in got])[:-1]]
    assert [r.doc_id or -1 for r in got] == sorted(r.doc_id or -1 for r in got)
    assert decoded(stored(encoded(no_docs, tokenizer_path()), "test-segments")).collect() == []


def test_exported_files(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    segments = stored(encoded(docs, tokenizer_path(), segment_ids=20_000), "test-segments")
    for _ in range(2):  # a repeated job leaves the same files
        files = sorted(r.path for r in export_segments(segments, str(tmp_path / "ids")).collect())
    assert sorted(str(p) for p in (tmp_path / "ids").iterdir()) == files
    ids = []
    for path in files:
        with open(path, "rb") as f:
            image = Segment(f.read())
        ids += image.read_ids(0, image.n_ids).tolist()
    assert ids == [x for _, own in reference([(r.doc_id, r.text) for r in docs.collect()]) for x in own]
