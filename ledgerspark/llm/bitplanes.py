"""Token ids as binary segments of compressed bit planes.

Documents are dealt to ranges of ids, tokenised in ascending order and
written as segments.  A segment holds whole documents and looks like this
(little-endian):

    magic "IDPL", version, bits of a plane (1 or 8), two zero bytes
    u32 ids of a full chunk, u32 chunks, u64 ids, u64 documents
    u32 bytes of the document table
    chunk index: for each chunk u64 where it begins (from the end of the
        document table), u32 ids, one u32 size for each plane
    document table, zstandard: for each document a null flag (u8), doc_id
        (i64), ids (i64)
    the planes of chunk after chunk, each a zstandard frame; a plane without
        a bit set is not stored (size 0)

A chunk is a fixed number of consecutive ids (the last of a segment may be
shorter).  Its ids are transposed: plane j of a bit-plane segment holds bit j
of every id, plane j of a byte-plane segment byte j.  The chunk index gives
any range of ids without touching other chunks (``read_ids``).

Segments are rows of a table that Spark writes to the shared folder, so a
task that runs twice leaves one copy.  ``export_segments`` writes them as
plain files instead.  Ties in doc_id are ordered by the text; equal rows are
interchangeable.  Null ids come first.  Null texts count as empty; a document
without words is its closing id alone.  An empty table gives an empty result.
Other columns of the input are ignored.  A null or repeated id that holds a
third of all rows is split over tasks by the text and the row.
"""

from __future__ import annotations

import os
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerspark.llm.common import ready, stored, text_of
from ledgerspark.llm.tokens import tokenized

MAGIC = b"IDPL"
_HEAD = struct.Struct("<4sBBHIIQQI")
SEGMENTS = "part int, segment int, first_id long, n_ids long, image binary"
DOCUMENTS = "doc_id long, start long, n_tokens long, ids_crc32 long"

#: ids of a chunk: 8 KB a bit plane
CHUNK_IDS = 1 << 16
#: a segment is closed after the document that reaches so many ids
SEGMENT_IDS = 1 << 20
LEVEL = 3


def to_planes(ids: np.ndarray, bits: int) -> list[bytes]:
    """The 32 bit planes or 4 byte planes of unsigned 32-bit ids."""
    rows = np.ascontiguousarray(ids, "<u4").view(np.uint8).reshape(-1, 4)
    if bits == 8:
        return [rows[:, j].tobytes() for j in range(4)]
    out = []
    for j in range(4):
        column = rows[:, j]
        if column.any():
            plane = np.unpackbits(column[:, None], axis=1, bitorder="little")
            out += [p.tobytes() for p in np.packbits(np.ascontiguousarray(plane.T), axis=1, bitorder="little")]
        else:
            out += [bytes(-(-len(ids) // 8))] * 8
    return out


def from_planes(planes: list[bytes | None], n: int, bits: int) -> np.ndarray:
    """Ids from their planes; None stands for a plane of zeros."""
    rows = np.zeros((n, 4), np.uint8)
    for j in range(4):
        if bits == 8:
            if planes[j] is not None:
                rows[:, j] = np.frombuffer(planes[j], np.uint8)
            continue
        some = planes[8 * j : 8 * j + 8]
        if any(p is not None for p in some):
            zero = bytes(-(-n // 8))
            packed = np.frombuffer(b"".join(p or zero for p in some), np.uint8).reshape(8, -1)
            plane = np.unpackbits(packed, axis=1, bitorder="little", count=n)
            rows[:, j] = np.packbits(np.ascontiguousarray(plane.T), axis=1, bitorder="little")[:, 0]
    return rows.reshape(-1).view("<u4")


def write_segment(
    ids: np.ndarray, lengths: np.ndarray, doc_ids: list[int | None], bits: int = 1, chunk_ids: int = CHUNK_IDS
) -> bytes:
    """The image of whole documents: their ids one after another, the number
    of ids of each, and their doc_ids."""
    if bits not in (1, 8):
        raise ValueError("a plane holds bits (1) or bytes (8)")
    press = zstandard.ZstdCompressor(level=LEVEL)
    index, body, at = [], [], 0
    for k in range(0, len(ids), chunk_ids):
        part = ids[k : k + chunk_ids]
        planes = to_planes(part, bits)
        zero = bytes(len(planes[0]))
        frames = [press.compress(p) if p != zero else b"" for p in planes]
        index.append(struct.pack(f"<QI{len(frames)}I", at, len(part), *map(len, frames)))
        body += frames
        at += sum(map(len, frames))
    nulls = np.array([d is None for d in doc_ids], np.uint8)
    numbers = np.array([d or 0 for d in doc_ids], "<i8")
    table = press.compress(nulls.tobytes() + numbers.tobytes() + np.asarray(lengths, "<i8").tobytes())
    head = _HEAD.pack(MAGIC, 1, bits, 0, chunk_ids, len(index), len(ids), len(doc_ids), len(table))
    return b"".join([head, *index, table, *body])


class Segment:
    """A segment image, read piece by piece."""

    def __init__(self, image: bytes):
        magic, version, self.bits, _, self.chunk_ids, n_chunks, self.n_ids, n_docs, table = _HEAD.unpack_from(image)
        if magic != MAGIC or version != 1:
            raise ValueError("not a segment of token ids")
        self.image = image
        entry = struct.Struct(f"<QI{32 // self.bits}I")
        at = _HEAD.size
        self.index = [entry.unpack_from(image, at + k * entry.size) for k in range(n_chunks)]
        at += n_chunks * entry.size
        flat = zstandard.ZstdDecompressor().decompress(image[at : at + table])
        self.body = at + table
        nulls = np.frombuffer(flat, np.uint8, n_docs)
        numbers = np.frombuffer(flat, "<i8", n_docs, n_docs)
        self.lengths = np.frombuffer(flat, "<i8", n_docs, 9 * n_docs)
        self.doc_ids = [None if null else i for null, i in zip(nulls.tolist(), numbers.tolist(), strict=True)]

    def chunk(self, k: int) -> np.ndarray:
        unpress = zstandard.ZstdDecompressor()
        at, n, *sizes = self.index[k]
        at += self.body
        planes: list[bytes | None] = []
        for size in sizes:
            planes.append(unpress.decompress(self.image[at : at + size]) if size else None)
            at += size
        return from_planes(planes, n, self.bits)

    def read_ids(self, lo: int, hi: int) -> np.ndarray:
        """The ids at places lo (inclusive) to hi (exclusive): only the
        chunks that hold them are read."""
        hi = min(hi, self.n_ids)
        if lo >= hi:
            return np.empty(0, "<u4")
        first, last = lo // self.chunk_ids, (hi - 1) // self.chunk_ids
        ids = np.concatenate([self.chunk(k) for k in range(first, last + 1)])
        return ids[lo - first * self.chunk_ids : hi - first * self.chunk_ids]


def encoded(
    docs: DataFrame,
    tokenizer_path: str,
    end_id: int = 1,
    bits: int = 1,
    chunk_ids: int = CHUNK_IDS,
    segment_ids: int = SEGMENT_IDS,
) -> DataFrame:
    """``docs`` as segments in ascending doc_id order: part and segment give
    the order, first_id the place of a segment's first id within its part."""
    ready()

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [
                ("part", pa.int32()),
                ("segment", pa.int32()),
                ("first_id", pa.int64()),
                ("n_ids", pa.int64()),
                ("image", pa.binary()),
            ]
        )
        held: list[np.ndarray] = []
        lengths: list[int] = []
        doc_ids: list[int | None] = []
        part, segment, first, n = 0, 0, 0, 0

        def close() -> pa.RecordBatch:
            image = write_segment(np.concatenate(held), np.array(lengths), doc_ids, bits, chunk_ids)
            return pa.RecordBatch.from_pylist(
                [{"part": part, "segment": segment, "first_id": first, "n_ids": n, "image": image}], schema
            )

        for batch, ids, offsets in tokenized(batches, tokenizer_path, end_id):
            part = batch.column("part")[0].as_py() if len(batch) else part
            at, numbers = 0, batch.column("doc_id").to_pylist()
            while at < len(batch):
                # as many whole documents as complete the segment
                to = int(np.searchsorted(offsets, offsets[at] + segment_ids - n))
                to = max(at + 1, min(to, len(batch)))
                held.append(ids[offsets[at] : offsets[to]])
                lengths += np.diff(offsets[at : to + 1]).tolist()
                doc_ids += numbers[at:to]
                n += int(offsets[to] - offsets[at])
                at = to
                if n >= segment_ids:
                    yield close()
                    segment, first, n = segment + 1, first + n, 0
                    held, lengths, doc_ids = [], [], []
        if n:
            yield close()

    order = ["doc_id", "_tie", "_row"]
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        text_of().alias("text"),
        F.xxhash64(text_of()).alias("_tie"),
        F.monotonically_increasing_id().alias("_row"),
    )
    return (
        rows.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select("doc_id", "text", F.spark_partition_id().alias("part"))
        .mapInArrow(segments, SEGMENTS)
    )


def decoded(segments: DataFrame) -> DataFrame:
    """The documents of stored segments: doc_id, start (ids of all documents
    before it), n_tokens, ids_crc32.

    Only one number for each part of the table goes through one task.
    """
    ready()

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(len(batch)):
                image = Segment(batch.column("image")[row].as_py())
                ids = memoryview(np.ascontiguousarray(image.read_ids(0, image.n_ids))).cast("B")
                ends = np.concatenate(([0], np.cumsum(image.lengths)))
                cuts = (4 * ends).tolist()
                starts = ends[:-1] + batch.column("first_id")[row].as_py()
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([batch.column("part")[row].as_py()] * len(starts), pa.int32()),
                        pa.array(image.doc_ids, pa.int64()),
                        pa.array(starts, pa.int64()),
                        pa.array(image.lengths, pa.int64()),
                        pa.array([zlib.crc32(ids[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)], pa.int64()),
                    ],
                    ["part", "doc_id", "start", "n_tokens", "ids_crc32"],
                )

    totals = segments.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = totals.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    return (
        segments.select("part", "first_id", "image")
        .mapInArrow(documents, f"part int, {DOCUMENTS}")
        .join(F.broadcast(base), "part")  # a row for each part
        .select("doc_id", (F.col("start") + F.col("base")).alias("start"), "n_tokens", "ids_crc32")
    )


def export_segments(segments: DataFrame, folder: str) -> DataFrame:
    """Writes each segment as a file ``part-segment.idpl`` of ``folder``, a
    path that every executor can open; returns part, segment and path.  A file
    appears whole or not at all, and a repeated task replaces its own."""
    ready()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.makedirs(folder, exist_ok=True)
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                path = os.path.join(folder, f"{row['part']:06d}-{row['segment']:06d}.idpl")
                fresh = f"{path}.{uuid.uuid4().hex}"
                with open(fresh, "wb") as f:
                    f.write(row["image"])
                os.replace(fresh, path)
                out.append({"part": row["part"], "segment": row["segment"], "path": path})
            if out:
                yield pa.RecordBatch.from_pylist(
                    out, pa.schema([("part", pa.int32()), ("segment", pa.int32()), ("path", pa.string())])
                )

    return segments.select("part", "segment", "image").mapInArrow(write, "part int, segment int, path string")


def round_trip(docs: DataFrame, tokenizer_path: str, end_id: int = 1, bits: int = 1) -> DataFrame:
    """``docs`` written as segments and read back."""
    return decoded(stored(encoded(docs, tokenizer_path, end_id, bits), "segments"))
