"""WARC derivatives: metadata and plain-text records from responses.

``responses`` wraps pages as WARC/1.1 response records; ``read_warc`` reads
them from files.  ``derivatives`` turns each response record into two linked
records:

* ``metadata`` (application/json): status and headers of the response, its
  digests, the page title and its links;
* ``conversion`` (text/plain): the text blocks of the page, one a line.

Both name their source in WARC-Refers-To, keep its target URI and date, carry
their own block digest and the source's payload digest, and have a record id
that is made from the source's id, so a repeated run writes the same records.

A null html or url counts as empty.  Records that are no HTTP response are
skipped by ``derivatives``; broken ones are reported as type ``invalid`` by
``parse``.  Repeated pages give repeated records.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import json
import os
import re
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerspark.llm.common import ready
from ledgerspark.llm.markup import blocks, squeeze

VERSION = "WARC/1.1"
DATE = "2024-01-01T00:00:00Z"
NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # RFC 4122: names that are URLs
_TITLE = re.compile(r"<title\b[^>]*>(.*?)(?:</title\s*>|\Z)", re.S | re.I)
_CHARSET = re.compile(r"charset=[\"']?([\w.:-]+)", re.I)


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(*parts: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(NAMESPACE, '|'.join(parts))}>"


def build(headers: list[tuple[str, str]], block: bytes) -> bytes:
    """A whole record; Content-Length and WARC-Block-Digest are added."""
    lines = [VERSION] + [f"{k}: {v}" for k, v in headers]
    lines += [f"WARC-Block-Digest: {digest(block)}", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _fields(head: bytes) -> tuple[str, list[tuple[str, str]]]:
    first, *lines = head.decode("utf-8", "replace").split("\r\n")
    out: list[tuple[str, str]] = []
    for line in lines:
        if line[:1] in (" ", "\t") and out:  # a folded header line
            out[-1] = (out[-1][0], f"{out[-1][1]} {line.strip()}")
        elif ":" in line:
            k, v = line.split(":", 1)
            out.append((k.strip(), v.strip()))
    return first, out


def parse(record: bytes) -> tuple[dict[str, str], bytes]:
    """Headers (lower-case names) and block of a record."""
    head, gap, rest = record.partition(b"\r\n\r\n")
    first, fields = _fields(head)
    known = {k.lower(): v for k, v in fields}
    length = known.get("content-length", "")
    if not first.startswith("WARC/") or not gap or not length.isdigit() or int(length) > len(rest):
        return {"warc-type": "invalid"}, b""
    return known, rest[: int(length)]


def parse_http(block: bytes) -> tuple[int, list[tuple[str, str]], bytes]:
    head, _, payload = block.partition(b"\r\n\r\n")
    status, fields = _fields(head)
    code = status.split(" ")[1] if status.startswith("HTTP/") and " " in status else ""
    return int(code) if code.isdigit() else 0, fields, payload


def response(page_id: str, url: str, html: str, date: str = DATE) -> bytes:
    payload = html.encode("utf-8", "replace")
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    headers = [
        ("WARC-Type", "response"),
        ("WARC-Record-ID", record_id("response", page_id, url)),
        ("WARC-Date", date),
        ("WARC-Target-URI", re.sub(r"[\x00-\x20]+", "%20", url)),
        ("WARC-Payload-Digest", digest(payload)),
        ("Content-Type", "application/http; msgtype=response"),
    ]
    return build(headers, http.encode() + payload)


def derive(record: bytes) -> list[tuple[str, bytes]]:
    """(type, record) of the derivatives of a response record."""
    source, block = parse(record)
    if source.get("warc-type") != "response":
        return []
    status, http, payload = parse_http(block)
    charset = _CHARSET.search(dict((k.lower(), v) for k, v in http).get("content-type", ""))
    try:
        page = payload.decode(charset[1] if charset else "utf-8", "replace")
    except LookupError:  # an encoding that nobody knows
        page = payload.decode("utf-8", "replace")
    found, links = blocks(page)
    payload_digest = source.get("warc-payload-digest") or digest(payload)
    title = _TITLE.search(page)
    envelope = {
        "refers-to": source.get("warc-record-id", ""),
        "target-uri": source.get("warc-target-uri", ""),
        "payload-digest": payload_digest,
        "block-digest": source.get("warc-block-digest") or digest(block),
        "payload-length": len(payload),
        "status": status,
        "headers": [list(x) for x in http],
        "title": squeeze(title[1]) if title else "",
        "links": [{"url": u, "text": t} for u, t in links],
    }

    def linked(kind: str, content_type: str, data: bytes) -> tuple[str, bytes]:
        headers = [
            ("WARC-Type", kind),
            ("WARC-Record-ID", record_id(kind, source.get("warc-record-id", ""))),
            ("WARC-Refers-To", source.get("warc-record-id", "")),
            ("WARC-Date", source.get("warc-date", "")),
            ("WARC-Target-URI", source.get("warc-target-uri", "")),
            ("WARC-Source-Payload-Digest", payload_digest),
            ("Content-Type", content_type),
        ]
        return kind, build(headers, data)

    text = "\n".join(b.text for b in found)
    return [
        linked("metadata", "application/json", json.dumps(envelope, ensure_ascii=False).encode("utf-8", "replace")),
        linked("conversion", "text/plain; charset=utf-8", text.encode("utf-8", "replace")),
    ]


def responses(pages: DataFrame, date: str = DATE) -> DataFrame:
    """page_id, record: each page as a response record."""
    ready()

    def wrap(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = zip(batch["page_id"], batch["key"], batch["url"], batch["html"], strict=True)
            made = [(i, response(k, u, h, date)) for i, k, u, h in rows]
            out = pd.DataFrame(made, columns=["page_id", "record"])
            out["page_id"] = out["page_id"].astype("Int64")
            yield out

    text = {c: F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("page_id", "url", "html")}
    source = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        text["page_id"].alias("key"),
        text["url"].alias("url"),
        text["html"].alias("html"),
    )
    return source.mapInPandas(wrap, "page_id long, record binary")


def derivatives(records: DataFrame) -> DataFrame:
    """page_id, warc_type, record: two records per response of ``records``."""
    ready()

    def make(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(i, kind, r) for i, rec in zip(batch["page_id"], batch["record"], strict=True) for kind, r in derive(rec)]
            out = pd.DataFrame(rows, columns=["page_id", "warc_type", "record"])
            out["page_id"] = out["page_id"].astype("Int64")
            yield out

    return records.select("page_id", "record").mapInPandas(make, "page_id long, warc_type string, record binary")


def described(records: DataFrame) -> DataFrame:
    """The header fields of each record, its content length and the SHA-256
    of its block; for metadata records also status and number of links."""
    ready()
    schema = (
        "page_id long, warc_type string, record_id string, refers_to string, target_uri string, warc_date string, "
        "content_type string, content_length long, block_digest string, source_payload_digest string, "
        "http_status int, n_links int, block_sha256 string"
    )

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = ["warc-type", "warc-record-id", "warc-refers-to", "warc-target-uri", "warc-date", "content-type"]
        for batch in batches:
            rows = []
            for i, record in zip(batch["page_id"], batch["record"], strict=True):
                h, block = parse(record)
                status = n_links = None
                if h["warc-type"] == "metadata":
                    envelope = json.loads(block)
                    status, n_links = envelope["status"], len(envelope["links"])
                rows.append(
                    (i, *[h.get(k) for k in names], len(block), h.get("warc-block-digest"), h.get("warc-source-payload-digest"))
                    + (status, n_links, hashlib.sha256(block).hexdigest())
                )
            out = pd.DataFrame(rows, columns=[f.split()[0] for f in schema.split(", ")])
            yield out.astype({"page_id": "Int64", "http_status": "Int32", "n_links": "Int32"})

    return records.select("page_id", "record").mapInPandas(read, schema)


def split_records(data: bytes) -> Iterator[bytes]:
    """The records of a WARC file, gzip or plain."""
    stream: io.BufferedIOBase = io.BytesIO(data)
    if data[:2] == b"\x1f\x8b":
        stream = gzip.GzipFile(fileobj=stream)
    while True:
        head = b""
        while not head.endswith(b"\r\n\r\n"):
            line = stream.readline()
            if not line:
                return
            if head or line.strip():
                head += line
        length = {k.lower(): v for k, v in _fields(head[:-4])[1]}.get("content-length", "0")
        yield head + stream.read(int(length) if length.isdigit() else 0) + b"\r\n\r\n"


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """page_id (null), record of every record in the files at ``path``; a
    file's bytes are held by one task while it is read."""
    ready()

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for data in batch["content"]:
                for record in split_records(data):
                    yield pd.DataFrame({"page_id": pd.array([None], dtype="Int64"), "record": [record]})

    return spark.read.format("binaryFile").load(path).select("content").mapInPandas(read, "page_id long, record binary")


def write_warc(records: DataFrame, folder: str) -> DataFrame:
    """Writes ``records`` as .warc.gz files, one per partition and one gzip
    member per record, below ``folder``, which every executor must see as a
    path; returns (file, records).  A repeated task replaces its own file."""
    ready()

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        os.makedirs(folder, exist_ok=True)
        context = TaskContext.get()
        name = os.path.join(folder, f"part-{context.partitionId():05d}.warc.gz")
        part, n = f"{name}.{context.taskAttemptId()}.tmp", 0
        with open(part, "wb") as out:
            for batch in batches:
                for record in batch["record"]:
                    out.write(gzip.compress(record, mtime=0))
                    n += 1
        os.replace(part, name)
        yield pd.DataFrame({"file": [name], "records": [n]})

    return records.select("record").mapInPandas(write, "file string, records long")
