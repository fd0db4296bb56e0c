"""WARC archives: records written by tasks, read back in splits."""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote

import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from maskflow.llm.common import stored
from maskflow.sources.shared import new_path

# Payloads shorter than this are never stored as revisits.
REVISIT_BYTES = 100
SPLIT_BYTES = 32 << 20
MOST_TASKS = 10_000
FILE_BYTES = 1 << 30
CHUNK = 1 << 20
HEADER_BYTES = 64 << 10
LEVEL = 5
# Rows of (digest, page) up to which repeated payloads are broadcast, about 100 bytes each.
BROADCAST_ROWS = 200_000
SALTS = 16

MAGIC = b"\x1f\x8b\x08"
RECORDS = (
    "path string, start bigint, end bigint, record_id string, record_type string, target_uri string, "
    "refers_to string, payload_bytes bigint, payload_digest string, payload binary"
)


def open_store(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a URI (file, hdfs, s3, gs, ...) or a local path."""
    return fs.FileSystem.from_uri(re.sub(r"^file:/(?=[^/])", "file:///", uri))


# -- writing

def encode_record(record_id: str, record_type: str, payload: bytes, digest: str,
                  target_uri: str | None = None, refers_to: str | None = None) -> bytes:
    """One WARC record as a gzip member of its own.

    A response carries the payload behind an HTTP header; a revisit carries no
    payload, only its digest and length and the record it repeats.
    """
    headers = [
        ("WARC-Type", record_type),
        ("WARC-Record-ID", f"<{record_id}>"),
        ("WARC-Date", "1970-01-01T00:00:00Z"),
        ("Content-Type", "application/http; msgtype=response"),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
        ("X-Payload-Length", str(len(payload))),
    ]
    if target_uri is not None:
        headers.append(("WARC-Target-URI", quote(target_uri, safe=":/?#[]@!$&'()*+,;=%~")))
    if refers_to is not None:
        headers.append(("WARC-Refers-To", f"<{refers_to}>"))
        headers.append(
            ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        )
    block = b""
    if record_type == "response":
        block = (
            b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "
            + str(len(payload)).encode() + b"\r\n\r\n" + payload
        )
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in headers)
    data = f"{head}Content-Length: {len(block)}\r\n\r\n".encode() + block + b"\r\n\r\n"
    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def with_revisits(pages: DataFrame) -> DataFrame:
    """(page_id, url, html, digest, bytes, refers_to): of pages with equal payloads of at
    least 100 bytes, all but those with the smallest page_id refer to it.

    A null html is an empty payload. Null page_ids sort last and are never
    referred to; repeated rows with the smallest page_id are all responses.
    Payloads that occur once take no part in the join; the others are broadcast
    while few, else met by (digest, salt).
    """
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    rows = pages.select(
        "page_id", "url", "html", F.sha2(payload, 256).alias("digest"),
        F.octet_length(payload).cast("bigint").alias("bytes"),
    )
    groups = (
        rows.where(F.col("bytes") >= REVISIT_BYTES).groupBy("digest")
        .agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
        .where("n > 1").select("digest", "first")
    )
    groups = stored(groups, "payloads")
    if groups.count() <= BROADCAST_ROWS:
        met = rows.join(F.broadcast(groups), "digest", "left")
    else:
        salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
        salt = F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)).cast("int")
        met = rows.withColumn("salt", salt).join(groups.select("*", salts), ["digest", "salt"], "left")
    return met.select(
        "page_id", "url", "html", "digest", "bytes",
        F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first")).alias("refers_to"),
    )


def page_urn(page) -> str:
    return f"urn:page:{'' if page is None else page}"


def write_warc(pages: DataFrame, folder: str | None = None, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Archive ``pages`` (page_id, url, html) and return the manifest (path, bytes, records).

    Every task writes its own files under names no other attempt uses; only the
    files of attempts that succeed are in the manifest. Without ``folder`` they
    go to the shared folder. An empty table gives an empty manifest; other columns play no
    part, whatever their names.
    """
    folder = (folder or new_path(pages.sparkSession, "warc")).rstrip("/")

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, root = open_store(folder)
        store.create_dir(root, recursive=True)
        files, out, name, size, records = [], None, "", 0, 0
        for batch in batches:
            for page, url, html, digest, first in zip(*(batch[c] for c in batch.columns)):
                if out is None or size >= file_bytes:
                    if out is not None:
                        out.close()
                        files.append((name, size, records))
                    name, size, records = f"pages-{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = store.open_output_stream(f"{root}/{name}", compression=None)
                data = encode_record(
                    page_urn(page), "response" if first is None else "revisit",
                    (html or "").encode("utf-8", "replace"), digest, url,
                    None if first is None else page_urn(first),
                )
                out.write(data)
                size, records = size + len(data), records + 1
        if out is not None:
            out.close()
            files.append((name, size, records))
        yield pd.DataFrame(
            [(f"{folder}/{n}", s, r) for n, s, r in files], columns=["path", "bytes", "records"]
        )

    rows = with_revisits(pages).select(
        F.col("page_id").cast("string"), "url", "html", "digest", F.col("refers_to").cast("string")
    )
    return stored(rows.mapInPandas(write, "path string, bytes bigint, records bigint"), "manifest")


# -- reading

class Source:
    """Random reads of an open file through one buffer."""

    def __init__(self, file):
        self.file, self.size = file, file.size()
        self.at, self.data = 0, b""

    def read(self, start: int, size: int) -> bytes:
        """Up to ``size`` bytes from ``start``; fewer at the end of the file."""
        if start < self.at or start + size > self.at + len(self.data):
            self.file.seek(start)
            self.at, self.data = start, self.file.read(max(size, CHUNK))
        return self.data[start - self.at : start - self.at + size]


@dataclass(frozen=True)
class Record:
    start: int
    end: int
    headers: dict[str, str]
    block: bytes


def parse_headers(head: bytes) -> dict[str, str] | None:
    """Named fields of a WARC header, names in lower case; None if it is none."""
    lines = head.decode("utf-8", "replace").split("\r\n")
    if not re.fullmatch(r"WARC/1\.[01]", lines[0]):
        return None
    fields = dict(re.findall(r"(?m)^([^:\r\n]+):[ \t]*([^\r\n]*)", "\r\n".join(lines[1:])))
    fields = {name.lower(): value for name, value in fields.items()}
    return fields if {"warc-type", "content-length"} <= fields.keys() else None


def read_record(source: Source, start: int) -> Record | None:
    """The record whose gzip member begins at ``start``, or None if none does.

    The header must decode first; then the whole member must, with its checksum
    and the stated length, and another member or the end of the file follows.
    """
    unpacker, at, data, headers, head_end = zlib.decompressobj(31), start, [], None, 0
    size = 0
    step = 4096
    try:
        while not unpacker.eof:
            chunk = source.read(at, step)
            if not chunk:
                return None
            data.append(unpacker.decompress(chunk))
            size += len(data[-1])
            at += len(chunk)
            if headers is None:
                head = b"".join(data)
                data = [head]
                head_end = head.find(b"\r\n\r\n")
                if not head.startswith(b"WARC/1."[: len(head)]) or (head_end < 0 and size > HEADER_BYTES):
                    return None
                if head_end >= 0:
                    headers = parse_headers(head[:head_end])
                    if headers is None or not headers["content-length"].isdigit():
                        return None
                    step = CHUNK // 4
    except zlib.error:
        return None
    if headers is None:
        return None
    end = at - len(unpacker.unused_data)
    body = b"".join(data)[head_end + 4 :]
    length = int(headers["content-length"])
    follows = source.read(end, 3)
    if len(body) != length + 4 or body[length:] != b"\r\n\r\n" or follows not in (b"", MAGIC):
        return None
    return Record(start, end, headers, body[:length])


def read_split(source: Source, start: int, end: int) -> Iterator[Record]:
    """Records whose members begin in [start, end), found by the gzip magic; the last
    may end behind the split."""
    at = start
    while at < end:
        chunk = source.read(at, min(CHUNK // 2, end - at + len(MAGIC) - 1))
        found = chunk.find(MAGIC)
        if found < 0:
            at += max(1, len(chunk) - len(MAGIC) + 1)
            continue
        at += found
        if at >= end:
            return
        record = read_record(source, at)
        if record is None:
            at += 1
        else:
            yield record
            at = record.end


def splits_of(manifest: DataFrame, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """(path, bytes, start) of all byte ranges of the files of a manifest, dealt out evenly:
    a task for each range, up to ``MOST_TASKS``, then several ranges a task."""
    ranges = F.sequence(F.lit(0).cast("bigint"), F.col("bytes") - 1, F.lit(split_bytes).cast("bigint"))
    files = manifest.where("bytes > 0")
    count = files.agg(F.sum(F.ceil(F.col("bytes") / split_bytes))).first()[0] or 1
    # The number is given, as adaptive execution would merge such short rows into one task.
    return files.select("path", "bytes", F.explode(ranges).alias("start")).repartition(int(min(count, MOST_TASKS)))


def read_warc(manifest: DataFrame, split_bytes: int = SPLIT_BYTES, payload: bool = True) -> DataFrame:
    """Records of the files of a manifest (path, bytes), a row for each.

    Files are cut into byte ranges; a task finds where records begin in its
    ranges and owns those. Digest and length are those of the payload read (for
    a revisit: of the payload it stands for). ``drop_embedded`` removes records
    of archives that lie within a payload larger than a split.
    """
    splits = splits_of(manifest, split_bytes)

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, size, start in zip(batch["path"], batch["bytes"], batch["start"]):
                store, name = open_store(path)
                rows, held = [], 0
                with store.open_input_file(name) as file:
                    for record in read_split(Source(file), int(start), min(int(start) + split_bytes, int(size))):
                        rows.append(row_of(path, record, payload))
                        held += len(rows[-1][-1] or b"")
                        if len(rows) >= 5000 or held > 8 << 20:
                            yield pd.DataFrame(rows, columns=names)
                            rows, held = [], 0
                yield pd.DataFrame(rows, columns=names)

    names = [column.split()[0] for column in RECORDS.split(", ")]
    return splits.mapInPandas(read, RECORDS)


def row_of(path: str, record: Record, payload: bool) -> tuple:
    """A record as a row; bare ids, digest and length of its payload."""
    headers = record.headers

    def bare(name: str) -> str | None:
        value = headers.get(name)
        return value[1:-1] if value and value[0] == "<" else value

    kind = headers["warc-type"]
    body = record.block
    if kind == "response" and headers.get("content-type", "").startswith("application/http"):
        body = body[body.find(b"\r\n\r\n") + 4 :]
    if kind == "revisit":
        length = headers.get("x-payload-length")
        size = int(length) if length else None
        digest = headers.get("warc-payload-digest", "").partition(":")[2] or None
        body = None
    else:
        size, digest = len(body), hashlib.sha256(body).hexdigest()
    return (path, record.start, record.end, bare("warc-record-id"), kind, headers.get("warc-target-uri"),
            bare("warc-refers-to"), size, digest, body if payload else None)


def drop_embedded(records: DataFrame) -> DataFrame:
    """Records without those that lie within an earlier record of their file."""
    earlier = Window.partitionBy("path").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    reach = F.max("end").over(earlier)
    return records.withColumn("_reach", reach).where("_reach is null or start >= _reach").drop("_reach")


def round_trip(pages: DataFrame) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of all pages, as read
    back from their archives."""
    kind = pages.schema["page_id"].dataType
    records = drop_embedded(read_warc(write_warc(pages), payload=False).drop("payload", "target_uri"))

    def page(urn: str):
        text = F.regexp_extract(urn, "^urn:page:(.*)$", 1)
        return F.when(text != "", text).cast(kind)

    return records.select(
        page("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        page("refers_to").alias("refers_to"),
    )
