"""WARC: round trips, splits at every size, false members, SQL."""

import gzip
import hashlib
import io
import random

import pytest
from pyspark.sql import functions as F

from maskflow.llm import warc

PAGES = "page_id bigint, url string, html string"


class File(io.BytesIO):
    def size(self):
        return len(self.getvalue())


def archive(n, payload=lambda k: b"<html>%d</html>" % k * (k * 7 % 40)):
    return [warc.encode_record(f"urn:page:{k}", "response", payload(k), "0", f"http://x/{k}") for k in range(n)]


def read_in_splits(data, size):
    source = warc.Source(File(data))
    return [r for at in range(0, len(data), size) for r in warc.read_split(source, at, min(at + size, len(data)))]


@pytest.mark.parametrize("size", [1, 2, 3, 7, 100, 1000, 1 << 20])
def test_every_split_size_finds_every_record_once(size):
    members = archive(12)
    data = b"".join(members)
    got = read_in_splits(data, size)
    starts = [sum(map(len, members[:k])) for k in range(12)]
    assert [r.start for r in got] == starts
    assert [r.headers["warc-record-id"] for r in got] == [f"<urn:page:{k}>" for k in range(12)]


def test_false_members_are_passed_over():
    inner = b"".join(archive(3))
    noise = warc.MAGIC + b"\x00" * 40 + warc.MAGIC * 9 + random.Random(1).randbytes(3000)
    payloads = [noise, gzip.compress(b"WARC/1.1\r\nContent-Length: 5\r\n\r\nno"), inner, noise + inner + noise]
    packed = []
    for k, payload in enumerate(payloads):
        level, warc.LEVEL = warc.LEVEL, 0  # stored, so that payload bytes stand in the file as they are
        try:
            packed.append(warc.encode_record(f"urn:page:{k}", "response", payload, "0"))
        finally:
            warc.LEVEL = level
    data = b"".join(packed)
    for size in (64, 500, 5000, len(data)):
        got = read_in_splits(data, size)
        reach, kept = 0, []
        for r in got:
            if r.start >= reach:
                kept.append(r)
            reach = max(reach, r.end)
        assert [r.start for r in kept] == [sum(map(len, packed[:k])) for k in range(4)]
        assert [warc.row_of("p", r, True)[-1] for r in kept] == payloads


def test_broken_files():
    members = archive(5)
    data = b"".join(members)
    cut = read_in_splits(data[:-10], 1 << 20)
    assert [r.headers["warc-record-id"] for r in cut] == [f"<urn:page:{k}>" for k in range(4)]
    hurt = bytearray(data)
    hurt[len(members[0]) + 30] ^= 255
    ids = [r.headers["warc-record-id"] for r in read_in_splits(bytes(hurt), 200)]
    assert "<urn:page:1>" not in ids and ids[-1] == "<urn:page:4>"


def page_rows():
    long = "a payload that is long enough to be referred to again " * 3
    rows = [(k, f"http://x/{k}?q=ä b\r\nEvil: 1", f"<p>page {k % 9}</p>" * (1 + k % 9)) for k in range(60)]
    return rows + [
        (100, None, None), (101, "", ""), (102, "u", "é" * 50), (103, "u", "é" * 50), (104, "u", "é" * 49),
        (105, "u", "é" * 49), (110, "u", long), (109, "v", long), (109, "w", long), (None, "n", long),
        (None, "n", "only without ids " * 9), (111, "u", "\r\n\r\nWARC/1.1\r\n\r\n" * 30), (112, "u", "x" * 3_000_000),
    ]


def expected(rows):
    first = {}
    for page, _, html in rows:
        data = (html or "").encode()
        if len(data) >= 100 and page is not None:
            first[data] = min(first.get(data, page), page)
    for page, _, html in rows:
        data = (html or "").encode()
        low = first.get(data)
        to = None if low is None or low == page else low
        yield page, len(data), hashlib.sha256(data).hexdigest(), "response" if to is None else "revisit", to


@pytest.mark.parametrize("broadcast", [True, False])
def test_round_trip(spark, broadcast, monkeypatch):
    if not broadcast:
        monkeypatch.setattr(warc, "BROADCAST_ROWS", 0)
    rows = page_rows()
    pages = spark.createDataFrame([(*r, 1) for r in rows], PAGES + ", digest int").repartition(3)
    pages = pages.withColumn("first", F.lit("x"))
    got = [tuple(r) for r in warc.round_trip(pages).collect()]
    assert sorted(map(str, got)) == sorted(map(str, expected(rows)))


def test_payloads_and_files(spark, tmp_path):
    rows = [(k, f"http://x/{k}", f"text {k} " * 100) for k in range(50)]
    pages = spark.createDataFrame(rows, PAGES).coalesce(1)
    manifest = warc.write_warc(pages, str(tmp_path / "warc"), file_bytes=2000)
    files = manifest.collect()
    assert len(files) > 3 and sum(r["records"] for r in files) == 50
    for r in files:  # any gzip reader sees all records of a file
        with open(r["path"], "rb") as file:
            data = file.read()
        assert len(data) == r["bytes"] and gzip.decompress(data).count(b"WARC/1.1\r\n") == r["records"]
    records = warc.read_warc(manifest, split_bytes=300).collect()
    assert sorted((r["target_uri"], bytes(r["payload"]).decode()) for r in records) == sorted(r[1:] for r in rows)


def test_empty(spark):
    pages = spark.createDataFrame([], PAGES)
    assert warc.round_trip(pages).count() == 0


def test_tasks_grow_with_the_bytes_listed(spark):
    """2,000 listed files of 1 GB are 64,000 ranges, a few in each of 10,000 tasks."""
    files = spark.range(2000).selectExpr("concat('file-', id) AS path", "cast(1 << 30 AS bigint) AS bytes", "1L AS records")
    splits = warc.splits_of(files)
    held = splits.groupBy(F.spark_partition_id().alias("task")).count().agg(
        F.count(F.lit(1)), F.max("count"), F.sum("count")
    ).first()
    assert held[0] == warc.MOST_TASKS and held[1] <= 8 and held[2] == 64_000
    few = warc.splits_of(files.limit(3), 300 << 20)
    assert few.rdd.getNumPartitions() == 12
    assert {len(part) for part in few.rdd.glom().collect()} == {1}
    assert warc.splits_of(files.where("bytes < 0")).count() == 0


def test_other_columns_play_no_part(spark):
    rows = [(1, "u", "<html>" + "x" * 200), (2, "u", "<html>" + "x" * 200), (3, None, None)]
    pages = spark.createDataFrame(rows, PAGES)
    plain = sorted(map(str, warc.round_trip(pages).collect()))
    odd = pages.select(
        F.lit("x").alias("digest"), F.lit(9).alias("bytes"), F.lit(8).alias("first"), "*", F.lit(7).alias("salt"),
        F.create_map(F.lit(1), F.lit(2)).alias("payload"),
    )
    assert sorted(map(str, warc.round_trip(odd).collect())) == plain
