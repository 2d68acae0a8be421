"""Exact round trips, members read incrementally, and broken archives."""

import gzip
import hashlib
import io
from pathlib import Path

import pytest

from feedloom.llm import warc

DATE = "2024-01-01T00:00:00Z"
SCHEMA = "page_id long, url string, html string, refers_to string"


def test_members_are_gzip_and_records_come_back():
    payloads = [b"", b"x", "é\r\n\r\nWARC/1.1".encode() * 50, bytes(range(256)) * 2000]
    data = b"".join(warc.record_bytes(i, f"http://a/{i} \r\nX: y", p, None, False, DATE) for i, p in enumerate(payloads))
    data += warc.record_bytes(9, None, payloads[3], 3, True, DATE)
    assert gzip.decompress(data).count(b"WARC/1.1\r\n") >= 5
    records = list(warc.read_records(io.BytesIO(data)))
    assert [r.payload for r in records] == [*payloads, b""]
    assert all(warc.verified(r) for r in records)
    assert records[4].type == "revisit" and records[4].headers["warc-refers-to"] == "<urn:page:3>"
    assert records[4].http["content-length"] == str(len(payloads[3]))
    records[1].payload = b"y"
    assert not warc.verified(records[1])


@pytest.mark.parametrize("cut", [1, 10, 200])
def test_cut_archives(cut):
    data = warc.record_bytes(1, "u", b"payload" * 100, None, False, DATE)
    with pytest.raises(warc.WarcError):
        list(warc.read_records(io.BytesIO(data[:-cut])))


@pytest.mark.parametrize("text", [b"hello", b"WARC/1.1\r\nContent-Length: 5\r\n\r\nabc\r\n\r\n", b"WARC/1.1\r\nX: y\r\n\r\n"])
def test_wrong_framing(text):
    with pytest.raises(warc.WarcError):
        list(warc.read_records(io.BytesIO(gzip.compress(text))))


def test_pages_round_trip(spark, tmp_path):
    long = "<p>" + "lorem é " * 400
    rows = [(1, "http://a", long, "z"), (2, "http://b", long, "z"), (7, None, long, "z"), (7, None, long, "z"), (None, "c d", long, "z"),
            (3, "u", "short", "z"), (4, "u", "short", "z"), (5, "u", None, "z"), (6, "u", "", "z"), (8, "u", "é" * 499, "z"), (9, "u", "é" * 499, "z"),
            (10, "u", "é" * 500, "z"), (11, "u", "é" * 500, "z"), (12, "u", "y" * 3_000_000, "z")]
    pages = spark.createDataFrame(rows, SCHEMA).repartition(3)
    archives = warc.write_archives(pages, str(tmp_path / "w"), archive_bytes=4000)
    listed = spark.createDataFrame(archives.collect(), archives.schema)
    got = warc.read_archives(listed).collect()
    assert len(got) == len(rows) and all(r.digest_ok for r in got)
    assert sum(r.records for r in listed.collect()) == len(rows)
    html = {(i, u): (h or "").encode() for i, u, h, _ in rows}
    for r in got:
        if r.url == "c d":
            assert r.page_id is None
        full = html[r.page_id, r.url]
        assert (r.payload_bytes, r.payload_digest) == (len(full), hashlib.sha1(full).hexdigest())
        assert r.payload is None if r.record_type == "revisit" else r.payload == full
    assert sorted((r.page_id or 0, r.refers_to) for r in got if r.record_type == "revisit") == [(0, 7), (1, 7), (2, 7), (10, 11)]


def test_only_listed_archives_are_read(spark, tmp_path):
    pages = spark.createDataFrame([(1, "u", "a", "")], SCHEMA)
    first = warc.write_archives(pages, str(tmp_path / "w")).collect()
    warc.write_archives(pages, str(tmp_path / "w")).collect()
    assert len(list(Path(tmp_path / "w").iterdir())) == 2
    assert warc.read_archives(spark.createDataFrame(first)).count() == 1


def test_empty_table(spark):
    assert warc.archive_pages(spark.createDataFrame([], SCHEMA)).count() == 0
