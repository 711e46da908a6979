import base64
import hashlib
import io
import struct
from pathlib import Path

import duckdb
import pytest
import zstandard

from stratalake.llm import warc

PAGES = "page_id long, url string, html string"
ROWS = [
    (1, "http://a/", "<p>one</p>"), (2, None, "<p>one</p>"), (3, "http://b/\r\nX: y", None), (4, "http://c/", ""),
    (5, "http://d/", "é" * 50_000), (5, "http://d/", "é" * 50_000), (None, "http://e/", "<p>one</p>"), (6, "u", "x\r\n\r\ny"),
]


def read(spark, rows, folder, **how):
    pages = spark.createDataFrame(rows, PAGES).selectExpr("*", "1 AS payload", "2 AS digest", "3 AS n")
    written = warc.write_archives(pages, f"file://{folder}", **how)
    return written, warc.read_archives(written).collect()


def test_round_trip(spark, tmp_path):
    written, got = read(spark, ROWS, tmp_path / "w")
    assert len(got) == len(ROWS) == sum(r.records for r in written.collect())
    by_id = {r.page_id: r for r in got}
    assert by_id[1].record_type == "response" and bytes(by_id[1].payload) == b"<p>one</p>"
    assert (by_id[2].record_type, by_id[2].refers_to, by_id[2].payload_bytes, by_id[2].payload) == ("revisit", 1, 10, None)
    assert by_id[3].payload_bytes == 0 and by_id[4].refers_to == 3
    assert bytes(by_id[5].payload).decode() == "é" * 50_000
    assert [r.record_type for r in got if r.page_id == 5] == ["response"] * 2
    assert by_id[None].refers_to is None
    assert by_id[3].url == "http://b/%0D%0AX: y" and by_id[2].url is None
    assert bytes(by_id[6].payload) == b"x\r\n\r\ny"


def test_minimum_and_hot_payloads(spark, tmp_path):
    rows = [(i, "u", "hot page") for i in range(700)] + [(1000 + i, "u", f"page {i % 5}") for i in range(10)]
    _, got = read(spark, rows, tmp_path / "a")
    assert {(r.page_id, r.refers_to) for r in got if r.page_id < 1000} == {(0, None)} | {(i, 0) for i in range(1, 700)}
    assert {(r.page_id, r.refers_to) for r in got if r.page_id > 1004} == {(1005 + i, 1000 + i) for i in range(5)}
    _, got = read(spark, rows, tmp_path / "b", min_bytes=8)
    assert all(r.record_type == "response" for r in got if r.page_id >= 1000)
    assert sum(r.record_type == "revisit" for r in got) == 699


def test_many_archives(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 2000)
    monkeypatch.setattr(warc, "SAMPLE_BYTES", 1500)
    written, got = read(spark, [(i, "u", f"<p>{i * 7919}</p>" * 30) for i in range(60)], tmp_path / "w")
    assert written.count() > 4
    assert {r.page_id: bytes(r.payload).decode() for r in got} == {i: f"<p>{i * 7919}</p>" * 30 for i in range(60)}


def test_empty_table(spark, tmp_path):
    written, got = read(spark, [], tmp_path / "w")
    assert got == [] and written.count() == 0


def archive(spark, tmp_path):
    written, _ = read(spark, ROWS[:2], tmp_path / "w")
    return Path(written.first().path.removeprefix("file://")).read_bytes()


def records(data):
    return list(warc.records_of(io.BytesIO(data)))


def test_bytes_on_disk(spark, tmp_path):
    """The dictionary stands in a skippable frame at the very start; each frame after it is one record, readable by offset."""
    written, _ = read(spark, ROWS[:2], tmp_path / "w")
    kinds = []
    for row in written.collect():
        data = Path(row.path.removeprefix("file://")).read_bytes()
        assert data[:4] == bytes.fromhex("5D2A4D18")
        (length,) = struct.unpack("<I", data[4:8])
        dictionary = zstandard.ZstdDecompressor().decompress(data[8 : 8 + length])
        reader = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary))
        at = 8 + length
        while at < len(data):
            frame = reader.decompressobj()
            record = frame.decompress(data[at:])
            assert frame.eof and record.startswith(b"WARC/1.1\r\n") and record.endswith(b"\r\n\r\n")
            kinds.append(warc.parsed(record)["record_type"])
            at = len(data) - len(frame.unused_data)
    assert sorted(kinds) == ["response", "revisit"]


def test_archive_of_another_writer(spark, tmp_path):
    """An archive built here, by hand, with a plain dictionary and names that end in .zst, is read from a folder."""
    payload, out = b"<p>elsewhere</p>", tmp_path / "other.warc.zst"
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    block = b"HTTP/1.1 200 OK\r\nContent-Length: %d\r\n\r\n%s" % (len(payload), payload)
    record = (
        f"WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:77>\r\nWARC-Date: 2020-01-01T00:00:00Z\r\n"
        f"WARC-Target-URI: http://z/\r\nWARC-Payload-Digest: sha1:{digest}\r\nContent-Length: {len(block)}\r\n\r\n"
    ).encode() + block + b"\r\n\r\n"
    dictionary = b"WARC-Type: response HTTP/1.1 200 OK Content-Length: " * 8
    compressor = zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(dictionary, dict_type=zstandard.DICT_TYPE_RAWCONTENT))
    out.write_bytes(struct.pack("<II", 0x184D2A5D, len(dictionary)) + dictionary + compressor.compress(record))
    got = warc.read_archives(spark.createDataFrame([(f"file://{out}",)], "path string")).collect()
    assert [(r.page_id, r.url, bytes(r.payload)) for r in got] == [(77, "http://z/", payload)]


def test_broken_archives_are_refused(spark, tmp_path):
    data = archive(spark, tmp_path)
    assert records(data)
    for broken in (data[:6], data[8:], data[:-3], data[:-9] + b"\0" * 9):
        with pytest.raises(warc.WarcError):
            records(broken)


def test_broken_records_are_refused():
    row = {"page_id": 1, "url": "u", "payload": b"abc", "digest": bytes(20), "refers_to": None}
    good = warc._record(row | {"digest": hashlib.sha1(b"abc").digest()})
    assert warc.parsed(good)["payload"] == b"abc"
    changes = [
        (b"WARC/1.1", b"WORK/1.1"), (b"Content-Length: ", b"Content-Length: 1"), (b"abc", b"abd"), (b"WARC-Type", b"WARC Type"),
        (b"WARC-Date: 1970-01-01T00:00:00Z\r\n", b""), (b"response", b"request"), (b"urn:page", b"urn:leaf"),
    ]
    for old, new in changes:
        with pytest.raises(warc.WarcError):
            warc.parsed(good.replace(old, new, 1))
    with pytest.raises(warc.WarcError):
        warc.parsed(good + b"WARC/1.1\r\n")
    with pytest.raises(warc.WarcError):
        warc.parsed(warc._record(row))


def test_frames_hold_one_record_each():
    dictionary = b"WARC/1.1\r\nWARC-Type: response\r\n" * 4
    head = struct.pack("<II", warc.DICTIONARY_FRAME, len(dictionary)) + dictionary
    good = warc._record({"page_id": 1, "url": None, "payload": b"", "digest": hashlib.sha1(b"").digest(), "refers_to": None})
    compressor = zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(dictionary))
    assert len(records(head + compressor.compress(good) * 3)) == 3
    with pytest.raises(warc.WarcError):
        records(head + compressor.compress(good + good))


@pytest.mark.skipif(not Path("/root/testdata/sf0.001").is_dir(), reason="no driver tables here")
def test_query_agrees_with_sql(spark):
    folder = "/root/testdata/sf0.001"
    got = warc.op2_zstd_warc(spark, folder)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{folder}/pages.parquet'")
    want = con.execute(f"SELECT {', '.join(got.columns)} FROM ({warc._SQL})").fetchall()
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, want))
