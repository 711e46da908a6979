"""WARC archives in Zstandard: a dictionary in a leading skippable frame, then one frame per record."""

from __future__ import annotations

import base64
import hashlib
import io
import re
import struct
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.llm.common import open_folder, stored, table
from stratalake.llm.registry import query
from stratalake.workspace import new_folder

#: Magic numbers of the format: the skippable frame that holds a dictionary, a frame, a dictionary.
DICTIONARY_FRAME = 0x184D2A5D
FRAME = b"\x28\xb5\x2f\xfd"
DICTIONARY = b"\x37\xa4\x30\xec"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

#: Bounds of the dictionary and of what it is trained on, for each archive.
DICTIONARY_BYTES = 32 << 10
SAMPLE_BYTES = 1 << 20
#: Compressed bytes after which a task opens its next archive.
ARCHIVE_BYTES = 64 << 20

_WRITTEN = "path string, records long"
_RECORD = (
    "page_id long, record_type string, url string, refers_to long, payload_bytes long, "
    "payload_digest string, payload binary, path string"
)


class WarcError(ValueError):
    """An archive or a record that breaks the format."""


def revisits(pages: DataFrame, min_bytes: int, id_col: str, payload_col: str, url_col: str) -> DataFrame:
    """Every page with the page that holds its payload: the smallest id of equal payloads."""
    payload = F.coalesce(F.encode(F.col(payload_col).cast("string"), "UTF-8"), F.lit(b""))
    url = F.col(url_col).cast("string") if url_col in pages.columns else F.lit(None).cast("string")
    rows = pages.select(
        F.col(id_col).cast("long").alias("page_id"), url.alias("url"), payload.alias("payload"),
        F.unhex(F.sha1(payload)).alias("digest"),
    )
    groups = rows.groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
    groups = stored(groups.where("n > 1").select(F.col("digest").alias("_digest"), "first", "n"), "warc-groups")
    # Payloads of more than a ten-thousandth of the rows are at most ten thousand: they are broadcast.
    copies = groups.agg(F.sum("n")).first()[0] or 0
    hot = F.col("n") > max(200, copies // 10_000)
    known = rows.join(F.broadcast(groups.where(hot).select("_digest", F.col("first").alias("hot"))), F.col("digest") == F.col("_digest"), "left")
    known = known.drop("_digest").join(groups.where(~hot).drop("n"), (F.col("digest") == F.col("_digest")) & F.col("hot").isNull(), "left")
    holder = F.coalesce("hot", "first")
    refers = F.when((holder != F.col("page_id")) & (F.octet_length("payload") >= min_bytes), holder)
    return known.select("page_id", "url", "payload", "digest", refers.alias("refers_to"))


def write_archives(
    pages: DataFrame,
    folder: str,
    min_bytes: int = 0,
    id_col: str = "page_id",
    payload_col: str = "html",
    url_col: str = "url",
) -> DataFrame:
    """Archives with one record for every page, and the paths and record counts of those that were kept.

    Of pages with equal payloads of at least ``min_bytes``, the one with the smallest id is a response
    and the others revisit it; all shorter ones are responses. The payload is the page in UTF-8, and no
    bytes for null. A null id is written as none and never refers to another page; rows that repeat
    a response's id are responses too. Each task writes archives of some ``ARCHIVE_BYTES``, whole under a
    name of its attempt; only those listed in the result count, so a lost task leaves no half archive.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        files, root = open_folder(folder)
        files.create_dir(root, recursive=True)
        name, number, held, size = f"{context.partitionId():06d}-{context.taskAttemptId()}", 0, [], 0
        archive: _Archive | None = None
        for batch in batches:
            for row in batch.to_pylist():
                record = _record(row)
                if archive is None:
                    # The first records wait until there is enough to train the dictionary on.
                    held.append(record)
                    size += len(record)
                    if size < SAMPLE_BYTES:
                        continue
                    archive, held, size = _Archive(files, f"{root}/{name}-{number}.warc.zst", held), [], 0
                else:
                    archive.add(record)
                if archive.size >= ARCHIVE_BYTES:
                    yield archive.close(folder)
                    archive, number = None, number + 1
        if archive is None and held:
            archive = _Archive(files, f"{root}/{name}-{number}.warc.zst", held)
        if archive:
            yield archive.close(folder)

    return stored(revisits(pages, min_bytes, id_col, payload_col, url_col).mapInArrow(write, _WRITTEN), "warc-written")


class _Archive:
    def __init__(self, files, path: str, records: list[bytes]) -> None:
        self.path, self.count, self.size = path, 0, 0
        trained = trained_dictionary(records)
        self.compressor = zstandard.ZstdCompressor(level=3, dict_data=zstandard.ZstdCompressionDict(trained), write_checksum=True)
        # Written and read as it is: the ending of the name must not choose a codec.
        self.out = files.open_output_stream(path, compression=None)
        frame = zstandard.ZstdCompressor(level=3).compress(trained)
        self.write(struct.pack("<II", DICTIONARY_FRAME, len(frame)) + frame)
        for record in records:
            self.add(record)

    def write(self, data: bytes) -> None:
        self.out.write(data)
        self.size += len(data)

    def add(self, record: bytes) -> None:
        self.write(self.compressor.compress(record))
        self.count += 1

    def close(self, folder: str) -> pa.RecordBatch:
        self.out.close()
        path = f"{folder.rstrip('/')}/{self.path.rsplit('/', 1)[-1]}"
        return pa.RecordBatch.from_arrays([pa.array([path]), pa.array([self.count], pa.int64())], names=["path", "records"])


def trained_dictionary(records: list[bytes]) -> bytes:
    """A dictionary trained on the first records of an archive, or their text if they are too few."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, records, k=1024, d=8).as_bytes()
    except zstandard.ZstdError:
        return b"".join(records)[:DICTIONARY_BYTES] or b"WARC/1.1\r\n"


def _record(row: dict) -> bytes:
    """One WARC record: the response with its payload, or the revisit with the response's head only."""
    payload, refers = row["payload"], row["refers_to"]
    kind = "response" if refers is None else "revisit"
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head + (payload if refers is None else b"")
    fields = [
        ("WARC-Type", kind),
        ("WARC-Record-ID", _urn(row["page_id"])),
        ("WARC-Date", "1970-01-01T00:00:00Z"),
        ("WARC-Payload-Digest", f"sha1:{base64.b32encode(row['digest']).decode()}"),
        ("WARC-Block-Digest", f"sha1:{base64.b32encode(hashlib.sha1(block).digest()).decode()}"),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    if row["url"] is not None:
        fields.insert(3, ("WARC-Target-URI", re.sub(r"[\r\n]", lambda m: f"%{ord(m[0]):02X}", row["url"])))
    if refers is not None:
        fields += [("WARC-Refers-To", _urn(refers)), ("WARC-Profile", REVISIT_PROFILE)]
    lines = "".join(f"{name}: {value}\r\n" for name, value in fields)
    return f"WARC/1.1\r\n{lines}\r\n".encode() + block + b"\r\n\r\n"


def _urn(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def read_archives(archives: DataFrame) -> DataFrame:
    """The records of the archives that ``path`` names, one task an archive at a time.

    Each archive must begin with a dictionary frame; each frame after it must hold exactly one record.
    A record whose version line, headers, lengths, digests or closing line breaks are wrong raises
    :class:`WarcError`, as does a cut archive. An empty list of archives gives no records.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                files, name = open_folder(path)
                with files.open_input_stream(name, compression=None) as stream:
                    rows: list[dict] = []
                    size = 0
                    for record in records_of(stream):
                        rows.append(record | {"path": path})
                        size += len(record["payload"] or b"")
                        if size > 8 << 20:
                            yield _batch(rows)
                            rows, size = [], 0
                    yield _batch(rows)

    spread = archives.select("path").repartition(max(1, min(10_000, archives.count())), "path")
    return spread.mapInArrow(read, _RECORD)


_ARROW = pa.schema([
    ("page_id", pa.int64()), ("record_type", pa.string()), ("url", pa.string()), ("refers_to", pa.int64()),
    ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary()), ("path", pa.string()),
])


def _batch(rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema=_ARROW)


def records_of(stream: io.RawIOBase) -> Iterator[dict]:
    """The checked records of one archive, a frame at a time."""
    head = _exactly(stream, 8)
    magic, length = struct.unpack("<II", head)
    if magic != DICTIONARY_FRAME:
        raise WarcError("the archive does not begin with a dictionary frame")
    dictionary = _exactly(stream, length)
    if dictionary[:4] == FRAME:
        dictionary = zstandard.ZstdDecompressor().decompress(dictionary)
    decompressor = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary))
    held = b""
    while True:
        frame, parts = decompressor.decompressobj(), []
        while not frame.eof:
            held = held or stream.read(1 << 20)
            if not held:
                break
            try:
                parts.append(frame.decompress(held))
            except zstandard.ZstdError as error:
                raise WarcError(f"a frame cannot be decoded: {error}") from error
            held = frame.unused_data
        if not frame.eof:
            if parts:
                raise WarcError("the archive ends within a frame")
            return
        yield parsed(b"".join(parts))


def _exactly(stream: io.RawIOBase, n: int) -> bytes:
    data = stream.read(n)
    if len(data) != n:
        raise WarcError("the archive ends within its first frame")
    return data


def parsed(record: bytes) -> dict:
    """One record with its headers, lengths and digests checked."""
    head, separator, rest = record.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if not separator or not re.fullmatch(rb"WARC/1\.[01]", lines[0]):
        raise WarcError("a record does not begin with a WARC version and headers")
    fields: dict[str, str] = {}
    for line in lines[1:]:
        name, colon, value = line.partition(b":")
        key = name.decode("ascii", "replace").lower()
        if not colon or not re.fullmatch(rb"[!#$%&'*+.^_`|~0-9A-Za-z-]+", name) or key in fields:
            raise WarcError(f"a header line is malformed or repeated: {line[:80]!r}")
        fields[key] = value.strip().decode("utf-8")
    for name in ("warc-type", "warc-record-id", "warc-date", "content-length", "warc-payload-digest"):
        if name not in fields:
            raise WarcError(f"a record lacks {name}")
    if not fields["content-length"].isdigit():
        raise WarcError("a record's length is not a number")
    length = int(fields["content-length"])
    block = rest[:length]
    if len(block) != length or rest[length:] != b"\r\n\r\n":
        raise WarcError("a frame does not hold exactly one record of the stated length")
    if "warc-block-digest" in fields and fields["warc-block-digest"] != _sha1(block):
        raise WarcError("a block does not have the stated digest")
    http, separator, payload = block.partition(b"\r\n\r\n")
    stated = re.search(rb"(?im)^content-length:\s*(\d+)\s*$", http)
    if not separator or not http.startswith(b"HTTP/") or not stated:
        raise WarcError("a block does not begin with an HTTP head that states a length")
    kind, size = fields["warc-type"], int(stated[1])
    if kind == "response":
        if len(payload) != size or _sha1(payload) != fields["warc-payload-digest"]:
            raise WarcError("a payload does not have the stated length and digest")
    elif kind == "revisit":
        if payload or "warc-refers-to" not in fields or "warc-profile" not in fields:
            raise WarcError("a revisit has a payload or names no response")
    else:
        raise WarcError(f"a record of type {kind}")
    return {
        "page_id": _page(fields["warc-record-id"]),
        "record_type": kind,
        "url": fields.get("warc-target-uri"),
        "refers_to": _page(fields["warc-refers-to"]) if kind == "revisit" else None,
        "payload_bytes": size,
        "payload_digest": fields["warc-payload-digest"].removeprefix("sha1:"),
        "payload": payload if kind == "response" else None,
    }


def _sha1(data: bytes) -> str:
    return f"sha1:{base64.b32encode(hashlib.sha1(data).digest()).decode()}"


def _page(urn: str) -> int | None:
    found = re.fullmatch(r"<urn:page:(-?\d*)>", urn)
    if not found:
        raise WarcError(f"a record id of another form: {urn[:80]}")
    return int(found[1]) if found[1] else None


_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
d AS (SELECT page_id, CAST(octet_length(encode(h)) AS BIGINT) AS payload_bytes, sha1(h) AS x FROM p),
bits AS (
    SELECT DISTINCT x, array_to_string(list_transform(range(1, 41), lambda i:
        lpad(bin(CAST(strpos('0123456789abcdef', substr(x, i, 1)) - 1 AS INTEGER)), 4, '0')), '') AS b FROM d),
digests AS (
    SELECT x, array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
        CAST(1 + list_sum(list_transform(range(0, 5), lambda j:
            CAST(substr(b, 5 * i + j + 1, 1) AS INTEGER) * (16 >> j))) AS INTEGER), 1)), '') AS payload_digest FROM bits),
g AS (SELECT x, min(page_id) AS r FROM d GROUP BY x)
SELECT page_id, payload_bytes, payload_digest,
    CASE WHEN page_id = r THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN page_id <> r THEN r END AS refers_to
FROM d JOIN digests USING (x) JOIN g USING (x)
"""


@query("op2_zstd_warc", _SQL)
def op2_zstd_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    archives = write_archives(table(spark, sf_dir, "pages"), new_folder(spark, "warc"))
    return read_archives(archives).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
