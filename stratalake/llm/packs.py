"""Documents packed to blocks of text, and counts of keys exchanged between the blocks.

A pack is one row: the ids, the byte lengths and the compressed texts of a megabyte of documents.
Packs are written once, so they stay the same when a task runs again, and numpy works on whole packs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.llm.common import stored

#: Bytes of text after which a pack is closed; a longer document is a pack of its own.
PACK_BYTES = 1 << 20
#: Keys that one task of an exchange should hold.
BUCKET_KEYS = 1 << 20
#: Stands for a null id, after all others.
NO_ID = (1 << 63) - 1

_PACK = "pack long, n_bytes long, ids binary, sizes binary, body binary"
_KEYS = "bucket long, pack long, keys binary, counts binary"

Docs = tuple[np.ndarray, np.ndarray, np.ndarray]  # ids, offsets, bytes of all texts
KeysOf = Callable[[Docs], np.ndarray]


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and bytes of an Arrow text column; null is empty."""
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) else b"")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    bytes_ = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return offsets - offsets[0], bytes_[offsets[0] : offsets[-1]]


def packed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents in packs, stored. Null text is empty; a null id counts as the largest."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        ids, sizes, parts, held = [], [], [], 0
        for batch in batches:
            keys = batch.column(0).to_numpy(zero_copy_only=False)
            offsets, data = text_buffers(batch.column(1))
            lengths = np.diff(offsets)
            start = 0
            for stop in range(1, len(keys) + 1):
                if held + offsets[stop] - offsets[start] >= PACK_BYTES or stop == len(keys):
                    ids.append(keys[start:stop])
                    sizes.append(lengths[start:stop])
                    parts.append(data[offsets[start] : offsets[stop]])
                    held += int(offsets[stop] - offsets[start])
                    start = stop
                    if held >= PACK_BYTES:
                        yield _pack_row(number, ids, sizes, parts)
                        number, ids, sizes, parts, held = number + 1, [], [], [], 0
        if ids:
            yield _pack_row(number, ids, sizes, parts)

    key = F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID))
    return stored(docs.select(key.alias("id"), F.col(text_col).alias("text")).mapInArrow(pack, _PACK), "packs")


def _pack_row(number: int, ids: list, sizes: list, parts: list) -> pa.RecordBatch:
    body = np.concatenate(parts).tobytes()
    return pa.RecordBatch.from_arrays(
        [
            pa.array([number], pa.int64()),
            pa.array([len(body)], pa.int64()),
            pa.array([np.concatenate(ids).astype(np.int64).tobytes()], pa.binary()),
            pa.array([np.concatenate(sizes).astype(np.int64).tobytes()], pa.binary()),
            pa.array([zstandard.ZstdCompressor(level=3).compress(body)], pa.binary()),
        ],
        names=["pack", "n_bytes", "ids", "sizes", "body"],
    )


def unpacked(row: dict) -> Docs:
    ids = np.frombuffer(row["ids"], np.int64)
    offsets = np.concatenate([[0], np.cumsum(np.frombuffer(row["sizes"], np.int64))]).astype(np.int64)
    body = zstandard.ZstdDecompressor().decompress(row["body"])
    return ids, offsets, np.frombuffer(body, np.uint8)


def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]


def shared_keys(packs: DataFrame, keys_of: KeysOf, bytes_per_key: float) -> DataFrame:
    """The keys that occur in two documents or more, sent back to every pack that has them.

    ``keys_of`` gives the 64-bit keys of a pack, each once for a document. Packs send each key once with
    its count, cut to the bucket and 32 bits, so a key of a third of all documents is one entry for
    a pack. A bucket adds up its keys and answers the packs it heard from. Two keys that agree in the
    bits sent are counted together. Returns ``pack`` and ``found``: its keys and counts by bucket.
    """
    total = packs.agg(F.sum("n_bytes")).first()[0] or 0
    buckets = max(8, int(total / bytes_per_key / BUCKET_KEYS) + 1)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in rows_of(batches):
            short, counts = np.unique(shorten(keys_of(unpacked(row)), buckets), return_counts=True)
            edges = np.searchsorted(short, np.arange(buckets + 1, dtype=np.uint64) << np.uint64(32))
            full = np.flatnonzero(np.diff(edges))
            cuts = [(edges[b], edges[b + 1]) for b in full]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(full, pa.int64()),
                    pa.array([row["pack"]] * len(full), pa.int64()),
                    pa.array([squeezed(short[a:z].astype(np.uint32), ascending=True) for a, z in cuts], pa.binary()),
                    pa.array([squeezed(counts[a:z].astype(np.uint32)) for a, z in cuts], pa.binary()),
                ],
                names=["bucket", "pack", "keys", "counts"],
            )

    def answer(group: pa.Table) -> pa.Table:
        sent = [expanded(k, ascending=True) for k in group.column("keys").to_pylist()]
        counts = [expanded(c) for c in group.column("counts").to_pylist()]
        keys, place = np.unique(np.concatenate(sent), return_inverse=True)
        sums = np.bincount(place, np.concatenate(counts), len(keys)).astype(np.int64)
        out_keys, out_counts, at = [], [], 0
        for k in sent:
            mine = sums[place[at : at + len(k)]]
            at += len(k)
            known = mine > 1
            out_keys.append(squeezed(k[known], ascending=True) if known.any() else None)
            out_counts.append(squeezed(np.minimum(mine[known], 0xFFFFFFFF).astype(np.uint32)) if known.any() else None)
        return pa.table(
            [group.column("bucket"), group.column("pack"), pa.array(out_keys, pa.binary()), pa.array(out_counts, pa.binary())],
            names=["bucket", "pack", "keys", "counts"],
        )

    answered = packs.mapInArrow(send, _KEYS).groupBy("bucket").applyInArrow(answer, _KEYS)
    found = answered.where("keys IS NOT NULL").groupBy("pack").agg(
        F.collect_list(F.struct("bucket", "keys", "counts")).alias("found"),
        F.lit(buckets).alias("buckets"),
    )
    return stored(found, "shared-keys")


def squeezed(numbers: np.ndarray, ascending: bool = False) -> bytes:
    """32-bit numbers, their steps if they ascend, compressed byte plane by byte plane."""
    if ascending:
        numbers = np.diff(numbers, prepend=np.uint32(0))
    planes = np.ascontiguousarray(numbers.astype(np.uint32).view(np.uint8).reshape(-1, 4).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def expanded(data: bytes, ascending: bool = False) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(4, -1)
    numbers = np.ascontiguousarray(planes.T).view(np.uint32).ravel()
    return np.cumsum(numbers, dtype=np.uint32) if ascending else numbers


def shorten(keys: np.ndarray, buckets: int) -> np.ndarray:
    """A key as sent: its bucket above 32 of its other bits."""
    n = np.uint64(buckets)
    return ((keys % n) << np.uint64(32)) | ((keys // n) & np.uint64(0xFFFFFFFF))


class Counts:
    """Counts of the shared keys of one pack."""

    def __init__(self, found: list[dict] | None, buckets: int | None) -> None:
        self.buckets = buckets or 1
        parts = sorted(found or [], key=lambda f: f["bucket"])
        keys = [expanded(f["keys"], ascending=True).astype(np.uint64) | (np.uint64(f["bucket"]) << np.uint64(32)) for f in parts]
        self.keys = np.concatenate(keys) if keys else np.zeros(0, np.uint64)
        counts = [expanded(f["counts"]) for f in parts]
        self.counts = np.concatenate(counts).astype(np.int64) if counts else np.zeros(0, np.int64)

    def of(self, keys: np.ndarray) -> np.ndarray:
        """The documents that have each key; 1 for a key that is not shared."""
        if not len(self.keys):
            return np.ones(len(keys), np.int64)
        short = shorten(keys, self.buckets)
        at = np.minimum(np.searchsorted(self.keys, short), len(self.keys) - 1)
        return np.where(self.keys[at] == short, self.counts[at], 1)
