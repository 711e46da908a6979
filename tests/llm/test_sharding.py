import random
import zlib
from collections import Counter
from pathlib import Path

import duckdb
import pytest
from helpers import AWKWARD, documents, prose

from stratalake.llm import sharding
from stratalake.llm.sharding import kd_shards


def made(spark, n=400):
    rng = random.Random(3)
    # A third of all rows in one source.
    rows = [(i, prose(rng, rng.choice([1, 5, 40])), "s0" if i % 3 == 0 else f"s{rng.randrange(5)}") for i in range(n)]
    return rows + AWKWARD


def codes(values):
    """Whole numbers as they are and null below the least; other values by rank, null first."""
    known = sorted({v for v in values if v is not None}, key=lambda v: v if isinstance(v, int) else str(v).encode())
    if known and isinstance(known[0], int):
        return {None: known[0] - 1} | {v: v for v in known}
    return {None: 0} | {v: i + 1 for i, v in enumerate(known)}


def brute(rows, leaves, spans, first=0):
    """(key, shard) of rows ((n_chars, source, lang), id, size) by the same rule, one node at a time."""
    if leaves == 1 or not rows:
        return [(r, first) for r in rows]

    def width(i):
        values = [r[0][i] for r in rows]
        return (max(values) - min(values)) / spans[i] if spans[i] else 0.0

    d = max(range(3), key=lambda i: (width(i), -i))
    by_key = Counter()
    for r in rows:
        by_key[r[0][d], r[1]] += r[2]
    total, seen, low = sum(by_key.values()), 0, set()
    for key in sorted(by_key):
        if (2 * seen + by_key[key]) * leaves < 2 * total * (leaves // 2):
            low.add(key)
        seen += by_key[key]
    inside = [r for r in rows if (r[0][d], r[1]) in low]
    outside = [r for r in rows if (r[0][d], r[1]) not in low]
    half = leaves // 2
    return brute(inside, half, spans, first) + brute(outside, leaves - half, spans, first + half)


def test_agrees_with_a_plain_tree(spark):
    rows = made(spark)
    got = kd_shards(documents(spark, rows), shards=5).collect()
    lengths, sources = codes([None if t is None else len(t) for _, t, _ in rows]), codes([s for _, _, s in rows])
    keyed = [
        ((lengths[None if t is None else len(t)], sources[s], 1), -(1 << 62) if i is None else i, len((t or "").encode()) + 1)
        for i, t, s in rows
    ]
    spans = [max(k[0][d] for k in keyed) - min(k[0][d] for k in keyed) for d in range(3)]
    want = Counter((k[1], k[2], shard) for k, shard in brute(keyed, 5, spans))
    assert Counter((-(1 << 62) if r.doc_id is None else r.doc_id, r.size, r.shard) for r in got) == want
    for shard in range(5):
        slots = sorted(r.slot for r in got if r.shard == shard)
        assert slots == list(range(len(slots)))
    sizes = Counter()
    for r in got:
        sizes[r.shard] += r.size
    assert max(sizes.values()) - min(sizes.values()) <= 2 * max(r.size for r in got)
    checksums = {(r.doc_id, r.text_crc32) for r in got}
    assert {(i, zlib.crc32((t or "").encode())) for i, t, _ in rows} == checksums


def test_target_bytes_and_reruns(spark):
    docs = documents(spark, made(spark))
    total = sum(r.size for r in kd_shards(docs, shards=1).collect())
    shards = {r.shard for r in kd_shards(docs, target_bytes=total // 6 + 1).collect()}
    assert shards == set(range(6))
    again = docs.repartition(7)
    assert sorted(kd_shards(docs, shards=3).collect(), key=repr) == sorted(kd_shards(again, shards=3).collect(), key=repr)


@pytest.mark.parametrize("limit", [8 << 20, 0])
def test_text_that_differs_late_is_told_apart(spark, monkeypatch, limit):
    monkeypatch.setattr(sharding, "_BROADCAST_BYTES", limit)
    rows = [(i, "same words here", f"commoncrawl-{2020 + i * 7 % 4}") for i in range(400)]
    got = kd_shards(documents(spark, rows), shards=4).collect()
    source = {i: s for i, _, s in rows}
    held = {shard: {source[r.doc_id] for r in got if r.shard == shard} for shard in range(4)}
    assert [sorted(held[s]) for s in range(4)] == [[f"commoncrawl-{y}"] for y in range(2020, 2024)]


def test_numbers_with_fractions_nulls_and_far_ends(spark):
    values = [0.25, 0.5, 0.75, None, float("nan"), -3.5]
    rows = [(i, "text", values[i % 6], [None, -1, -(1 << 63), (1 << 63) - 1][i % 4]) for i in range(240)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score double, far long")
    got = kd_shards(docs, shards=6, dimensions=["score"]).collect()
    held = {shard: {repr(values[r.doc_id % 6]) for r in got if r.shard == shard} for shard in range(6)}
    assert [held[s] for s in range(6)] == [{"None"}, {"-3.5"}, {"0.25"}, {"0.5"}, {"0.75"}, {"nan"}]
    got = kd_shards(docs, shards=4, dimensions=["far"]).collect()
    held = {shard: {rows[r.doc_id][3] for r in got if r.shard == shard} for shard in range(4)}
    assert [held[s] for s in range(4)] == [{None}, {-(1 << 63)}, {-1}, {(1 << 63) - 1}]


def test_empty_and_few_rows(spark):
    assert kd_shards(documents(spark, []), shards=8).collect() == []
    assert [r.slot for r in kd_shards(documents(spark, [(1, "x", "a")]), shards=8).collect()] == [0]


@pytest.mark.skipif(not Path("/root/testdata/sf0.001").is_dir(), reason="no driver tables here")
def test_query_agrees_with_sql(spark):
    folder = "/root/testdata/sf0.001"
    got = sharding.op3_kd_tree_shards(spark, folder)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet'")
    want = con.execute(f"SELECT {', '.join(got.columns)} FROM ({sharding._SQL})").fetchall()
    assert sorted(map(tuple, got.collect())) == sorted(want)
