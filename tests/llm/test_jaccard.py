import random
import re
from pathlib import Path

import duckdb
import numpy as np
import pytest
from helpers import AWKWARD, documents, prose

from stratalake.llm import jaccard, packs
from stratalake.llm.components import components


def shingles(text, k):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1)))


def brute(rows, k, percent):
    sets = {}
    for i, t in rows:
        sets.setdefault(i, []).append(shingles(t, k))
    nodes = list(sets)
    parent = {i: i for i in nodes}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    order = {i: (i is None, i or 0) for i in nodes}
    for x in nodes:
        for y in nodes:
            for a in sets[x]:
                for b in sets[y]:
                    if a and b and 100 * len(a & b) >= percent * len(a | b):
                        p, q = sorted((root(x), root(y)), key=lambda i: order[i])
                        parent[q] = p
    return sorted(repr((i, len(shingles(t, k)), root(i))) for i, t in rows)


def rows_of():
    rng = random.Random(2)
    rows = [(i, t) for i, t, _ in AWKWARD]
    passage = prose(rng, 25, 40)
    for family in range(6):
        base = prose(rng, 60, 2000).split()
        for copy in range(12):
            words = list(base)
            for _ in range(rng.randrange(0, 4)):
                words[rng.randrange(len(words))] = f"edit{rng.randrange(10**6)}"
            rows.append((100 + family * 50 + copy, " ".join(words)))
    rows += [(500 + i, prose(rng, 12, 3000) + " " + passage + " " + prose(rng, 12, 3000)) for i in range(25)]
    rows += [(700 + i, rows[10][1].upper()) for i in range(4)]
    rows += [(800, "a b c"), (801, "a  B\tc"), (802, "a b"), (803, "a b c d e f g h"), (804, "x b c d e f g h")]
    return rows


@pytest.mark.parametrize("k, percent, pivots, pack_bytes", [(4, 85, 16, 1 << 20), (4, 85, 1, 2000), (5, 80, 2, 4000)])
def test_agrees_with_brute_force(spark, monkeypatch, k, percent, pivots, pack_bytes):
    monkeypatch.setattr(jaccard, "_PIVOTS", pivots)
    monkeypatch.setattr(packs, "PACK_BYTES", pack_bytes)
    rows = rows_of()
    got = jaccard.jaccard_links(documents(spark, [(i, t, "a") for i, t in rows], extra=("n", "digest", "prefix")), k, percent)
    got = sorted(repr((r.doc_id, r.n_shingles, r.component_id)) for r in got.collect())
    assert got == brute(rows, k, percent)


def test_empty_table(spark):
    assert jaccard.jaccard_links(documents(spark, [])).collect() == []


def test_prefix_length_is_sound():
    for n in range(1, 200):
        for percent in (80, 85):
            p = int(jaccard.prefix_length(np.array([n]), percent)[0])
            # Sets that share nothing in their prefixes share n - p tokens at most: too few.
            assert 100 * (n - p) < percent * n and 1 <= p <= n


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 90), (90, 95), (7, 7)], "a long, b long")
    got = {(r.id, r.component) for r in components(links).collect()}
    assert got == {(i, 0) for i in range(41)} | {(90, 90), (95, 90), (100, 90)}
    assert components(links.limit(0)).collect() == []


@pytest.mark.skipif(not Path("/root/testdata/sf0.001").is_dir(), reason="no driver tables here")
def test_query_agrees_with_sql(spark):
    folder = "/root/testdata/sf0.001"
    got = jaccard.op5_multi_order_jaccard(spark, folder)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet'")
    want = con.execute(f"SELECT {', '.join(got.columns)} FROM ({jaccard._SQL})").fetchall()
    assert sorted(map(tuple, got.collect())) == sorted(want)
