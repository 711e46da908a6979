import hashlib
import random
import zlib
from pathlib import Path

import duckdb
import pytest
from helpers import prose

from stratalake.llm import trie

TURNS = "conv_id long, turn long, role string, text string"


def brute(rows):
    """Every node by plain lists, as the contract states it."""
    convs = {}
    for c, turn, role, text in rows:
        if c is not None:
            convs.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    for c, turns in convs.items():
        turns.sort(key=lambda t: (t[:2], hashlib.md5(f"{len(t[2].encode())}:{t[2]}{t[3]}".encode()).hexdigest()))
        convs[c] = [t[2:] for t in turns]
    built = {}
    for c, turns in convs.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (abs(c) % 100 if c >= 0 else -(abs(c) % 100))
        built[c] = tuple(convs.get(base, [])[:h] + turns[h:])
    nodes = {}
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(turns[:d], []).append(c)
    out = []
    children = {}
    for key in nodes:
        if key:
            children.setdefault(key[:-1], []).append(key)

    totals = {}
    for key in sorted(nodes, key=len, reverse=True):
        under = [totals[k] for k in children.get(key, [])]
        own = (len(nodes[key]) - 1) * (len(key[-1][1]) if key else 0)
        totals[key] = (sum(x for x, _ in under) if under else 1, own + sum(y for _, y in under))
    for key, members in nodes.items():
        ends = ",".join(str(c) for c in sorted(members) if len(built[c]) == len(key))
        out.append((
            min(members), len(key), min(nodes[key[:-1]]) if key else None, len(members), len(children.get(key, [])),
            *totals[key], hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return sorted(map(repr, out))


def got(spark, rows, **how):
    turns = spark.createDataFrame(rows, TURNS)
    for name in ("conv", "depth", "place", "chunk", "digest", "points", "nth", "k1"):
        turns = turns.selectExpr("*", f"'x' AS {name}")
    return sorted(map(repr, map(tuple, trie.conversation_trie(turns, **how).collect())))


def made(seed, n=120):
    rng = random.Random(seed)
    texts = [prose(rng, 3) for _ in range(3)] + ["", None, "émile 𝒳"]
    rows = []
    for c in [*range(n), *range(300, 420), -1, -105, -200, 100_000_000_007]:
        # Some blocks have no first conversation; some conversations one turn.
        if c in (0, 300) and rng.random() < 0.5:
            continue
        for turn in range(rng.choice([1, 2, 2, 3, 7])):
            rows.append((c, turn if rng.random() < 0.9 else None, rng.choice(["user", "user", None, ""]), rng.choice(texts)))
    rows += [(None, 1, "user", "nobody's"), (5, 1, "user", "again"), (5, 1, "user", "again"), (6, None, None, None)]
    rows += [(7, 3, "user", "long " * 40_000)]
    return rows


def copies():
    """One conversation many times over, and one deep one twice."""
    rows = [(1000 + 6 * i, t, "user", f"same {t}") for i in range(150) for t in range(4)]
    return rows + [(c, t, "a", f"turn {t % 7}") for c in (2003, 2004) for t in range(45)]


@pytest.mark.parametrize("seed", [1, 2])
def test_agrees_with_plain_lists(spark, seed):
    rows = made(seed)
    assert got(spark, rows) == brute(rows)


def test_bands_and_chunks(spark, monkeypatch):
    rows = copies()
    want = brute(rows)
    assert got(spark, rows, band=4) == want
    # Chunks and shares so small that every part of the work is cut.
    monkeypatch.setattr(trie, "CHUNK", 8)
    monkeypatch.setattr(trie, "IDS", 16)
    monkeypatch.setattr(trie, "HOT_SHARE", 4)
    assert got(spark, rows) == want


def test_no_conversations(spark):
    assert got(spark, []) == []
    assert got(spark, [(None, 1, "user", "x")]) == []
    # A single conversation that loses all of its turns is a member of the root alone.
    lost = next(c for c in range(1, 100) if zlib.crc32(str(c).encode()) % 6 > 1)
    assert got(spark, [(lost, 0, "user", "x")]) == brute([(lost, 0, "user", "x")])


@pytest.mark.skipif(not Path("/root/testdata/sf0.01").is_dir(), reason="no driver tables here")
def test_query_agrees_with_sql(spark):
    folder = "/root/testdata/sf0.01"
    found = trie.op12_conversation_trie(spark, folder)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{folder}/conversations.parquet'")
    want = con.execute(f"SELECT {', '.join(found.columns)} FROM ({trie._SQL})").fetchall()
    assert sorted(map(repr, map(tuple, found.collect()))) == sorted(map(repr, want))
