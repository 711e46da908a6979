import hashlib
import random
import zlib
from pathlib import Path

import duckdb
import pytest
from helpers import DOCS, prose

from stratalake.llm import merkle


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def framed(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def leaf(row, text=...):
    i, t, lang, source, n = row
    return sha(*map(framed, (i, source, lang, n, t if text is ... else text)))


def tree(leaves, fan):
    """All levels over some hashes, the lowest first."""
    levels = [leaves]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([sha(*below[a : a + fan]) for a in range(0, len(below), fan)])
    return levels


def steps(levels, place, fan):
    for level in levels[:-1]:
        a = place // fan * fan
        yield level[a:place], level[place + 1 : a + fan]
        place //= fan


def brute(rows, fan=8):
    """The whole contract by plain lists: (doc_id, leaf, subroot, root, proof, folded, verified) of each row."""
    groups = {}
    for row in rows:
        groups.setdefault(row[2], []).append(row)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    made = {}
    for g in order:
        groups[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        made[g] = tree([leaf(r) for r in groups[g]], fan)
    crown = tree([made[g][-1][0] for g in order], fan)
    root, out = crown[-1][0], []
    for at, g in enumerate(order):
        for place, row in enumerate(groups[g]):
            path = [*steps(made[g], place, fan), *steps(crown, at, fan)]
            h = leaf(row)
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 3 == 0 and row[1] is not None:
                h = leaf(row, "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in row[1]))
            for left, right in path:
                h = sha(*left, h, *right)
            proof = sha(*(x for left, right in path for x in left + right))
            out.append((row[0], leaf(row), made[g][-1][0], root, proof, h, h == root))
    return sorted(map(repr, out))


def run(spark, rows, tmp_path):
    folder = tmp_path / f"t{len(list(tmp_path.iterdir()))}"
    docs = spark.createDataFrame(rows, DOCS)
    for name in ("hash", "tree", "lo", "run", "group", "path", "nth", "id"):
        docs = docs.selectExpr("*", f"'x' AS {name}")
    docs.write.parquet(f"{folder}/documents.parquet")
    return sorted(map(repr, map(tuple, merkle.op13_merkle_manifest(spark, str(folder)).collect())))


def made_rows(n, langs, seed=2):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        text = rng.choice([None, "", "Ünï Größe " + prose(rng, 9).upper(), prose(rng, 30).title(), "lower case only"])
        rows.append((i * 7 % 1000, text, rng.choice(langs), rng.choice([None, "s1"]), rng.choice([None, 3, -4])))
    return rows


def test_agrees_with_plain_lists(spark, tmp_path):
    """A hot group, a group of one row, null and empty groups, null ids, repeated ids and rows, very long texts."""
    rows = made_rows(180, ["en"] * 5 + ["de", None, "é"])
    rows += [(None, "A", "en", None, 1), (None, "A", "en", None, 1), (3, "Q" * 300_000, "one", "s", 2), (4, "Z", "", "s", 1)]
    rows += [(11, "Same ROW", "de", "s", 8)] * 20
    assert run(spark, rows, tmp_path) == brute(rows)


@pytest.mark.parametrize("n", [1, 2, 8, 9, 64, 65])
def test_edges_of_runs(spark, tmp_path, n):
    rows = made_rows(n, ["en"])
    assert run(spark, rows, tmp_path) == brute(rows)


def test_many_groups(spark, tmp_path, monkeypatch):
    rows = made_rows(60, [f"l{i}" for i in range(25)] + ["en"] * 30)
    want = brute(rows)
    assert run(spark, rows, tmp_path) == want
    monkeypatch.setattr(merkle, "FEW", 3)
    assert run(spark, rows, tmp_path) == want


def test_no_rows(spark, tmp_path):
    assert run(spark, [], tmp_path) == []
    manifest = merkle.merkle_manifest(spark.createDataFrame([], DOCS))
    assert manifest.root is None and manifest.forest.nodes().count() == 0


def test_intervals_nest(spark):
    docs = spark.createDataFrame(made_rows(100, ["en"]), DOCS)
    manifest = merkle.merkle_manifest(docs, fan=3)
    nodes = manifest.forest.nodes().collect()
    by_level = {}
    for r in nodes:
        by_level.setdefault(r.level, []).append((r.lo, r.hi))
    assert sorted(by_level) == [0, 1, 2, 3, 4, 5]
    for k, spans in by_level.items():
        spans.sort()
        assert spans[0][0] == 0 and spans[-1][1] == 100 and all(x[1] == y[0] for x, y in zip(spans, spans[1:]))
        assert all(lo % 3**k == 0 for lo, _ in spans)
    assert manifest.root == tree([r.hash for r in sorted((r for r in nodes if r.level == 0), key=lambda r: r.lo)], 3)[-1][0]


@pytest.mark.skipif(not Path("/root/testdata/sf0.001").is_dir(), reason="no driver tables here")
def test_query_agrees_with_sql(spark):
    folder = "/root/testdata/sf0.001"
    got = merkle.op13_merkle_manifest(spark, folder)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet'")
    want = con.execute(f"SELECT {', '.join(got.columns)} FROM ({merkle._SQL})").fetchall()
    assert sorted(map(tuple, got.collect())) == sorted(want)
    assert {r.verified for r in got.collect()} == {True, False}
