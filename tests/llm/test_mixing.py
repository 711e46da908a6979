import random
import re
from collections import defaultdict

from helpers import AWKWARD, documents, prose
from pyspark.sql import functions as F

from stratalake.llm import mixing
from stratalake.llm.common import stored, word_count


def rows_of():
    rng = random.Random(5)
    rows = [(i, prose(rng, rng.choice([0, 3, 30, 300])), "s0" if i % 3 else f"s{rng.randrange(1, 7)}") for i in range(20, 900)]
    return rows + AWKWARD


def plain_targets(sizes):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (1, 2, 3)[i % 3] for i, s in enumerate(order)}
    total, capped = sum(sizes.values()), set()
    while True:
        rest = [s for s in order if s not in capped]
        unit = (total - sum(3 * sizes[s] for s in capped)) / sum(weight[s] for s in rest)
        above = {s for s in rest if unit * weight[s] > 3 * sizes[s]}
        if not above:
            return {s: float(3 * sizes[s]) if s in capped else unit * weight[s] for s in order}
        capped |= above


def test_targets_and_taken(spark, monkeypatch):
    monkeypatch.setattr(mixing, "FAN_IN", 8)
    rows = rows_of()
    docs = documents(spark, rows)
    got = mixing.mix_sources(docs).collect()
    count = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes, longest = defaultdict(int), defaultdict(int)
    for _, t, s in rows:
        sizes[s] += count(t)
        longest[s] = max(longest[s], count(t))
    want = plain_targets(sizes)
    assert sorted((r.doc_id or -1, r.size) for r in got) == sorted((i or -1, count(t)) for i, t, _ in rows)
    taken = defaultdict(int)
    for r in got:
        assert r.source_size == sizes[r.source]
        assert abs(r.target - want[r.source]) < 1e-6 * max(1, want[r.source])
        assert 0 <= r.taken <= 3 * r.size and r.taken == r.copies * r.size
        if r.size:
            assert int(r.target / r.source_size) <= r.copies <= int(r.target / r.source_size) + 1
        taken[r.source] += r.taken
    for source, words in taken.items():
        assert abs(words - want[source]) <= longest[source] + 1
    again = mixing.mix_sources(docs.repartition(9)).collect()
    assert sorted(map(repr, got)) == sorted(map(repr, again))


def test_expectation_over_seeds(spark):
    """Each document gets one copy about as often as its probability says."""
    rows = [(i, "a b c d", "s0") for i in range(40)] + [(100 + i, "a b", "s1") for i in range(40)]
    ones, n = 0, 12
    for seed in range(n):
        got = mixing.mix_sources(documents(spark, rows), seed=seed).collect()
        ones += sum(r.copies for r in got if r.doc_id == 7)
        assert sum(r.copies for r in got if r.doc_id < 100) == 20
    assert 1 <= ones < n


def test_mixed_rows_and_empty(spark):
    docs = documents(spark, rows_of())
    copies = {}
    for r in mixing.mix_sources(docs).collect():
        copies[r.doc_id, r.source, r.size] = copies.get((r.doc_id, r.source, r.size), 0) + r.copies
    mixed = mixing.mixed(docs)
    assert mixed.columns == docs.columns
    assert mixed.count() == sum(copies.values())
    assert mixing.mix_sources(documents(spark, [])).collect() == []
    assert mixing.mixed(documents(spark, [])).collect() == []


def test_equal_rows_share_the_copies(spark, monkeypatch):
    """A third of all rows has one id, and half of a source's words; its rows are not all taken alike."""
    monkeypatch.setattr(mixing, "CHUNK", 64)
    text = " ".join(["word"] * 100)
    rows = [(7, text, "A")] * 400 + [(1000 + i, text, "B") for i in range(400)] + [(2000 + i, text, "C") for i in range(400)]
    rows += [(None, text, "C")] * 15
    docs = documents(spark, rows)
    got = mixing.mix_sources(docs).collect()
    assert len(got) == len(rows)
    taken, targets = defaultdict(int), {}
    for r in got:
        taken[r.source] += r.taken
        targets[r.source] = r.target
    assert all(abs(taken[s] - targets[s]) <= 100 for s in "ABC")
    assert {r.copies for r in got if r.doc_id == 7} == {0, 1}
    again = mixing.mix_sources(docs.repartition(5)).collect()
    assert sorted(map(repr, got)) == sorted(map(repr, again))
    # The copies that are handed out are those that were decided.
    mixed = defaultdict(int)
    for r in mixing.mixed(docs).collect():
        mixed[r.doc_id, r.source] += 1
    decided = defaultdict(int)
    for r in got:
        decided[r.doc_id, r.source] += r.copies
    assert mixed == {k: n for k, n in decided.items() if n}


def test_words_are_counted_without_a_list_of_them(spark):
    texts = [None, "", " ", "\n\t ", "a", " a", "a ", " a  b\x0b\x0cc\r\n", "é ü   x", "x x", "\x00 \x1f\x20\U0001f600 b", "w " * 5000]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string").select("i", word_count(F.col("text")).alias("n"))
    assert [r.n for r in rows.orderBy("i").collect()] == [len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for t in texts]
    assert "regexp_extract_all" not in rows._jdf.queryExecution().optimizedPlan().toString()


def test_units_are_written_once(spark, monkeypatch):
    written = []
    monkeypatch.setattr(mixing, "stored", lambda df, purpose: written.append((purpose, set(df.columns))) or stored(df, purpose))
    docs = documents(spark, rows_of())
    assert mixing.mix_sources(docs).count() == docs.count()
    assert [purpose for purpose, columns in written if "doc_id" in columns] == ["mix-units"]
