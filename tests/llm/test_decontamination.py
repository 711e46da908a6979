import random
import re
from collections import Counter

import numpy as np
from helpers import AWKWARD, documents, prose

from stratalake.llm import decontamination


def bag(words, k):
    return Counter(tuple(words[i : i + k]) for i in range(len(words) - k + 1))


def tokens(text):
    return re.findall(rb"[a-z0-9\x80-\xff]+", re.sub(rb"[A-Z]+", lambda m: m[0].lower(), (text or "").encode()))


def brute(rows, items, k=5, threshold=0.8):
    out = {}
    for d, text in rows:
        words = tokens(text)
        for i, item in items:
            own = tokens(item)
            n, size = min(k, len(own)), len(own)
            if not own or len(words) < n:
                continue
            want = bag(own, n)
            best = 0.0
            for a in range(max(1, len(words) - size + 1)):
                window = bag(words[a : a + size], n)
                shared = (window & want).total()
                best = max(best, shared / (window.total() + want.total() - shared))
            if best >= threshold:
                out[d, i] = round(best, 9)
    return out


def case(rng):
    items = [(i, prose(rng, rng.choice([3, 6, 20, 45]), 3000)) for i in range(30)]
    items += [(50, items[0][1]), (51, "same same same same same same same"), (52, ""), (53, "  .,; "), (54, "one two")]
    rows = [(i, t) for i, t, _ in AWKWARD]
    for d in range(100, 160):
        _, item = rng.choice(items[:30])
        words = item.split()
        if rng.random() < 0.3:
            words[rng.choice([0, -1])] = "edited"
        text = f"{prose(rng, rng.randrange(0, 30), 3000)}, {' '.join(words).upper()}! {prose(rng, 10, 3000)}"
        rows.append((d, text if rng.random() < 0.8 else prose(rng, 40, 3000)))
    rows += [(200, "same " * 9), (201, items[2][1]), (202, items[2][1][:-2]), (203, "One, TWO.")]
    return rows, items


def test_agrees_with_brute_force(spark, monkeypatch):
    rows, items = case(random.Random(4))
    items_df = spark.createDataFrame([*items, (60, None)], "item_id long, text string").selectExpr("*", "1 AS similarity")
    docs = documents(spark, [(i, t, "a") for i, t in rows if i is not None], extra=("hits", "item_id"))
    want = brute([(i, t) for i, t in rows if i is not None], items)
    for items_in_a_pass in (4096, 7):
        monkeypatch.setattr(decontamination, "PASS_ITEMS", items_in_a_pass)
        got = decontamination.contaminated(docs, items_df).collect()
        assert {(r.doc_id, r.item_id): round(r.similarity, 9) for r in got} == want
        assert len(got) == len(want) and all(r.distance <= decontamination.RADIUS for r in got)
    clean = decontamination.without_items(docs, items_df)
    assert clean.columns == docs.columns
    dirty = {d for d, _ in want}
    assert sorted(r.doc_id for r in clean.collect()) == sorted(i for i, _ in rows if i is not None and i not in dirty)


def test_empty_tables(spark):
    items = spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")
    docs = documents(spark, AWKWARD)
    assert decontamination.contaminated(documents(spark, []), items).collect() == []
    assert decontamination.contaminated(docs, items.limit(0)).collect() == []
    assert decontamination.without_items(docs, items.limit(0)).count() == len(AWKWARD)


def test_index_finds_all_within_the_radius():
    rng = np.random.default_rng(7)
    prints = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
    queries = prints[rng.integers(0, 40, 400)].copy()
    for i in range(400):
        for bit in rng.choice(64, i % 20, replace=False):
            queries[i] ^= np.uint64(1) << np.uint64(bit)
    place, item, distance = decontamination.BlockIndex(prints).search(queries)
    full = np.bitwise_count(queries[:, None] ^ prints[None, :])
    want = {(q, i, int(full[q, i])) for q, i in zip(*np.nonzero(full <= decontamination.RADIUS))}
    assert set(zip(place.tolist(), item.tolist(), distance.tolist())) == want


def test_items_without_an_id(spark):
    text = "an item whose id is missing but whose words are all here"
    items = spark.createDataFrame([(None, text), (5, text), (None, text + " too")], "item_id long, text string")
    docs = documents(spark, [(1, text, "a"), (2, "clean words only", "a")])
    got = decontamination.contaminated(docs, items).collect()
    assert [(r.doc_id, r.item_id, r.similarity) for r in got] == [(1, None, 1.0), (1, 5, 1.0)]
    assert [r.doc_id for r in decontamination.without_items(docs, items).collect()] == [2]
