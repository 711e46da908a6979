import random
import zlib
from pathlib import Path

import numpy as np
import pytest
from helpers import AWKWARD, documents, prose
from pyspark.sql import functions as F

from stratalake.llm import ranking

LABELS = "doc_id long, quality int"


def encoded(texts):
    raw = [t.encode() for t in texts]
    return np.r_[0, np.cumsum([len(r) for r in raw])].astype(np.int64), np.frombuffer(b"".join(raw), np.uint8)


def plain(text):
    """Some measures of one text, by its words."""
    words = text.split()
    n = max(1, len(words))
    low = [w.lower() for w in words]
    upper, lower = sum("A" <= c <= "Z" for c in text), sum("a" <= c <= "z" for c in text)
    return {
        "capitals": upper / max(1, upper + lower),
        "capital words": sum(sum("A" <= c <= "Z" for c in w) > 1 and not any("a" <= c <= "z" for c in w) for w in words) / n,
        "words like the one before": sum(a == b for a, b in zip(low, low[1:])) / n,
        "words like the one before that": sum(a == b for a, b in zip(low, low[2:])) / n,
        "words met before": 1 - len(set(low)) / n if words else 1.0,
        "commonest word": max(map(low.count, low)) / n if len(words) > 1 else 0.0,
        "digits": sum(c.isdigit() for c in text) / max(1, len(text.encode())),
        "empty": float(not words),
    }


def test_measures_of_words():
    rng = random.Random(5)
    texts = ["", "One", "a A a b", "ABC DEF!! ghi ABC", "x | y | z ###", prose(rng, 400), "Ünï 12 12 12\n\nend.", " \n "]
    got = ranking.features(*encoded(texts))
    assert got.shape == (len(texts), ranking.FEATURES) and got.min() >= 0 and got.max() <= 1
    half = len(ranking.MEASURES)
    assert np.allclose(got[:, half:], np.sqrt(got[:, :half]))
    for row, text in zip(got, texts):
        for name, value in plain(text).items():
            assert row[ranking.MEASURES.index(name)] == pytest.approx(value), (name, text)
    # A text is measured alike among others and alone.
    for row, text in zip(got, texts):
        assert np.allclose(row, ranking.features(*encoded([text]))[0])


def test_weights_minimise_the_loss():
    rng = np.random.default_rng(2)
    truth = np.array([2.0, -1.0, 0.0])
    x = rng.normal(size=(4000, 3))
    better, worse = x[:2000], x[2000:]
    swap = rng.random(2000) > 1 / (1 + np.exp(-(better - worse) @ truth))
    d = np.where(swap[:, None], worse - better, better - worse)
    w = ranking._bradley_terry(d)
    assert np.allclose(w, truth, atol=0.25)
    slope = ranking.PENALTY * w - d.T @ (1 / (1 + np.exp(d @ w))) / len(d)
    assert np.abs(slope).max() < 1e-6


def corpus(spark, n=300):
    rng = random.Random(1)
    rows = [(i, prose(rng, 40).upper() + "!!" if i % 4 == 0 else prose(rng, 40) + ".", "a") for i in range(n)]
    labels = [(i, int(i % 4 != 0)) for i in range(n) if i % 3]
    return rows, spark.createDataFrame(labels, LABELS)


def test_pairs_and_scores(spark):
    rows, labels = corpus(spark)
    docs = documents(spark, [*rows, *((None if i is None else 1000 + i, t, s) for i, t, s in AWKWARD)], extra=("utility", "quality", "mark"))
    learn = F.col("doc_id") % 5 != 0
    pairs = ranking.pairs_from_labels(labels, learn).collect()
    good = {r.doc_id for r in labels.where("quality = 1").collect()}
    assert pairs and all(p.better in good and p.worse not in good and p.better % 5 and p.worse % 5 for p in pairs)
    assert len(set(pairs)) == len(pairs)
    got = ranking.score_quality(docs, labels, learn).collect()
    assert len(got) == len(rows) + len(AWKWARD)
    assert all(0 <= r.score <= 1 for r in got)
    by_id = {r.doc_id: r.score for r in got}
    assert all((by_id[i] >= 0.3) == (i % 4 != 0) for i, _, _ in rows)
    again = ranking.score_quality(docs.repartition(5), labels, learn).collect()
    assert sorted(map(repr, got)) == sorted(map(repr, again))
    assert ranking.score_quality(documents(spark, []), labels, learn).collect() == []


def test_labels_that_teach_nothing(spark):
    rows, labels = corpus(spark, 40)
    docs = documents(spark, rows)
    always = F.lit(True)
    assert {r.score for r in ranking.score_quality(docs, labels.where("quality = 1"), always).collect()} == {1.0}
    assert {r.score for r in ranking.score_quality(docs, labels.limit(0), always).collect()} == {0.5}
    messy = labels.unionByName(labels.withColumn("quality", 1 - F.col("quality")))
    messy = messy.unionByName(spark.createDataFrame([(None, 1), (3, None), (4, 7)], LABELS))
    assert ranking.pairs_from_labels(messy, always).collect() == []


def test_samples_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(ranking, "SAMPLE", 50)
    labels = spark.range(4000).selectExpr("id AS doc_id", "CAST(id % 2 AS int) AS quality")
    pairs = ranking.pairs_from_labels(labels, F.lit(True))
    ids = {r.better for r in pairs.collect()} | {r.worse for r in pairs.collect()}
    assert 60 < len(ids) < 150 and pairs.count() <= 2 * 75 * ranking.PARTNERS


@pytest.mark.skipif(not Path("/root/testdata/sf0.1").is_dir(), reason="no driver tables here")
def test_held_out_rows(spark):
    folder = "/root/testdata/sf0.1"
    truth = {r.doc_id: r.quality for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    got = ranking.op11_pairwise_quality(spark, folder).collect()
    assert len(got) == 10_000
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and r.predicted == (r.score >= 0.3) for r in got)
    held = [(truth[r.doc_id], r.predicted) for r in got if r.held_out and r.doc_id in truth]
    assert sum(a == b for a, b in held) / len(held) > 0.98
    assert sum(a == b for a, b in held if not a) / sum(not a for a, _ in held) > 0.95
