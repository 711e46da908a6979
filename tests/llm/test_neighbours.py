import math
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from stratalake.llm import neighbours

SCHEMA = "vec_id long, embedding array<float>"


def brute(ids, vectors, k):
    out = {}
    for i in range(len(ids)):
        if ids[i] % 50 == 0:
            others = np.flatnonzero(np.array(ids) != ids[i])
            score = neighbours.cosine(np.repeat(vectors[i : i + 1], len(others), 0), vectors[others])
            best = np.lexsort((np.array(ids)[others], -score))[:k]
            out[ids[i]] = [(ids[others[b]], score[b]) for b in best]
    return out


def found(rows):
    out = {}
    for r in sorted(rows, key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert len(out[r.query_id]) == r.rank
    return out


def frame(spark, ids, vectors):
    return spark.createDataFrame([(i, [float(x) for x in v]) for i, v in zip(ids, vectors)], SCHEMA)


def test_small_tables_are_exact(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "BLOCK_ROWS", 7)
    monkeypatch.setattr(neighbours, "BLOCK_QUERIES", 2)
    rng = np.random.default_rng(0)
    ids = [50 * i if i < 6 else 1000 + 3 * i for i in range(60)]
    vectors = rng.normal(size=(60, 8)).astype(np.float32).astype(float)
    vectors[20:40] = vectors[3]  # ties
    got = found(neighbours.nearest(frame(spark, ids, vectors), F.col("vec_id") % 50 == 0, probes=1.0).collect())
    assert got == brute(ids, vectors, 5)


def test_unusable_vectors_take_no_part(spark):
    rows = [
        (0, [1.0, 0.0]), (50, [0.0, 0.0]), (1, None), (2, []), (3, [math.nan, 1.0]), (4, [math.inf, 1.0]), (5, [None, 1.0]),
        (6, [1.0, 1.0]), (7, [1.0, 1.0]), (8, [1.0, 2.0, 3.0]), (None, [1.0, 0.0]), (0, [1.0, 0.0]), (9, [-1.0, 0.0]),
    ]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS vector", "2 AS part", "3 AS luck")
    got = found(neighbours.nearest(df, F.col("vec_id") % 50 == 0, k=5).collect())
    assert {q: [v for v, _ in hits][:3] for q, hits in got.items()} == {0: [6, 7, 9]}
    assert neighbours.nearest(df.limit(0), F.col("vec_id") % 50 == 0).collect() == []
    assert neighbours.nearest(df.where("vec_id = 50"), F.col("vec_id") % 50 == 0).collect() == []
    assert neighbours.nearest(df.where("vec_id = 6"), F.col("vec_id") % 50 == 0).collect() == []


def test_partitions_are_balanced_and_keep_neighbours():
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(8, 16)) * 3
    unit = neighbours._unit(np.concatenate([c + rng.normal(size=(64, 16)) for c in centres]))
    near = neighbours._neighbours(unit, 8)
    part = neighbours.balanced_partition(near, 8, 1)
    assert np.bincount(part, minlength=8).tolist() == [64] * 8
    assert (part[near] == part[:, None]).mean() > 0.8


@pytest.mark.skipif(not Path("/root/testdata/sf0.1").is_dir(), reason="no driver tables here")
def test_recall(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = df.orderBy("vec_id").collect()
    want = brute([r.vec_id for r in rows], np.array([r.embedding for r in rows]), 5)
    got = found(neighbours.op1_learned_partition_search(spark, "/root/testdata/sf0.1").collect())
    shared = [len({v for v, _ in got[q]} & {v for v, _ in hits}) / 5 for q, hits in want.items()]
    assert np.mean(shared) >= 0.9
