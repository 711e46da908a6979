"""Approximate nearest neighbours by learned partitions."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.llm.common import stored, table
from stratalake.llm.registry import query

#: Rows that the index is fitted on: a bounded sample, whatever the size of the table.
SAMPLE_ROWS = 4096
#: Partitions of the graph; fewer if the sample is small.
PARTITIONS = 64
#: Rows, and queries, that meet in one block of a partition.
BLOCK_ROWS = 8192
BLOCK_QUERIES = 2048


@dataclass
class Router:
    """A softmax classifier from a unit vector to partitions of the neighbour graph."""

    weights: np.ndarray
    bias: np.ndarray

    def scores(self, vectors: np.ndarray) -> np.ndarray:
        return vectors @ self.weights + self.bias


def usable(vector: Column) -> Column:
    """Vectors without null or non-finite components and not all zero."""
    # The difference of a number to itself is zero unless it is NaN or infinite.
    finite = F.forall(vector, lambda x: x.isNotNull() & ((x - x) == 0))
    return vector.isNotNull() & F.coalesce(finite, F.lit(False)) & F.exists(vector, lambda x: x != 0)


def fit_router(vectors: np.ndarray, partitions: int, degree: int = 12, seed: int = 1) -> Router:
    """Partition the neighbour graph of the sample evenly, and learn to tell the parts of a vector."""
    unit = _unit(vectors.astype(np.float64))
    near = _neighbours(unit, min(degree, len(unit) - 1))
    part = balanced_partition(near, partitions, seed)
    # A vector is worth a search wherever its neighbours are.
    labels = np.zeros((len(unit), partitions))
    labels[np.arange(len(unit)), part] += 1.0
    for column in near.T:
        labels[np.arange(len(unit)), part[column]] += 1.0
    return _softmax(unit, labels / labels.sum(axis=1, keepdims=True))


def _unit(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def _neighbours(unit: np.ndarray, degree: int) -> np.ndarray:
    near = np.empty((len(unit), degree), np.int64)
    for a in range(0, len(unit), 512):
        sims = unit[a : a + 512] @ unit.T
        sims[np.arange(len(sims)), np.arange(a, a + len(sims))] = -np.inf
        near[a : a + 512] = np.argpartition(-sims, degree - 1, axis=1)[:, :degree] if degree else 0
    return near


def balanced_partition(near: np.ndarray, partitions: int, seed: int) -> np.ndarray:
    """Parts of nearly equal size with few neighbours apart, by recursive bisection.

    A part is halved by the order of its second eigenvector (power iteration on the graph); then nodes
    are swapped in pairs across the cut as long as that brings more neighbours together.
    """
    n = len(near)
    rows = np.repeat(np.arange(n), near.shape[1])
    graph = np.unique(np.concatenate([np.stack([rows, near.ravel()], 1), np.stack([near.ravel(), rows], 1)]), axis=0)
    part = np.zeros(n, np.int64)
    rng = np.random.default_rng(seed)
    waiting = [(np.arange(n), partitions, 0)]
    while waiting:
        nodes, k, first = waiting.pop()
        if k == 1 or len(nodes) < 2:
            part[nodes] = first
            continue
        size = len(nodes) * (k // 2) // k
        low = _bisected(graph, nodes, size, rng)
        waiting += [(nodes[low], k // 2, first), (nodes[~low], k - k // 2, first + k // 2)]
    return part


def _bisected(graph: np.ndarray, nodes: np.ndarray, size: int, rng) -> np.ndarray:
    local = np.full(max(graph.max(initial=0), nodes.max()) + 1, -1)
    local[nodes] = np.arange(len(nodes))
    edges = local[graph]
    edges = edges[(edges >= 0).all(axis=1)]
    a, b = edges[:, 0], edges[:, 1]
    degree = np.bincount(a, minlength=len(nodes)) + 1e-9
    root = np.sqrt(degree)
    x = rng.normal(size=len(nodes))
    for _ in range(60):
        x -= root * (x @ root) / (root @ root)
        spread = np.bincount(a, x[b] / root[b], len(nodes)) / root
        x = 0.5 * (x + spread)
        x /= np.linalg.norm(x) + 1e-300
    low = np.zeros(len(nodes), bool)
    low[np.argsort(x / root, kind="stable")[:size]] = True
    for _ in range(20):
        across = np.bincount(a, low[a] != low[b], len(nodes))
        gain = 2 * across - degree
        ups, downs = np.flatnonzero(low), np.flatnonzero(~low)
        ups = ups[np.argsort(-gain[ups], kind="stable")]
        downs = downs[np.argsort(-gain[downs], kind="stable")]
        k = min(len(ups), len(downs))
        # Half the swaps that gain, so that neighbours do not merely change sides together.
        good = int((gain[ups[:k]] + gain[downs[:k]] > 0).sum())
        if good < 2:
            break
        before, kept = int(across.sum()), low.copy()
        low[ups[: good // 2]], low[downs[: good // 2]] = False, True
        if int((low[a] != low[b]).sum()) >= before:
            low = kept
            break
    return low


def _softmax(x: np.ndarray, labels: np.ndarray, steps: int = 120, rate: float = 0.5, penalty: float = 1e-5) -> Router:
    weights, bias = np.zeros((x.shape[1], labels.shape[1])), np.zeros(labels.shape[1])
    moment = [np.zeros_like(weights), np.zeros_like(bias), np.zeros_like(weights), np.zeros_like(bias)]
    for t in range(1, steps + 1):
        scores = x @ weights + bias
        p = np.exp(scores - scores.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        for i, (value, slope) in enumerate(
            ((weights, x.T @ (p - labels) / len(x) + penalty * weights), (bias, (p - labels).mean(axis=0)))
        ):
            moment[i] = 0.9 * moment[i] + 0.1 * slope
            moment[i + 2] = 0.999 * moment[i + 2] + 0.001 * slope**2
            value -= rate * (moment[i] / (1 - 0.9**t)) / (np.sqrt(moment[i + 2] / (1 - 0.999**t)) + 1e-8)
    return Router(weights, bias)


def nearest(
    vectors: DataFrame,
    is_query: Column,
    k: int = 5,
    probes: float = 0.7,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """The ``k`` nearest other rows of every query row, by cosine, of those its partitions hold.

    The index is fitted on at most ``SAMPLE_ROWS`` rows, those of least hash: their neighbour graph is cut
    into partitions of equal size, and a classifier learns which partitions hold a vector's neighbours.
    Every row goes to its likeliest partition, every query to the most likely ``probes`` of them, and all
    rows there are ranked by cosine in double precision on the original components. Vectors without
    clusters, as random ones, need most partitions (0.7 of them for nine in ten neighbours); clustered ones
    few. A partition is cut
    into blocks of rows and blocks of queries, so none is ever whole in a task; each block keeps the best
    ``k`` of a query.

    Vectors that are null, empty, zero, or hold a null or non-finite component take no part, and neither
    do those of another length than most of the sample. Ties go to the smaller id. Rows of one id are
    several candidates, but no candidate of their own query, which is asked once, with the least of their
    vectors; rows without an id take no part. With no
    queries or no candidates there are no rows. Returns ``query_id``, ``rank`` (from 1), ``vec_id``
    and ``score``.
    """
    rows = stored(
        vectors.where(F.col(id_col).isNotNull() & usable(F.col(vector_col)))
        .select(
            F.col(id_col).cast("long").alias("vec_id"),
            F.col(vector_col).cast("array<double>").alias("vector"),
            F.coalesce(is_query, F.lit(False)).alias("is_query"),
            F.xxhash64(F.col(id_col), F.lit(3)).alias("luck"),
        ),
        "vectors",
    )
    count = rows.count()
    if not count:
        return rows.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    # Twice the share that is needed makes it unlikely that too few rows fall under the threshold.
    share = min(1.0, 2.0 * SAMPLE_ROWS / count)
    limit = int((share - 0.5) * (2**64 - 1))
    drawn = rows.where(F.col("luck") <= min(limit, 2**63 - 1)).orderBy("luck", "vec_id").limit(SAMPLE_ROWS)
    sample = [np.array(r.vector) for r in drawn.select("vector").collect()]
    lengths = np.bincount([len(v) for v in sample])
    dimension = int(lengths.argmax())
    sample = np.stack([v for v in sample if len(v) == dimension])
    partitions = max(1, min(PARTITIONS, len(sample) // 32))
    router = fit_router(sample, partitions) if len(sample) > 1 else Router(np.zeros((dimension, 1)), np.zeros(1))
    partitions = router.weights.shape[1]
    probed = int(np.ceil(max(1, probes * partitions)))
    rows = rows.where(F.size("vector") == dimension)

    route_type = T.ArrayType(T.IntegerType())

    @F.pandas_udf(route_type)
    def likeliest(batch: pd.Series) -> pd.Series:
        scores = router.scores(_unit(np.stack(batch.to_numpy())))
        best = np.argsort(-scores, axis=1, kind="stable")[:, :probed]
        return pd.Series(list(best.astype(np.int32)))

    routed = stored(rows.withColumn("parts", likeliest("vector")), "routed")
    sizes = routed.groupBy(F.col("parts")[0].alias("part")).agg(F.count("*").alias("rows"))
    once = F.min(F.struct("vector", "parts", "luck")).alias("q")
    asking = routed.where("is_query").groupBy("vec_id").agg(once).select("vec_id", "q.*")
    asked = asking.select(F.explode("parts").alias("part")).groupBy("part").agg(F.count("*").alias("asks"))
    # One row for each partition, 64 at most.
    plan = F.broadcast(
        sizes.join(asked, "part").select(
            "part",
            F.ceil(F.col("rows") / BLOCK_ROWS).cast("int").alias("row_blocks"),
            F.ceil(F.col("asks") / BLOCK_QUERIES).cast("int").alias("query_blocks"),
        )
    )
    block = ["part", "row_block", "query_block"]
    candidates = (
        routed.withColumn("part", F.col("parts")[0]).join(plan, "part")
        .withColumn("row_block", F.pmod(F.xxhash64("vec_id", "luck"), F.col("row_blocks")).cast("int"))
        .withColumn("query_block", F.explode(F.sequence(F.lit(0), F.col("query_blocks") - 1)))
        .select(*block, "vec_id", "vector")
    )
    queries = (
        asking.withColumn("part", F.explode("parts")).join(plan, "part")
        .withColumn("query_block", F.pmod(F.xxhash64("vec_id", F.lit(9)), F.col("query_blocks")).cast("int"))
        .withColumn("row_block", F.explode(F.sequence(F.lit(0), F.col("row_blocks") - 1)))
        .select(*(F.col(c).alias(f"asked_{c}") for c in (*block, "vec_id", "vector")))
    )
    asked_block = [f"asked_{c}" for c in block]
    found = candidates.groupBy(*block).cogroup(queries.groupBy(*asked_block)).applyInArrow(
        lambda left, right: _block(left, right, k), "query_id long, vec_id long, score double"
    )
    best = F.slice(
        F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("far"), F.col("vec_id").alias("vec_id")))), 1, k
    )
    # A query has at most k rows from each block.
    return (
        found.groupBy("query_id").agg(best.alias("best"))
        .select("query_id", F.posexplode("best").alias("at", "hit"))
        .select("query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("hit.vec_id").alias("vec_id"), (-F.col("hit.far")).alias("score"))
    )


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    flat = column.combine_chunks().flatten()
    return flat.to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _block(left: pa.Table, right: pa.Table, k: int) -> pa.Table:
    """The best k candidates of every query of a block; all scores of a pair are summed in one order."""
    out: list[np.ndarray] = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]
    if left.num_rows and right.num_rows:
        ids, rows = left.column("vec_id").to_numpy(), _matrix(left.column("vector"))
        asks, queries = right.column("asked_vec_id").to_numpy(), _matrix(right.column("asked_vector"))
        parts = [_best(asks[a : a + 256], queries[a : a + 256], ids, rows, k) for a in range(0, len(asks), 256)]
        out = [np.concatenate(c) for c in zip(*parts)]
    return pa.table(out, names=["query_id", "vec_id", "score"])


def _best(asks, queries, ids, rows, k):
    rough = _unit(queries) @ _unit(rows).T
    rough[asks[:, None] == ids[None, :]] = -np.inf
    kth = np.partition(rough, -min(k, rough.shape[1]), axis=1)[:, -min(k, rough.shape[1])]
    # Whatever may tie with the k-th is scored exactly.
    q, r = np.nonzero((rough >= kth[:, None] - 1e-9) & np.isfinite(rough))
    score = np.empty(len(q))
    for a in range(0, len(q), 1 << 18):
        x, y = queries[q[a : a + (1 << 18)]], rows[r[a : a + (1 << 18)]]
        score[a : a + len(x)] = cosine(x, y)
    order = np.lexsort((ids[r], -score, q))
    q, r, score = q[order], r[order], score[order]
    place = np.arange(len(q)) - np.searchsorted(q, q)
    keep = place < k
    return asks[q[keep]], ids[r[keep]], score[keep]


def cosine(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Cosines of pairs of vectors, row by row."""
    return (x * y).sum(axis=1) / (np.sqrt((x * x).sum(axis=1)) * np.sqrt((y * y).sum(axis=1)))


@query("op1_learned_partition_search")
def op1_learned_partition_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)
