"""Links between documents of similar shingle sets: prefix filters under several token orders."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.llm.common import discard, stored, table
from stratalake.llm.components import components
from stratalake.llm.hashing import NOT_SPACE, distinct, mix, shingles, words
from stratalake.llm.packs import NO_ID, Counts, Docs, packed, rows_of, shared_keys, unpacked
from stratalake.llm.registry import query

#: Token orders whose prefix filters a candidate must pass.
ORDERS = 3
#: Pivots of a token group in the first round; sixteen times as many in each round after it.
_PIVOTS = 16

_SET = "doc_id long, n long, digest binary, prefix array<struct<token: long, place: int>>, others array<binary>, tokens binary"
_LINK = "a long, b long"


def shingle_sets(docs: Docs, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingle hashes of a pack, and the place of the document each belongs to."""
    _, offsets, data = docs
    h, doc, _, _ = words(offsets, data, NOT_SPACE)
    h, doc, _ = shingles(h, doc, k)
    return distinct(h, doc)


def jaccard_links(
    docs: DataFrame,
    words_per_shingle: int = 5,
    percent: int = 80,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Shingle count and component of every document under links of Jaccard similarity.

    Words lie between ASCII white space, A-Z lower-cased; a document is the set of its distinct word
    shingles, or its whole word sequence if that is shorter. Two documents link when
    100 * intersection >= ``percent`` * union; the component is the smallest id reachable.

    Tokens are ordered by rarity class (powers of two of the documents that have them, counted over
    all documents), and within a class by one of three hashes: three global orders. Of n tokens in
    an order, similar sets share one of the first n - ceil(percent * n / 100) + 1. Documents that share
    such a token in the first order are candidates if they do so in the others too; then the whole sets
    are compared. A shared token at places i and j bounds the intersection by what comes from there on, so a
    pair is only taken where min(n - i, m - j) suffices, as it does at the first token two similar sets share.
    Tokens of one document only are not sent, equal sets are one class, and token groups with the same
    members are one group, that of the first token in the order.

    Large groups are not paired out: each round compares sixteen members (then 256, 4,096 …) with those of
    their group that are not in their component yet. A pivot leaves its group, and a group ends when it
    lies in one component or every pair left has been compared, so no link between components is lost.

    Null, empty and blank texts have no shingles and link with nothing. A null id orders last. Rows of one
    id are one document, whose sets link as any others. An empty table gives no rows. Only the named columns
    are read. Returns ``doc_id``, ``n_shingles``, ``component_id`` and ``class_id`` (the smallest id of an
    equal set) for every row.
    """
    packs = packed(docs, id_col, text_col)
    counts = shared_keys(packs, lambda d: shingle_sets(d, words_per_shingle)[0], bytes_per_key=7.0)
    joined = packs.join(counts, "pack", "left")
    sets = stored(joined.mapInArrow(_sets_of(words_per_shingle, percent), _SET), "shingle-sets")
    discard(packs, counts)
    classes = stored(
        sets.where("n > 0").groupBy("digest").agg(F.min("doc_id").alias("class_id")), "set-classes"
    )
    # Only a class's smallest document goes on; a pack has already left out its other copies.
    firsts = stored(
        sets.where("tokens IS NOT NULL")
        .join(classes.withColumnRenamed("digest", "_digest"), (F.col("digest") == F.col("_digest")) & (F.col("doc_id") == F.col("class_id")))
        .select("doc_id", "n", "prefix", "others", "tokens"),
        "set-firsts",
    )
    groups = _labelled(firsts, percent).withColumnRenamed("id", "class_id")
    discard(firsts)
    named = sets.select("doc_id", "n", "digest").join(classes, "digest", "left").join(groups, "class_id", "left")
    known = {
        "doc_id": F.col("doc_id"),
        "component_id": F.coalesce("component", "class_id", "doc_id"),
        "class_id": F.coalesce("class_id", "doc_id"),
    }
    known = {c: F.nullif(v, F.lit(NO_ID)).alias(c) for c, v in known.items()}
    return named.select(known["doc_id"], F.col("n").alias("n_shingles"), known["component_id"], known["class_id"])


def prefix_length(n: np.ndarray, percent: int) -> np.ndarray:
    return n - (n * percent + 99) // 100 + 1


def _sets_of(k: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in rows_of(batches):
            docs = unpacked(row)
            ids = docs[0]
            h, doc = shingle_sets(docs, k)
            counts = Counts(row["found"], row["buckets"]).of(h)
            rarity = np.floor(np.log2(counts)).astype(np.uint64)
            edges = np.searchsorted(doc, np.arange(len(ids) + 1))
            n = np.diff(edges)
            length = prefix_length(n, percent)
            firsts, places = [], None
            for order in range(ORDERS):
                rank = mix(h ^ np.uint64(0x9E37 * (order + 1)))
                placed = np.lexsort((rank, rarity, doc))
                in_prefix = np.arange(len(h)) - edges[doc] < length[doc]
                at = np.flatnonzero(in_prefix & (counts[placed] > 1))
                firsts.append(placed[at])
                places = at - edges[doc[at]] if places is None else places
            bounds = [np.searchsorted(doc[f], np.arange(len(ids) + 1)) for f in firsts]
            seen: dict[bytes, int] = {}
            digests = [xxhash.xxh3_128_digest(h[a:z].tobytes()) for a, z in zip(edges[:-1], edges[1:])]
            for i in np.argsort(ids, kind="stable"):
                if n[i]:
                    seen.setdefault(digests[i], i)
            out: dict[str, list] = {c: [] for c in ("prefix", "others", "tokens")}
            for i in range(len(ids)):
                cuts = [f[b[i] : b[i + 1]] for f, b in zip(firsts, bounds)]
                going = bool(n[i]) and seen[digests[i]] == i and all(len(c) for c in cuts)
                if going:
                    place = places[bounds[0][i] : bounds[0][i + 1]]
                    tokens = h[cuts[0]].view(np.int64)
                    out["prefix"].append([{"token": t, "place": p} for t, p in zip(tokens.tolist(), place.tolist())])
                else:
                    out["prefix"].append(None)
                out["others"].append([np.sort(h[c]).tobytes() for c in cuts[1:]] if going else None)
                out["tokens"].append(h[edges[i] : edges[i + 1]].tobytes() if going else None)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids), pa.array(n, pa.int64()), pa.array(digests, pa.binary()),
                    pa.array(out["prefix"], pa.list_(pa.struct([("token", pa.int64()), ("place", pa.int32())]))),
                    pa.array(out["others"], pa.list_(pa.binary())),
                    pa.array(out["tokens"], pa.binary()),
                ],
                names=["doc_id", "n", "digest", "prefix", "others", "tokens"],
            )

    return run


def _labelled(firsts: DataFrame, percent: int) -> DataFrame:
    """The component of each first document of a class that has a candidate: ``id`` and ``component``."""
    entries = firsts.select("doc_id", "n", F.explode("prefix").alias("p")).select("doc_id", "n", "p.token", "p.place")
    entries = entries.distinct()
    members = entries.groupBy("token").agg(
        F.count("*").alias("q"),
        F.sum(F.xxhash64("doc_id").cast("decimal(38,0)")).alias("x"),
        F.bit_xor(F.xxhash64("doc_id", F.lit(5))).alias("y"),
        F.sum("place").alias("place"),
    ).where("q > 1")
    # Of tokens with the same members, the first in the order stands for all.
    groups = members.groupBy("q", "x", "y").agg(F.min(F.struct("place", "token"))["token"].alias("token")).select("token")
    # The largest partner that what follows the place leaves room for.
    reach = F.floor((100 * F.col("n") - (100 + percent) * F.col("place")) / percent)
    entries = stored(entries.join(groups, "token").withColumn("reach", reach), "token-entries")
    sizes = entries.groupBy("token", "n").agg(F.max("reach").alias("mr")).withColumnsRenamed({"token": "t", "n": "m"})
    # Members without any partner in reach, on either side, go before pairs are made.
    possible = (F.col("token") == F.col("t")) & (F.col("m") <= F.col("reach")) & (F.col("mr") >= F.col("n"))
    entries = stored(entries.join(sizes, possible, "left_semi"), "token-entries")
    labels = stored(entries.select("doc_id").distinct().withColumn("label", F.col("doc_id")), "labels")
    pivots, round_ = _PIVOTS, 0
    while True:
        marked = entries.join(labels, "doc_id")
        open_ = (
            marked.groupBy("token")
            .agg(F.count("*").alias("q"), F.min("label").alias("l"), F.max("label").alias("m"))
            .where("l <> m")
            .select("token", "q")
        )
        # The same documents are pivots of all groups of their size.
        luck = F.xxhash64("doc_id", F.lit(round_)) / (2.0**64) + 0.5
        chosen = (F.col("q") <= pivots) | (luck * F.col("q") < pivots)
        marked = stored(marked.join(open_, "token").withColumn("pivot", chosen), "token-round")
        # Members one at a time against the pivots of their group; equal pairs of many groups are one.
        names = {"doc_id": "p", "n": "pn", "label": "pl", "reach": "pr"}
        pair = marked.where("pivot").select("token", *(F.col(c).alias(n) for c, n in names.items()))
        near = (F.col("n") <= F.col("pr")) & (F.col("pn") <= F.col("reach")) & (F.col("label") != F.col("pl"))
        candidates = (
            marked.join(pair, "token").where(near)
            .select(F.least("doc_id", "p").alias("a"), F.greatest("doc_id", "p").alias("b"))
            .where("a <> b").distinct()
        )
        links = _verified(candidates, firsts, percent)
        if not links.isEmpty():
            labels = _relabelled(labels, links)
        entries = marked.where("NOT pivot").select("token", "doc_id", "n", "reach")
        if entries.isEmpty():
            return labels.select(F.col("doc_id").alias("id"), F.col("label").alias("component"))
        pivots, round_ = pivots * 16, round_ + 1


def _relabelled(labels: DataFrame, links: DataFrame) -> DataFrame:
    """Labels joined by links: only the links between components are looked at again."""
    ends = [labels.select(F.col("doc_id").alias(c), F.col("label").alias(f"l{c}")) for c in ("a", "b")]
    between = links.join(ends[0], "a").join(ends[1], "b").select(F.col("la").alias("a"), F.col("lb").alias("b"))
    joined = components(between)
    return stored(
        labels.join(joined, F.col("label") == F.col("id"), "left")
        .select("doc_id", F.coalesce("component", "label").alias("label")),
        "labels",
    )


def _verified(candidates: DataFrame, firsts: DataFrame, percent: int) -> DataFrame:
    """Candidates that share prefix tokens in the other orders too, and whose whole sets are similar."""

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = [], []
            sides = [batch.column(c).to_pylist() for c in ("a", "b", "others_a", "others_b", "tokens_a", "tokens_b")]
            for id_a, id_b, other_a, other_b, set_a, set_b in zip(*sides):
                passed = all(_common(x, y) for x, y in zip(other_a, other_b))
                if passed and _similar(set_a, set_b, percent):
                    a.append(id_a)
                    b.append(id_b)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    def side(name: str) -> DataFrame:
        return firsts.select(
            F.col("doc_id").alias(name), F.col("others").alias(f"others_{name}"), F.col("tokens").alias(f"tokens_{name}")
        )

    paired = candidates.join(side("a"), "a").join(side("b"), "b")
    return stored(paired.select("a", "b", "others_a", "others_b", "tokens_a", "tokens_b").mapInArrow(verify, _LINK), "links")


def _common(x: bytes, y: bytes) -> int:
    return len(np.intersect1d(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), assume_unique=True))


def _similar(x: bytes, y: bytes, percent: int) -> bool:
    shared = _common(x, y)
    return 100 * shared >= percent * (len(x) // 8 + len(y) // 8 - shared)


#: Words, shingles, pairs and reachable ids in SQL.
_SQL = r"""
WITH RECURSIVE w AS (
    SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
    SELECT doc_id, CASE WHEN w IS NULL OR len(w) = 0 THEN []
        WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
        ELSE list_distinct(list_transform(range(1, len(w) - 2),
            lambda i: array_to_string(w[i:i + 3], ' '))) END AS s FROM w),
t AS (SELECT doc_id, len(s) AS n, unnest(s) AS t FROM s),
shared AS (
    SELECT x.doc_id AS a, y.doc_id AS b, x.n AS na, y.n AS nb, count(*) AS i
    FROM t x JOIN t y ON x.t = y.t AND x.doc_id < y.doc_id
        AND 100 * least(x.n, y.n) >= 85 * greatest(x.n, y.n)
    GROUP BY ALL),
links AS (SELECT a, b FROM shared WHERE 100 * i >= 85 * (na + nb - i)),
both_ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach AS (
    SELECT doc_id, doc_id AS r FROM s
    UNION
    SELECT reach.doc_id, both_ways.b FROM reach JOIN both_ways ON reach.r = both_ways.a)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, m.component_id
FROM s JOIN (SELECT doc_id, min(r) AS component_id FROM reach GROUP BY doc_id) m USING (doc_id)
"""


@query("op5_multi_order_jaccard", _SQL)
def op5_multi_order_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    linked = jaccard_links(table(spark, sf_dir, "documents"), words_per_shingle=4, percent=85)
    return linked.select("doc_id", "n_shingles", "component_id")
