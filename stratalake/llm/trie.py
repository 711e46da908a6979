"""Prefix tries of conversations, with subtree totals rolled up by bands of depth."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stratalake.llm.common import SQL_BITS, discard, placed, sql_crc32, stored, table
from stratalake.llm.registry import query

#: Conversations whose first turns the others borrow are apart by so much; the most turns borrowed.
BLOCK = 100
MOST_BORROWED = 6
#: Turns of one conversation, and ids of one node's members, that go together in one row or window.
CHUNK = 4096
IDS = 512
#: A node with more than one in so many of all nodes as children is joined by broadcast.
HOT_SHARE = 1024

_KEY = ["k1", "k2"]


def _renamed(df: DataFrame, **names: str) -> DataFrame:
    return df.select(*(F.col(old).alias(new) for new, old in names.items()))


def ordered_turns(
    turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """Every turn with its ``place`` in its conversation, the conversation's ``n``, its hash and code points.

    Turns go by their number, null first, and those of one number by the md5 of role and text. Null role
    or text is empty. Rows without a conversation's id belong to none and are left out. The texts
    themselves are read once and go no further.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    digest = F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text))
    read = turns.where(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("long").alias("conv"), F.col(turn_col).alias("turn"), digest.alias("digest"),
        F.length(text).cast("long").alias("points"), F.monotonically_increasing_id().alias("nth"),
    )
    order = [F.col("turn").asc_nulls_first(), F.col("digest"), F.col("nth")]
    return placed(read, ["conv"], order, "place", "n").select("conv", "place", "n", "digest", "points")


def rebuilt(turns: DataFrame) -> DataFrame:
    """The rebuilt conversations, a row a turn: ``conv``, ``depth`` (from 1), the term of its hash and its code points.

    Conversation c takes the first h turns of conversation c - c % 100 (all if that has fewer, none if there is
    none), then its own after its first h; h is the crc32 of its id in decimal, modulo 6. ``depth`` 0 is a row
    for every conversation, turnless ones included.
    """
    lengths = turns.where("place = 0").select("conv", "n")
    h = F.crc32(F.encode(F.col("conv").cast("string"), "UTF-8")) % MOST_BORROWED
    convs = lengths.select("conv", h.alias("h"), (F.col("conv") - F.col("conv") % BLOCK).alias("base"))
    held = _renamed(lengths, _base="conv", _n="n")
    convs = convs.join(held, F.col("base") == F.col("_base"), "left")
    convs = stored(convs.select("conv", "base", "h", F.least("h", F.coalesce("_n", F.lit(0))).alias("m")), "trie-convs")
    # A block's first turns are few, and a block has BLOCK conversations, or twice that around zero.
    first = _renamed(turns.where(F.col("place") < MOST_BORROWED), _base="conv", place="place", digest="digest", points="points")
    borrowed = convs.join(first, (F.col("base") == F.col("_base")) & (F.col("place") < F.col("m")))
    borrowed = borrowed.select("conv", (F.col("place") + 1).alias("depth"), "digest", "points")
    # Both numbers of a conversation follow from its turns' own key, so a long one is not joined by one key:
    # its chunks are.
    chunk = F.floor(F.col("place") / CHUNK)
    sizes = turns.where(F.col("place") % CHUNK == 0).select("conv", chunk.alias("chunk"))
    shifts = sizes.join(convs.select("conv", "h", "m"), "conv")
    shifts = _renamed(shifts, _conv="conv", _chunk="chunk", h="h", m="m")
    own = turns.withColumn("chunk", chunk).join(shifts, (F.col("conv") == F.col("_conv")) & (F.col("chunk") == F.col("_chunk")))
    own = own.where(F.col("place") >= F.col("h")).select(
        "conv", (F.col("place") - F.col("h") + F.col("m") + 1).alias("depth"), "digest", "points"
    )
    none = convs.select(
        "conv", F.lit(0).cast("long").alias("depth"), F.lit(None).cast("string").alias("digest"), F.lit(0).cast("long").alias("points")
    )
    rows = none.unionByName(borrowed).unionByName(own)
    terms = {
        name: F.when(F.col("digest").isNull(), F.lit(0)).otherwise(F.xxhash64("digest", "depth", F.lit(seed)))
        for name, seed in (("t1", 1), ("t2", 2))
    }
    return stored(rows.select("conv", "depth", *(c.cast("long").alias(n) for n, c in terms.items()), "points"), "trie-rows")


def _prefixes(rows: DataFrame) -> DataFrame:
    """The 128-bit key of the prefix that ends in each row, and that of the one before.

    A key is the exclusive or of the hashes of all (turn, depth) of the prefix, so that of any part
    of a long conversation can be taken on its own: rows are chunked by depth.
    """
    chunked = rows.withColumn("chunk", F.floor(F.col("depth") / CHUNK))
    before = Window.partitionBy("conv").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    sums = chunked.groupBy("conv", "chunk").agg(*(F.bit_xor(t).alias(t) for t in ("t1", "t2")))
    starts = sums.select(
        F.col("conv").alias("_conv"), F.col("chunk").alias("_chunk"),
        *(F.coalesce(F.bit_xor(t).over(before), F.lit(0)).alias(f"_{t}") for t in ("t1", "t2")),
    )
    within = Window.partitionBy("conv", "chunk").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    running = chunked.select(
        "conv", "chunk", "depth", "t1", "t2", "points",
        *(F.bit_xor(t).over(within).alias(f"r{t}") for t in ("t1", "t2")),
    ).join(starts, (F.col("conv") == F.col("_conv")) & (F.col("chunk") == F.col("_chunk")))
    keys = {f"k{i}": F.col(f"rt{i}").bitwiseXOR(F.col(f"_t{i}")) for i in (1, 2)}
    return running.select(
        "conv", "depth", "points", *(c.alias(n) for n, c in keys.items()),
        *(keys[f"k{i}"].bitwiseXOR(F.col(f"t{i}")).alias(f"p{i}") for i in (1, 2)),
    )


def conversation_trie(
    turns: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    band: int | None = None,
) -> DataFrame:
    """A row for every node of the trie of rebuilt conversations.

    A node is a distinct sequence of turns (role and text); the root, of depth 0, has none. It is named by its smallest
    member and its depth. Totals of subtrees are taken in two steps: every node adds its own to its ancestors within
    its band of ``band`` depths, all bands at once; then, from the deepest band up, the roots of a band, now
    complete, add theirs to their ancestors in the band above. A node thus adds to ``band`` others at most, and there
    are depth/``band`` rounds over band roots alone. Unset, ``band`` is the square root of the greatest depth.

    Turns of one number are ordered by the md5 of role and text, null numbers come first, null role and text are
    empty; rows without an id are left out; rows that repeat are turns of their own. An empty table has no nodes. Only
    the named columns are read. Returns ``conv_id``, ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``,
    ``n_leaves``, ``saved_tokens`` and ``ends_sha256``.
    """
    ordered = ordered_turns(turns, conv_col, turn_col, role_col, text_col)
    rows = stored(_prefixes(rebuilt(ordered)), "trie-prefixes")
    nodes = stored(
        rows.groupBy("depth", *_KEY).agg(
            F.min("conv").alias("conv"), F.count("*").alias("n_convs"), F.max("points").alias("points"),
            F.max("p1").alias("p1"), F.max("p2").alias("p2"),
        ),
        "trie-nodes",
    )
    children = stored(
        nodes.where("depth > 0").groupBy("p1", "p2").agg(F.count("*").alias("n_children")), "trie-children"
    )
    own = nodes.join(_renamed(children, c1="p1", c2="p2", n_children="n_children"), (F.col("k1") == F.col("c1")) & (F.col("k2") == F.col("c2")), "left")
    own = stored(
        own.select(*nodes.columns, F.coalesce("n_children", F.lit(0)).alias("n_children")).withColumns({
            "leaves": F.when(F.col("n_children") == 0, 1).otherwise(0).cast("long"),
            "saved": (F.col("n_convs") - 1) * F.col("points"),
        }),
        "trie-own",
    )
    totals = subtree_totals(rows, own, band)
    named = _with_parents(own, children)
    ends = ends_hashes(rows)
    found = named.join(_renamed(totals, a1="k1", a2="k2", n_leaves="leaves", saved_tokens="saved"), (F.col("k1") == F.col("a1")) & (F.col("k2") == F.col("a2")))
    found = found.join(_renamed(ends, e1="k1", e2="k2", ends_sha256="ends_sha256"), (F.col("k1") == F.col("e1")) & (F.col("k2") == F.col("e2")), "left")
    nothing = F.lit(hashlib.sha256(b"").hexdigest())
    return found.select(
        F.col("conv").alias("conv_id"), "depth", "parent_conv_id", "n_convs", F.col("n_children").cast("long").alias("n_children"),
        "n_leaves", "saved_tokens", F.coalesce("ends_sha256", nothing).alias("ends_sha256"),
    )


def subtree_totals(rows: DataFrame, own: DataFrame, band: int | None = None) -> DataFrame:
    """The sums of ``leaves`` and ``saved`` over the subtree of every node, by its key."""
    deepest = own.agg(F.max("depth")).first()[0] or 0
    band = band or max(2, math.isqrt(deepest + 1))
    # The keys of a conversation within a band: as many as the band is high, at most.
    of_band = F.floor(F.col("depth") / band)
    entry = F.struct("depth", "k1", "k2")
    lines = rows.groupBy("conv", of_band.alias("band")).agg(F.array_sort(F.collect_list(entry)).alias("line"))
    lines = stored(lines.select(F.col("conv").alias("_conv"), F.col("band").alias("_band"), "line"), "trie-lines")

    def added(nodes: DataFrame, up_to: Column) -> DataFrame:
        """What nodes add to their ancestors in a band, themselves included where they are in it."""
        met = nodes.join(lines, (F.col("conv") == F.col("_conv")) & (F.col("at") == F.col("_band")))
        met = met.select(F.explode(F.filter("line", lambda x: x["depth"] <= up_to)).alias("a"), "leaves", "saved")
        sums = met.groupBy("a.k1", "a.k2").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
        return sums

    banded = own.select("conv", "depth", *_KEY, "leaves", "saved", of_band.alias("at"))
    within = added(banded, F.col("depth"))
    same = (F.col("k1") == F.col("a1")) & (F.col("k2") == F.col("a2"))
    partial = banded.drop("leaves", "saved").join(_renamed(within, a1="k1", a2="k2", leaves="leaves", saved="saved"), same)
    partial = stored(partial.drop("a1", "a2"), "trie-partial")
    done: list[DataFrame] = []
    for at in range(deepest // band, -1, -1):
        here = partial.where(F.col("at") == at)
        if done:
            roots = done[-1].where(F.col("depth") == (at + 1) * band).withColumn("at", F.lit(at).cast("long"))
            coming = _renamed(added(roots, F.col("depth")), a1="k1", a2="k2", more_leaves="leaves", more_saved="saved")
            here = here.join(coming, same, "left").withColumns({
                "leaves": F.col("leaves") + F.coalesce("more_leaves", F.lit(0)),
                "saved": F.col("saved") + F.coalesce("more_saved", F.lit(0)),
            }).drop("a1", "a2", "more_leaves", "more_saved")
        done.append(stored(here, f"trie-band{at}"))
    return reduce(DataFrame.unionByName, done).select(*_KEY, "leaves", "saved")


def _with_parents(own: DataFrame, children: DataFrame) -> DataFrame:
    """Nodes with the smallest member of their parent.

    Parents with more than one in ``HOT_SHARE`` of all nodes as children are that many at most, and are broadcast.
    """
    share = own.count() // HOT_SHARE
    is_parent = (F.col("k1") == F.col("c1")) & (F.col("k2") == F.col("c2"))
    hot = children.where(F.col("n_children") > share).select(F.col("p1").alias("c1"), F.col("p2").alias("c2"))
    hot = own.join(F.broadcast(hot), is_parent).select(F.col("k1").alias("h1"), F.col("k2").alias("h2"), F.col("conv").alias("_hot"))
    hot = stored(hot, "trie-hot")
    known = own.join(F.broadcast(hot), (F.col("p1") == F.col("h1")) & (F.col("p2") == F.col("h2")) & (F.col("depth") > 0), "left")
    known = known.drop("h1", "h2")
    rest = known.where("_hot IS NULL AND depth > 0").join(
        _renamed(own, c1="k1", c2="k2", _cold="conv"), (F.col("p1") == F.col("c1")) & (F.col("p2") == F.col("c2"))
    )
    settled = known.where("_hot IS NOT NULL OR depth = 0")
    return settled.withColumnRenamed("_hot", "parent_conv_id").unionByName(
        rest.drop("_hot", "c1", "c2").withColumnRenamed("_cold", "parent_conv_id")
    )


def ends_hashes(rows: DataFrame) -> DataFrame:
    """For each key where conversations end, the sha256 of their ids, ascending and joined by commas.

    Ids are put in order by ranges and joined ``IDS`` to a row; the hash of a node then runs over those rows in
    order, a batch at a time, so that it never holds all members of a node.
    """
    last = rows.groupBy("conv").agg(F.max_by(F.struct(*_KEY), "depth").alias("end")).select("conv", "end.*")
    ranked_ids = placed(last, _KEY, [F.col("conv")], "rank", "members")
    ids = F.concat_ws(",", F.transform(F.array_sort(F.collect_list("conv")), lambda c: c.cast("string")))
    chunks = ranked_ids.groupBy(*_KEY, F.floor(F.col("rank") / IDS).alias("chunk")).agg(ids.alias("ids"))

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, state = None, None
        out: list[tuple[int, int, str]] = []
        for batch in batches:
            for k1, k2, text in zip(*(batch.column(i).to_pylist() for i in (0, 1, 3))):
                if at != (k1, k2):
                    if at is not None:
                        out.append((*at, state.hexdigest()))
                    at, state = (k1, k2), hashlib.sha256(text.encode())
                else:
                    state.update(b"," + text.encode())
            if out:
                yield _hash_batch(out)
                out = []
        if at is not None:
            yield _hash_batch([(*at, state.hexdigest())])

    dealt = chunks.repartition(*_KEY).sortWithinPartitions(*_KEY, "chunk")
    return dealt.mapInArrow(hashed, "k1 long, k2 long, ends_sha256 string")


def _hash_batch(rows: list[tuple[int, int, str]]) -> pa.RecordBatch:
    k1, k2, digests = zip(*rows)
    return pa.RecordBatch.from_arrays(
        [pa.array(k1, pa.int64()), pa.array(k2, pa.int64()), pa.array(digests)], names=["k1", "k2", "ends_sha256"]
    )


_SQL = f"""
WITH {SQL_BITS},
t AS (SELECT conv_id AS c, coalesce(role, '') AS r, coalesce(text, '') AS x, turn FROM conversations WHERE conv_id IS NOT NULL),
o AS (SELECT c, r, x, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST,
    md5(CAST(octet_length(encode(r)) AS VARCHAR) || ':' || r || x)) - 1 AS p FROM t),
h AS (SELECT c, c - c % {BLOCK} AS b, CAST({sql_crc32("CAST(c AS VARCHAR)")} % {MOST_BORROWED} AS BIGINT) AS h
    FROM (SELECT DISTINCT c FROM t), bits),
g AS (SELECT h.*, least(h, (SELECT count(*) FROM o WHERE o.c = h.b)) AS m FROM h),
q AS (SELECT c, 0 AS d, '' AS r, '' AS x FROM g
    UNION ALL SELECT g.c, o.p + 1, r, x FROM g JOIN o ON o.c = g.b AND o.p < g.m
    UNION ALL SELECT g.c, o.p - g.h + g.m + 1, r, x FROM g JOIN o ON o.c = g.c AND o.p >= g.h),
k AS (SELECT c, d, length(x) AS points, sha256(string_agg(octet_length(encode(r)) || ':' || octet_length(encode(x)) || ':' || r || x, '')
    OVER (PARTITION BY c ORDER BY d)) AS key FROM q),
w AS (SELECT *, lag(key) OVER (PARTITION BY c ORDER BY d) AS parent, lead(key) OVER (PARTITION BY c ORDER BY d) IS NULL AS ends FROM k),
n AS (SELECT d, key, min(c) AS c, count(*) AS n_convs, max(points) AS points, min(parent) AS parent,
    sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (ends), '')) AS ends_sha256 FROM w GROUP BY d, key),
l AS (SELECT n.*, (SELECT count(*) FROM n AS z WHERE z.parent = n.key AND z.d = n.d + 1) AS n_children FROM n),
s AS (SELECT a.key, a.d, sum(CASE WHEN l.n_children = 0 THEN 1 ELSE 0 END) AS n_leaves,
    sum((l.n_convs - 1) * l.points) AS saved_tokens FROM l JOIN k AS a ON a.c = l.c AND a.d <= l.d GROUP BY a.key, a.d)
SELECT l.c AS conv_id, CAST(l.d AS BIGINT) AS depth, u.c AS parent_conv_id, l.n_convs, l.n_children,
    CAST(n_leaves AS BIGINT) AS n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens, l.ends_sha256
FROM l JOIN s ON s.key = l.key AND s.d = l.d LEFT JOIN n AS u ON u.key = l.parent AND u.d = l.d - 1
"""


@query("op12_conversation_trie", _SQL)
def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie(table(spark, sf_dir, "conversations"))
