"""Merkle manifests: nested intervals of leaf ranks, containment joins for ancestors, proofs of every row."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.llm.common import SQL_BITS, placed, ranked, sql_crc32, stored, table
from stratalake.llm.registry import query

#: Nodes of a run: as many consecutive ones become one node of the level above.
FAN = 8
#: Groups whose numbers are broadcast.
FEW = 100_000
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")

_STEP = "STRUCT<left: STRING, right: STRING>"


def framed(value: Column) -> Column:
    """A value as its UTF-8 byte count, a colon and itself; ``-`` if null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(values: Sequence[Column]) -> Column:
    """The hash of a row: sha256 of its framed values."""
    return F.sha2(F.concat(*map(framed, values)), 256)


def _joined(hashes: Column) -> Column:
    return F.concat_ws("", F.transform(hashes, lambda x: x["hash"]))


@dataclass
class Forest:
    """Trees over ranked leaves, level by level.

    Every node is labelled by its tree and the interval [lo, hi) of leaf ranks it covers; ``n`` is the number of
    leaves of its tree and ``run`` its children, eight at most, with their own intervals. Level 0 is the leaves. A tree
    goes up until one node covers all of [0, n).
    """

    levels: list[DataFrame]
    fan: int

    def tops(self) -> DataFrame:
        """The node of each tree that covers all of its leaves."""
        covering = [level.where("lo = 0 AND hi = n").select("tree", "hash") for level in self.levels]
        return reduce(DataFrame.unionByName, covering)

    def nodes(self) -> DataFrame:
        """All nodes: ``tree``, ``level``, ``lo``, ``hi`` and ``hash``."""
        return reduce(
            DataFrame.unionByName,
            [nodes.select("tree", F.lit(k).alias("level"), "lo", "hi", "hash") for k, nodes in enumerate(self.levels)],
        )

    def attached(self, above: DataFrame) -> DataFrame:
        """The leaves, each with its path: the siblings to the left and right, from its run up to that of the root.

        ``above`` holds, for each tree, the path that goes on from its top and the columns that go along. Going down
        the levels, a node joins the bucket of the level above that its interval lies in; the intervals of that run less
        its own are its siblings, and the path of the parent is the rest of its own. A bucket has eight
        children at most, whatever the tree.
        """
        along = [c for c in above.columns if c not in ("tree", "path")]
        above = above.select(*(F.col(c).alias(f"_{c}") for c in above.columns))
        parents = None
        for k in range(len(self.levels) - 1, -1, -1):
            nodes = self.levels[k]
            found = nodes.join(above, F.col("tree") == F.col("_tree")).where("lo = 0 AND hi = n")
            found = found.select(*nodes.columns, F.col("_path").alias("path"), *(F.col(f"_{c}").alias(c) for c in along))
            if parents is not None:
                bucket = F.floor(F.col("lo") / self.fan ** (k + 1))
                held = parents.select(*(F.col(c).alias(f"_{c}") for c in ("tree", "lo", "hi", "run", "path", *along)))
                held = held.withColumn("_bucket", F.floor(F.col("_lo") / self.fan ** (k + 1)))
                inside = (F.col("lo") >= F.col("_lo")) & (F.col("hi") <= F.col("_hi"))
                step = F.struct(
                    _joined(F.filter("_run", lambda x: x["hi"] <= F.col("lo"))).alias("left"),
                    _joined(F.filter("_run", lambda x: x["lo"] >= F.col("hi"))).alias("right"),
                )
                below = nodes.withColumn("_at", bucket).join(
                    held, (F.col("tree") == F.col("_tree")) & (F.col("_at") == F.col("_bucket")) & inside
                )
                found = found.unionByName(below.select(
                    *nodes.columns,
                    F.concat(F.array(step), F.col("_path")).alias("path"),
                    *(F.col(f"_{c}").alias(c) for c in along),
                ))
            parents = found
        return parents


def grown(leaves: DataFrame, fan: int = FAN) -> Forest:
    """Trees over leaves of ``tree``, ``lo`` (the rank), ``n`` and ``hash``; other columns stay on level 0."""
    leaves = leaves.withColumn("hi", F.col("lo") + 1)
    levels, tallest = [leaves], leaves.agg(F.max("n")).first()[0] or 0
    while fan ** (len(levels) - 1) < tallest:
        below, width = levels[-1], fan ** len(levels)
        run = F.array_sort(F.collect_list(F.struct("lo", "hi", "hash")))
        runs = (
            below.where(F.col("n") > F.lit(width // fan))
            .groupBy("tree", "n", F.floor(F.col("lo") / width).alias("bucket"))
            .agg(run.alias("run"))
        )
        levels.append(stored(
            runs.select(
                "tree", "n", "run", F.col("run")[0]["lo"].alias("lo"), F.element_at("run", -1)["hi"].alias("hi"),
                F.sha2(_joined(F.col("run")), 256).alias("hash"),
            ),
            "merkle-level",
        ))
    return Forest(levels, fan)


@dataclass
class Manifest:
    """The trees of the groups, the tree of their tops in the order of the groups, and the root."""

    groups: DataFrame
    forest: Forest
    crown: Forest
    root: str | None


def merkle_manifest(
    docs: DataFrame,
    columns: Sequence[str] = COLUMNS,
    id_col: str = "doc_id",
    group_col: str = "lang",
    fan: int = FAN,
    carried: dict[str, Column] | None = None,
) -> Manifest:
    """Hash trees over all rows of a table, one for each value of ``group_col``, and one over their tops.

    The leaf of a row is the sha256 of its named columns, each framed by its byte count and ``-`` if null, in hex.
    Leaves of a group are ranked by id, null first, then by leaf; each ``fan`` consecutive nodes become the hash of
    their hashes until one is left. The tops, ordered by group (null first, then bytewise), give the root the same way.
    ``carried`` are further columns that stay with the leaves.

    Null ids, null groups, empty and long texts are values like others; a row that repeats has a leaf for
    each time, and equal rows may change places without changing any hash. A group of one row is its own top. An
    empty table has no nodes and no root. Only the named columns are read.
    """
    rows = docs.select(
        F.col(id_col).alias("id"),
        F.col(group_col).alias("group"),
        leaf_hash([F.col(c) for c in columns]).alias("hash"),
        *(c.alias(name) for name, c in (carried or {}).items()),
        # Equal rows are told apart, so that a table of nothing else still spreads.
        F.monotonically_increasing_id().alias("nth"),
    )
    order = [F.col("id").asc_nulls_first(), F.col("hash"), F.col("nth")]
    leaves = placed(rows, ["group"], order, "lo", "n").drop("nth")
    groups = leaves.where("lo = 0").select("group", "n")
    groups = stored(ranked(groups, [F.col("group").asc_nulls_first()], "tree"), "merkle-groups")
    return _planted(leaves, groups, fan)


def _planted(leaves: DataFrame, groups: DataFrame, fan: int) -> Manifest:
    numbers = groups.select("tree", F.col("group").alias("_group"))
    # The largest groups are broadcast, at most FEW; each of the others then has at most a FEW-th of the rows.
    if groups.count() <= FEW:
        leaves = leaves.join(F.broadcast(numbers), F.col("group").eqNullSafe(F.col("_group"))).drop("_group")
    else:
        large = groups.orderBy(F.desc("n")).limit(FEW)
        known = large.select(F.col("tree").alias("_large"), F.col("group").alias("_group"))
        leaves = leaves.join(F.broadcast(known), F.col("group").eqNullSafe(F.col("_group")), "left").drop("_group")
        rest = leaves.where("_large IS NULL").join(numbers, F.col("group").eqNullSafe(F.col("_group"))).drop("_group", "_large")
        leaves = leaves.where("_large IS NOT NULL").withColumnRenamed("_large", "tree").unionByName(rest)
        leaves = stored(leaves, "merkle-leaves")
    forest = grown(leaves, fan)
    tops = stored(forest.tops(), "merkle-tops")
    crown = grown(tops.select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("lo"), "hash").withColumn("n", F.lit(groups.count())), fan)
    last = crown.tops().first()
    return Manifest(groups, forest, crown, last["hash"] if last else None)


def proofs(manifest: Manifest) -> DataFrame:
    """The leaves with ``path`` (siblings to the left and right, level by level up to the root) and ``subroot``."""
    no_steps = F.array().cast(f"ARRAY<{_STEP}>")
    over = manifest.crown.tops().select("tree", no_steps.alias("path"))
    tops = manifest.crown.attached(over).select(F.col("lo").alias("tree"), "path", F.col("hash").alias("subroot"))
    return manifest.forest.attached(tops)


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its path lead to."""
    return F.aggregate(path, leaf, lambda h, step: F.sha2(F.concat(step["left"], h, step["right"]), 256))


def proof_hash(path: Column) -> Column:
    """sha256 of all siblings, left to right, level by level."""
    return F.sha2(F.concat_ws("", F.transform(path, lambda step: F.concat(step["left"], step["right"]))), 256)


# --- SQL ---------------------------------------------------------------------------------------------

#: Levels that the SQL writes out: more than sixteen million leaves.
_SQL_LEVELS = 8
_CAPITALS, _SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _sql_leaf(text: str) -> str:
    values = ["CAST(doc_id AS VARCHAR)", "source", "lang", "CAST(n_chars AS VARCHAR)", text]
    return "sha256(" + " || ".join(
        f"coalesce(CAST(octet_length(encode({v})) AS VARCHAR) || ':' || {v}, '-')" for v in values
    ) + ")"


def _sql_tree(name: str) -> str:
    """Levels of the trees over ``{name}0`` (tree, i, h), the steps of every leaf and the tops."""
    levels = "".join(
        f"{name}{k + 1} AS (SELECT tree, i // {FAN} AS i, sha256(string_agg(h, '' ORDER BY i)) AS h FROM {name}{k}"
        f" WHERE tree IN (SELECT tree FROM {name}{k} GROUP BY tree HAVING count(*) > 1) GROUP BY tree, i // {FAN}),\n"
        for k in range(_SQL_LEVELS)
    )
    nodes = " UNION ALL ".join(f"SELECT tree, {k} AS k, i, h FROM {name}{k}" for k in range(_SQL_LEVELS + 1))
    widths = "CAST(pow(8, s.k) AS BIGINT)"
    return f"""{levels}{name}_all AS ({nodes}),
{name}_top AS (SELECT tree, arg_max(h, k) AS h, max(k) AS height FROM {name}_all GROUP BY tree),
{name}_side AS (SELECT o.tree, o.i, s.k,
    coalesce(string_agg(s.h, '' ORDER BY s.i) FILTER (s.i < o.i // {widths}), '') AS l,
    coalesce(string_agg(s.h, '' ORDER BY s.i) FILTER (s.i > o.i // {widths}), '') AS r
    FROM {name}0 o JOIN {name}_top t ON t.tree = o.tree JOIN {name}_all s
    ON s.tree = o.tree AND s.k < t.height AND s.i // {FAN} = o.i // {widths} // {FAN} GROUP BY o.tree, o.i, s.k),
{name}_path AS (SELECT tree, i, list({{'l': l, 'r': r}} ORDER BY k) AS path FROM {name}_side GROUP BY tree, i),
"""


_SQL = f"""
WITH {SQL_BITS},
m AS (SELECT doc_id, lang, {_sql_leaf("text")} AS leaf,
    CASE WHEN {sql_crc32("coalesce(CAST(doc_id AS VARCHAR), '')")} % 3 = 0 AND doc_id IS NOT NULL
        THEN {_sql_leaf(f"translate(text, '{_CAPITALS}', '{_SMALL}')")} END AS tampered FROM documents, bits),
r AS (SELECT *, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree,
    row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i FROM m),
a0 AS (SELECT tree, i, leaf AS h FROM r),
{_sql_tree("a")}b0 AS (SELECT 0 AS tree, tree AS i, h FROM a_top),
{_sql_tree("b")}f AS (SELECT r.*, a_top.h AS subroot, (SELECT h FROM b_top) AS root,
    list_concat(coalesce(a_path.path, []), coalesce(b_path.path, [])) AS path
    FROM r JOIN a_top USING (tree) LEFT JOIN a_path USING (tree, i) LEFT JOIN b_path ON b_path.i = r.tree),
g AS (SELECT *, list_reduce(list_prepend({{'l': coalesce(tampered, leaf), 'r': ''}}, path),
    lambda h, s: {{'l': sha256(s.l || h.l || s.r), 'r': ''}}).l AS folded_root FROM f)
SELECT doc_id, leaf, subroot, root, sha256(list_aggregate(list_prepend('', list_transform(path, lambda s: s.l || s.r)),
    'string_agg', '')) AS proof_sha256, folded_root, folded_root = root AS verified FROM g
"""


@query("op13_merkle_manifest", _SQL)
def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    struck = F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")) % 3 == 0
    lowered = F.translate("text", _CAPITALS, _SMALL)
    values = [lowered if c == "text" else F.col(c) for c in COLUMNS]
    manifest = merkle_manifest(docs, carried={"tampered": F.when(struck, leaf_hash(values))})
    found = proofs(manifest)
    root = F.lit(manifest.root).cast("string")
    return found.select(
        F.col("id").alias("doc_id"), F.col("hash").alias("leaf"), "subroot", root.alias("root"),
        proof_hash(F.col("path")).alias("proof_sha256"),
        folded(F.coalesce("tampered", "hash"), F.col("path")).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
