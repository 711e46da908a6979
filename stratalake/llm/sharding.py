"""Shards by a k-d tree: weighted medians along the widest metadata dimension."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.llm.common import id_hash, numbered, ranked, stored, table, utf8_size
from stratalake.llm.registry import query

#: Ranges a key interval is cut into in one pass of the search for a median.
_RANGES = 1024
#: Distinct values of a dimension, with their ranks, that are broadcast; salts of a value beyond that.
_BROADCAST_BYTES = 8 << 20
_SALTS = 16
DIMENSIONS = ("n_chars", "source", "lang")


def kd_shards(
    docs: DataFrame,
    shards: int | None = None,
    target_bytes: int | None = None,
    dimensions: Sequence[str] = DIMENSIONS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """The shard and slot of every document.

    The root holds all documents and is planned to become ``shards`` leaves, or as many leaves of
    ``target_bytes`` as their bytes need. A node of k planned leaves is cut along the dimension whose
    spread, as a share of its spread over all rows, is widest (the first named, in a tie), where the
    bytes of the lower part come nearest to floor(k/2)/k of the node's. Rows are ordered by the
    dimension and then by id, so that ties are cut as well; rows of one id and one value stay together.
    Each pass narrows the intervals of all nodes of a level at once, by sums over 1,024 ranges.

    Whole numbers order by value, and a null as one below the least; all else by the dense rank of its
    distinct values, text by its UTF-8 bytes and null first. A missing dimension
    is left out. Null text has size 1 and the checksum of no bytes; an empty table gives no rows;
    repeated rows are kept. Rows of equal text are groups for the checksum only: they are not kept together.
    Only the named columns are read, so other columns never clash. Returns
    ``doc_id``, ``size``, ``text_crc32``, ``shard`` and ``slot`` (gapless within a shard).
    """
    if (shards is None) == (target_bytes is None):
        raise ValueError("give either shards or target_bytes")
    present = [d for d in dimensions if d in docs.columns]
    codes = [f"d{i}" for i in range(max(1, len(present)))]
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        (utf8_size(F.col(text_col)) + 1).alias("size"),
        F.crc32(F.encode(F.coalesce(F.col(text_col), F.lit("")), "UTF-8")).alias("text_crc32"),
        F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 62))).alias("key"),
        *([F.col(d).alias(c) for d, c in zip(present, codes)] or [F.lit(0).alias("d0")]),
        F.lit(0).alias("node"),
    )
    for c in codes:
        rows = _coded(rows, c)
    rows = stored(rows, "kd")
    spread = [f(f"d{i}").alias(f"{n}{i}") for i in range(len(codes)) for n, f in (("lo", F.min), ("hi", F.max))]
    whole = rows.agg(F.count("*").alias("n"), F.sum("size").alias("bytes"), *spread).first()
    if shards is None:
        shards = max(1, -(-(whole.bytes or 0) // target_bytes))
    # Planned leaves and the first shard of each node that rows are in.
    plan = {0: (shards, 0)}
    while any(leaves > 1 for leaves, _ in plan.values()):
        measured = {r.node: r for r in rows.groupBy("node").agg(F.sum("size").alias("bytes"), *spread).collect()}
        cuts = {}
        for node, (leaves, _) in plan.items():
            if leaves > 1 and node in measured:
                cuts[node] = _Cut(measured[node], whole, leaves, len(codes))
        _find_cuts(rows, cuts)
        grown: dict[int, tuple[int, int]] = {}
        for node, (leaves, first) in plan.items():
            if leaves == 1 or node not in cuts:
                grown[2 * node + 1] = (1, first)
            else:
                grown[2 * node + 1] = (leaves // 2, first)
                grown[2 * node + 2] = (leaves - leaves // 2, first + leaves // 2)
        rows, plan = stored(_dealt(rows, cuts), "kd"), grown
    firsts = _small(rows.sparkSession, [(n, f) for n, (_, f) in plan.items()], "node long, shard int")
    placed = rows.join(F.broadcast(firsts), "node").select("doc_id", "size", "text_crc32", "shard")
    order = [F.col(c) for c in ("doc_id", "text_crc32", "size")]
    return numbered(placed, "shard", id_hash(F.col("doc_id")), order, whole.n, shards, "slot")


class _Cut:
    """The search for the key at which a node is cut; keys are (dimension value, id)."""

    def __init__(self, node, whole, leaves: int, dimensions: int) -> None:
        def width(i: int) -> float:
            span = whole[f"hi{i}"] - whole[f"lo{i}"]
            return (node[f"hi{i}"] - node[f"lo{i}"]) / span if span else 0.0

        self.dimension = max(range(dimensions), key=lambda i: (width(i), -i))
        self.total, self.left, self.leaves = node.bytes, leaves // 2, leaves
        self.lo, self.hi = node[f"lo{self.dimension}"], node[f"hi{self.dimension}"]
        self.base, self.value, self.key, self.inclusive = 0, None, None, False

    @property
    def goal(self) -> int:
        return self.total * self.left // self.leaves

    def narrow(self, row) -> None:
        """Take the range in which the running sum passes the goal."""
        self.base = row.before
        if row.low != row.high:
            self.lo, self.hi = row.low, row.high
        elif self.value is None:
            self.value, self.lo, self.hi = row.low, row.key_low, row.key_high
        else:
            self.key = row.low
            # The key itself goes to the lower part if that comes nearer to the goal.
            self.inclusive = (2 * row.before + row.bytes) * self.leaves < 2 * self.total * self.left


def _find_cuts(rows: DataFrame, cuts: dict[int, _Cut]) -> None:
    """Narrow all open cuts, one pass over the rows for all of them, until each is a single key."""
    while open_cuts := {n: c for n, c in cuts.items() if c.key is None}:
        table_ = _small(
            rows.sparkSession,
            [(n, c.dimension, c.value, c.lo, c.hi, c.base, c.goal) for n, c in open_cuts.items()],
            "node long, dimension int, value long, lo long, hi long, base long, goal long",
        )
        dims = [c for c in rows.columns if c[0] == "d" and c[1:].isdigit()]
        found = rows.join(F.broadcast(table_), "node").withColumn("code", F.array(*dims)[F.col("dimension")])
        searched = F.when(F.col("value").isNull(), F.col("code")).otherwise(F.col("key"))
        inside = F.col("value").isNull() | (F.col("code") == F.col("value"))
        step = F.ceil((F.col("hi") - F.col("lo") + 1) / _RANGES)
        sums = (
            found.withColumn("at", searched)
            .where(inside & F.col("at").between(F.col("lo"), F.col("hi")))
            .withColumn("range", ((F.col("at") - F.col("lo")) / step).cast("long"))
            .groupBy("node", "base", "goal", "range")
            .agg(F.sum("size").alias("bytes"), F.min("at").alias("low"), F.max("at").alias("high"),
                 F.min("key").alias("key_low"), F.max("key").alias("key_high"))
        )
        running = Window.partitionBy("node").orderBy("low")
        crossing = (
            sums.withColumn("upto", F.col("base") + F.sum("bytes").over(running))
            .where(F.col("upto") > F.col("goal"))
            .withColumn("first", F.row_number().over(running))
            .where("first = 1")
            .withColumn("before", F.col("upto") - F.col("bytes"))
        )
        for row in crossing.collect():  # a row for each node
            cuts[row.node].narrow(row)


def _dealt(rows: DataFrame, cuts: dict[int, _Cut]) -> DataFrame:
    """Rows with the child each belongs to; nodes that are not cut keep all in the lower child."""
    table_ = _small(
        rows.sparkSession,
        [(n, c.dimension, c.value, c.key, c.inclusive) for n, c in cuts.items()],
        "node long, dimension int, value long, cut long, inclusive boolean",
    )
    dims = [c for c in rows.columns if c[0] == "d" and c[1:].isdigit()]
    code = F.array(*dims)[F.col("dimension")]
    upper = (code > F.col("value")) | (
        (code == F.col("value"))
        & ((F.col("key") > F.col("cut")) | ((F.col("key") == F.col("cut")) & ~F.col("inclusive")))
    )
    child = 2 * F.col("node") + F.when(F.coalesce(upper, F.lit(False)), 2).otherwise(1)
    return (
        rows.join(F.broadcast(table_), "node", "left")
        .withColumn("node", child)
        .select(*rows.columns)
    )


def _coded(rows: DataFrame, name: str) -> DataFrame:
    """The rows with a whole number in place of a column, that orders as the column does, null first."""
    kind = rows.schema[name].dataType
    if isinstance(kind, T.IntegralType):
        found = rows.agg(F.min(name).alias("lo"), F.max(name).alias("hi")).first()
        lo, hi = found.lo or 0, found.hi or 0
        # Beyond that, the width of an interval is no long any more.
        if hi - lo < 1 << 62 and lo > -(1 << 63):
            return rows.withColumn(name, F.coalesce(F.col(name).cast("long"), F.lit(lo - 1).cast("long")))
    value = F.col(name) if isinstance(kind, T.NumericType) else F.col(name).cast("string")
    values = rows.where(F.col(name).isNotNull()).select(value.alias("_value")).distinct()
    codes = stored(ranked(values, [F.col("_value")], "_rank"), "kd-codes")
    size = codes.agg(F.sum(F.octet_length(F.col("_value").cast("string")) + 16)).first()[0] or 0
    rows = rows.withColumn("_value_of", value)
    if size <= _BROADCAST_BYTES:
        joined = rows.join(F.broadcast(codes), F.col("_value_of") == F.col("_value"), "left")
    else:
        # One value may hold a third of the rows: each has a row for every salt.
        codes = codes.withColumn("_salt_of", F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))))
        salt = F.pmod(F.xxhash64("key", "text_crc32", "size", F.spark_partition_id()), F.lit(_SALTS)).cast("int")
        joined = rows.withColumn("_salt", salt).join(
            codes, (F.col("_value_of") == F.col("_value")) & (F.col("_salt") == F.col("_salt_of")), "left"
        )
    coded = joined.withColumn(name, F.coalesce(F.col("_rank") + 1, F.lit(0)).cast("long"))
    return coded.select(*[c for c in rows.columns if c != "_value_of"])


def _small(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A table of one row for each node, no more than there are shards, as literals of the plan."""
    names = [c.split() for c in schema.split(", ")]
    if not rows:
        return spark.range(0).select(*(F.lit(None).cast(kind).alias(name) for name, kind in names))
    made = ", ".join("(" + ", ".join("NULL" if v is None else str(v) for v in row) + ")" for row in rows)
    columns = ", ".join(f"CAST({name} AS {kind}) AS {name}" for name, kind in names)
    return spark.sql(f"SELECT {columns} FROM VALUES {made} AS t({', '.join(name for name, _ in names)})")


#: A level of the tree in SQL: spreads, the widest dimension, running sums by key, and the halves.
_SQL_LEVEL = """
s{i} AS (SELECT node, sum(size) AS total, min(d0) AS a0, max(d0) AS b0, min(d1) AS a1, max(d1) AS b1,
    min(d2) AS a2, max(d2) AS b2 FROM n{i} GROUP BY node),
w{i} AS (SELECT node, total,
    coalesce(CAST(b0 - a0 AS DOUBLE) / nullif((SELECT max(d0) - min(d0) FROM m), 0), 0) AS w0,
    coalesce(CAST(b1 - a1 AS DOUBLE) / nullif((SELECT max(d1) - min(d1) FROM m), 0), 0) AS w1,
    coalesce(CAST(b2 - a2 AS DOUBLE) / nullif((SELECT max(d2) - min(d2) FROM m), 0), 0) AS w2 FROM s{i}),
c{i} AS (SELECT n{i}.*, total, CASE WHEN w0 >= w1 AND w0 >= w2 THEN d0 WHEN w1 >= w2 THEN d1 ELSE d2 END AS v
    FROM n{i} JOIN w{i} USING (node)),
k{i} AS (SELECT node, v, key, sum(size) AS b FROM c{i} GROUP BY ALL),
q{i} AS (SELECT *, sum(b) OVER (PARTITION BY node ORDER BY v, key) AS upto FROM k{i}),
n{j} AS (SELECT doc_id, size, crc, key, d0, d1, d2, 2 * node + CASE WHEN 2 * upto - b < total THEN 0 ELSE 1 END AS node
    FROM c{i} JOIN q{i} USING (node, v, key)),"""

_SQL_CODE = "dense_rank() OVER (ORDER BY {c} NULLS FIRST)"

#: Eight shards in SQL; the checksum is folded byte by byte through its table.
_SQL = f"""
WITH bits AS (SELECT list_transform(range(256), lambda n: list_reduce(list_prepend(n, range(8)),
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS crcs),
m AS (SELECT doc_id, CAST(octet_length(encode(coalesce(text, ''))) + 1 AS BIGINT) AS size,
    xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(
        regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda p: CAST('0x' || p AS BIGINT))),
        lambda c, b: xor(c >> 8, crcs[CAST(xor(c, b) & 255 AS BIGINT) + 1]))) AS crc,
    coalesce(doc_id, {-(1 << 62)}) AS key, coalesce(n_chars, (SELECT min(n_chars) - 1 FROM documents)) AS d0,
    {_SQL_CODE.format(c="source")} AS d1, {_SQL_CODE.format(c="lang")} AS d2 FROM documents, bits),
n0 AS (SELECT *, 0 AS node FROM m),{"".join(_SQL_LEVEL.format(i=i, j=i + 1) for i in range(3))}
p AS (SELECT *, CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT)
    % greatest(16, (SELECT count(*) FROM m) // 400000 + 1) AS bucket FROM n3)
SELECT doc_id, size, CAST(crc AS BIGINT) AS text_crc32, 'bytes' AS law, CAST(node AS INTEGER) AS shard,
    row_number() OVER (PARTITION BY node ORDER BY bucket, doc_id NULLS FIRST, crc, size) - 1 AS slot,
    CAST(NULL AS INTEGER) AS grown_shard FROM p
"""


@query("op3_kd_tree_shards", _SQL)
def op3_kd_tree_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = kd_shards(table(spark, sf_dir, "documents"), shards=8)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
