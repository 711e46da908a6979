"""Source mixes by pivotal dependent rounding of fractional copies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.llm.common import placed, ranked, stored, table, unit_interval, word_count
from stratalake.llm.registry import query

#: Copy probabilities are whole multiples of 2^-30, so that transfers of mass are exact.
_BITS = 30
_ONE = 1 << _BITS
#: Most documents, or survivors of the level below, that are rounded together.
FAN_IN = 256
#: Equal rows that are written out together.
CHUNK = 10_000

_FIELDS = "id BIGINT, size BIGINT, rows BIGINT, sure BIGINT, mass BIGINT, luck BIGINT"
_UNIT = "STRUCT<" + ", ".join(f.replace(" ", ": ") for f in _FIELDS.split(", ")) + ">"
_DONE = "STRUCT<id: BIGINT, size: BIGINT, rows: BIGINT, sure: BIGINT, extra: INT>"


def _done(unit: str, extra: int) -> str:
    return f"array(named_struct('id', {unit}.id, 'size', {unit}.size, 'rows', {unit}.rows, 'sure', {unit}.sure, 'extra', {extra}))"


def _kept(unit: str, mass: str) -> str:
    return (
        f"named_struct('id', {unit}.id, 'size', {unit}.size, 'rows', {unit}.rows, 'sure', {unit}.sure, "
        f"'mass', {mass}, 'luck', {unit}.luck)"
    )


def _state(left: str, done: str) -> str:
    return f"named_struct('left', {left}, 'done', concat(s.done, {done}))"


#: One fold over an ordered array of units. The unit left over meets the next one: mass moves at random
#: from one to the other, keeping both expectations, until one of them has no copy more or one copy more.
_FOLD = f"""
aggregate(units,
  named_struct('left', CAST(NULL AS {_UNIT}), 'done', CAST(array() AS ARRAY<{_DONE}>)),
  (s, x) -> CASE
    WHEN s.left IS NULL THEN named_struct('left', x, 'done', s.done)
    WHEN s.left.mass + x.mass < {_ONE} THEN
      IF(x.luck * (s.left.mass + x.mass) < x.mass * {_ONE},
         {_state(_kept("x", "s.left.mass + x.mass"), _done("s.left", 0))},
         {_state(_kept("s.left", "s.left.mass + x.mass"), _done("x", 0))})
    WHEN s.left.mass + x.mass = {_ONE} THEN
      IF(x.luck < x.mass,
         {_state(f"CAST(NULL AS {_UNIT})", f"concat({_done('s.left', 0)}, {_done('x', 1)})")},
         {_state(f"CAST(NULL AS {_UNIT})", f"concat({_done('s.left', 1)}, {_done('x', 0)})")})
    ELSE
      IF(x.luck * ({2 * _ONE}L - s.left.mass - x.mass) < ({_ONE} - x.mass) * {_ONE},
         {_state(_kept("x", f"s.left.mass + x.mass - {_ONE}"), _done("s.left", 1))},
         {_state(_kept("s.left", f"s.left.mass + x.mass - {_ONE}"), _done("x", 1))})
  END)
"""


def mix_sources(
    docs: DataFrame,
    weights: tuple[int, ...] = (1, 2, 3),
    total_share: float = 1.0,
    max_repeat: int = 3,
    seed: int = 8,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """Whole copies of documents whose words come near a target for each source.

    Sources in code point order, null last, weigh ``weights`` in turn and share ``total_share`` of all
    words; a target stops at ``max_repeat`` times the words of its source, and the excess goes to the
    others by weight until none is above. Every document of a source is due target/words copies: the
    whole part is given, the rest is a copy probability rounded by pairs. Documents of a source are
    dealt by size class, at most some 256 to a group; in each group probability mass moves at random
    between two documents until one of them is whole. What is left of a group, one document at most,
    meets those of the other groups of its class, 256 at a time, level by level, then of the classes
    from large to small; the last one of a source is decided by its own luck. Neighbours in size make up
    for each other, so a source misses its target by less than its longest document. Luck is a hash of
    the id and ``seed``: reruns agree.

    Null or empty text has no words and is taken 0 words. Rows of one id, size and source cannot be told apart: as
    many of them as their probabilities add up to get one copy more, and only what is left of the sum, less than
    one row, is rounded with the others. An empty table gives no rows; only the named columns are read. Returns ``doc_id``,
    ``size``, ``source``, ``source_size``, ``target``, ``copies`` and ``taken`` for every row.
    """
    units = decided_copies(docs, weights, total_share, max_repeat, seed, id_col, text_col, source_col)
    return _each_row(units).select(
        "doc_id", "size", "source", "source_size", "target", "copies", (F.col("size") * F.col("copies")).alias("taken")
    )


def _each_row(units: DataFrame) -> DataFrame:
    """A row for each row of a unit, with its ``copies``: the first ``extras`` have one more than the others.

    A unit of many rows is cut to ``CHUNK`` of them first, and those are dealt out.
    """

    def numbered_from(start, rows) -> Column:
        return F.explode(F.sequence(start + 1, start + rows))

    few = units.where(F.col("rows") <= CHUNK).withColumn("nth", numbered_from(F.lit(0).cast("long"), F.col("rows")))
    many = units.where(F.col("rows") > CHUNK)
    starts = F.sequence(F.lit(0).cast("long"), F.col("rows") - 1, F.lit(CHUNK).cast("long"))
    many = many.withColumn("start", F.explode(starts)).repartition("doc_id", "start")
    many = many.withColumn("nth", numbered_from(F.col("start"), F.least(F.lit(CHUNK), F.col("rows") - F.col("start")))).drop("start")
    more = F.when(F.col("nth") <= F.col("extras"), 1).otherwise(0)
    return few.unionByName(many).withColumn("copies", F.col("whole") + more)


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **how) -> DataFrame:
    """The documents, each row as often as :func:`mix_sources` takes it, with their own columns."""
    units = decided_copies(docs, id_col=id_col, text_col=text_col, source_col=source_col, **how)
    units = stored(units.where("whole + extras > 0"), "mix-decided")
    # Rows of a unit that get the same copies need not be told apart.
    alike = F.col("extras").isin(0) | (F.col("extras") == F.col("rows"))
    even = units.where(alike).withColumn("copies", F.col("whole") + F.when(F.col("extras") > 0, 1).otherwise(0))
    taken = _of_units(docs, even, ["copies"], id_col, text_col, source_col)
    uneven = units.where(~alike)
    if not uneven.isEmpty():
        met = _of_units(docs, uneven, ["rows", "whole", "extras"], id_col, text_col, source_col)
        met = met.withColumns({
            "_mix_id": F.col(id_col).cast("long"), "_mix_of": F.col(source_col), "_mix_words": word_count(F.col(text_col)),
            "_mix_hash": F.xxhash64(text_col), "_mix_row": F.monotonically_increasing_id(),
        })
        keys = ["_mix_id", "_mix_of", "_mix_words"]
        order = [F.col("_mix_hash"), F.col("_mix_row")]
        placed_rows = placed(met, keys, order, "_mix_nth", "_mix_n")
        copies = F.col("_mix_whole") + F.when(F.col("_mix_nth") < F.col("_mix_extras"), 1).otherwise(0)
        chosen = placed_rows.withColumn("_mix_copies", copies).where("_mix_copies > 0")
        taken = taken.unionByName(chosen.select(*docs.columns, "_mix_copies"))
    return taken.withColumn("_mix_copy", F.explode(F.sequence(F.lit(1), F.col("_mix_copies")))).select(*docs.columns)


def _of_units(docs: DataFrame, units: DataFrame, along: list[str], id_col: str, text_col: str, source_col: str) -> DataFrame:
    """The documents of some units, with columns of their unit."""
    held = units.select(*(F.col(c).alias(f"_mix_{c}") for c in ("doc_id", "size", "source", *along)))
    same = (
        F.col(id_col).cast("long").eqNullSafe(F.col("_mix_doc_id"))
        & F.col(source_col).eqNullSafe(F.col("_mix_source"))
        & (word_count(F.col(text_col)) == F.col("_mix_size"))
    )
    return docs.join(held, same).select(*docs.columns, *(f"_mix_{c}" for c in along))


def decided_copies(
    docs: DataFrame,
    weights: tuple[int, ...] = (1, 2, 3),
    total_share: float = 1.0,
    max_repeat: int = 3,
    seed: int = 8,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """The copies of each distinct id, size and source: ``rows`` rows get ``whole`` copies, ``extras`` of them one more."""
    read = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        word_count(F.col(text_col)).alias("size"),
        F.col(source_col).alias("source"),
    )
    units = stored(read.groupBy("doc_id", "size", "source").agg(F.count("*").alias("rows")), "mix-units")
    targets = source_targets(units, weights, total_share, max_repeat)
    due = F.when(F.col("source_size") > 0, F.least(F.col("target") / F.col("source_size"), F.lit(float(max_repeat))))
    due = F.coalesce(due, F.lit(0.0))
    sources = targets.withColumns({
        "whole": F.floor(due).cast("int"),
        "mass": F.round((due - F.floor(due)) * _ONE).cast("long"),
    }).withColumns({
        "whole": F.col("whole") + F.when(F.col("mass") == _ONE, 1).otherwise(0),
        "mass": F.when(F.col("mass") == _ONE, 0).otherwise(F.col("mass")).cast("long"),
    })
    # Not stored: the units are read again for each use, for less than writing them a second time.
    keyed = (
        units.join(sources.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source")))
        .drop("_source")
        # The probabilities of equal rows add up: so many rows for sure, and a probability that is left.
        .withColumns({
            "sure": F.shiftright(F.col("rows") * F.col("mass"), _BITS),
            "mass": F.pmod(F.col("rows") * F.col("mass"), F.lit(_ONE)),
        })
    )
    decided = _rounded(keyed.where("mass > 0"), seed).join(
        sources.select("rank", "source", "source_size", "target", "whole"), "rank"
    )
    settled = keyed.where("mass = 0").withColumn("extra", F.lit(0))
    columns = ["doc_id", "size", "source", "source_size", "target", "whole", "rows", "sure", "extra"]
    return (
        settled.select(*columns).unionByName(decided.select(*columns))
        .withColumn("extras", F.col("sure") + F.col("extra"))
        .select("doc_id", "size", "source", "rows", "source_size", "target", "whole", "extras")
    )


def source_targets(units: DataFrame, weights: tuple[int, ...], total_share: float, max_repeat: int) -> DataFrame:
    """Rank, words and target of each source; one aggregate over the sources for each round of resharing."""
    sums = units.groupBy("source").agg(F.sum(F.col("size") * F.col("rows")).alias("source_size"))
    order = [F.col("source").asc_nulls_last()]
    sources = stored(
        ranked(sums, order, "rank")
        .withColumn("weight", F.array(*map(F.lit, weights))[F.pmod("rank", F.lit(len(weights))).cast("int")])
        .withColumn("cap", F.col("source_size") * max_repeat),
        "mix-sources",
    )
    total = (sources.agg(F.sum("source_size")).first()[0] or 0) * total_share
    unit, capped = 0.0, -1
    while True:
        above = F.col("weight") * unit > F.col("cap")
        held = sources.agg(
            F.count(F.when(above, 1)).alias("n"),
            F.sum(F.when(above, F.col("cap"))).alias("cap"),
            F.sum(F.when(~above, F.col("weight"))).alias("weight"),
        ).first()
        if held.n == capped or not held.weight:
            break
        capped, unit = held.n, max(0.0, total - (held.cap or 0)) / held.weight
    target = F.least(F.col("weight") * F.lit(unit), F.col("cap").cast("double"))
    return sources.select("rank", "source", "source_size", target.alias("target"))


def _rounded(units: DataFrame, seed: int) -> DataFrame:
    """0 or 1 copies more for each unit: (rank, doc_id, size, rows, sure, extra)."""
    spark = units.sparkSession
    level = units.select(
        "rank",
        F.floor(F.log(1.0 + F.col("size")) / F.log(F.lit(1.3))).cast("int").alias("class"),
        F.col("doc_id").alias("id"), "size", "rows", "sure", "mass",
    )
    counts = level.groupBy("rank", "class").agg(F.count("*").alias("n"))
    sized = level.join(counts, ["rank", "class"]).withColumn(
        "group", F.pmod(F.xxhash64("id", "size", F.lit(seed)), F.ceil(F.col("n") / FAN_IN).cast("long"))
    )
    results, depth = [], 0
    while True:
        folded = stored(_fold(sized, ["rank", "class", "group"], seed, depth), f"mix-level{depth}")
        results.append(folded)
        depth += 1
        last = folded.agg(F.max("group")).first()[0]
        sized = _survivors(folded, "rank", "class", "group").withColumn("group", F.floor(F.col("group") / FAN_IN))
        if not last:
            break
    # Classes of one source: a hundred at most, since sizes are 64-bit numbers and classes grow by 1.3.
    roots = stored(_fold(sized.drop("group"), ["rank"], seed, depth, by_class=True), "mix-roots")
    results.append(roots)
    decided = None
    for folded in results:
        done = folded.select("rank", F.explode("state.done").alias("u")).select("rank", "u.*")
        decided = done if decided is None else decided.unionByName(done)
    left = _survivors(roots, "rank")
    luck = unit_interval(F.col("id"), F.lit(seed), F.lit(depth + 1), bits=_BITS)
    last_ones = left.select("rank", "id", "size", "rows", "sure", F.when(luck < F.col("mass"), 1).otherwise(0).alias("extra"))
    return decided.unionByName(last_ones).withColumnRenamed("id", "doc_id")


def _survivors(folded: DataFrame, *keys: str) -> DataFrame:
    return folded.where("state.left IS NOT NULL").select(*keys, "state.left.*").drop("luck")


def _fold(units: DataFrame, keys: list[str], seed: int, depth: int, by_class: bool = False) -> DataFrame:
    """Rounds the units of each group in order of falling size; groups hold some 256 units."""
    luck: Column = unit_interval(F.col("id"), F.lit(seed), F.lit(depth), bits=_BITS)
    unit = F.struct("id", "size", "rows", "sure", "mass", luck.alias("luck"))
    first = F.struct((-F.col("class") if by_class else F.lit(0)).alias("c"), (-F.col("size")).alias("o"),
                     F.col("id").alias("i"), unit.alias("unit"))
    ordered = F.transform(F.sort_array(F.collect_list(first)), lambda x: x["unit"])
    return units.groupBy(*keys).agg(ordered.alias("units")).select(*keys, F.expr(_FOLD).alias("state"))


@query("op8_pivotal_mix")
def op8_pivotal_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken", "copies"
    )
