"""A training corpus from raw documents: clean, deduplicate, decontaminate, mix and shard."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.llm.common import in_training_part, placed, stored, table
from stratalake.llm.decontamination import without_items
from stratalake.llm.jaccard import jaccard_links
from stratalake.llm.mixing import mixed
from stratalake.llm.sharding import kd_shards
from stratalake.llm.toxicity import fit_toxicity, score_column

TOXIC_FROM = 0.3
SHARDS = 8


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose restored text scores below ``TOXIC_FROM``; one without text has no toxic words and stays.

    Where the labels are toxic in more than that share, so that a text without any telling word would score
    above it, the share alone is no evidence: the score of such a text is the least that a document must exceed.
    """
    model = fit_toxicity(docs, table(spark, sf_dir, "labels"), in_training_part(F.col("doc_id")))
    clean = F.coalesce(F.length("text"), F.lit(0)) == 0
    plain = 1 / (1 + math.exp(-model.bias))
    score = score_column(model)(F.col("text"))
    kept = score < TOXIC_FROM if plain < TOXIC_FROM else score <= plain + 1e-9
    return docs.where(clean | kept)


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked at five-word shingles and a similarity of 0.8, the one of the smallest id.

    Rows that share an id, or have none, are documents of their own: the first of an id keeps it, all others come
    after every id.
    """
    rows = with_row_ids(docs, "_row")
    linked = jaccard_links(rows, words_per_shingle=5, percent=80, id_col="_row")
    first = linked.where(F.col("component_id") == F.col("doc_id")).select(F.col("doc_id").alias("_kept"))
    return rows.join(first, F.col("_row") == F.col("_kept"), "left_semi").select(*docs.columns)


def with_row_ids(docs: DataFrame, name: str) -> DataFrame:
    """The documents with a number of every row: its id where that is the first of its id, else one beyond all ids."""
    ids = docs.groupBy(F.col("doc_id").alias("_shared")).agg(F.count("*").alias("_n"))
    shared = stored(ids.where("_n > 1 OR _shared IS NULL").select("_shared"), "shared-ids")
    n = shared.count()
    if not n:
        return docs.withColumn(name, F.col("doc_id"))
    # Ids alone; more than that are joined by a shuffle.
    side = F.broadcast(shared) if n <= 1_000_000 else shared
    same = F.col("doc_id").eqNullSafe(F.col("_shared"))
    single = docs.join(side, same, "left_anti").withColumn(name, F.col("doc_id"))
    several = docs.join(side, same, "left_semi").withColumn("_met", F.monotonically_increasing_id())
    counted = placed(several, ["doc_id"], [F.xxhash64("text"), F.col("_met")], "_nth", "_of")
    beyond = F.lit((docs.agg(F.max("doc_id")).first()[0] or 0) + 1) + F.monotonically_increasing_id()
    keeps = (F.col("_nth") == 0) & F.col("doc_id").isNotNull()
    numbered = counted.withColumn(name, F.when(keeps, F.col("doc_id")).otherwise(beyond))
    return single.unionByName(stored(numbered.select(*docs.columns, name), "row-ids"))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window similar to a benchmark item."""
    return without_items(docs, table(spark, sf_dir, "benchmark"))


def mix_to_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it."""
    return mixed(docs)


def place_in_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The shard and slot of every copy."""
    return kd_shards(docs, shards=SHARDS)


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard_join", keep_one_of_each_group),
    ("benchmark_decontamination", drop_contaminated),
    ("source_mixing", mix_to_weights),
    ("sharding", place_in_shards),
]

#: The classifier, the fingerprints and the dependent rounding have no SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder, each stored before the next begins."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
