import pytest
from pyspark.sql import functions as F

from stratalake.operators import joins
from stratalake.operators.joins import find_hot_keys, lookup_join, salted


def rows_of(df):
    return sorted(map(repr, df.select(sorted(df.columns)).collect()))


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows on one key, a third without a key, and copies of one row."""
    n = F.col("id")
    key = F.when(n % 3 == 0, "hot").when(n % 3 == 1, None).otherwise((n % 50).cast("string"))
    facts = spark.range(3000).select(key.alias("k"), n.alias("v"))
    copies = spark.range(500).select(F.lit("hot").alias("k"), F.lit(-1).cast("long").alias("v"))
    return facts.unionByName(copies)


@pytest.fixture(scope="module")
def lookup(spark):
    rows = [("hot", "a"), ("hot", "b"), *[(str(i), f"n{i}") for i in range(0, 60, 2)]]
    return spark.createDataFrame(rows, "k string, name string")


def test_hot_keys_are_found(skewed):
    assert dict(find_hot_keys(skewed, "k", 500).collect()) == {"hot": 3, None: 2}


def test_hot_keys_of_nothing(skewed):
    assert find_hot_keys(skewed.limit(0), "k", 1).collect() == []


@pytest.mark.parametrize("how", ["left", "inner"])
def test_salting_does_not_change_the_result(skewed, lookup, how):
    hot = find_hot_keys(skewed, "k", 100)
    assert set(dict(hot.collect())) >= {"hot", None}
    plain = skewed.join(lookup, "k", how)
    salted = lookup_join(skewed, lookup, "k", how, hot=hot)
    assert salted.columns == plain.columns
    assert rows_of(salted) == rows_of(plain)
    assert rows_of(lookup_join(skewed, lookup, "k", how, broadcast_lookup=True)) == rows_of(plain)
    assert rows_of(lookup_join(skewed, lookup, "k", how)) == rows_of(plain)


def test_salting_with_keys_that_are_not_text(spark):
    facts = spark.range(100).select((F.col("id") % 2).alias("k"), F.col("id").alias("v"))
    lookup = spark.range(2).select(F.col("id").alias("k"), F.col("id").alias("w"))
    hot = find_hot_keys(facts, "k", 10)
    assert set(dict(hot.collect())) == {0, 1}
    salted = lookup_join(facts, lookup, "k", hot=hot)
    assert rows_of(salted) == rows_of(facts.join(lookup, "k", "left"))


def test_hot_rows_and_copies_spread(spark, skewed, lookup):
    """With AQE off, the rows of the hot key and their copies reach several tasks."""
    hot = spark.createDataFrame([("hot", 16), (None, 16)], "__hot string, __salts int")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = lookup_join(skewed.repartition(8), lookup, "k", hot=hot)
        spread = joined.withColumn("task", F.spark_partition_id()).groupBy("k").agg(
            F.count_distinct("task").alias("tasks"),
            F.count_distinct(F.when(F.col("v") == -1, F.col("task"))).alias("copies"),
        )
        tasks = {r["k"]: (r["tasks"], r["copies"]) for r in spread.collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert tasks["hot"][0] > 1 and tasks["hot"][1] > 1 and tasks[None][0] > 1


def test_every_hot_key_is_found(spark):
    facts = spark.range(60_000).select((F.col("id") % 20_000).cast("string").alias("k"))
    assert find_hot_keys(facts, "k", 2).count() == 20_000


def test_other_joins_are_refused(skewed, lookup):
    with pytest.raises(ValueError):
        lookup_join(skewed, lookup, "k", "right")


def test_counts_of_keys_are_added_up_by_several_tasks(spark):
    facts = spark.range(4000).select((F.col("id") % 1000).cast("string").alias("k"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        hot = find_hot_keys(facts, "k", 2)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert hot.count() == 1000
    assert hot.select("_metadata.file_path").distinct().count() > 1


def test_a_key_has_no_more_salts_than_spread_its_rows(spark, skewed, lookup):
    hot = spark.createDataFrame([("hot", 10_000), (None, 10_000), ("2", 2)], "__hot string, __salts int")
    _, right = salted(skewed, lookup, "k", hot)
    most = joins.SALTS_PER_TASK * int(spark.conf.get("spark.sql.shuffle.partitions"))
    repeated = dict(right.groupBy("k").count().collect())
    # Two lookup rows have the hot key.
    assert (repeated["hot"], repeated["2"], repeated["4"]) == (2 * most, 2, 1)
    assert rows_of(lookup_join(skewed, lookup, "k", hot=hot)) == rows_of(skewed.join(lookup, "k", "left"))


@pytest.mark.parametrize("how", ["left", "inner"])
def test_many_hot_keys_shuffle_the_facts_once(spark, skewed, lookup, how, monkeypatch):
    """Of more hot keys than may be broadcast, those with most rows are salted; all rows still meet."""
    monkeypatch.setattr(joins, "BROADCAST_KEYS", 3)
    hot = find_hot_keys(skewed, "k", 10)
    assert hot.count() > 3
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        left, right = salted(skewed, lookup, "k", hot)
        assert "BroadcastHashJoin" in left._jdf.queryExecution().toString()
        assert {r["k"] for r in right.groupBy("k").count().where("count > 2").collect()} == {"hot"}
        assert rows_of(lookup_join(skewed, lookup, "k", how, hot=hot)) == rows_of(skewed.join(lookup, "k", how))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
