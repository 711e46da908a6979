"""Operators against plain Python over generated values."""

import random
from datetime import date, timedelta
from decimal import Decimal
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from stratalake import workspace
from stratalake.functions.customer import age_years, income_class
from stratalake.functions.text import null_marker_to_null
from stratalake.operators.joins import find_hot_keys, lookup_join
from stratalake.operators.profile import data_size
from stratalake.operators.totals import product_totals

CLASSES = ["Classe E", "Classe D", "Classe C", "Classe B", "Classe A"]


def test_income_classes_are_total_and_monotone(spark):
    band = income_class(F.col("id").cast("string")).alias("c")
    incomes = spark.range(0, 10000).select("id", band)
    ranks = [CLASSES.index(row["c"]) for row in incomes.orderBy("id").collect()]
    assert ranks == sorted(ranks) and set(ranks) == set(range(5))


def test_income_classes_by_hand(spark):
    rng = random.Random(7)
    texts = [f"{rng.randint(-50, 9999)}.{rng.randint(0, 99):02d}" for _ in range(500)]
    df = spark.createDataFrame([(t,) for t in texts], "v string")

    def expected(text):
        amount = int(float(text))
        for upper, name in zip([521, 1042, 4427, 8856], CLASSES):
            if amount <= upper:
                return name
        return CLASSES[-1]

    got = df.select("v", income_class(F.col("v")).alias("c")).collect()
    assert all(row["c"] == expected(row["v"]) for row in got)


def test_null_markers_by_hand(spark):
    rng = random.Random(8)
    parts = [" ", "NULL", "null", "Null", "x", "\t", ""]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 4))) for _ in range(500)]
    df = spark.createDataFrame([(t,) for t in texts], "v string")
    got = df.select("v", null_marker_to_null("v").alias("n")).collect()
    for row in got:
        assert row["n"] == (None if row["v"].strip(" ") in ("NULL", "null") else row["v"])


def test_ages_by_hand(spark):
    as_of = date(2025, 4, 16)
    births = [as_of - timedelta(days=n) for n in range(0, 40000, 61)]
    df = spark.createDataFrame([(str(b),) for b in births], "v string")
    got = df.select("v", age_years(F.col("v"), as_of).alias("a")).collect()
    want = {str(b): str(int((as_of - b).days // 365.25)) for b in births}
    assert {row["v"]: row["a"] for row in got} == want


def test_salted_joins_by_hand(spark):
    rng = random.Random(9)
    for _ in range(3):
        keys = ["hot"] * 300 + [None] * 200 + [str(rng.randint(0, 40)) for _ in range(400)]
        facts = [(k, i) for i, k in enumerate(keys)]
        lookup = [("hot", 1)] + [(str(rng.randint(0, 30)), i) for i in range(40)]
        left = spark.createDataFrame(facts, "k string, v int").repartition(5)
        right = spark.createDataFrame(lookup, "k string, w int")
        hot = find_hot_keys(left, "k", 50)
        got = sorted(map(tuple, lookup_join(left, right, "k", hot=hot).collect()), key=str)
        want = []
        for k, v in facts:
            matches = [w for other, w in lookup if k is not None and other == k]
            want += [(k, v, w) for w in matches] or [(k, v, None)]
        assert got == sorted(want, key=str)


def test_totals_by_hand(spark):
    rng = random.Random(10)
    rows = [
        (f"p{rng.randint(0, 5)}", f"{rng.randint(0, 10**9) / 100:.2f}", f"{rng.randint(1, 9)}00.00")
        for _ in range(2000)
    ]
    schema = "prod_contratado string, valor_prod_contratado string, limite_credito string"
    got = product_totals(spark.createDataFrame(rows, schema)).collect()
    for name, value, limit in got:
        mine = [row for row in rows if row[0] == name]
        assert value == float(sum(Decimal(row[1]) for row in mine))
        assert limit == float(sum(Decimal(row[2]) for row in mine))


def test_data_size_by_hand(spark):
    rng = random.Random(11)
    texts = [None, "", "á", 'a"b', "x" * 50]
    rows = [(rng.choice(texts), rng.choice([None, "ç ã"])) for _ in range(300)]
    df = spark.createDataFrame(rows, "primeira string, b string")
    assert data_size(df).first()["chars"] == sum(len(str(row)) for row in df.collect())


def session(master, setting=None):
    known = {"spark.checkpoint.dir": setting, "spark.sql.warehouse.dir": "file:/w/"}
    conf = SimpleNamespace(get=lambda name, default=None: known[name] or default)
    return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master))


def test_scratch_is_shared_on_a_cluster():
    assert workspace.shared_root(session("yarn", "hdfs:///ck/")) == "hdfs:///ck"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        workspace.shared_root(session("yarn"))
    assert workspace.shared_root(session("local[2]")) == "file:/w/_scratch"
    one = workspace.new_folder(session("yarn", "/ck"), "x")
    assert one.startswith("/ck/stratalake/x-")
