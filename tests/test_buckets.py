import re
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from stratalake.config import ACQUISITIONS, CREDIT_CUSTOMERS, CUSTOMERS, PRODUCTS
from stratalake.errors import BadInput, JobFailed
from stratalake.operators.joins import lookup_join
from stratalake.plans.silver import co_located_parts, silver_credit_customers
from stratalake.sinks.buckets import HOT, BucketLayout, create_layout, layout_scan, put_layout
from stratalake.sinks.tables import write_slices
from stratalake.sources.tables import scan_table, slice_scan

#: Rows of customer 7 (each third and each ninetieth) and without a customer.
HELD = 200 + 7 + 80
DATE, NEXT = "20250415", "20250416"
LAYOUTS = (
    BucketLayout(ACQUISITIONS, "cliente_id", 4, split_hot=True),
    BucketLayout(CUSTOMERS, "client_id", 4),
)


def sales(spark, n=600):
    """A third of one customer, some without, some of customers that nobody knows."""
    rows = [
        (str(i), "7" if i % 3 == 0 else None if i % 5 == 1 else str(i % 90), str(i % 5), f"{i}.50") for i in range(n)
    ]
    return spark.createDataFrame(rows, "id string, cliente_id string, produto_id string, valor_aquisicao string")


def masters(spark):
    rows = [(str(i), f"{i:011d}", "1980-01-01", str(i * 100), "x" * 50) for i in range(80)]
    return spark.createDataFrame(rows, "client_id string, cpf string, data_nascimento string, renda string, nome string")


@pytest.fixture
def small(spark, lake):
    lake = replace(lake, rows_per_task=50, broadcast_chars=3000)
    write_slices(spark, lake, ACQUISITIONS, sales(spark), [DATE])
    write_slices(spark, lake, CUSTOMERS, masters(spark), [DATE])
    products = [(str(i), f"p{i}", "c", "9.00" if i else None) for i in range(5)]
    goods = spark.createDataFrame(products, "produto_id string, nome string, categoria string, limite_credito string")
    write_slices(spark, lake, PRODUCTS, goods, [DATE])
    return lake


def laid_out(spark, lake, load_date=DATE):
    return [put_layout(spark, lake, layout, load_date) for layout in LAYOUTS]


def rows(df):
    return sorted(map(repr, df.collect()))


def test_layout_holds_the_slice_with_hot_keys_apart(spark, small):
    found = laid_out(spark, small)
    # Customer 7 and null are the keys of more than 50 rows.
    assert found[0] == {0: 600 - HELD, 1: HELD} and found[1] == {0: 80}
    for layout, names in ((LAYOUTS[0], ["id", "cliente_id"]), (LAYOUTS[1], ["client_id", "cpf"])):
        even, hot = layout_scan(spark, small, layout, DATE)
        whole = even if hot is None else even.unionByName(hot)
        assert rows(whole.select(names)) == rows(slice_scan(spark, small, layout.source, DATE, names))
    even, hot = layout_scan(spark, small, LAYOUTS[0], DATE)
    assert {r.cliente_id for r in hot.select("cliente_id").distinct().collect()} == {"7", None}
    # One file a bucket, and no task of the hot rows with more than its share.
    assert even.select("_metadata.file_path").distinct().count() <= 4
    most = hot.groupBy("_metadata.file_path").count().agg(F.max("count")).first()[0]
    assert most < 150


def test_hot_rows_take_no_more_tasks_than_a_shuffle_has(spark, small):
    put_layout(spark, replace(small, rows_per_task=1), LAYOUTS[0], DATE)
    even, hot = layout_scan(spark, small, LAYOUTS[0], DATE)
    assert even.count() + hot.count() == 600 and hot.count() > 100
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # A task has a file for each bucket.
    assert hot.select("_metadata.file_path").distinct().count() <= tasks * LAYOUTS[0].buckets


def test_even_rows_join_without_an_exchange(spark, small):
    laid_out(spark, small)
    (even, customers, plan), (hot, met, near) = co_located_parts(spark, small, DATE, LAYOUTS)
    joined = lookup_join(even.withColumnRenamed("cliente_id", "client_id"), customers, "client_id", hot=plan.hot_customers)
    text = joined._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in text and "Exchange" not in text
    assert len(re.findall("Bucketed: true|SelectedBucketsCount", text)) >= 2
    assert near.broadcast_customers and met.count() == 1 and hot.count() == HELD


@pytest.mark.parametrize("chars", [3000, 0])
def test_silver_is_the_same_with_layouts(spark, small, chars):
    small = replace(small, broadcast_chars=chars)
    silver_credit_customers(spark, small, DATE)
    want = rows(scan_table(spark, small, CREDIT_CUSTOMERS))
    with pytest.raises(JobFailed, match="no layout"):
        silver_credit_customers(spark, small, DATE, layouts=LAYOUTS)
    laid_out(spark, small)
    metrics = silver_credit_customers(spark, small, DATE, layouts=LAYOUTS)
    assert rows(scan_table(spark, small, CREDIT_CUSTOMERS)) == want and len(want) == 480
    assert metrics["qtd_total_rows_insert"] == metrics["qts_total_rows_insert_verify"] == 480


def test_layouts_that_are_out_of_date_are_refused_and_put_again(spark, small):
    laid_out(spark, small)
    fewer = sales(spark).where("id % 3 <> 0 AND cliente_id IS NOT NULL")
    write_slices(spark, small, ACQUISITIONS, fewer, [DATE])
    with pytest.raises(BadInput, match="out of date"):
        layout_scan(spark, small, LAYOUTS[0], DATE)
    # No key is hot any more: the partition of hot rows goes.
    n = fewer.count()
    assert put_layout(spark, small, LAYOUTS[0], DATE) == {0: n}
    even, hot = layout_scan(spark, small, LAYOUTS[0], DATE)
    assert hot is None and even.count() == n
    # Only hot rows, then none; other dates stay.
    write_slices(spark, small, ACQUISITIONS, sales(spark), [NEXT])
    put_layout(spark, small, LAYOUTS[0], NEXT)
    write_slices(spark, small, ACQUISITIONS, sales(spark).where("cliente_id = '7'"), [DATE])
    assert put_layout(spark, small, LAYOUTS[0], DATE) == {1: sales(spark).where("cliente_id = '7'").count()}
    write_slices(spark, small, ACQUISITIONS, sales(spark).limit(0), [DATE])
    assert put_layout(spark, small, LAYOUTS[0], DATE) == {}
    assert sum(f.count() for f in layout_scan(spark, small, LAYOUTS[0], NEXT)) == 600


def test_new_columns_and_other_bucket_numbers(spark, small):
    laid_out(spark, small)
    write_slices(spark, small, CUSTOMERS, masters(spark).withColumn("apelido", F.lit("a")), [DATE])
    put_layout(spark, small, LAYOUTS[1], DATE)
    even, _ = layout_scan(spark, small, LAYOUTS[1], DATE)
    assert {r.apelido for r in even.collect()} == {"a"} and HOT not in even.columns
    with pytest.raises(BadInput, match="8 buckets"):
        create_layout(spark, small, replace(LAYOUTS[1], buckets=8))
    with pytest.raises(ValueError, match="same number"):
        co_located_parts(spark, small, DATE, (LAYOUTS[0], replace(LAYOUTS[1], buckets=8)))
