from pathlib import Path

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from driver_queries.registry import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"

needs_data = pytest.mark.skipif(not Path(SF_DIR).is_dir(), reason="no driver tables here")

# The queries that show most; tools/check_queries.py runs all of them.
SHOWN = [
    "null_marker_to_null", "income_class", "age_years", "data_size", "null_counts",
    "left_join_customer", "left_join_then_not_null", "product_totals", "slice_scan",
    "replace_slice", "schema_merge", "bronze_ingest", "gold_product_totals", "arrival_ingest",
]


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(repr(tuple(row[i] for i in order)) for row in rows)


@pytest.fixture(scope="module")
def tables():
    con = duckdb.connect()
    for path in Path(SF_DIR).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


@needs_data
@pytest.mark.parametrize("name", SHOWN)
def test_query_agrees_with_its_sql(spark, tables, name):
    df = queries()[name](spark, SF_DIR)
    result = tables.execute(oracle_sql()[name])
    names = [column[0] for column in result.description]
    assert sorted(names) == sorted(df.columns)
    assert rows_of(df.columns, df.collect()) == rows_of(names, result.fetchall())


@needs_data
def test_entry(spark):
    assert entry(spark).columns == [
        "prod_contratado", "valor_total_prod_contratado", "valor_total_limite_credito",
    ]


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(oracle_sql()) <= set(queries())
