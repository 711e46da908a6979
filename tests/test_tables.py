from concurrent.futures import ThreadPoolExecutor
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from stratalake.config import ACQUISITIONS, ALL_TABLES, CUSTOMERS, PRODUCT_TOTALS, PRODUCTS
from stratalake.operators.quality import hash_totals, row_hash
from stratalake.schemas import LOAD_DATE
from stratalake.sinks import tables
from stratalake.sinks.runlog import RunLog, metrics_sink, run_log
from stratalake.sinks.tables import (
    _open_files,
    audit_slice,
    create_lake,
    create_table,
    slices,
    table_exists,
    write_slices,
)
from stratalake.sources.tables import scan_table

D1, D2, D3 = "20250415", "20250416", "20250417"


def products(spark, *names):
    rows = [(str(i), name) for i, name in enumerate(names)]
    return spark.createDataFrame(rows, "produto_id string, nome string")


def stored(spark, lake, table=PRODUCTS):
    rows = scan_table(spark, lake, table).select("nome", LOAD_DATE)
    return sorted(map(tuple, rows.collect()))


def test_tables_are_described(spark, lake):
    create_lake(spark, lake)
    for table in ALL_TABLES:
        assert table_exists(spark, lake, table)
        columns = spark.catalog.listColumns(table.full_name(lake))
        assert [c.name for c in columns] == table.schema.names
        assert [c.name for c in columns if c.isPartition] == [LOAD_DATE]
        assert all(c.description for c in columns)
    types = dict(scan_table(spark, lake, PRODUCT_TOTALS).dtypes)
    assert types["valor_total_limite_credito"] == "double" and types[LOAD_DATE] == "string"


def test_append_doubles_a_slice(spark, lake):
    for _ in range(2):
        write_slices(spark, lake, PRODUCTS, products(spark, "a"), [D1], "append")
    assert stored(spark, lake) == [("a", D1), ("a", D1)]


def test_replace_slice_keeps_the_others_and_repeats_safely(spark, lake):
    write_slices(spark, lake, PRODUCTS, products(spark, "a"), [D1])
    write_slices(spark, lake, PRODUCTS, products(spark, "b"), [D2])
    for _ in range(2):
        assert write_slices(spark, lake, PRODUCTS, products(spark, "c", "d"), [D1])["rows"] == 2
    assert stored(spark, lake) == [("b", D2), ("c", D1), ("d", D1)]


def test_overwrite_table_keeps_the_last(spark, lake):
    write_slices(spark, lake, PRODUCTS, products(spark, "a"), [D1])
    write_slices(spark, lake, PRODUCTS, products(spark, "b"), [D2], "overwrite_table")
    assert stored(spark, lake) == [("b", D2)] and slices(spark, lake, PRODUCTS) == [D2]
    folders = [p.name for p in Path(PRODUCTS.path(lake)).iterdir() if p.is_dir()]
    assert folders == [f"{LOAD_DATE}={D2}"]


def test_an_empty_replacement_empties_the_slice(spark, lake):
    write_slices(spark, lake, PRODUCTS, products(spark, "a"), [D1])
    write_slices(spark, lake, PRODUCTS, products(spark, "b"), [D2])
    write_slices(spark, lake, PRODUCTS, products(spark, "x").limit(0), [D1])
    assert stored(spark, lake) == [("b", D2)]


def test_several_slices_of_which_one_is_empty(spark, lake):
    write_slices(spark, lake, PRODUCTS, products(spark, "old"), [D1])
    rows = products(spark, "a", "b").withColumn(
        LOAD_DATE, F.when(F.col("nome") == "a", D2).otherwise(D3)
    )
    write_slices(spark, lake, PRODUCTS, rows, [D1, D2, D3])
    assert stored(spark, lake) == [("a", D2), ("b", D3)]


@pytest.mark.parametrize("dates", [[D1], [D1, D2]])
def test_a_row_of_another_date_fails_the_write(spark, lake, dates):
    write_slices(spark, lake, PRODUCTS, products(spark, "old"), [D1])
    rows = products(spark, "a", "b").withColumn(
        LOAD_DATE, F.when(F.col("nome") == "a", D1).otherwise(D3)
    )
    with pytest.raises(Exception, match="another load date"):
        write_slices(spark, lake, PRODUCTS, rows, dates)
    assert stored(spark, lake) == [("old", D1)]


def test_slices_side_by_side_need_no_sort(spark, lake):
    name, seen = "spark.sql.maxConcurrentOutputFileWriters", []
    before = spark.conf.get(name)
    for n in (1, 3, 9):
        with _open_files(spark, n):
            seen.append(spark.conf.get(name))
        assert spark.conf.get(name) == before
    assert seen == [before, "3", before]
    rows = products(spark, "a", "b", "c", "d").coalesce(1)
    dates = F.array(*[F.lit(d) for d in (D1, D2, D3)])
    write_slices(spark, lake, PRODUCTS, rows.withColumn(LOAD_DATE, F.explode(dates)), [D1, D2, D3])
    assert stored(spark, lake) == sorted((n, d) for n in "abcd" for d in (D1, D2, D3))
    assert all(audit_slice(spark, lake, PRODUCTS, d).files == 1 for d in (D1, D2, D3))


def test_unknown_mode(spark, lake):
    with pytest.raises(ValueError, match="upsert"):
        write_slices(spark, lake, PRODUCTS, products(spark, "a"), [D1], "upsert")


def test_a_new_column_extends_the_table(spark, lake):
    write_slices(spark, lake, PRODUCTS, products(spark, "a"), [D1])
    more = products(spark, "b").withColumn("Canal novo", F.lit("web"))
    write_slices(spark, lake, PRODUCTS, more, [D2])
    rows = scan_table(spark, lake, PRODUCTS).select("nome", "Canal novo", "descricao")
    assert sorted(map(tuple, rows.collect()), key=str) == [
        ("a", None, None), ("b", "web", None),
    ]
    write_slices(spark, lake, PRODUCTS, products(spark, "c"), [D3])
    assert scan_table(spark, lake, PRODUCTS).where("`Canal novo` IS NULL").count() == 2


def test_typed_input_is_stored_as_the_table_says(spark, lake):
    typed = spark.sql("SELECT 7 AS produto_id, 'a' AS NOME, 2.50BD AS limite_credito")
    write_slices(spark, lake, PRODUCTS, typed, [D1])
    row = scan_table(spark, lake, PRODUCTS).first()
    assert (row["produto_id"], row["nome"], row["limite_credito"]) == ("7", "a", "2.50")


def test_totals_and_helper_columns(spark, lake):
    rows = products(spark, "a", "bc").withColumn("__chars", F.length("nome"))
    found = write_slices(
        spark, lake, PRODUCTS, rows, [D1], totals={"chars": F.sum("__chars")}
    )
    assert found == {"rows": 2, "chars": 3}
    assert "__chars" not in scan_table(spark, lake, PRODUCTS).columns


def test_rows_per_file(spark, lake):
    rows = spark.range(1000).selectExpr("CAST(id AS STRING) AS id").coalesce(1)
    write_slices(spark, lake, ACQUISITIONS, rows, [D1], rows_per_file=100)
    audit = audit_slice(spark, lake, ACQUISITIONS, D1)
    assert (audit.rows, audit.files, audit.columns) == (1000, 10, 6)
    write_slices(spark, lake, ACQUISITIONS, rows.repartition(8), [D1], rebalance=True)
    assert audit_slice(spark, lake, ACQUISITIONS, D1).files == 1


def test_audit_reads_no_column(spark, lake):
    write_slices(spark, lake, PRODUCTS, products(spark, "a"), [D1])
    audit = audit_slice(spark, lake, PRODUCTS, D2)
    assert (audit.rows, audit.files) == (0, 0)


def test_a_table_over_existing_data_finds_its_slices(spark, lake):
    write_slices(spark, lake, CUSTOMERS, products(spark, "a").select("nome"), [D1])
    spark.sql(f"DROP TABLE {CUSTOMERS.full_name(lake)}")
    create_table(spark, lake, CUSTOMERS)
    assert slices(spark, lake, CUSTOMERS) == [D1]
    assert stored(spark, lake, CUSTOMERS) == [("a", D1)]


def test_slices_can_be_appended_at_the_same_time(spark, lake):
    def load(load_date):
        write_slices(spark, lake, PRODUCTS, products(spark, "a"), [load_date], "append")

    with ThreadPoolExecutor(3) as pool:
        list(pool.map(load, [D1, D2, D3]))
    assert stored(spark, lake) == [("a", D1), ("a", D2), ("a", D3)]


def test_run_documents_can_be_written_at_the_same_time(spark, lake):
    def finish(i):
        run = RunLog("bronze", f"t{i}", D1)
        run.log("it's \"done\"\\")
        run.finish()
        metrics_sink(spark, lake, run)

    with ThreadPoolExecutor(6) as pool:
        list(pool.map(finish, range(12)))
    assert {r["table_name"] for r in run_log(spark, lake).collect()} == {f"t{i}" for i in range(12)}


def test_metrics_row(spark):
    run = RunLog("silver", "clie_limit", D1)
    with run.timed("load_total_time"):
        pass
    run.set(qtd_total_rows_insert=3)
    run.log("halt", "ERROR")
    assert run.finish()["execution_succes"] is False  # metrics are still missing
    row = run.metrics_row(spark).first()
    assert row["qtd_total_rows_insert"] == 3 and row["alerta"] is None
    assert row["load_total_time"] >= 0 and row["dat_carga"] == D1
    with pytest.raises(KeyError):
        run.set(number_lines_loaded=1)
    plan = run.document_row(spark)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan


def test_a_hash_of_a_row_needs_no_array(spark):
    rows = spark.createDataFrame([("x", None, 1), (None, None, None), ("é", "y", 2)], "B string, a string, c int")
    values = {name: F.col(name) for name in rows.columns}
    parts = [F.when(F.col(c).isNotNull(), F.xxhash64(F.lit(c.lower()), F.col(c))) for c in ("a", "B", "c")]
    # As stored ledgers hold it.
    as_before = F.xxhash64(F.array_compact(F.array(*parts)))
    assert rows.select(row_hash(values).eqNullSafe(as_before)).distinct().collect() == [(True,)]
    assert "array" not in str(row_hash(values))


def test_a_write_observes_a_hash_that_rows_hold(spark, lake, monkeypatch):
    seen = []

    def observed(hashed):
        seen.append(str(hashed))
        return hash_totals(hashed)

    monkeypatch.setattr(tables, "hash_totals", observed)
    found = write_slices(spark, lake, PRODUCTS, products(spark, "a", "b"), [D1], fingerprint=True)
    audit = audit_slice(spark, lake, PRODUCTS, D1, content=True).found
    assert {k: found[k] for k in ("rows", "fingerprint_sum", "fingerprint_xor")}.items() <= dict(audit).items()
    assert len(seen) == 1 and "xxhash64" not in seen[0]
    assert [c for c in scan_table(spark, lake, PRODUCTS).columns if c.startswith("__")] == []
