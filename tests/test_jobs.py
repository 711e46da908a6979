import json
from dataclasses import replace
from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import bank
from stratalake import config
from stratalake.config import BRONZE_LOADS, CREDIT_CUSTOMERS, PRODUCT_TOTALS, Lake
from stratalake.errors import JobFailed
from stratalake.functions.customer import hash_document
from stratalake.operators.totals import product_totals
from stratalake.plans.bronze import bronze_ingest
from stratalake.plans.gold import gold_product_totals
from stratalake.plans.run import run_layers
from stratalake.plans.silver import (
    JoinPlan,
    credit_customers,
    profile_inputs,
    silver_credit_customers,
)
from stratalake.schemas import LOAD_DATE
from stratalake.sinks.runlog import run_log
from stratalake.sinks.stage import Purge, land_snapshot, purge_stage
from stratalake.sinks.tables import write_slices
from stratalake.sources.stage import scan_stage, stage_path
from stratalake.sources.tables import scan_table
from stratalake.streaming.arrival import arrival_ingest, arrival_table
from stratalake.workspace import path_exists

D1, D2 = "20250415", "20250416"
AS_OF = date(2025, 4, 16)


def land_bank(spark, lake, load_date):
    customers = bank.customers(spark).withColumn("nome", F.lit("Ana"))
    for name, rows in (
        ("clientes", customers),
        ("produtos", bank.products(spark)),
        ("clientesxprod", bank.acquisitions(spark)),
    ):
        land_snapshot(rows, lake.stage_root, name, load_date)


def silver_view(df, spark):
    """Silver rows with the customer key in place of the hashed document."""
    keys = bank.customers(spark).select("client_id", hash_document(F.col("cpf")).alias("num_doc"))
    rows = df.join(keys, "num_doc", "left").select(
        "client_id", "prod_contratado", "classe_renda", "idade", "valor_prod_contratado"
    )
    return sorted(map(tuple, rows.collect()), key=str)


def gold_view(df):
    return sorted(tuple(r)[:3] for r in df.drop(LOAD_DATE).collect())


def clean_inputs(spark):
    customers = bank.customers(spark).withColumn(
        "renda", F.when(F.trim("renda") != "NULL", F.col("renda"))
    )
    return bank.acquisitions(spark), customers, bank.products(spark)


@pytest.mark.parametrize(
    "limits", [{}, {"broadcast_chars": 0}, {"broadcast_chars": 0, "rows_per_task": 1}]
)
def test_silver_by_hand(spark, limits):
    plan = profile_inputs(Lake("", "", **limits), *clean_inputs(spark)).joins
    rows = credit_customers(*clean_inputs(spark), AS_OF, plan)
    assert silver_view(rows, spark) == sorted(bank.SILVER, key=str)
    assert gold_view(product_totals(rows)) == sorted(bank.GOLD)


def test_products_of_one_name_can_be_kept_apart(spark):
    acquisitions, customers, products = clean_inputs(spark)
    rows = credit_customers(acquisitions, customers, products, AS_OF)
    merged = product_totals(rows).where("prod_contratado = 'CDB de Longo Prazo'")
    apart = product_totals(rows, ["classe_renda"]).where("prod_contratado = 'CDB de Longo Prazo'")
    assert merged.count() == 1 and apart.count() == 2


def test_inputs_decide_the_joins(spark):
    inputs = clean_inputs(spark)
    small = profile_inputs(Lake("", "", rows_per_task=2), *inputs)
    assert small.joins == JoinPlan(broadcast_products=True, broadcast_customers=True)
    sizes = [sum(len(str(r)) for r in df.collect()) for df in inputs]
    assert small.chars == sum(sizes[1:]) and sizes[2] > sizes[1]
    limited = Lake("", "", broadcast_chars=sizes[1], rows_per_task=2)
    large = profile_inputs(limited, *inputs).joins
    assert not large.broadcast_customers and not large.broadcast_products
    assert set(dict(large.hot_products.collect())) == {"4"}
    assert large.hot_customers.count() == 0


def test_products_come_before_the_customer_shuffle(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = credit_customers(*clean_inputs(spark), AS_OF, JoinPlan(broadcast_products=True))
        plan = rows._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    joins = [line for line in plan.splitlines() if "Join" in line]
    assert "SortMergeJoin" in joins[0] and "LeftOuter" in joins[0]
    assert "BroadcastHashJoin" in joins[1] and "Inner" in joins[1]


def test_one_date_through_all_layers(spark, lake):
    land_bank(spark, lake, D2)
    metrics = run_layers(spark, lake, D2)
    assert {name: m["execution_succes"] for name, m in metrics.items()} == {
        "clientes": True, "produtos": True, "clientesxprod": True, "clie_limit": True,
        "prod_contrat_diario": True,
    }
    assert metrics["clie_limit"]["qtd_total_rows_insert"] == len(bank.SILVER)
    silver = scan_table(spark, lake, CREDIT_CUSTOMERS)
    assert silver_view(silver, spark) == sorted(bank.SILVER, key=str)
    assert gold_view(scan_table(spark, lake, PRODUCT_TOTALS)) == sorted(bank.GOLD)
    for name in BRONZE_LOADS:
        assert not path_exists(spark, stage_path(lake.stage_root, name, D2))
    assert run_log(spark, lake).where("success").count() == 5


def test_dates_one_after_the_other(spark, lake):
    for load_date in (D1, D2):
        land_bank(spark, lake, load_date)
        run_layers(spark, lake, load_date, as_of=AS_OF, purge=False)
    for load_date in (D1, D2):
        part = scan_table(spark, lake, PRODUCT_TOTALS).where(F.col(LOAD_DATE) == load_date)
        assert gold_view(part) == sorted(bank.GOLD)
    silver_credit_customers(spark, lake, D2, mode="overwrite_table")
    gold_product_totals(spark, lake, D2, mode="overwrite_table")
    dates = scan_table(spark, lake, PRODUCT_TOTALS).select(LOAD_DATE).distinct().collect()
    assert [r[0] for r in dates] == [D2]


def test_gold_totals_equal_silver_totals(spark, lake):
    land_bank(spark, lake, D2)
    run_layers(spark, lake, D2)
    silver = scan_table(spark, lake, CREDIT_CUSTOMERS)
    gold = scan_table(spark, lake, PRODUCT_TOTALS)
    limits = silver.agg(F.sum(F.col("limite_credito").cast("double"))).first()[0]
    assert gold.agg(F.sum("valor_total_limite_credito")).first()[0] == limits


def test_second_load_of_a_date(spark, lake, stage):
    stage("clientes", D1, "client_id,nome,cpf\n1,Ana,11\n2,Rui,22\n")
    load = BRONZE_LOADS["clientes"]
    for _ in range(2):
        metrics = bronze_ingest(spark, lake, load, D1).metrics
        assert metrics["qtd_total_rows_insert"] == 2 and metrics["alerta"] is False
    metrics = bronze_ingest(spark, lake, load, D1, mode="append").metrics
    assert metrics["qtd_total_rows_insert"] == 4 and metrics["alerta"] is True


def test_required_nulls_stop_a_load_before_the_write(spark, lake, stage):
    stage("clientes", D1, "client_id,nome,cpf\n1,Ana,NULL\n2,Rui,22\n")
    with pytest.raises(JobFailed, match="'cpf': 1"):
        bronze_ingest(spark, lake, BRONZE_LOADS["clientes"], D1)
    assert scan_table(spark, lake, config.CUSTOMERS).count() == 0
    row = run_log(spark, lake).first()
    assert row["success"] is False and "QualityError" in row["document"]


def test_missing_required_column(spark, lake, stage):
    stage("clientes", D1, "client_id,nome\n1,Ana\n")
    with pytest.raises(JobFailed, match="cpf"):
        bronze_ingest(spark, lake, BRONZE_LOADS["clientes"], D1)


def test_missing_stage_folder_leaves_a_failed_run(spark, lake):
    with pytest.raises(JobFailed):
        bronze_ingest(spark, lake, BRONZE_LOADS["clientes"], D1)
    assert run_log(spark, lake).select("success", "dat_carga").collect() == [(False, D1)]


def test_empty_load(spark, lake, stage):
    stage("clientes", D1, "client_id,nome,cpf\n")
    load = BRONZE_LOADS["clientes"]
    metrics = bronze_ingest(spark, lake, load, D1).metrics
    assert (metrics["number_lines_loaded"], metrics["data_size_mb_formatted"]) == (0, 0.0)
    assert metrics["alerta"] is False and metrics["execution_succes"] is True
    with pytest.raises(JobFailed, match="no rows"):
        bronze_ingest(spark, lake, replace(load, reject_empty=True), D1)


def test_an_empty_load_does_not_remove_a_slice(spark, lake, stage):
    load = BRONZE_LOADS["clientes"]
    folder = Path(stage("clientes", D1, "client_id,nome,cpf\n1,Ana,11\n"))
    bronze_ingest(spark, lake, load, D1)
    (folder / "part.csv").write_text("client_id,nome,cpf\n", encoding="utf-8")
    with pytest.raises(JobFailed, match="would remove the 1 rows"):
        bronze_ingest(spark, lake, load, D1)
    assert scan_table(spark, lake, config.CUSTOMERS).count() == 1


def test_late_files_are_added(spark, lake, stage):
    load = BRONZE_LOADS["clientes"]
    folder = stage("clientes", D1, "client_id,nome,cpf\n1,Ana,11\n2,Rui,22\n", "a.csv")
    done = bronze_ingest(spark, lake, load, D1)
    stage("clientes", D1, "client_id,nome,cpf,canal\n3,Eva,33,web\n", "late.csv")
    assert purge_stage(spark, folder, done.input_files) == Purge(1, 1)
    for _ in range(2):
        metrics = bronze_ingest(spark, lake, load, D1).metrics
        assert metrics["alerta"] is False
        names = scan_table(spark, lake, config.CUSTOMERS).select("nome").collect()
        assert sorted(r[0] for r in names) == ["Ana", "Eva", "Rui"]
    assert metrics["number_lines_loaded"] == 0
    (Path(folder) / "late.csv").write_text("client_id,nome,cpf,canal\n4,Leo,44,web\n")
    with pytest.raises(JobFailed, match="have changed while others are gone"):
        bronze_ingest(spark, lake, load, D1)


def test_headers_that_differ_stop_a_load(spark, lake, stage):
    stage("clientes", D1, "client_id,nome,cpf\n1,Ana,11\n", "a.csv")
    stage("clientes", D1, "nome,client_id,cpf\nRui,2,22\n", "b.csv")
    with pytest.raises(JobFailed, match="(?i)header"):
        bronze_ingest(spark, lake, BRONZE_LOADS["clientes"], D1)
    assert scan_table(spark, lake, config.CUSTOMERS).count() == 0


def test_ragged_records(spark, lake, stage):
    load = BRONZE_LOADS["clientes"]
    stage("clientes", D1, "client_id,nome,cpf,renda\n1,Ana,11,5\n2,Rui,22,5,x\n3,Eva,33\n")
    with pytest.raises(JobFailed, match="more or fewer values"):
        bronze_ingest(spark, lake, load, D1)
    assert scan_table(spark, lake, config.CUSTOMERS).count() == 0
    done = bronze_ingest(spark, lake, replace(load, refuse_ragged=False), D1)
    assert (done.profile.rows, done.profile.ragged) == (3, 2)
    assert "2 records have more or fewer" in run_log(spark, lake).where("success").first()["document"]


def test_unparsed_values_are_logged(spark, lake):
    rows = bank.acquisitions(spark).limit(1).withColumn("valor_aquisicao", F.lit("1.234,50"))
    rows = rows.unionByName(bank.acquisitions(spark))
    rows = rows.withColumn("produto_id", F.lit(bank.products(spark).first()["produto_id"]))
    write_slices(spark, lake, config.ACQUISITIONS, rows, [D1])
    write_slices(spark, lake, config.CUSTOMERS, bank.customers(spark), [D1])
    products = bank.products(spark).withColumn("limite_credito", F.lit("10.00"))
    write_slices(spark, lake, config.PRODUCTS, products, [D1])
    silver_credit_customers(spark, lake, D1)
    gold_product_totals(spark, lake, D1)
    documents = {r["layer"]: r["document"] for r in run_log(spark, lake).collect()}
    for layer in ("silver", "gold"):
        logged = [e["Message"] for e in json.loads(documents[layer])["logs"]]
        assert "column valor_prod_contratado has 2 unparsed values" in logged


def test_new_column_in_a_second_load(spark, lake, stage):
    load = BRONZE_LOADS["clientes"]
    stage("clientes", D1, "client_id,nome,cpf\n1,Ana,11\n")
    stage("clientes", D2, "client_id,nome,cpf, canal \n2,Rui,22,web\n")
    for load_date in (D1, D2):
        bronze_ingest(spark, lake, load, load_date)
    rows = scan_table(spark, lake, config.CUSTOMERS).select("nome", "canal")
    assert sorted(map(tuple, rows.collect())) == [("Ana", None), ("Rui", "web")]


def test_a_failed_source_stops_the_run(spark, lake):
    land_bank(spark, lake, D1)
    folder = Path(stage_path(lake.stage_root, "produtos", D1))
    for part in folder.glob("part-*"):
        part.write_text("produto_id;nome\n1;x\n", encoding="utf-8")
    with pytest.raises(JobFailed, match="produtos"):
        run_layers(spark, lake, D1)
    assert scan_table(spark, lake, CREDIT_CUSTOMERS).count() == 0
    assert path_exists(spark, str(folder))


def test_arrivals_are_read_once(spark, lake, tmp_path):
    load = BRONZE_LOADS["clientesxprod"]
    checkpoint = str(tmp_path / "checkpoint")
    rows = bank.acquisitions(spark)
    land_snapshot(rows, lake.stage_root, "clientesxprod", D1)
    assert arrival_ingest(spark, lake, load, checkpoint) == len(bank.ACQUISITIONS)
    assert arrival_ingest(spark, lake, load, checkpoint) == 0
    path = land_snapshot(rows, lake.stage_root, "clientesxprod", D2)
    parts = len(scan_stage(spark, path).inputFiles())
    arrived = arrival_ingest(spark, lake, load, checkpoint, max_files=1)
    assert arrived == len(bank.ACQUISITIONS) and parts > 1
    stored = scan_table(spark, lake, arrival_table(load))
    counts = stored.groupBy(LOAD_DATE).count().collect()
    assert {r[0]: r[1] for r in counts} == {D1: 12, D2: 12}
    runs = run_log(spark, lake).select("dat_carga", "success", "document").collect()
    assert {r["dat_carga"] for r in runs} == {D1, D2} and all(r["success"] for r in runs)
    loaded = [json.loads(r["document"])["metrics"] for r in runs]
    assert sum(m["number_lines_loaded"] for m in loaded) == 24
    assert sum(m["num_files"] for m in loaded) >= 2 and not any(m["alerta"] for m in loaded)


def test_a_repeated_batch_replaces_itself(spark, lake, tmp_path):
    """The end of the last batch is forgotten, so the next start runs it again."""
    load = BRONZE_LOADS["clientesxprod"]
    checkpoint = tmp_path / "checkpoint"
    land_snapshot(bank.acquisitions(spark), lake.stage_root, "clientesxprod", D1)
    arrival_ingest(spark, lake, load, str(checkpoint))
    for name in ("0", ".0.crc"):
        (checkpoint / "commits" / name).unlink(missing_ok=True)
    assert arrival_ingest(spark, lake, load, str(checkpoint)) == len(bank.ACQUISITIONS)
    assert scan_table(spark, lake, arrival_table(load)).count() == len(bank.ACQUISITIONS)


def test_a_new_checkpoint_does_not_replace_older_batches(spark, lake, stage, tmp_path):
    load = BRONZE_LOADS["clientesxprod"]
    header = "id,cliente_id,produto_id,data_aquisicao,valor_aquisicao\n"
    folder = Path(stage("clientesxprod", D1, header + "1,1,1,2025-01-01,1.00\n", "a.csv"))
    arrival_ingest(spark, lake, load, str(tmp_path / "one"))
    (folder / "a.csv").unlink()
    stage("clientesxprod", D1, header + "2,1,1,2025-01-01,1.00\n", "b.csv")
    arrival_ingest(spark, lake, load, str(tmp_path / "two"))
    ids = scan_table(spark, lake, arrival_table(load)).select("id").collect()
    assert sorted(r[0] for r in ids) == ["1", "2"]


def test_a_bad_arrival_stops_the_stream(spark, lake, stage, tmp_path):
    stage("clientes", D1, "client_id,nome,cpf\n1,,11\n")
    with pytest.raises(Exception, match="required column holds a null: nome"):
        arrival_ingest(spark, lake, BRONZE_LOADS["clientes"], str(tmp_path / "checkpoint"))


def test_a_file_outside_a_dated_folder_stops_the_stream(spark, lake, stage, tmp_path):
    header = "id,cliente_id,produto_id,data_aquisicao,valor_aquisicao\n"
    stage("clientesxprod", "today", header + "1,1,1,2025-01-01,1.00\n")
    with pytest.raises(Exception, match="not in a folder named by its load date"):
        arrival_ingest(spark, lake, BRONZE_LOADS["clientesxprod"], str(tmp_path / "checkpoint"))
    assert run_log(spark, lake).where("success").count() == 0


def test_arrivals_go_by_header_name(spark, lake, stage, tmp_path):
    header = "id,cliente_id,produto_id,data_aquisicao,valor_aquisicao"
    stage("clientesxprod", D1, f"{header}\n1,10,20,2025-01-01,1.00\n", "a.csv")
    swapped = "id,produto_id,cliente_id,data_aquisicao,valor_aquisicao,canal"
    stage("clientesxprod", D1, f"{swapped}\n2,20,10,2025-01-01,1.00,web\n", "b.csv")
    load = BRONZE_LOADS["clientesxprod"]
    assert arrival_ingest(spark, lake, load, str(tmp_path / "checkpoint")) == 2
    rows = scan_table(spark, lake, arrival_table(load)).select("id", "cliente_id", "produto_id", "canal")
    assert sorted(map(tuple, rows.collect()), key=str) == [("1", "10", "20", None), ("2", "10", "20", "web")]


def test_an_arrival_without_a_required_column_leaves_a_failed_run(spark, lake, stage, tmp_path):
    stage("clientesxprod", D1, "id,produto_id\n1,2\n")
    with pytest.raises(Exception, match="cliente_id"):
        arrival_ingest(spark, lake, BRONZE_LOADS["clientesxprod"], str(tmp_path / "checkpoint"))
    assert run_log(spark, lake).select("success").collect() == [(False,)]


def test_arrivals_reach_gold(spark, lake, tmp_path):
    land_bank(spark, lake, D1)
    arrived = {}
    for name, load in BRONZE_LOADS.items():
        arrival_ingest(spark, lake, load, str(tmp_path / name))
        arrived[name] = arrival_table(load)
    silver_credit_customers(
        spark, lake, D1, customers_table=arrived["clientes"], products_table=arrived["produtos"],
        acquisitions_table=arrived["clientesxprod"], as_of=AS_OF,
    )
    gold_product_totals(spark, lake, D1)
    assert gold_view(scan_table(spark, lake, PRODUCT_TOTALS)) == sorted(bank.GOLD)


def test_a_load_date_in_the_source_is_replaced(spark, lake, stage):
    stage("clientes", D1, f"client_id,nome,cpf,{LOAD_DATE}\n1,Ana,11,19990101\n")
    bronze_ingest(spark, lake, BRONZE_LOADS["clientes"], D1)
    rows = scan_table(spark, lake, config.CUSTOMERS).select("nome", LOAD_DATE)
    assert [tuple(r) for r in rows.collect()] == [("Ana", D1)]


def test_no_python_in_the_plans(spark, lake):
    write_slices(spark, lake, config.CUSTOMERS, bank.customers(spark), [D1])
    rows = credit_customers(
        scan_table(spark, lake, config.ACQUISITIONS),
        scan_table(spark, lake, config.CUSTOMERS),
        scan_table(spark, lake, config.PRODUCTS),
        AS_OF,
        profile_inputs(Lake("", "", broadcast_chars=0, rows_per_task=1), *clean_inputs(spark)).joins,
    )
    plan = product_totals(rows)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "ExistingRDD" not in plan
