import pytest

from stratalake.config import BRONZE_LOADS, CUSTOMERS, Lake
from stratalake.errors import (
    AlreadyLanded,
    BadInput,
    MissingPackage,
    QualityError,
    UnsupportedFormat,
)
from stratalake.operators.cleaning import clean, null_markers_to_null
from stratalake.operators.profile import data_size, null_counts, profile_load
from stratalake.operators.quality import null_report, reconcile, required_not_null
from stratalake.schemas import PRODUCTS_SOURCE
from stratalake.sinks.stage import first_row_peek, land_snapshot, purge_stage, snapshot_export
from stratalake.sources.stage import AVRO_SOURCE, inline_rows, list_files, scan_stage, stage_path
from stratalake.sources.tables import slice_scan

D1, D2 = "20250415", "20250416"


def test_csv_is_all_text(spark, stage):
    df = scan_stage(spark, stage("t", D1, "id,v\n1,2.5\n2,\n3,\"\"\n"))
    assert set(dict(df.dtypes).values()) == {"string"}
    assert sorted(map(tuple, df.collect())) == [("1", "2.5"), ("2", None), ("3", None)]


def test_doubled_quotes(spark, stage):
    df = scan_stage(spark, stage("t", D1, 'id,v\n1,"say ""hi"", now"\n'))
    assert df.first()["v"] == 'say "hi", now'


def test_line_breaks_inside_values(spark, stage):
    path = stage("t", D1, 'id,v\n1,"a\nb"\n2,c\n')
    assert scan_stage(spark, path, multiline=True).count() == 2


def test_txt_with_another_separator(spark, stage):
    df = scan_stage(spark, stage("t", D1, "id|v\n1|x\n", "a.txt"), "txt", sep="|")
    assert df.columns == ["id", "v"] and df.count() == 1


def test_parquet_keeps_its_types(spark, lake):
    path = stage_path(lake.stage_root, "t", D1)
    spark.range(3).selectExpr("id", "id * 2.5D AS v").write.parquet(path)
    assert dict(scan_stage(spark, path, "parquet").dtypes) == {"id": "bigint", "v": "double"}


def test_avro_without_its_package(spark, stage):
    with pytest.raises(MissingPackage, match="spark-avro"):
        scan_stage(spark, stage("t", D1, "x"), "avro")


def test_avro_keeps_rows_and_types(spark, lake):
    path = stage_path(lake.stage_root, "t", D1)
    rows = [(1, 'say "hi",\n', 2.5), (2, None, None), (None, "", -1.0), (None, "", -1.0)]
    inline_rows(spark, rows, "id long, v string, x double").coalesce(2).write.format(AVRO_SOURCE).save(path)
    found = scan_stage(spark, path, "avro")
    assert dict(found.dtypes) == {"id": "bigint", "v": "string", "x": "double"}
    assert sorted(map(repr, map(tuple, found.collect()))) == sorted(map(repr, rows))


def test_unknown_format(spark, stage):
    with pytest.raises(UnsupportedFormat):
        scan_stage(spark, stage("t", D1, "{}"), "json")


def test_one_column_shows_the_row(spark, stage):
    with pytest.raises(BadInput, match="1;x"):
        scan_stage(spark, stage("t", D1, "id;v\n1;x\n"))


def test_header_spaces_and_markers(spark, stage):
    df = clean(scan_stage(spark, stage("t", D1, "id, nome ,v\n1, NULL ,Null\n2,null, x \n")))
    assert df.columns == ["id", "nome", "v"]
    assert sorted(map(tuple, df.collect())) == [("1", None, "Null"), ("2", None, " x ")]


def test_markers_leave_other_types_alone(spark):
    df = spark.sql("SELECT 1L AS n, array('NULL') AS a, 'NULL' AS s, true AS `x.y`")
    cleaned = null_markers_to_null(df)
    assert cleaned.dtypes == df.dtypes
    assert tuple(cleaned.first()) == (1, ["NULL"], None, True)


def test_profile(spark, stage):
    path = stage("t", D1, "a, b\n1,NULL\n2,x\n", "p1.csv")
    stage("t", D1, "a, b\n3,\n", "p2.csv")
    found = profile_load(scan_stage(spark, path), D1)
    texts = [f"Row(a='1',  b='NULL', dat_ref_carga='{D1}')",
             f"Row(a='2',  b='x', dat_ref_carga='{D1}')",
             f"Row(a='3',  b=None, dat_ref_carga='{D1}')"]
    assert (found.rows, found.files, found.chars) == (3, 2, sum(map(len, texts)))
    assert found.nulls == {"a": 0, "b": 2}


def test_profile_of_a_header_alone(spark, stage):
    found = profile_load(scan_stage(spark, stage("t", D1, "a,b\n")), D1)
    assert (found.rows, found.files, found.chars, found.size_mb) == (0, 0, 0, 0.0)
    assert found.nulls == {"a": 0, "b": 0}
    assert found.row_chars == 0


def test_rows_per_file():
    lake = Lake("", "", target_file_bytes=1000, chars_per_byte=2)
    assert [lake.rows_per_file(n) for n in (0, 10, 5000)] == [2000, 200, 1]


def test_data_size_equals_the_text_of_the_rows(spark):
    df = spark.createDataFrame([("x", None, 3), (None, "längér", -7)], "a string, b string, n int")
    row = data_size(df).first()
    assert row["chars"] == sum(len(str(r)) for r in df.collect())
    assert data_size(df.limit(0)).first()["chars"] == 0


def test_null_counts_and_report(spark):
    df = spark.createDataFrame([("x", None), (None, None)], "a string, `b c` string")
    counts = null_counts(df)
    assert {r[0]: r[1] for r in counts.collect()} == {"a": 1, "b c": 2}
    report = {r["column_name"]: r["verdict"] for r in null_report(counts, ["a"]).collect()}
    assert report == {"a": "error", "b c": "noted"}
    assert {r[1] for r in null_counts(df.limit(0)).collect()} == {0}


def test_required_columns_and_nulls():
    assert required_not_null({"a": 0, "b": 3}, ["a"]) == {"b": 3}
    with pytest.raises(QualityError, match="missing: c, d"):
        required_not_null({"a": 0}, ["a", "c", "d"])
    with pytest.raises(QualityError, match="'b': 3"):
        required_not_null({"a": 0, "b": 3}, ["a", "b"])


def test_reconcile(spark):
    same = reconcile(spark.range(3), spark.range(3)).first()
    other = reconcile(spark.range(3), spark.range(0)).first()
    assert tuple(same) == (3, 3, False) and tuple(other) == (3, 0, True)


def test_listing_does_not_read_contents(spark, stage):
    path = stage("t", D1, "a,b\n1,2\n")
    listed = list_files(spark, path)
    assert [r["length"] for r in listed.collect()] == [8]
    assert "content" not in listed._jdf.queryExecution().executedPlan().toString()


def test_export_round_trip(spark, tmp_path):
    rows = [(" a ", 'say "hi", now'), (None, "back\\slash"), ("NULL", "x;y")]
    df = spark.createDataFrame(rows, "a string, b string")
    snapshot_export(df, str(tmp_path / "out"))
    back = scan_stage(spark, str(tmp_path / "out"))
    assert sorted(map(repr, back.collect())) == sorted(map(repr, df.collect()))


def test_landing_never_overwrites(spark, lake):
    df = spark.createDataFrame([("1", "x")], "id string, v string")
    path = land_snapshot(df, lake.stage_root, "t", D1)
    assert path.endswith(f"/table_ingestion_files/t/{D1}")
    with pytest.raises(AlreadyLanded):
        land_snapshot(df, lake.stage_root, "t", D1)
    assert first_row_peek(spark, path) == "id,v"


def test_peek_of_an_empty_file(spark, stage):
    assert first_row_peek(spark, stage("t", D1, "")) is None


def test_purge_keeps_files_that_were_not_loaded(spark, stage, lake):
    path = stage("t", D1, "a,b\n1,2\n", "first one.csv")
    loaded = scan_stage(spark, path).inputFiles()
    stage("t", D1, "a,b\n3,4\n", "late.csv")
    outcome = purge_stage(spark, path, loaded)
    assert (outcome.deleted, outcome.kept) == (1, 1)
    assert [tuple(r) for r in scan_stage(spark, path).collect()] == [("3", "4")]


def test_purge_removes_a_loaded_folder(spark, stage):
    path = stage("t", D1, "a,b\n1,2\n")
    outcome = purge_stage(spark, path, scan_stage(spark, path).inputFiles())
    assert (outcome.deleted, outcome.kept) == (1, 0)
    assert purge_stage(spark, path) == purge_stage(spark, path, [])


def test_inline_rows(spark):
    row = [None] * len(PRODUCTS_SOURCE)
    row[0], row[1] = 1, "Conta"
    assert inline_rows(spark, [row], PRODUCTS_SOURCE).first()["nome"] == "Conta"


def test_slice_scan_prunes(spark, lake):
    df = slice_scan(spark, lake, CUSTOMERS, D2, ["client_id", "cpf"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dat_ref_carga" in plan
    assert "ReadSchema: struct<client_id:string,cpf:string>" in plan


def test_load_configs():
    assert BRONZE_LOADS["clientes"].required == ("nome", "cpf")
    assert {load.mode for load in BRONZE_LOADS.values()} == {"replace_slice"}
