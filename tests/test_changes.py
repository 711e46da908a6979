"""Snapshot changes, newest rows, sums of batches, compaction, types and sizes."""


import random

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake import config
from stratalake.errors import BadInput, LakeError
from stratalake.functions.python_text import quoted_length
from stratalake.operators.changes import CHANGE, apply_changes, latest_per_key, snapshot_changes
from stratalake.operators.profile import FILE_SKETCH_ERROR, data_size, sketched_count
from stratalake.operators.types import CAST, CHECK, KEEP, WIDEN, lost_counts, merged, merges
from stratalake.plans.bronze import bronze_ingest
from stratalake.plans.increments import BATCH, PARTIALS, differences, put_batch, refresh_totals
from stratalake.sinks import compact
from stratalake.sinks.compact import compact_slice, finish_compaction
from stratalake.sinks.ledger import Ledger, staged_files
from stratalake.sinks.tables import slice_path, write_slices
from stratalake.sources.tables import scan_table, slice_scan

D1, D2 = "20250415", "20250416"
KEYED = "id string, a string, b string"


def test_changes_and_their_application(spark):
    old = [("1", "x", None), ("2", "x", "y"), ("3", None, "z"), (None, "n", "n"), ("5", "x", "")]
    new = [("1", None, "x"), ("2", "x", "y"), (None, "n", None), ("4", "new", "w"), ("5", "x", None)]
    before, after = spark.createDataFrame(old, KEYED), spark.createDataFrame(new, KEYED)
    changes = snapshot_changes(before, after, ["id"])
    got = {(r[CHANGE], r.id): (r.a, r.b) for r in changes.collect()}
    assert got == {
        ("update", "1"): (None, "x"), ("delete", "3"): (None, "z"), ("update", None): ("n", None),
        ("insert", "4"): ("new", "w"), ("update", "5"): ("x", None),
    }
    state = apply_changes(before, changes, ["id"]).collect()
    assert sorted(map(str, map(tuple, state))) == sorted(map(str, new))
    assert snapshot_changes(after, after, ["id"]).count() == 0
    assert {r[CHANGE] for r in snapshot_changes(before.limit(0), after, ["id"]).collect()} == {"insert"}
    wider = after.withColumn("c", F.when(F.col("id") == "2", "c"))
    assert {r.id for r in snapshot_changes(after, wider, ["id"]).collect()} == {"2"}


def test_newest_row_of_a_hot_key(spark):
    rows = [("hot", str(i), None) for i in range(500)] + [("a", None, "x"), ("a", "1", None), (None, "2", "y"), ("t", "1", "b"), ("t", "1", "a")]
    found = latest_per_key(spark.createDataFrame(rows, KEYED), ["id"], ["a"])
    assert sorted(map(str, map(tuple, found.collect()))) == sorted(map(str, [("hot", "99", None), ("a", "1", None), (None, "2", "y"), ("t", "1", "b")]))
    assert "Window" not in found._jdf.queryExecution().toString()


PRODUCTS = "produto_id string, nome string, limite_credito string"
SALES = "produto_id string, valor_aquisicao string"


def test_sums_of_batches(spark, lake):
    products = spark.createDataFrame([("1", "p", "10.00"), ("2", "q", None), ("3", "p", "0.10")], PRODUCTS)
    write_slices(spark, lake, config.PRODUCTS, products, [D1])

    def sales(*rows):
        return spark.createDataFrame(rows, SALES)

    assert put_batch(spark, lake, D1, "a", sales(("1", "1.10"), ("2", "9"), ("9", "9"))) == 1
    put_batch(spark, lake, D1, "b", sales(("3", "2.20"), ("3", "bad")))
    before = slice_scan(spark, lake, PARTIALS, D1).where(F.col(BATCH) == "b").collect()
    assert [(str(r.valor), str(r.limite), r.linhas) for r in before] == [("2.20", "0.20", 2)]
    old = spark.createDataFrame(before)
    put_batch(spark, lake, D1, "b", sales(("3", "5.00")))
    refresh_totals(spark, lake, D1)
    gold = scan_table(spark, lake, config.PRODUCT_TOTALS).collect()
    assert [(r.prod_contratado, r.valor_total_prod_contratado, r.valor_total_limite_credito) for r in gold] == [("p", 6.1, 10.1)]
    new = slice_scan(spark, lake, PARTIALS, D1).where(F.col(BATCH) == "b")
    assert [(str(r.valor), str(r.limite), r.linhas) for r in differences(old, new).collect()] == [("2.80", "-0.10", -1)]
    assert differences(old, old).count() == 0
    put_batch(spark, lake, D1, "b", spark.createDataFrame([], SALES))
    assert slice_scan(spark, lake, PARTIALS, D1).select(BATCH).distinct().count() == 1


def small_files(spark, lake, n=40):
    rows = spark.range(400).selectExpr("CAST(id AS string) id", "md5(CAST(id AS string)) cliente_id").repartition(n)
    write_slices(spark, lake, config.ACQUISITIONS, rows, [D1])
    return slice_path(lake, config.ACQUISITIONS, D1)


def held(spark, lake):
    return sorted(int(r.id) for r in scan_table(spark, lake, config.ACQUISITIONS).collect())


def test_small_files_become_as_few_as_fit(spark, lake):
    folder = small_files(spark, lake)
    total = sum(f.length for f in staged_files(spark, folder))
    done = compact_slice(spark, lake, config.ACQUISITIONS, D1, total // 4 + 1)
    assert (done.before, done.after, done.rewritten_bytes) == (40, 4, total)
    assert held(spark, lake) == list(range(400)) and len(staged_files(spark, folder)) == 4
    # What is large enough is left alone; a slice that is not there has nothing to compact.
    assert compact_slice(spark, lake, config.ACQUISITIONS, D1, 100).rewritten_bytes == 0
    assert compact_slice(spark, lake, config.ACQUISITIONS, D2, 100).before == 0


@pytest.mark.parametrize("at", ["move_file", "delete_file"])
def test_a_compaction_that_dies_is_finished(spark, lake, monkeypatch, at):
    folder = small_files(spark, lake, 10)
    with monkeypatch.context() as m:
        calls = []

        def dies(*args):
            calls.append(args)
            if len(calls) > 1:
                raise RuntimeError("died")
            return original(*args)

        original = getattr(compact, at)
        m.setattr(compact, at, dies)
        with pytest.raises(RuntimeError):
            compact_slice(spark, lake, config.ACQUISITIONS, D1, 8_000)
    assert finish_compaction(spark, lake, config.ACQUISITIONS, D1)
    assert not finish_compaction(spark, lake, config.ACQUISITIONS, D1)
    assert held(spark, lake) == list(range(400)) and len(staged_files(spark, folder)) < 10


def test_no_compaction_over_a_dead_load_or_of_other_rows(spark, lake, stage, monkeypatch):
    stage("clientesxprod", D1, "id,cliente_id,produto_id,data_aquisicao,valor_aquisicao\n1,2,3,4,5\n")

    def die(*_):
        raise RuntimeError("died")

    with monkeypatch.context() as m:
        m.setattr(Ledger, "end", die)
        with pytest.raises(Exception, match="died"):
            bronze_ingest(spark, lake, config.BRONZE_LOADS["clientesxprod"], D1)
    with pytest.raises(LakeError, match="cut off"):
        compact_slice(spark, lake, config.ACQUISITIONS, D1)


def test_places_of_types():
    i, big, text, double = T.IntegerType(), T.LongType(), T.StringType(), T.DoubleType()
    assert merged(i, i).action == KEEP
    assert (merged(i, big).action, merged(i, big).kind) == (WIDEN, big)
    assert merged(big, i).action == CAST
    assert merged(big, T.DecimalType(12, 2)).kind == T.DecimalType(22, 2)
    assert merged(T.DecimalType(22, 2), T.DecimalType(12, 2)).action == CAST
    assert merged(T.DecimalType(38, 0), T.DecimalType(38, 10)).action == CHECK
    assert merged(text, i).action == CAST and merged(i, text).action == CHECK
    assert merged(double, i).action == CAST and merged(double, big).action == CHECK
    assert merged(T.FloatType(), double).kind == double
    assert merged(T.TimestampType(), T.DateType()).action == CAST and merged(T.DateType(), T.TimestampType()).action == CHECK


def test_values_that_would_be_lost_are_counted(spark):
    rows = spark.createDataFrame([("1",), (" 2 ",), ("1.5",), ("x",), (None,), ("99999999999",)], "v string")
    stored = T.StructType([T.StructField("V", T.IntegerType())])
    assert lost_counts(rows, merges(stored, rows.schema)) == {"V": 3}
    fits = rows.where("v IN ('1', ' 2 ') OR v IS NULL")
    assert lost_counts(fits, merges(stored, rows.schema)) == {}


def test_a_table_widens_and_refuses(spark, lake):
    table = config.LakeTable("b_vend", "m", T.StructType([T.StructField("v", T.IntegerType(), True, {"comment": "a number"}), T.StructField("dat_ref_carga", T.StringType())]))
    write_slices(spark, lake, table, spark.createDataFrame([(7,)], "v int"), [D1])
    write_slices(spark, lake, table, spark.createDataFrame([(1 << 40,)], "v long"), [D2])
    stored = scan_table(spark, lake, table)
    assert stored.schema["v"].dataType == T.LongType() and sorted(r.v for r in stored.collect()) == [7, 1 << 40]
    assert [c.description for c in spark.catalog.listColumns(table.full_name(lake))][0] == "a number"
    with pytest.raises(BadInput, match="1 of v"):
        write_slices(spark, lake, table, spark.createDataFrame([("8",), ("nine",)], "v string"), ["20250417"])
    assert scan_table(spark, lake, table).count() == 2


def test_lengths_of_literals(spark):
    rng = random.Random(3)
    signs = ["'", '"', "\\", "\n", "\r", "\t", "\x00", "\x07", "\x7f", "\x85", "\xa0", "\xad", "é", "ÿ", "Ā", "​", " ", "　", "漢", "𝒳", "\U000e0001", "a", " "]
    texts = ["".join(rng.choice(signs) for _ in range(rng.randrange(12))) for _ in range(600)] + ["", "plain"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    got = {r.t: r.n for r in rows.select("t", quoted_length(F.col("t")).alias("n")).collect()}
    assert got == {t: len(repr(t)) for t in texts}
    total = data_size(spark.createDataFrame([(t, None) for t in texts], "t string, u string"), exact=True).first()
    assert total.chars == sum(len(str(Row(t=t, u=None))) for t in texts)


def test_sketches_count_within_their_bound(spark):
    for n in (0, 1, 300, 200_000):
        got = spark.range(n).agg(sketched_count(F.xxhash64("id")).alias("n")).first()["n"] or 0
        assert abs(got - n) <= FILE_SKETCH_ERROR * n

