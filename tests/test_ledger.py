"""Loads that die, files that change, late files on named file systems, refused rows, contents of slices."""

from dataclasses import replace
from pathlib import Path

import pytest

from stratalake import config
from stratalake.config import BRONZE_LOADS
from stratalake.errors import BadInput, JobFailed
from stratalake.plans import bronze
from stratalake.plans.bronze import bronze_ingest
from stratalake.sinks.ledger import Fingerprint, Ledger, StagedFile, same_form, staged_files
from stratalake.sinks.stage import purge_stage
from stratalake.sinks.tables import slice_path, write_slices
from stratalake.sources.stage import stage_path
from stratalake.sources.tables import scan_table

D1 = "20250415"
LOAD = BRONZE_LOADS["clientesxprod"]
HEADER = "id,cliente_id,produto_id,data_aquisicao,valor_aquisicao\n"


def lines(*ids):
    return HEADER + "".join(f"{i},10,20,2025-01-01,1.00\n" for i in ids)


def ids(spark, lake, table=config.ACQUISITIONS):
    return sorted(r.id for r in scan_table(spark, lake, table).select("id").collect())


def die(*_args, **_kwargs):
    raise RuntimeError("the run died")


def late_half(spark, lake, stage):
    """One file loaded and purged, another one staged since."""
    folder = stage("clientesxprod", D1, lines(1, 2), "a.csv")
    done = bronze_ingest(spark, lake, LOAD, D1)
    purge_stage(spark, stage_path(lake.stage_root, "clientesxprod", D1), done.loaded)
    stage("clientesxprod", D1, lines(3, 4), "b.csv")
    return folder


def test_a_run_that_dies_after_its_commit_is_undone(spark, lake, stage, monkeypatch):
    folder = late_half(spark, lake, stage)
    with monkeypatch.context() as m:
        m.setattr(Ledger, "end", die)
        with pytest.raises(JobFailed, match="died"):
            bronze_ingest(spark, lake, LOAD, D1)
    assert ids(spark, lake) == ["1", "2", "3", "4"]
    again = bronze_ingest(spark, lake, LOAD, D1)
    assert ids(spark, lake) == ["1", "2", "3", "4"] and again.metrics["alerta"] is False
    purge_stage(spark, folder, again.loaded)
    stage("clientesxprod", D1, lines(5), "c.csv")
    assert bronze_ingest(spark, lake, LOAD, D1).metrics["alerta"] is False
    assert ids(spark, lake) == ["1", "2", "3", "4", "5"]


def test_a_run_that_dies_before_it_writes_leaves_nothing(spark, lake, stage, monkeypatch):
    late_half(spark, lake, stage)
    with monkeypatch.context() as m:
        m.setattr(bronze, "_write", die)
        with pytest.raises(JobFailed):
            bronze_ingest(spark, lake, LOAD, D1)
    bronze_ingest(spark, lake, LOAD, D1)
    assert ids(spark, lake) == ["1", "2", "3", "4"]


def test_a_run_that_dies_while_it_replaces_is_repeated(spark, lake, stage, monkeypatch):
    stage("clientesxprod", D1, lines(1), "a.csv")
    bronze_ingest(spark, lake, LOAD, D1)
    stage("clientesxprod", D1, lines(2), "b.csv")
    with monkeypatch.context() as m:
        m.setattr(Ledger, "end", die)
        with pytest.raises(JobFailed):
            bronze_ingest(spark, lake, LOAD, D1)
    assert bronze_ingest(spark, lake, LOAD, D1).metrics["alerta"] is False
    assert ids(spark, lake) == ["1", "2"]


def test_a_dead_run_whose_files_are_gone_stops_the_next(spark, lake, stage, monkeypatch):
    folder = late_half(spark, lake, stage)
    with monkeypatch.context() as m:
        m.setattr(Ledger, "end", die)
        with pytest.raises(JobFailed):
            bronze_ingest(spark, lake, LOAD, D1)
    (Path(folder) / "b.csv").unlink()
    stage("clientesxprod", D1, lines(9), "z.csv")
    with pytest.raises(JobFailed, match="neither finished nor undone"):
        bronze_ingest(spark, lake, LOAD, D1)


def test_an_append_that_dies_is_undone(spark, lake, stage, monkeypatch):
    stage("clientesxprod", D1, lines(1, 2), "a.csv")
    with monkeypatch.context() as m:
        m.setattr(Ledger, "end", die)
        with pytest.raises(JobFailed):
            bronze_ingest(spark, lake, LOAD, D1, mode="append")
    bronze_ingest(spark, lake, LOAD, D1, mode="append")
    assert ids(spark, lake) == ["1", "2"]
    # A finished append is kept, and the next one raises the alert.
    assert bronze_ingest(spark, lake, LOAD, D1, mode="append").metrics["alerta"] is True
    assert ids(spark, lake) == ["1", "1", "2", "2"]


def test_a_file_replaced_since_the_listing_is_not_purged(spark, lake, stage):
    folder = stage("clientesxprod", D1, lines(1), "a.csv")
    done = bronze_ingest(spark, lake, LOAD, D1)
    stage("clientesxprod", D1, lines(1, 2), "a.csv")
    outcome = purge_stage(spark, folder, done.loaded)
    assert (outcome.deleted, outcome.kept) == (0, 1)
    bronze_ingest(spark, lake, LOAD, D1)
    assert ids(spark, lake) == ["1", "2"]


def test_changed_files_beside_gone_ones_stop_a_load(spark, lake, stage):
    folder = stage("clientesxprod", D1, lines(1), "a.csv")
    stage("clientesxprod", D1, lines(2), "b.csv")
    bronze_ingest(spark, lake, LOAD, D1)
    (Path(folder) / "a.csv").unlink()
    stage("clientesxprod", D1, lines(2, 3), "b.csv")
    with pytest.raises(JobFailed, match="neither replaced nor extended"):
        bronze_ingest(spark, lake, LOAD, D1)


def test_late_files_on_a_named_file_system(spark, lake, stage, tmp_path):
    """The stage has a scheme and a host; late files are opened by the name they were listed by."""
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    conf.set("fs.viewfs.mounttable.store.link./in", f"file://{lake.stage_root}")
    named = replace(lake, stage_root="viewfs://store/in")
    folder = late_half(spark, named, stage)
    assert not (Path(folder) / "a.csv").exists()
    listed = staged_files(spark, stage_path(named.stage_root, "clientesxprod", D1))
    assert [f.path.startswith("viewfs://store/in/") for f in listed] == [True]
    again = bronze_ingest(spark, named, LOAD, D1)
    assert ids(spark, named) == ["1", "2", "3", "4"] and again.metrics["alerta"] is False
    assert bronze_ingest(spark, named, LOAD, D1).metrics["number_lines_loaded"] == 0


def test_names_are_compared_without_their_spelling():
    assert same_form("file:/x/a b.csv") == same_form("file:///x/a%20b.csv") == "/x/a b.csv"
    assert same_form("s3a://bucket/x") == "bucket/x" != same_form("s3a://other/x")
    assert StagedFile("file:/x", 1, 2).state == (1, 2)


def test_fingerprints_add_up_and_tell_rows_apart(spark, lake):
    def written(rows, mode="replace_slice"):
        df = spark.createDataFrame(rows, "id string, cliente_id string, produto_id string")
        return Fingerprint.of(write_slices(spark, lake, config.ACQUISITIONS, df, [D1], mode, fingerprint=True))

    one, two = written([("1", "a", None)]), written([("2", "b", "c"), ("1", "a", None)])
    assert written([("2", "b", "c")]) + one == two
    # A lost row and a doubled one, a value that moved to another column.
    assert written([("1", "a", None)] * 2).rows == two.rows and written([("1", "a", None)] * 2) != two
    assert written([("1", None, "a")]) != one
    assert written([]) == Fingerprint()


def test_other_contents_raise_the_alert(spark, lake, stage, monkeypatch):
    stage("clientesxprod", D1, lines(1, 2), "a.csv")

    def tampered(*args, **kwargs):
        found = write_slices(*args, **kwargs)
        rows = spark.createDataFrame([("1", "10", "20", "2025-01-01", "1.00")] * 2, scan_table(spark, lake, config.ACQUISITIONS).drop("dat_ref_carga").schema)
        rows.write.mode("overwrite").parquet(slice_path(lake, config.ACQUISITIONS, D1))
        spark.catalog.refreshTable(config.ACQUISITIONS.full_name(lake))
        return found

    monkeypatch.setattr(bronze, "write_slices", tampered)
    assert bronze_ingest(spark, lake, LOAD, D1).metrics["alerta"] is True
    assert bronze_ingest(spark, lake, replace(LOAD, verify="rows"), D1).metrics["alerta"] is False


QUARANTINE = replace(LOAD, bad_rows="quarantine")


def rejects(spark, lake):
    rows = scan_table(spark, lake, config.rejects_of(config.ACQUISITIONS)).collect()
    return sorted((r.motivo, r.registro, r.arquivo.rsplit("/", 1)[-1]) for r in rows)


def test_bad_rows_are_set_aside(spark, lake, stage):
    bad = lines(1, 2) + "3,10\n" + '4, NULL ,20,2025-01-01,"1,00"\n' + "5,1,2,3,4,5\n"
    folder = stage("clientesxprod", D1, bad, "a.csv")
    done = bronze_ingest(spark, lake, QUARANTINE, D1)
    assert ids(spark, lake) == ["1", "2"] and done.rejected == 3 and done.profile.rows == 5
    assert done.metrics["alerta"] is False and done.metrics["qtd_total_rows_insert"] == 2
    assert rejects(spark, lake) == [
        ("cliente_id is null", '4, NULL ,20,2025-01-01,"1,00"', "a.csv"),
        ("more or fewer values than the header", "3,10", "a.csv"),
        ("more or fewer values than the header", "5,1,2,3,4,5", "a.csv"),
    ]
    # Late files add their own refused rows; a load of mended files replaces all.
    purge_stage(spark, folder, done.loaded)
    stage("clientesxprod", D1, lines(6) + "7,,,,\n", "b.csv")
    bronze_ingest(spark, lake, QUARANTINE, D1)
    assert ids(spark, lake) == ["1", "2", "6"] and len(rejects(spark, lake)) == 4


def test_a_mended_load_replaces_its_rejects(spark, lake, stage):
    stage("clientesxprod", D1, lines(1) + "2,,20,2025-01-01,1.00\n", "a.csv")
    bronze_ingest(spark, lake, QUARANTINE, D1)
    assert len(rejects(spark, lake)) == 1
    stage("clientesxprod", D1, lines(1, 2), "a.csv")
    assert bronze_ingest(spark, lake, QUARANTINE, D1).rejected == 0
    assert ids(spark, lake) == ["1", "2"] and rejects(spark, lake) == []


def test_a_load_of_bad_rows_alone_replaces_nothing(spark, lake, stage):
    stage("clientesxprod", D1, lines(1), "a.csv")
    bronze_ingest(spark, lake, QUARANTINE, D1)
    stage("clientesxprod", D1, HEADER + "2,,20,2025-01-01,1.00\n", "a.csv")
    with pytest.raises(JobFailed, match="no row of the load is good"):
        bronze_ingest(spark, lake, QUARANTINE, D1)
    assert ids(spark, lake) == ["1"]


def test_unknown_choices(spark, lake):
    for load in (replace(LOAD, bad_rows="drop"), replace(LOAD, verify="no")):
        with pytest.raises(ValueError, match="unknown choice"):
            bronze_ingest(spark, lake, load, D1)
    assert issubclass(BadInput, ValueError)
