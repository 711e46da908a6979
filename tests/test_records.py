"""Records with line breaks inside values, read by many tasks."""

import csv
import io
import random

import pytest

from stratalake.errors import BadInput
from stratalake.sources.records import records_of, scan_records
from stratalake.sources.stage import FILE, RAGGED, scan_delimited, scan_stage


@pytest.fixture
def small_blocks(spark):
    names = {"spark.sql.files.maxPartitionBytes": "900", "spark.sql.files.openCostInBytes": "0"}
    for name, value in names.items():
        spark.conf.set(name, value)
    yield
    for name in names:
        spark.conf.unset(name)


def write(folder, name, rows, header=("id", "texto", "fim")):
    out = io.StringIO()
    writer = csv.writer(out, lineterminator="\n")
    writer.writerows([header, *rows])
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(out.getvalue(), encoding="utf-8", newline="")


def messy(n, seed):
    rng = random.Random(seed)
    parts = ["a", "b,", '"', "\n", "\r\n", "é", " ", '",\n"']
    rows = [(str(i), "".join(rng.choice(parts) for _ in range(rng.randrange(12))), "x" * rng.randrange(5)) for i in range(n)]
    # A value over many blocks, and one that is nothing but line breaks.
    rows[n // 2] = (str(n // 2), "long\n" * 2000, "y")
    rows[n // 3] = (str(n // 3), "\n" * 50, "")
    return rows


def test_many_tasks_read_what_one_does(spark, tmp_path, small_blocks):
    folder = tmp_path / "in"
    write(folder, "a.csv", messy(700, 1))
    write(folder, "b.csv", messy(50, 2))
    write(folder, "c.csv", [])
    got = scan_records(spark, str(folder), ragged=True)
    assert spark.read.text(str(folder)).rdd.getNumPartitions() > 10
    one = scan_delimited(spark, str(folder), multiline=True, ragged=True, options={"lineSep": "\n"})
    assert got.columns == [*one.columns, FILE]
    rows = got.collect()
    assert sorted(map(repr, (tuple(r)[:-1] for r in rows))) == sorted(map(repr, map(tuple, one.collect())))
    assert {r[FILE].rsplit("/", 1)[-1] for r in rows} == {"a.csv", "b.csv"}


def test_ragged_records_and_windows_line_ends(spark, tmp_path, small_blocks):
    (tmp_path / "a.csv").write_bytes(b'id,t\r\n1,"x\r\ny"\r\n2\r\n3,"q ""r""",z\r\n\r\n')
    got = scan_records(spark, str(tmp_path / "a.csv"), ragged=True).collect()
    assert sorted((r.id, r.t, r[RAGGED]) for r in got if r[RAGGED] is None) == [("1", "x\r\ny", None)]
    assert sorted(r[RAGGED] for r in got if r[RAGGED] is not None) == ["2", '3,"q ""r""",z']
    assert scan_stage(spark, str(tmp_path / "a.csv"), multiline=True).columns == ["id", "t", FILE]


def test_headers_must_agree_and_quotes_must_close(spark, tmp_path):
    write(tmp_path / "in", "a.csv", [("1", "2", "3")])
    write(tmp_path / "in", "b.csv", [("1", "2", "3")], header=("id", "outro", "fim"))
    with pytest.raises(Exception, match="another header"):
        scan_records(spark, str(tmp_path / "in")).collect()
    (tmp_path / "open.csv").write_text('id,t\n1,"never closed\n2,3\n')
    with pytest.raises(BadInput, match="inside a quoted value"):
        records_of(spark, str(tmp_path / "open.csv"))
    (tmp_path / "empty.csv").write_text("")
    with pytest.raises(BadInput, match="no header"):
        scan_records(spark, str(tmp_path / "empty.csv"))
