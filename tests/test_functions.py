from datetime import date

import pytest
from pyspark.sql import functions as F

from stratalake.config import load_day, today_load_date
from stratalake.errors import BadInput
from stratalake.functions.amounts import amount, rounded, total_amount
from stratalake.functions.customer import age_years, hash_document, income_class, whole_number
from stratalake.functions.dates import load_date_of_path, load_date_text
from stratalake.functions.text import null_marker_to_null, sql_text, trimmed_names


def values(spark, items, column):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(items)], "i int, v string")
    return [r[0] for r in df.orderBy("i").select(column).collect()]


@pytest.mark.parametrize("marker", ["NULL", "null", " NULL ", "null  "])
def test_null_marker_becomes_null(spark, marker):
    assert values(spark, [marker], null_marker_to_null("v")) == [None]


def test_other_text_is_kept_as_it_was(spark):
    texts = ["Null", "nulls", " x ", "", None, "\tNULL"]
    assert values(spark, texts, null_marker_to_null("v")) == texts


def test_markers_are_a_parameter(spark):
    assert values(spark, ["it's", "NULL"], null_marker_to_null("v", ["it's"])) == [None, "NULL"]


def test_sql_text_escapes(spark):
    text = "a'b\\c"
    assert spark.sql(f"SELECT {sql_text(text)}").first()[0] == text


def test_names_are_trimmed():
    assert trimmed_names(["id", " nome ", "v"]) == ["id", "nome", "v"]


@pytest.mark.parametrize("names", [["a", "a "], ["Nome", " nome"]])
def test_names_that_collide_raise(names):
    with pytest.raises(BadInput, match="same name"):
        trimmed_names(names)


def test_income_bands(spark):
    incomes = ["521", "522", "1042", "1043", "4427", "4428", "8856", "8857", "-10", "0"]
    classes = ["E", "D", "D", "C", "C", "B", "B", "A", "E", "E"]
    assert values(spark, incomes, income_class(F.col("v"))) == [f"Classe {c}" for c in classes]


def test_income_fraction_is_cut_off(spark):
    assert values(spark, ["521.50", " 521.99 ", ".9"], income_class(F.col("v"))) == ["Classe E"] * 3


def test_malformed_income(spark):
    incomes = [None, "abc", "1e2", "1.234,50", ""]
    assert values(spark, incomes, income_class(F.col("v"))) == ["Classe A"] * 5
    assert values(spark, incomes, income_class(F.col("v"), unparsed=None)) == [None] * 5


def test_large_incomes(spark):
    incomes = ["3000000000", "99999999999.5", "9" * 30, "-3000000000"]
    classes = ["Classe A"] * 3 + ["Classe E"]
    assert values(spark, incomes, income_class(F.col("v"), unparsed=None)) == classes


def test_whole_number_agrees_with_a_lenient_cast(spark):
    texts = ["1", " 2 ", "3.7", "-3.7", "+4.", ".5", ".", "", "x", "1.x", "1e3", "2147483648",
             "2147483647.9", "--1", "0012.5", None]
    got = values(spark, texts, whole_number(F.col("v")))
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        want = values(spark, texts, F.col("v").cast("long"))
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")
    assert got == want


def test_text_that_is_no_whole_number_is_kept_from_the_cast(spark):
    texts = ["n/d", "1,5", "7\t", "\x7f8", "9\x00", "é", "1_0", "+ 1", "12-", "a.5", "1.5.2", "~", "\u00a04", " ", "+", "-7"]
    got = values(spark, texts, whole_number(F.col("v")))
    assert got == values(spark, texts, F.coalesce(
        F.col("v").try_cast("long"),
        F.regexp_replace("v", r"^\s*(?<sign>[+-]?)(?<digits>[0-9]*)\.[0-9]*\s*$", "${sign}0${digits}").try_cast("long"),
    ).cast("decimal(38,0)"))
    # A cast that fails builds an error for each value: each of the two has a guard, beside the one of wide numbers.
    assert str(whole_number(F.col("v"))).upper().count("RLIKE") == 3


def test_age_by_mean_year(spark):
    births = ["2020-04-16", "1990-04-16", "2025-04-16", "x", None]
    ages = values(spark, births, age_years(F.col("v"), date(2025, 4, 16)))
    # 1826 days are less than five mean years.
    assert ages == ["4", "35", "0", None, None]
    assert values(spark, ["2020-04-16"], age_years(F.col("v"), date(2021, 4, 16))) == ["0"]


def test_document_hash(spark):
    known = "ba7816bf8f01cfea414140de5dae2223b00361a396177a9cb410ff61f20015ad"
    assert values(spark, ["abc", None], hash_document(F.col("v"))) == [known, None]
    assert values(spark, ["bc", None], hash_document(F.col("v"), salt="a")) == [known, None]


def test_amounts(spark):
    texts = ["1.005", "-1.005", "1e2", "x", None, " 7 "]
    assert [None if v is None else str(v) for v in values(spark, texts, amount(F.col("v")))] == [
        "1.01", "-1.01", "100.00", None, None, "7.00",
    ]
    assert values(spark, ["2.345", "x"], rounded(F.col("v"))) == [2.35, None]


def test_totals_do_not_depend_on_order(spark):
    texts = ["0.10"] * 10 + ["1000000000000.01", "-1000000000000.01"]
    df = spark.createDataFrame([(t,) for t in texts], "v string")
    for parts in (1, 7):
        assert df.repartition(parts).agg(total_amount(F.col("v"))).first()[0] == 1.0


def test_total_of_nothing_is_null(spark):
    df = spark.createDataFrame([(None,), ("x",)], "v string")
    assert df.agg(total_amount(F.col("v"))).first()[0] is None


def test_load_date_of_a_time(spark):
    times = ["2025-04-16 02:59:59", "2025-04-16 03:00:00"]
    assert values(spark, times, load_date_text(F.col("v").cast("timestamp"))) == [
        "20250415", "20250416",
    ]


def test_load_date_of_a_path(spark):
    paths = ["s3://b/x/clientes/20250415/p.csv", "/x/20250415/more/p.csv"]
    assert values(spark, paths, load_date_of_path(F.col("v"))) == ["20250415", ""]


@pytest.mark.parametrize("bad", ["2025-04-15", "20251315", "", "2025041"])
def test_bad_load_dates(bad):
    with pytest.raises(ValueError):
        load_day(bad)


def test_today_is_a_load_date():
    assert load_day(today_load_date())
