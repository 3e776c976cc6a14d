import pytest
from pyspark.sql import functions as F

from fundpanel import functions as fn
from fundpanel.operators.aggregate import bin_label, size_bin


def apply(spark, values, expr, type="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {type}")
    return [r[0] for r in df.select(expr(F.col("x")).alias("y"), "i").orderBy("i").select("y").collect()]


@pytest.mark.parametrize("given,expected", [
    ("$1,234.5", 1234.5), (" 12 % ", 12.0), ("-11", -11.0), ("1e3", 1000.0), (".5", 0.5), ("5.", 5.0),
    ("NaN", None), ("Infinity", None), ("1d", None), ("", None), (None, None), ("abc", None), ("1 2", 12.0),
])
def test_to_number(spark, given, expected):
    assert apply(spark, [given], fn.to_number) == [expected]


def test_sentinel(spark):
    assert apply(spark, ["-11111", "x-11111y", "-1111", None], fn.sentinel_null) == [None, None, "-1111", None]


def test_title_case_breaks_at_hyphen(spark):
    given = ["TOTAL CASH AND SHORT-TERM INVESTMENTS", "time, savings deposits", None, " a  b"]
    assert apply(spark, given, fn.title_case) == ["Total Cash And Short-Term Investments", "Time, Savings Deposits", None, " A  B"]


def test_pad_keeps_long_codes(spark):
    assert apply(spark, ["1", "12", "123", None], lambda c: fn.pad_code(c, 2)) == ["01", "12", "123", None]


def test_two_digit_year(spark):
    assert apply(spark, ["69", "70", "00", "99", "x"], fn.expand_year2) == [2069, 1970, 2000, 1999, None]


@pytest.mark.parametrize("name,year", [
    ("COG_2012_COGPP00SL_with_ann.csv", 2012), ("2007indiv_unit_reported_data.txt", 2007), ("ret99t2.csv", 1999),
    ("93ret35.txt", 1993), ("2003Ret02.csv", 2003), ("2012ASPPSummary.csv", 2012), ("notes.txt", None),
])
def test_year_from_name(spark, name, year):
    assert apply(spark, [name], fn.year_from_name) == [year]


def test_part_past_the_end_is_null(spark):
    assert apply(spark, ["a_b", "a", None], lambda c: fn.part(c, "_", 2)) == ["b", None, None]


def test_codes_and_labels(spark):
    assert apply(spark, [1, 0, 7, None], lambda c: fn.label(c, [1, 0], ["market", "smoothed"]), "int") == ["market", "smoothed", None, None]
    assert apply(spark, ["b", "z", None], lambda c: fn.ordinal(c, ["a", "b"])) == [2, None, None]
    assert apply(spark, [" 2.0", "x", "3"], fn.norm_code) == [2, None, 3]


def test_relabel_takes_first_rule(spark):
    rules = [("State", "State"), ("Count", "County")]
    assert apply(spark, ["State Counties", "Counties", "Town", None], lambda c: fn.relabel_regex(c, rules)) == ["State", "County", "Town", None]


def test_override(spark):
    df = spark.createDataFrame([("52", None), ("01", "AL"), ("98", None)], "k string, v string")
    got = df.select(fn.override_code(F.col("v"), F.col("k"), {"52": "NATL"}, "US")).collect()
    assert [r[0] for r in got] == ["NATL", "AL", "US"]


def test_null_condition_gives_null(spark):
    assert apply(spark, [1, -1, None], lambda c: fn.if_known(c > 0, F.lit("y"), F.lit("n")), "int") == ["y", "n", None]


def test_division_by_zero_is_null(spark):
    assert apply(spark, [0.0, 2.0, None], lambda c: fn.pct(F.lit(1.0), c), "double") == [None, 50.0, None]
    assert apply(spark, [0.0, -1.0], fn.log_value, "double") == [None, None]


def test_round_to_even(spark):
    assert apply(spark, [0.5, 1.5, 2.5, -0.5], fn.round_even, "double") == [0.0, 2.0, 2.0, 0.0]


def test_display_name(spark):
    df = spark.createDataFrame([("", "id"), ("pub ", "id"), (None, "id")], "p string, i string")
    assert [r[0] for r in df.select(fn.display_name(F.col("p"), F.col("i"))).collect()] == ["id", "pub", None]


def test_size_bins_close_on_the_right(spark):
    got = apply(spark, [0.0, 0.5, 1.0, 1.5, 5.0, 6.0, 1e5, 1e6, None], lambda c: bin_label(size_bin(c)), "double")
    assert got == [None, "(0,1]", "(0,1]", "(1,2]", "(4,5]", "(5,10]", "(1e+04,1e+05]", "(1e+05,Inf]", None]
