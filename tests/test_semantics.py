"""The null and tie rules of SURVEY section 1.4, one test each."""

import datetime as dt

from pyspark.sql import functions as F

from tests.conftest import rows
from tidewater.functions.dates import parse_date
from tidewater.functions.numbers import local_number, round_half_even_int
from tidewater.functions.rules import first_rule, flag, not_equal_keep_null, not_in_keep_null, not_true
from tidewater.functions.text import capitalize_first, concat_null_empty
from tidewater.operators.aggregates import group_agg, numeric_sums
from tidewater.operators.reshape import attribute_pivot
from tidewater.operators.relational import lookup_join
from tidewater.operators.versions import first_by, latest_by


def test_n1_null_keys_match_only_when_null_safe(spark):
    a = spark.createDataFrame([(None, 1), ("x", 2)], "k string, v int")
    b = spark.createDataFrame([(None, "n"), ("x", "y")], "k string, w string")
    sql = lookup_join(a, b, "k")
    assert rows(sql, "v", "w") == [(1, None), (2, "y")]
    pandas_like = lookup_join(a, b, "k", null_safe=True)
    assert rows(pandas_like, "v", "w") == [(1, "n"), (2, "y")]


def test_n2_not_true_keeps_null(spark):
    df = spark.createDataFrame([(True,), (False,), (None,)], "f boolean")
    assert df.where(not_true("f")).count() == 2


def test_n3_not_equal_keeps_null(spark):
    df = spark.createDataFrame([("X",), ("Y",), (None,)], "t string")
    assert sorted(df.where(not_equal_keep_null("t", "X")).collect(), key=repr) == sorted(
        df.where(F.col("t").isNull() | (F.col("t") != "X")).collect(), key=repr)
    assert df.where(not_equal_keep_null("t", "X")).count() == 2


def test_n4_not_in_keeps_null(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "t string")
    assert df.where(not_in_keep_null("t", ["a"])).count() == 2


def test_n5_pandas_groupby_drops_null_keys(spark):
    df = spark.createDataFrame([("a", 1.0), (None, 2.0)], "k string, v double")
    assert group_agg(df, ["k"], {"s": ("sum", "v")}).count() == 2
    assert rows(group_agg(df, ["k"], {"s": ("sum", "v")}, drop_null_keys=True)) == [("a", 1.0)]


def test_n6_pandas_sum_of_nulls_is_zero(spark):
    df = spark.createDataFrame([("a", None), ("a", None)], "k string, v double")
    assert rows(group_agg(df, ["k"], {"s": ("sum", "v")})) == [("a", None)]
    assert rows(numeric_sums(df, ["k"])) == [("a", 0.0)]


def test_n7_null_order_never_ranks_first(spark):
    df = spark.createDataFrame([("a", None, 1), ("a", 5, 2), ("b", None, 3), (None, 1, 4)],
                               "k string, o int, id int")
    out = first_by(df, ["k"], "o", "id", drop_null_keys=True, drop_null_order=True)
    assert rows(out, "k", "id") == [("a", 2)]
    # Spark SQL default: nulls first ascending
    sql = first_by(df, ["k"], "o", "id")
    assert ("a", 1) in rows(sql, "k", "id")


def test_n8_ties_need_a_tie_break(spark):
    df = spark.createDataFrame([("a", 1, 10), ("a", 1, 11)], "k string, o int, id int")
    assert rows(latest_by(df, ["k"], "o", "id"), "id") == [(11,)]
    assert rows(first_by(df, ["k"], "o", "id"), "id") == [(10,)]
    import pytest
    with pytest.raises(ValueError):
        latest_by(df, ["k"], None)


def test_n9_half_even_rounding(spark):
    df = spark.createDataFrame([(0.5,), (1.5,), (2.5,), (-2.5,), (None,)], "x double")
    assert [r[0] for r in df.select(round_half_even_int("x")).collect()] == [0, 2, 2, -2, None]


def test_n10_bad_text_becomes_null(spark):
    df = spark.createDataFrame([("31-02-2023",), ("28-02-2023",), ("abc",)], "t string")
    got = [r[0] for r in df.select(parse_date("t", "dd-MM-yyyy")).collect()]
    assert got == [None, dt.date(2023, 2, 28), None]
    nums = spark.createDataFrame([("1.234,56",), ("x",)], "t string")
    assert [r[0] for r in nums.select(local_number("t")).collect()] == [1234.56, None]


def test_n11_tsql_concat_null_is_empty(spark):
    df = spark.createDataFrame([("a", None)], "x string, y string")
    assert df.select(concat_null_empty("x", "y")).first()[0] == "a"
    assert df.select(F.concat("x", "y")).first()[0] is None


def test_n12_capitalize_first_only(spark):
    df = spark.createDataFrame([("hELLO wORLD",), ("",), (None,)], "t string")
    assert [r[0] for r in df.select(capitalize_first("t")).collect()] == ["Hello world", "", None]


def test_n13_dot_removed_literally(spark):
    df = spark.createDataFrame([("1.000.000,5",)], "t string")
    assert df.select(local_number("t")).first()[0] == 1000000.5


def test_n14_pivot_repeats_are_reported(spark):
    df = spark.createDataFrame([(1, "a", "x"), (1, "a", "y"), (2, "b", "z")], "e int, attr string, v string")
    wide, dupes = attribute_pivot(df, "e", "attr", "v", ["a", "b", "c"])
    assert set(wide.columns) == {"e", "a", "b", "c"}
    assert rows(dupes) == [(1, "a", 2)]


def test_n15_or_with_nulls_is_false(spark):
    df = spark.createDataFrame([(None, None), (1, None)], "a int, b int")
    got = [r[0] for r in df.select(flag((F.col("a") > 0) | (F.col("b") > 0))).collect()]
    assert got == [False, True]
    got2 = [r[0] for r in df.select(first_rule([(F.col("a") > 0, "y")], "n")).collect()]
    assert got2 == ["n", "y"]
