"""Column functions: names, text, numbers, dates, rules, nested data."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidewater.functions.dates import (month_name, parse_date, partitions_since, period_label, style_105, style_120,
                                       within_last_year, years_between)
from tidewater.functions.names import cast_columns, clean_name, clean_names, rename_positional
from tidewater.functions.nested import explode_groups, inner_names, json_text, map_lookup
from tidewater.functions.numbers import tax_inclusive
from tidewater.functions.rules import brackets, in_range_or_null, later_wins, yes_no_nonzero
from tidewater.functions.text import (contains_any, first_word, fold, full_name, sha256_text, split_part, tax_id,
                                      tax_id_with_dv)
from tidewater.streaming.incremental import rows_after_mark, years_to_reprocess


@pytest.mark.parametrize("raw,clean", [("Año", "ano"), ("Reg. Rom.", "reg_rom_"), ("BARRA_PROYECCION", "barra_proyeccion"),
                                       ("stateMachineArn", "statemachinearn"), ("MedidaHoraria2", "medidahoraria2"),
                                       ("Saldo ($)", "saldo_"), ("Código Cliente", "codigo_cliente")])
def test_clean_name(raw, clean):
    assert clean_name(raw) == clean


def test_clean_names_collision_and_positional(spark):
    df = spark.createDataFrame([(1, 2)], "`A b` int, `a_b` int")
    with pytest.raises(ValueError):
        clean_names(df)
    with pytest.raises(ValueError):
        rename_positional(df, ["x"])


def test_cast_columns_bad_values_null(spark):
    df = spark.createDataFrame([("12", "x", "2023-01-05")], "a string, b string, c string")
    out = cast_columns(df, {"int": ["a", "b", "missing"], "date": ["c"]}).first()
    assert (out["a"], out["b"], out["c"]) == (12, None, dt.date(2023, 1, 5))


def test_fold_and_first_word(spark):
    df = spark.createDataFrame([("Ñuble Árbol",), ("Biobío",), ("straße",), (None,)], "t string")
    assert [r[0] for r in df.select(fold("t")).collect()] == ["nuble arbol", "biobio", "strae", None]
    assert [r[0] for r in df.select(first_word("t")).collect()] == ["nuble", "biobio", "strae", None]


def test_text_helpers(spark):
    df = spark.createDataFrame([("12345678-k", None, "a  b", "x:y:z")], "r string, n string, s string, p string")
    r = df.select(tax_id("r").alias("t"), tax_id(F.lit("1-9")).alias("short"),
                  sha256_text("n").alias("h"), sha256_text("s").alias("h2"),
                  full_name("s", "n", F.lit("c")).alias("fn"), split_part("p", ":", -1).alias("last"),
                  tax_id_with_dv(F.lit(12), F.lit(None).cast("string")).alias("dv")).first()
    assert r["t"] == "012345678K" and r["short"] == "0000000019"
    assert r["h"] is None and len(r["h2"]) == 64
    assert r["fn"] == "a b c" and r["last"] == "z" and r["dv"] is None


def test_contains_any_words(spark):
    df = spark.createDataFrame([("Reunión CANCELADA",), ("ok",), (None,)], "t string")
    assert [r[0] for r in df.select(contains_any("t", ["cancelada", "pospuesta"])).collect()] == [True, False, None]


def test_bad_data_gives_null(spark):
    from tidewater.functions.numbers import local_number, round_half_even_int
    df = spark.createDataFrame([("202313", "solo", "3.000.000.000,00"), ("202300", None, "x")], "p string, s string, n string")
    got = df.select(period_label("p"), split_part("s", ":", 2), round_half_even_int(local_number("n"))).collect()
    assert [tuple(r) for r in got] == [(None, None, 3000000000), (None, None, None)]


def test_period_label_and_months(spark):
    df = spark.createDataFrame([("202301",), ("20235",), ("202312",), (None,)], "p string")
    assert [r[0] for r in df.select(period_label("p")).collect()] == ["ene - 2023", "may - 2023", "dic - 2023", None]
    m = spark.createDataFrame([(1,), (12,), (13,)], "m int")
    assert [r[0] for r in m.select(month_name("m")).collect()] == ["Enero", "Diciembre", None]


def test_years_between_half_even(spark):
    df = spark.createDataFrame([(dt.date(2000, 1, 1),), (None,)], "d date")
    got = [r[0] for r in df.select(years_between("d", "2023-01-01")).collect()]
    assert got == [round(8401 / 365), None]


def test_date_styles_and_last_year(spark):
    df = spark.createDataFrame([(dt.date(2022, 3, 4),), (None,)], "d date")
    r = df.select(style_120("d"), style_105("d"), within_last_year("d", "2023-03-01")).collect()
    assert tuple(r[0]) == ("2022-03-04", "04-03-2022", True)
    assert r[1][2] is False


def test_partition_predicates(spark):
    df = spark.createDataFrame([(y, m) for y in (2021, 2022, 2023) for m in range(1, 13)], "year int, month int")
    assert df.where(partitions_since("2023-05-15", months=12)).count() == 7 + 12  # 2022-06 .. 2023-12
    assert df.where(partitions_since("2023-05-15")).count() == 1
    jan = years_to_reprocess(df, "2023-01-10")
    assert sorted({r["year"] for r in jan.collect()}) == [2022, 2023]
    jul = years_to_reprocess(df, "2023-07-10")
    assert sorted({r["year"] for r in jul.collect()}) == [2023]
    missing = years_to_reprocess(df.where("year = 2021"), "2023-01-10")
    assert missing.count() == 0


def test_rows_after_mark(spark):
    df = spark.createDataFrame([(1,), (5,), (9,)], "v int")
    marks = spark.createDataFrame([("t", 4), ("t", 6), ("u", 100)], "table_name string, mark int")
    assert rows(rows_after_mark(df, marks, "t", "v")) == [(9,)]
    assert rows(rows_after_mark(df, marks, "none", "v")) == [(1,), (5,), (9,)]


def test_rules(spark):
    df = spark.createDataFrame([(5.0,), (10.0,), (25.0,), (1e6,), (None,)], "x double")
    out = [r[0] for r in df.select(brackets("x", [10, 25], ["a", "b", "c"], otherwise="z")).collect()]
    assert out == ["a", "a", "b", "c", "z"]
    codes = spark.createDataFrame([("FRN1",), ("FR2",), ("FN3",), ("X",)], "c string")
    c = F.col("c")
    rule = later_wins([(c.startswith("FR"), "FR"), (c.startswith("FN"), "FN"), (c.startswith("FRN"), "FRN")], "other")
    assert [r[0] for r in codes.select(rule).collect()] == ["FRN", "FR", "FN", "other"]
    ages = spark.createDataFrame([(17,), (18,), (120,), (121,), (None,)], "a int")
    assert [r[0] for r in ages.select(in_range_or_null("a", 18, 120)).collect()] == [False, True, True, False, True]
    nz = spark.createDataFrame([(0, None), (0, 2), (None, None)], "a int, b int")
    assert [r[0] for r in nz.select(yes_no_nonzero("a", "b")).collect()] == ["No", "Si", "No"]


def test_tax_inclusive(spark):
    df = spark.createDataFrame([(100.0, "IVA_EXE"), (100.0, None), (100.0, "C1")], "n double, c string")
    assert [round(r[0], 6) for r in df.select(tax_inclusive("n", "c")).collect()] == [100.0, 119.0, 119.0]


def test_json_helpers(spark):
    schema = "name STRING, types ARRAY<STRUCT<type: STRUCT<name: STRING>>>"
    df = spark.createDataFrame([('{"name":"a","types":[{"type":{"name":"x"}},{"type":{"name":"y"}}],"max_tol":"5"}',),
                                ('{"name":"b"}',), ("not json",)], "j string")
    got = [r[0] for r in df.select(inner_names("j", schema, "types", "type.name")).collect()]
    assert got == [["x", "y"], None, None]
    assert [r[0] for r in df.select(json_text("j", "$.max_tol")).collect()] == ["5", None, None]


def test_maps_and_groups(spark):
    df = spark.createDataFrame([("F",), ("P",), (None,)], "s string")
    assert [r[0] for r in df.select(map_lookup("s", {"F": "Fin"})).collect()] == ["Fin", None, None]
    g = explode_groups(spark, {"A": ["x", "y"], "B": ["z"]}, "grupo", "v")
    assert rows(g) == [("A", "x"), ("A", "y"), ("B", "z")]


def test_parse_date_guard_matches_plain_parse(spark):
    import random
    rnd = random.Random(7)
    texts = []
    for _ in range(400):
        y, m, d = rnd.randint(0, 2100), rnd.randint(0, 14), rnd.randint(0, 33)
        texts += [f"{y:04d}-{m:02d}-{d:02d}", f"{d:02d}-{m:02d}-{y:04d}", f"{d:02d}/{m:02d}/{y:04d}"]
    texts += ["2024-02-29", "2023-02-29", "29-02-2000", "29/02/1900", "1-1-2020", "2020-1-01", " 2020-01-01",
              "2020-01-01 ", "x", "", None, "10000-01-01", "2020/01/01", "31-04-2021", "30-04-2021"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for fmt in ["yyyy-MM-dd", "dd-MM-yyyy", "dd/MM/yyyy"]:
        got = df.select(parse_date("t", fmt).alias("a"), F.to_date(F.try_to_timestamp("t", F.lit(fmt))).alias("b")).collect()
        assert [r["a"] for r in got] == [r["b"] for r in got], fmt
