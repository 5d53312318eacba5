"""Operators on small hand-made frames, checked against brute-force answers."""

import datetime as dt

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tests.conftest import plan_text, rows
from tidewater.operators.aggregates import group_agg, profile_table
from tidewater.operators.history import snapshot_merge
from tidewater.operators.relational import (branch_counts, exclude, exists_flag, folded_join, hop, keep_only,
                                            lookup_join, role_join)
from tidewater.operators.reshape import attribute_pivot, densify_sum, key_batches, month_spine, rollup_rows
from tidewater.operators.sets import name_difference, split_union, tagged_union, union_all
from tidewater.operators.versions import drop_earliest_dup, first_by, latest_by


def test_latest_by_matches_row_number_window(spark):
    data = [(k, t, i, float(i)) for i, (k, t) in enumerate(
        [("a", 1), ("a", 3), ("a", 3), ("b", 2), ("b", None), (None, 5), (None, 1), ("c", None)])]
    df = spark.createDataFrame(data, "k string, t int, id int, v double")
    w = Window.partitionBy("k").orderBy(F.col("t").desc(), F.col("id").desc())
    expected = df.withColumn("rn", F.row_number().over(w)).where("rn = 1").drop("rn")
    assert rows(latest_by(df, ["k"], "t", "id")) == rows(expected)
    w2 = Window.partitionBy("k").orderBy(F.col("t").asc(), F.col("id").asc())
    expected2 = df.withColumn("rn", F.row_number().over(w2)).where("rn = 1").drop("rn")
    assert rows(first_by(df, ["k"], "t", "id")) == rows(expected2)


def test_hot_key_selection_is_reduced_before_the_shuffle(spark):
    df = spark.range(0, 3000).select((F.col("id") % 3 == 0).cast("int").alias("k"), F.col("id").alias("t"))
    plan = plan_text(latest_by(df, ["k"], "t"))
    partial = plan.index("Partial")
    assert "WindowGroupLimit" in plan and plan.index("Exchange") < partial
    assert rows(latest_by(df, ["k"], "t")) == [(0, 2999), (1, 2997)]


def test_drop_earliest_dup(spark):
    d1, d2, d3 = dt.date(2023, 1, 1), dt.date(2023, 1, 2), dt.date(2023, 1, 3)
    df = spark.createDataFrame([(1, d1, "a"), (1, d1, "b"), (1, d2, "c"), (2, d1, "d"), (3, d1, "e"),
                                (3, d2, "f"), (3, d3, "g"), (None, d1, "h"), (4, None, "i")],
                               "reuid int, fecha date, x string")
    assert rows(drop_earliest_dup(df, "reuid", "fecha"), "x") == [("c",), ("d",), ("f",), ("g",), ("h",), ("i",)]


def test_lookup_join_unknown_member_and_select(spark):
    fact = spark.createDataFrame([(1, 10.0), (2, 20.0)], "k int, v double")
    dim = spark.createDataFrame([(1, "one", "x")], "id int, name string, other string")
    out = lookup_join(fact, dim, {"k": "id"}, select=["id", "name"], defaults={"id": 99999999, "name": "Sin Información"})
    assert rows(out, "k", "id", "name") == [(1, 1, "one"), (2, 99999999, "Sin Información")]
    assert "other" not in out.columns


def test_role_join_and_hop(spark):
    nodes = spark.createDataFrame([(1, "n1", 1), (2, "n2", 2), (3, "n3", 1)], "id int, name string, typ int")
    facts = spark.createDataFrame([(1, 2), (3, 1)], "a int, b int")
    out = role_join(facts, nodes, "id", {"src": "a", "dst": "b"}, ["name"])
    assert rows(out, "src_name", "dst_name") == [("n1", "n2"), ("n3", "n1")]
    edges = spark.createDataFrame([(1, 2), (1, 3), (2, 3)], "s int, d int")
    got = hop(edges, nodes, "s", "d", "id", ["name", "typ"], dst_filter=F.col("dst_typ") == 1)
    assert rows(got, "src_name", "dst_name") == [("n1", "n3"), ("n2", "n3")]


def test_flags_and_exclusions(spark):
    a = spark.createDataFrame([(1,), (2,), (2,), (3,)], "k int")
    b = spark.createDataFrame([(2,), (2,), (4,)], "k int")
    assert rows(exists_flag(a, b, "k", "f")) == [(1, False), (2, True), (2, True), (3, False)]
    assert rows(exclude(a, b, "k")) == [(1,), (3,)]
    assert rows(keep_only(a, b, "k")) == [(2,), (2,)]


def test_folded_join(spark):
    a = spark.createDataFrame([("Biobío",), ("ÑUBLE",), ("Los Ríos",)], "comuna string")
    b = spark.createDataFrame([("biobio", 8), ("nuble", 16)], "n string, id int")
    assert rows(folded_join(a, b, "comuna", "n"), "comuna", "id") == [("Biobío", 8), ("Los Ríos", None), ("ÑUBLE", 16)]


def test_branch_counts_true_and_fan_out(spark):
    parent = spark.createDataFrame([(1,), (2,), (3,)], "k int")
    m = spark.createDataFrame([(1,), (1,), (2,)], "k int")
    c = spark.createDataFrame([(1,), (1,), (1,)], "k int")
    s = spark.createDataFrame([(9,)], "k int")
    br = {"m": (m, "k"), "c": (c, "k"), "s": (s, "k")}
    assert rows(branch_counts(parent, "k", br)) == [(1, 2, 3, 0), (2, 1, 0, 0)]
    # the chained LEFT JOIN form: person 1 has 2 x 3 joined rows
    assert rows(branch_counts(parent, "k", br, fan_out=True)) == [(1, 6, 6, 0), (2, 1, 0, 0)]


def test_group_agg_having_and_expressions(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", None)], "k string, v int")
    out = group_agg(df, ["k"], {"n": ("count", "*"), "nn": ("count", "v"), "s": ("sum", "v")},
                    having=(F.col("n") > 1) | (F.col("nn") > 5))
    assert rows(out) == [("a", 2, 2, 3)]


def test_profile_table(spark):
    df = spark.createDataFrame([(1, "x"), (3, None)], "a int, b string")
    got = {r["column_name"]: r for r in profile_table(df).collect()}
    assert got["a"]["n_non_null"] == 2 and got["a"]["mean_value"] == 2.0 and got["a"]["max_value"] == 3.0
    assert got["b"]["n_non_null"] == 1 and got["b"]["min_value"] is None


def test_attribute_pivot_dedup_first(spark):
    df = spark.createDataFrame([(1, "a", "late", 2), (1, "a", "early", 1), (1, "b", "x", 5)],
                               "e int, attr string, v string, o int")
    wide, _ = attribute_pivot(df, "e", "attr", "v", ["a", "b", "zz"], dedup_order="o")
    assert rows(wide, "e", "a", "b", "zz") == [(1, "early", "x", None)]


def test_densify_sum(spark):
    df = spark.createDataFrame([("s1", "r1", "t1", 2020, 5.0), ("s1", "r1", "t1", 2020, 1.0),
                                ("s2", "r2", "t1", 2022, 2.0), (None, "r1", "t1", 2021, 7.0)],
                               "escenario string, region string, tecnologia string, ano int, potencia double")
    out = densify_sum(df, ["escenario", "region", "tecnologia"], "ano", "potencia")
    got = rows(out)
    assert len(got) == 2 * 2 * 1 * 3
    assert ("s1", "r1", "t1", 2020, 6.0) in got and ("s2", "r2", "t1", 2022, 2.0) in got
    assert ("s1", "r2", "t1", 2021, 0.0) in got
    assert all(r[0] is not None for r in got)


def test_rollup_rows(spark):
    d = dt.date
    df = spark.createDataFrame([
        ("p1", "h1", "m1", "ana", True, d(2023, 1, 5), d(2023, 2, 1)),
        ("p1", "h2", "m2", "bob", None, d(2023, 1, 1), d(2023, 3, 1)),
        ("p2", "h3", "m3", "cy", False, d(2023, 5, 1), None),
        (None, "h4", "m4", "dd", True, d(2023, 1, 1), d(2023, 1, 2)),
    ], "id string, id_hito string, nombre string, lider string, fin boolean, ini date, fn date")
    out = rollup_rows(df, "id", mins=["ini"], maxs=["fn"], done_col="fin", label_col="nombre", label="H0",
                      cleared=["lider", "id_hito"], order_by="ini", tie_break="id_hito")
    summary = {r["id"]: r for r in out.where("nombre = 'H0'").collect()}
    assert set(summary) == {"p1", "p2"}
    assert summary["p1"]["fin"] is True and summary["p2"]["fin"] is False
    assert summary["p1"]["ini"] == d(2023, 1, 1) and summary["p1"]["fn"] == d(2023, 3, 1)
    assert summary["p1"]["lider"] is None and summary["p1"]["id_hito"] is None
    assert out.count() == 6


@pytest.mark.parametrize("n", [29, 30, 31, 61])
def test_key_batches_sizes(spark, n):
    df = spark.range(0, n).select((F.col("id") * 7 % 1000).alias("k")).union(
        spark.range(0, 5).select((F.col("id") * 7).alias("k")))
    out = key_batches(df, "k", size=30).collect()
    keys = sorted({(i * 7) % 1000 for i in range(n)})
    expected = [",".join(str(k) for k in keys[i:i + 30]) for i in range(0, len(keys), 30)]
    got = [r["claves"] for r in sorted(out, key=lambda r: r["grupo"])]
    assert got == expected
    assert [r["grupo"] for r in sorted(out, key=lambda r: r["grupo"])] == list(range(len(expected)))


def test_month_spine(spark):
    out = month_spine(spark, "2020-11-15", "2021-02-01").collect()
    assert [r["periodo"] for r in out] == [2020011, 2020012, 2021001, 2021002]


def test_snapshot_merge_cases(spark):
    d = dt.date
    hist = spark.createDataFrame([
        ("r1", "a", d(2022, 1, 1), None, None),      # open, still in snapshot -> kept open
        ("r2", "b", d(2022, 1, 1), None, None),      # open, gone -> finished
        (None, "c", d(2022, 1, 1), None, None),      # fallback key, gone -> never finished (as written)
        ("r4", "d", d(2022, 1, 1), "2022-05-01", True),  # finished, back in snapshot -> appended again
    ], "rut string, rol string, fecha_publicacion date, fecha_ejecucion string, proceso_finalizado boolean")
    snap = spark.createDataFrame([("r1", "a", d(2022, 11, 1)), ("r4", "d", d(2022, 11, 1)),
                                  ("r5", "e", d(2022, 11, 1)), (None, "f", d(2022, 11, 1))],
                                 "rut string, rol string, fecha_publicacion date")
    reg = spark.createDataFrame([("r5", "Five", "ACTIVO", 1), ("r5", "Five b", "ACTIVO", 2), ("r4", "Four", "INACTIVO", 1)],
                                "rut string, razon_social string, estado string, o int")
    out = snapshot_merge(hist, snap, "2022-11-07", registry=reg, registry_cols=["razon_social"],
                         registry_filter=F.col("estado") == "ACTIVO", registry_order="o")
    assert out.count() == 7  # 4 history rows + r4 (no longer open), r5 and the fallback-key row
    got = {(r["rut"], r["rol"], r["fecha_publicacion"]): r for r in out.collect()}
    got = {k[:2]: v for k, v in sorted(got.items(), key=lambda kv: kv[0][2])}
    assert got[("r2", "b")]["proceso_finalizado"] is True and got[("r2", "b")]["fecha_ejecucion"] == "2022-11-07"
    assert got[("r1", "a")]["proceso_finalizado"] is None
    assert got[(None, "c")]["proceso_finalizado"] is None
    assert got[("r5", "e")]["razon_social"] == "Five b"
    assert (None, "f") in got
    fixed = snapshot_merge(hist, snap, "2022-11-07", finished_by="key", open_only=True)
    fixed_rows = {(r["rut"], r["rol"]): r for r in fixed.collect()}
    assert fixed_rows[(None, "c")]["proceso_finalizado"] is True


def test_unions(spark):
    a = spark.createDataFrame([(1, "x")], "id int, a string")
    b = spark.createDataFrame([(2, 3.0)], "id int, b double")
    assert rows(union_all([a, b], allow_missing=True), "id", "a", "b") == [(1, "x", None), (2, None, 3.0)]
    t = tagged_union({"s1": a, "s2": a}, "escenario")
    assert rows(t, "escenario") == [("s1",), ("s2",)]
    df = spark.createDataFrame([(1, None), (2, "x"), (3, "y")], "id int, c string")
    out = split_union(df, F.col("c") == "x", {"id": F.col("id"), "t": F.lit("yes")}, {"id": F.col("id"), "t": F.lit("no"), "u": F.lit(1)})
    assert rows(out, "id", "u") == [(1, 1), (2, None), (3, 1)]
    assert rows(out, "id", "t") == [(1, "no"), (2, "yes"), (3, "no")]
    raw = spark.createDataFrame([("p1",), ("p2",), ("p2",)], "n string")
    stg = spark.createDataFrame([("p1",)], "n string")
    assert rows(name_difference(raw, stg, "n")) == [("p2",), ("p2",)]
    assert rows(name_difference(raw, stg, "n", distinct=True)) == [("p2",)]


def test_group_agg_other_functions(spark):
    df = spark.createDataFrame([("a", 1, True), ("a", 1, False), ("a", 3, None), ("b", None, True)],
                               "k string, v int, f boolean")
    out = group_agg(df, ["k"], {"nd": ("count_distinct", "v"), "anyf": ("any", "f"), "allf": ("all", "f"),
                                "mn": ("min", "v"), "mx": ("max", "v"), "av": ("avg", "v")})
    got = {r["k"]: r for r in out.collect()}
    assert (got["a"]["nd"], got["a"]["anyf"], got["a"]["allf"], got["a"]["mn"], got["a"]["mx"]) == (2, True, False, 1, 3)
    assert got["b"]["nd"] == 0 and got["b"]["av"] is None
    zero = group_agg(df, ["k"], {"s": ("sum", "v")}, zero_sum=True)
    assert {r["k"]: r["s"] for r in zero.collect()} == {"a": 5, "b": 0}


def test_lookup_join_semi_anti_and_multi_key_null_safe(spark):
    a = spark.createDataFrame([(1, None, "x"), (1, "p", "y"), (2, "q", "z")], "k1 int, k2 string, v string")
    b = spark.createDataFrame([(1, None, "N"), (1, "p", "P")], "c1 int, c2 string, w string")
    on = {"k1": "c1", "k2": "c2"}
    assert rows(lookup_join(a, b, on, how="left_semi"), "v") == [("y",)]
    assert rows(lookup_join(a, b, on, how="left_anti"), "v") == [("x",), ("z",)]
    assert rows(lookup_join(a, b, on, null_safe=True), "v", "w") == [("x", "N"), ("y", "P"), ("z", None)]
