"""Listings in tasks, schema evolution, staging of exports, partition replacement, observed writes, published versions."""

import datetime as dt
import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.conftest import plan_text, rows
from tidewater.sources import (Outdated, PathPart, SchemaConflict, current_version, discard_unpublished, evolve_table, files_below, publish, read_evolved,
                               read_exports, read_target, read_version, reconcile, stored_partitions, write_audited, write_table, write_targets)
from tidewater.sources import snapshots
from tidewater.streaming.incremental import reprocess_years, stored_years


def test_files_are_listed_level_by_level(spark, tmp_dir):
    want = set()
    for folder, names in {"": ["top.csv"], "a": ["1", "2"], "a/b c/ñ=1": ["x%20y", "z+"], "deep/" + "/".join("abcdef"): ["f"], "empty": [], "_hidden": ["h"], "a/.dot": ["h"]}.items():
        os.makedirs(os.path.join(tmp_dir, folder), exist_ok=True)
        for n in names:
            with open(os.path.join(tmp_dir, folder, n), "w") as f:
                f.write("12345")
            if "_h" not in folder and ".d" not in folder:
                want.add((os.path.join(tmp_dir, folder, n), folder))
    for base in (tmp_dir, tmp_dir + "/", "file://" + tmp_dir):
        got = files_below(spark, base).collect()
        assert {(r.path.replace("file://", ""), r.folder) for r in got} == want and {r["size"] for r in got} == {5}
    nothing = os.path.join(tmp_dir, "empty")
    assert files_below(spark, nothing).collect() == []


def test_partitions_come_from_folder_names(spark, tmp_dir):
    path = os.path.join(tmp_dir, "t")
    df = spark.createDataFrame([(1, 2022, "a/b"), (2, 2022, "c=d e"), (3, 2023, None), (4, None, "ñ+%")], "v int, year int, k string")
    write_table(df, path, partition_by=["year", "k"])
    got = stored_partitions(spark, path, ["year", "k"])
    assert rows(got) == rows(df.select(F.col("year").cast("string"), "k"))
    assert rows(stored_partitions(spark, path, ["year"]).distinct()) == [("2022",), ("2023",), (None,)]
    assert stored_partitions(spark, path, ["nokey"]).collect() == []


def test_years_are_replaced_by_partition_values(spark, tmp_dir):
    raw, target = os.path.join(tmp_dir, "raw"), os.path.join(tmp_dir, "target")
    data = [(i, y, f"{m:02d}") for i, (y, m) in enumerate([(2021, 12), (2022, 3), (2022, 11), (2023, 1), (2023, 2)])]
    write_table(spark.createDataFrame(data, "v int, year int, month string"), raw, partition_by=["year", "month"])
    write_table(spark.createDataFrame([(-1, y, m) for _, y, m in data], "v int, year int, month string"), target, partition_by=["year", "month"])
    assert stored_years(spark, raw, "2023-02-15") == [2022, 2023]
    assert stored_years(spark, raw, "2022-03-10") == [2022] and stored_years(spark, raw, "2024-06-01") == []
    assert stored_years(spark, raw, "2024-06-01", full_load=True) == [2021, 2022, 2023]
    seen = []
    years = reprocess_years(spark, raw, target, lambda d: seen.append(plan_text(d)) or d, "2023-02-15")
    assert years == [2022, 2023]
    scans = [line for line in seen[0].splitlines() if "FileScan" in line]
    assert len(scans) == 1 and "Join" not in seen[0] and "PartitionFilters: []" not in scans[0]
    assert rows(spark.read.parquet(target), "v", "year") == [(-1, 2021), (1, 2022), (2, 2022), (3, 2023), (4, 2023)]
    os.makedirs(os.path.join(raw, "year=odd", "month=13"))
    assert stored_years(spark, raw, "2023-02-15") == [2022, 2023]


def test_reconcile():
    s = T.StructType.fromDDL
    got = reconcile(s("a int, b string, c float, d date, e decimal(5,2), f smallint"), s("A bigint, c double, d timestamp_ntz, e int, g boolean, f int"))
    assert got == s("a bigint, b string, c double, d timestamp_ntz, e decimal(12,2), f int, g boolean")
    for stored, new in (("a int", "a string"), ("a bigint", "a double"), ("a decimal(38,10)", "a decimal(38,0)"), ("a struct<x:int>", "a struct<x:bigint>"), ("a boolean", "a int")):
        with pytest.raises(SchemaConflict, match="a: "):
            reconcile(s(stored), s(new))
    with pytest.raises(SchemaConflict, match="n: no type"):
        reconcile(s("a int"), T.StructType([T.StructField("n", T.NullType())]))
    assert reconcile(s("a int"), T.StructType([T.StructField("a", T.NullType())])) == s("a int")


def test_writes_evolve_the_table_and_its_catalog_entry(spark, tmp_dir):
    path, table = os.path.join(tmp_dir, "evo"), "tw_evolved"
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    evolve_table(spark.createDataFrame([(1, 1.5, dt.date(2020, 1, 2), Decimal(2), 2023)], "a int, f float, d date, n decimal(4,1), year int"), path, partition_by=["year"], table=table)
    evolve_table(spark.createDataFrame([(2, 1 << 40, "x", 2024)], "year2 int, a bigint, b string, year int").drop("year2"), path, partition_by=["year"], table=table)
    evolve_table(spark.createDataFrame([(3, 0.1, dt.datetime(2021, 5, 6, 7, 8), 7, 2024)], "a smallint, f double, d timestamp_ntz, n int, year int"), path, partition_by=["year"], table=table)
    want = [(1 << 40, None, None, None, "x", 2024), (1, 1.5, dt.datetime(2020, 1, 2), 2, None, 2023), (3, 0.1, dt.datetime(2021, 5, 6, 7, 8), 7, None, 2024)]
    for back in (read_evolved(spark, path), spark.table(table)):
        assert back.columns == ["a", "f", "d", "n", "b", "year"]
        assert [t for _, t in back.dtypes] == ["bigint", "double", "timestamp_ntz", "decimal(11,1)", "string", "int"]
        assert rows(back) == sorted(want, key=repr)
    with pytest.raises(SchemaConflict):
        evolve_table(spark.createDataFrame([("no", 2025)], "a string, year int"), path, partition_by=["year"], table=table)
    assert read_evolved(spark, path).count() == 3 and spark.sql(f"SHOW PARTITIONS {table}").count() == 2
    evolve_table(spark.createDataFrame([(9, 2024)], "a int, year int"), path, mode="overwrite_partitions", partition_by=["year"], table=table)
    assert rows(spark.table(table), "a", "year") == [(1, 2023), (9, 2024)]
    spark.sql(f"DROP TABLE IF EXISTS {table}")


def test_old_files_without_a_kept_schema(spark, tmp_dir):
    path = os.path.join(tmp_dir, "old")
    write_table(spark.createDataFrame([(1, "x")], "a int, b string"), path)
    evolve_table(spark.createDataFrame([(1 << 33, 2.5)], "a bigint, c double"), path)
    assert rows(read_evolved(spark, path)) == [(1, "x", None), (1 << 33, None, 2.5)]


def test_exports_are_routed_by_their_path(spark, tmp_dir):
    base, target = os.path.join(tmp_dir, "raw bucket"), os.path.join(tmp_dir, "staging")
    for key, lines in {"plan/costo/2021/Esc Húmedo/cmg_a.csv": ["x,1"], "plan/costo/2021/Esc Húmedo/cmg_b+1.csv": ["y,2"], "plan/costo/2021/seco/barras_a.csv": ["z,3", ",bad"],
                       "plan/costo/2021/seco/notes.txt": ["n,9"]}.items():
        os.makedirs(os.path.dirname(os.path.join(base, key)), exist_ok=True)
        with open(os.path.join(base, key), "w") as f:
            f.write("\n".join(["name,v", *lines]) + "\n")
    parts = {"esc": PathPart(3), "tabla": PathPart(-1, before="_"), "year": PathPart(2), "none": PathPart(9)}
    got = read_exports(spark, base, "name string, v int", parts)
    assert rows(got) == sorted([("x", 1, "Esc Húmedo", "cmg", "2021", None), ("y", 2, "Esc Húmedo", "cmg", "2021", None), ("z", 3, "seco", "barras", "2021", None), (None, None, "seco", "barras", "2021", None)], key=repr)
    spark.sql("CREATE DATABASE IF NOT EXISTS tw_staging")
    write_targets(got.drop("none"), target, "tabla", ["year", "esc"], database="tw_staging")
    assert rows(read_target(spark, target, "tabla", "cmg", ["year", "esc"]), "name", "v", "year", "esc") == [("x", 1, "2021", "Esc Húmedo"), ("y", 2, "2021", "Esc Húmedo")]
    again = got.drop("none").where("tabla = 'barras'").withColumn("v", F.lit(7))
    write_targets(again.withColumn("esc", F.lit("nuevo")), target, "tabla", ["year", "esc"], database="tw_staging")
    assert rows(spark.table("tw_staging.barras"), "v", "esc") == [(3, "seco"), (7, "nuevo"), (7, "nuevo"), (None, "seco")]
    assert spark.table("tw_staging.cmg").count() == 2
    with pytest.raises(Exception, match="no tabla in a file"):
        write_targets(got.drop("none").withColumn("tabla", F.lit(None).cast("string")), target, "tabla", ["year", "esc"])
    with pytest.raises(FileNotFoundError):
        read_target(spark, target, "tabla", "other")
    spark.sql("DROP DATABASE tw_staging CASCADE")


def test_audit_of_a_write_executes_the_input_once(spark, tmp_dir):
    ran = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            ran.add(len(b))
            yield b

    df = spark.range(1000).select("id", F.date_add(F.lit("2023-01-01").cast("date"), (F.col("id") % 7).cast("int")).alias("d")).mapInPandas(count, "id long, d date")
    for k, options in enumerate(({}, {"partition_by": ["d"], "mode": "overwrite_partitions"}, {"files": 3})):
        path, before = os.path.join(tmp_dir, str(k)), ran.value
        row = write_audited(df, path, "t", "staging", "2023-03-01", mark="d", **options)
        assert ran.value - before == 1000
        assert rows(row) == [("t", "staging", dt.date(2023, 3, 1), 1000, "OK", None, dt.date(2023, 1, 7))]
        assert spark.read.parquet(path).count() == 1000
    empty = write_audited(df.where("id < 0"), os.path.join(tmp_dir, "e"), "t", "staging", "2023-03-01").first()
    assert (empty["n_rows"], empty["status"], empty["error"]) == (0, "ERROR", "t: no rows written")


def test_published_versions(spark, tmp_dir, monkeypatch):
    path = os.path.join(tmp_dir, "hist")
    assert current_version(spark, path) is None
    with pytest.raises(FileNotFoundError):
        read_version(spark, path)
    assert publish(spark.range(3), path, None) == 1
    assert publish(read_version(spark, path).union(spark.range(3, 5)), path, 1) == 2
    # a job that dies between write and commit
    with monkeypatch.context() as m:
        m.setattr(snapshots, "commit_version", lambda *a: (_ for _ in ()).throw(KeyboardInterrupt()))
        with pytest.raises(KeyboardInterrupt):
            snapshots.publish(spark.range(100), path, 2)
    assert current_version(spark, path) == 2 and read_version(spark, path).count() == 5
    assert len(snapshots.unpublished(spark, path)) == 1
    # one that dies while it commits
    fs, p = snapshots.hadoop(spark, f"{path}/commits/0000000003")
    fs.create(p, False).close()
    assert current_version(spark, path) == 2
    assert publish(spark.range(7), path, 2) == 4
    with pytest.raises(Outdated):
        publish(spark.range(9), path, 2)
    assert read_version(spark, path).count() == 7 and read_version(spark, path, 1).count() == 3
    assert len(discard_unpublished(spark, path)) == 2 and snapshots.unpublished(spark, path) == []
    assert read_version(spark, path, 2).count() == 5
