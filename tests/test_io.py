"""Write/read round trips (K1-K15, S1-S12) in fresh folders."""

import datetime as dt
import os

from pyspark.sql import functions as F

from tests.conftest import plan_text, rows
from tidewater.sources.readers import file_prefixes, read_partitions, read_table, typed_ingest, with_path_columns
from tidewater.sources.sinks import audit_row, high_water_mark, write_table
from tidewater.functions.dates import partitions_since


def test_overwrite_partitions_only_touches_present_partitions(spark, tmp_dir):
    path = os.path.join(tmp_dir, "t")
    df = spark.createDataFrame([(1, 2023, 1), (2, 2023, 2)], "v int, year int, month int")
    write_table(df, path, mode="overwrite", partition_by=["year", "month"])
    upd = spark.createDataFrame([(9, 2023, 2), (3, 2023, 3)], "v int, year int, month int")
    write_table(upd, path, mode="overwrite_partitions", partition_by=["year", "month"])
    assert rows(read_table(spark, path), "v", "month") == [(1, 1), (3, 3), (9, 2)]
    write_table(upd, path, mode="overwrite", partition_by=["year", "month"])
    assert rows(read_table(spark, path), "v") == [(3,), (9,)]
    write_table(upd, path, mode="append", partition_by=["year", "month"])
    assert read_table(spark, path).count() == 4


def test_partition_pruned_read_and_path_columns(spark, tmp_dir):
    path = os.path.join(tmp_dir, "p")
    df = spark.createDataFrame([(i, 2023, m) for i, m in enumerate([1, 2, 3, 4])], "v int, year int, month int")
    write_table(df, path, partition_by=["year", "month"], compression="gzip")
    got = read_partitions(spark, path, partitions_since("2023-03-20"))
    assert rows(got, "v") == [(2,)]
    plan = plan_text(got)
    assert "PartitionFilters" in plan
    back = with_path_columns(spark.read.parquet(path), {"m": -2}, strip_prefix={"m": "month="})
    assert sorted(r["m"] for r in back.collect()) == ["1", "2", "3", "4"]
    assert sorted(r[0] for r in file_prefixes(spark.read.parquet(path), 2).collect()) == [
        "month=1", "month=2", "month=3", "month=4"]


def test_typed_ingest_and_csv(spark, tmp_dir):
    path = os.path.join(tmp_dir, "c")
    os.makedirs(path)
    with open(os.path.join(path, "a.csv"), "w", encoding="utf-8") as fh:
        fh.write("Año;Reg. Rom.;Valor\n2023;XV;1.5\n20x3;I;2\n")
    out = typed_ingest(spark, path, "`Año` INT, `Reg. Rom.` STRING, Valor DOUBLE", sep=";")
    assert out.columns == ["ano", "reg_rom_", "valor"]
    assert rows(out) == [(2023, "XV", 1.5), (None, "I", 2.0)]
    tsv = os.path.join(tmp_dir, "tsv")
    df = spark.createDataFrame([(1, "a b", dt.date(2023, 1, 2))], "id int, s string, d date")
    write_table(df, tsv, fmt="csv", sep="\t", compression="none")
    text = "".join(open(os.path.join(tsv, f), encoding="utf-8").read() for f in sorted(os.listdir(tsv)) if f.endswith(".csv"))
    assert text.splitlines()[0] == "id\ts\td"
    assert rows(typed_ingest(spark, tsv, "id INT, s STRING, d DATE", sep="\t", clean=False)) == [(1, "a b", dt.date(2023, 1, 2))]


def test_write_casts_clean_names_and_catalog(spark, tmp_dir):
    path = os.path.join(tmp_dir, "k")
    df = spark.createDataFrame([("1", "x")], "`Código` string, `Otro Campo` string")
    write_table(df, path, casts={"int": ["Código"]}, clean=True, files=2, table="tw_test_table")
    back = spark.table("tw_test_table")
    assert back.columns == ["codigo", "otro_campo"] and rows(back) == [(1, "x")]
    spark.sql("DROP TABLE IF EXISTS tw_test_table")


def test_audit_and_marks(spark):
    df = spark.createDataFrame([(dt.date(2023, 1, 1),), (dt.date(2023, 2, 1),)], "d date")
    a = audit_row(df, "t", "staging", "2023-03-01", mark=F.col("d")).first()
    assert (a["n_rows"], a["status"], a["error"], a["mark"]) == (2, "OK", None, dt.date(2023, 2, 1))
    empty = audit_row(df.where("false"), "t", "staging", "2023-03-01").first()
    assert empty["status"] == "ERROR" and "no rows" in empty["error"]
    assert high_water_mark(df, "d", "t").first()["mark"] == dt.date(2023, 2, 1)


def test_available_now_file_run(spark, tmp_dir):
    from tidewater.streaming.incremental import run_available_files
    src, out, ckpt = (os.path.join(tmp_dir, p) for p in ("src", "out", "ckpt"))
    spark.createDataFrame([(1, "a"), (2, "b")], "id int, s string").write.parquet(os.path.join(src, "batch=1"))
    seen = []

    def sink(batch_df, epoch_id):
        seen.append(epoch_id)
        batch_df.write.mode("append").parquet(out)

    run_available_files(spark, src, "id int, s string, batch int", lambda d: d.where("id > 1"), sink, ckpt)
    assert rows(spark.read.parquet(out), "id") == [(2,)]
    spark.createDataFrame([(3, "c")], "id int, s string").write.parquet(os.path.join(src, "batch=2"))
    run_available_files(spark, src, "id int, s string, batch int", lambda d: d.where("id > 1"), sink, ckpt)
    assert rows(spark.read.parquet(out), "id") == [(2,), (3,)]  # the first file is not read again


def test_schema_evolution_on_append(spark, tmp_dir):
    path = os.path.join(tmp_dir, "evo")
    write_table(spark.createDataFrame([(1, 2023)], "a int, year int"), path, partition_by=["year"])
    write_table(spark.createDataFrame([(2, "x", 2024)], "a int, b string, year int"), path, mode="append",
                partition_by=["year"])
    back = read_table(spark, path, merge_schema=True)
    assert sorted(back.columns) == ["a", "b", "year"]
    assert rows(back, "a", "b", "year") == [(1, None, 2023), (2, "x", 2024)]


def test_incremental_load_with_audit_and_marks(spark, tmp_dir):
    import datetime as dt
    from tidewater.streaming.incremental import incremental_load
    src, tgt, audit, marks, ckpt = (os.path.join(tmp_dir, p) for p in ("src", "tgt", "audit", "marks", "ckpt"))
    schema = "id int, d date, month int"
    spark.createDataFrame([(1, dt.date(2023, 1, 5)), (2, dt.date(2023, 2, 1))], "id int, d date").write \
        .parquet(os.path.join(src, "month=1"))
    args = dict(target=tgt, table="t", stage="staging", as_of="2023-03-01", checkpoint=ckpt, audit_path=audit,
                marks_path=marks, mark_col="d", partition_by=["month"])
    incremental_load(spark, src, schema, lambda d: d.where("id > 0"), **args)
    spark.createDataFrame([(3, dt.date(2023, 3, 9))], "id int, d date").write.parquet(os.path.join(src, "month=3"))
    incremental_load(spark, src, schema, lambda d: d.where("id > 0"), **args)
    assert rows(spark.read.parquet(tgt), "id") == [(1,), (2,), (3,)]
    spark.createDataFrame([(4, dt.date(2023, 2, 2))], "id int, d date").write.mode("append").parquet(os.path.join(src, "month=1"))
    incremental_load(spark, src, schema, lambda d: d.where("id > 0"), **args)
    assert rows(spark.read.parquet(tgt), "id") == [(1,), (2,), (3,), (4,)]          # an old partition keeps its rows
    incremental_load(spark, src, schema, lambda d: d.where("id > 0"), **args)
    assert sorted((r["n_rows"], r["status"]) for r in spark.read.parquet(audit).collect()) == [(0, "ERROR"), (1, "OK"), (1, "OK"), (2, "OK")]
    assert max(r["mark"] for r in spark.read.parquet(marks).collect()) == dt.date(2023, 3, 9)


def test_output_file_control(spark, tmp_dir):
    df = spark.range(0, 1000).select((F.col("id") % 3).alias("g"), F.col("id"))
    p1 = os.path.join(tmp_dir, "files4")
    write_table(df, p1, files=4)
    assert len([f for f in os.listdir(p1) if f.endswith(".parquet")]) == 4
    p2 = os.path.join(tmp_dir, "capped")
    write_table(df.coalesce(1), p2, max_records_per_file=300)
    assert len([f for f in os.listdir(p2) if f.endswith(".parquet")]) == 4
    assert read_table(spark, p2).count() == 1000


def test_recursive_read_and_literal_bound(spark, tmp_dir):
    from tidewater.sources.readers import literal_table
    base = os.path.join(tmp_dir, "rec")
    spark.createDataFrame([(1,)], "a int").write.parquet(os.path.join(base, "x", "y"))
    spark.createDataFrame([(2,)], "a int").write.parquet(os.path.join(base, "z"))
    assert rows(read_table(spark, base, recursive=True), "a") == [(1,), (2,)]
    assert literal_table(spark, [(1, "a")], "n int, s string").count() == 1


def test_no_machine_local_folder_off_local_mode():
    import pytest
    from tidewater.session import ensure_checkpoint_dir

    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return Conf()

    class Session:
        sparkContext = Context()
        conf = Conf()

    with pytest.raises(RuntimeError):
        ensure_checkpoint_dir(Session())
