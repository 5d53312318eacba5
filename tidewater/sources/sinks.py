"""Writers (K1-K15): one ``write_table`` for parquet / delimited text, audit rows, high-water marks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tidewater.functions.dates import as_date
from tidewater.functions.names import cast_columns, clean_names

_MODES = {"overwrite": ("overwrite", "static"), "overwrite_partitions": ("overwrite", "dynamic"),
          "append": ("append", None)}


def write_table(df: DataFrame, path: str, mode: str = "overwrite", partition_by: Sequence[str] = (),
                compression: str = "snappy", casts: Mapping[str, list[str]] | None = None,
                table: str | None = None, files: int | None = None, fmt: str = "parquet",
                sep: str | None = None, header: bool = True, clean: bool = False,
                max_records_per_file: int | None = None,
                observed: tuple[Observation, Sequence[Column]] | None = None) -> None:
    """Write a frame.

    - ``mode``: ``overwrite`` (whole target), ``overwrite_partitions`` (only partitions present
      in the data, K2) or ``append``; purging the prefix by hand (K12) is never needed.
    - ``partition_by`` (K4), ``compression`` (K5), ``casts`` = ``{type: [cols]}`` (K9),
      ``clean`` column names (K10).
    - partitioned data is clustered by the partition columns before it is written, so a task writes few
      partitions; AQE splits the tasks of a hot partition value (REBALANCE).
    - ``files`` fixes the number of output tasks (K11), by the partition columns where there are any, else
      round robin; ``max_records_per_file`` caps file size.
    - ``table`` registers an external catalog table over ``path`` (K7).
    - ``fmt="csv"`` with ``sep`` writes delimited text (K8, K15); no index column is written.
    - ``observed`` takes aggregates of the rows as they are written, in the writing tasks (``write_audited``).
    """
    if casts:
        df = cast_columns(df, casts)
    if clean:
        df = clean_names(df)
    if files:
        df = df.repartition(files, *partition_by) if partition_by else df.repartition(files)
    elif partition_by:
        df = df.hint("rebalance", *[F.col(c) for c in partition_by])
    if observed:
        # above every exchange: these aggregates come from the tasks that write, whose results count once however often a task ran
        df = df.observe(observed[0], *observed[1])
    save_mode, overwrite_kind = _MODES[mode]
    w = df.write.mode(save_mode).option("compression", compression)
    if overwrite_kind:
        w = w.option("partitionOverwriteMode", overwrite_kind)
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", max_records_per_file)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w = w.option("header", str(header).lower()).option("sep", sep or ",")
    if table:
        w.format(fmt).option("path", path).saveAsTable(table)
    else:
        w.format(fmt).save(path)


def audit_row(df: DataFrame, table: str, stage: str, as_of, mark: Column | None = None) -> DataFrame:
    """K13 (+K14): one row describing a write: table, stage, date, row count, status, error text,
    and, when ``mark`` is given, the high-water mark ``max(mark)`` from the same aggregate.

    Status is ``ERROR`` with a message when the count is below one.
    """
    aggs = [F.count(F.lit(1)).alias("n_rows")] + ([F.max(mark).alias("mark")] if mark is not None else [])
    extra = ["mark"] if mark is not None else []
    return df.agg(*aggs).select(
        F.lit(table).alias("table_name"), F.lit(stage).alias("stage"), as_date(as_of).alias("fecha"),
        F.col("n_rows"),
        F.when(F.col("n_rows") < 1, "ERROR").otherwise("OK").alias("status"),
        F.when(F.col("n_rows") < 1, F.lit(f"{table}: no rows written")).alias("error"), *extra)


def write_audited(df: DataFrame, path: str, table: str, stage: str, as_of, mark: Column | str | None = None, **options) -> DataFrame:
    """K13/K14 from the write itself: ``write_table(df, path, **options)`` and its audit row, as ``audit_row`` gives it.

    Row count and mark are observed on the rows on their way into the files: the input is executed once, nothing is cached or
    read back. The row is one literal row; the caller appends it where the job keeps its audit."""
    seen = Observation()
    of = F.col(mark) if isinstance(mark, str) else mark
    kind = df.select(of.alias("mark")).schema["mark"].dataType.simpleString() if of is not None else None
    write_table(df, path, observed=(seen, [F.count(F.lit(1)).alias("n"), *([F.max(of).alias("mark")] if of is not None else [])]), **options)
    got = seen.get
    n, spark = int(got["n"]), df.sparkSession
    values = (table, stage, n, "ERROR" if n < 1 else "OK", f"{table}: no rows written" if n < 1 else None, *([got["mark"]] if of is not None else []))
    row = spark.createDataFrame([values], "table_name string, stage string, n_rows bigint, status string, error string" + (f", mark {kind}" if kind else ""))
    return row.select("table_name", "stage", as_date(as_of).alias("fecha"), "n_rows", "status", "error", *(["mark"] if kind else []))


def high_water_mark(df: DataFrame, col: str | Column, table: str) -> DataFrame:
    """One row (table, mark) with the greatest value of ``col`` in the output."""
    c = F.col(col) if isinstance(col, str) else col
    return df.agg(F.max(c).alias("mark")).select(F.lit(table).alias("table_name"), "mark")
