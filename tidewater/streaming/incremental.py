"""Incremental processing. The reference has no streams (no watermarks, windows or state);
its incremental behaviour is batch: reprocess recent partitions (T18, S4) and record a
high-water mark per output (K14). Both are expressed here over partitioned tables, plus a
file-stream wrapper that runs one job over files not yet processed.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.functions.dates import as_date


def years_to_reprocess(df: DataFrame, as_of, year_col: str = "year", month_col: str = "month",
                       full_load: bool = False) -> DataFrame:
    """Rows of the whole years that need reprocessing.

    Months considered run from ``as_of`` minus 3 months (when ``as_of`` is in January or
    February) or from ``as_of``'s own month, through ``as_of``'s month. Every year with at
    least one existing (year, month) partition in that window is reprocessed whole.
    The window is a predicate on partition columns (pruned); the year list is a left-semi
    join on the distinct years found, never a driver-side loop.
    """
    if full_load:
        return df
    d = as_date(as_of)
    start = F.when(F.month(d) <= 2, F.add_months(F.trunc(d, "MM"), -3)).otherwise(F.trunc(d, "MM"))
    first_day = F.make_date(F.col(year_col).cast("int"), F.col(month_col).cast("int"), F.lit(1))
    years = df.where(first_day.between(start, d)).select(year_col).distinct()
    return df.join(years, year_col, "left_semi")


def stored_years(spark: SparkSession, base: str, as_of, year_col: str = "year", month_col: str = "month", full_load: bool = False) -> list[int]:
    """The years to reprocess among those that ``base`` holds, from its folder names alone: every year with a (year, month) partition in
    the window of ``years_to_reprocess``, or all with ``full_load``. No data file is opened; the result is a few numbers, by which
    ``reprocess_years`` prunes its one scan."""
    from tidewater.sources.paths import stored_partitions

    parts = stored_partitions(spark, base, [year_col, month_col])
    year, month = F.try_to_number(year_col, F.lit("9999")).cast("int"), F.try_to_number(month_col, F.lit("99")).cast("int")
    d = as_date(as_of)
    start = F.when(F.month(d) <= 2, F.add_months(F.trunc(d, "MM"), -3)).otherwise(F.trunc(d, "MM"))
    hit = F.lit(True) if full_load else F.try_make_timestamp(year, month, F.lit(1), F.lit(0), F.lit(0), F.lit(0)).cast("date").between(start, d)
    return sorted(r[0] for r in parts.where(hit & year.isNotNull()).select(year).distinct().collect())


def reprocess_years(spark: SparkSession, base: str, target: str, transform: Callable[[DataFrame], DataFrame], as_of,
                    year_col: str = "year", month_col: str = "month", full_load: bool = False, **options) -> list[int]:
    """``transform`` the whole years of ``base`` that need it and replace the partitions of ``target`` that come out; stored partitions of
    other years stay. One scan, pruned to the years' folders; returns the years. Year and month reach ``transform`` as the text of their
    folders (``05``), so that they are written under the same names."""
    from pyspark.sql.types import StringType, StructField, StructType
    from tidewater.sources.sinks import write_table

    years = stored_years(spark, base, as_of, year_col, month_col, full_load)
    if years:
        fields = spark.read.parquet(base).schema.fields
        schema = StructType([StructField(f.name, StringType()) if f.name in (year_col, month_col) else f for f in fields])
        rows = spark.read.schema(schema).parquet(base).where(F.try_to_number(year_col, F.lit("9999")).cast("int").isin(years))
        write_table(transform(rows), target, **{"mode": "overwrite_partitions", "partition_by": [year_col, month_col], **options})
    return years


def rows_after_mark(df: DataFrame, marks: DataFrame, table: str, col: str) -> DataFrame:
    """Rows of ``df`` newer than the recorded high-water mark of ``table`` (all rows when none).

    ``marks`` is the (table_name, mark) table appended by ``sinks.high_water_mark``; the
    newest mark is a scalar subquery (one value), compared in a plain filter.
    """
    mark = marks.where(F.col("table_name") == table).agg(F.max("mark")).scalar()
    return df.where(mark.isNull() | (F.col(col) > mark))


def run_available_files(spark: SparkSession, source_dir: str, schema, transform: Callable[[DataFrame], DataFrame],
                        sink: Callable[[DataFrame, int], None], checkpoint: str, fmt: str = "parquet"):
    """Process every file not processed before, once, then stop (``Trigger.AvailableNow``).

    The checkpoint (in the shared folder) records which files were consumed, so reruns and
    lost executors neither skip nor repeat input. ``sink`` receives each micro-batch.
    """
    stream = spark.readStream.format(fmt).schema(schema).load(source_dir)
    q = (transform(stream).writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return q


def incremental_load(spark: SparkSession, source_dir: str, schema, transform: Callable[[DataFrame], DataFrame],
                     target: str, table: str, stage: str, as_of, checkpoint: str, audit_path: str,
                     marks_path: str | None = None, mark_col: str | None = None,
                     partition_by: list[str] | None = None, fmt: str = "parquet"):
    """Raw -> staging for files not loaded before, with the write bookkeeping of the batch jobs.

    Every micro-batch of new files (``Trigger.AvailableNow``) is transformed and added to ``target``: it
    is written under its own ``load_epoch`` below the partition columns, so rows loaded earlier stay and a
    batch that is run again after a failure replaces what it had written. Its audit row (row count, OK/ERROR, K13) and, with ``mark_col``, the batch's high-water
    mark (K14) are observed in that write, so a batch is executed once, and written under the same epoch. The streaming checkpoint records consumed files; a run that
    found no new file, or a batch of no rows, writes an ERROR audit row, as a write of zero rows does in the batch jobs; runs without a
    new file share one row, under ``load_epoch`` -1.
    """
    from tidewater.sources.sinks import audit_row, write_audited, write_table

    def sink(batch: DataFrame, epoch_id: int) -> None:
        epochs.append(epoch_id)
        epoch = {"load_epoch": F.lit(epoch_id)}
        kept = {"mode": "overwrite_partitions", "partition_by": ["load_epoch"]}
        done = write_audited(batch.withColumns(epoch), target, table, stage, as_of, mark=mark_col,
                             mode="overwrite_partitions", partition_by=[*(partition_by or ()), "load_epoch"]).withColumns(epoch)
        write_table(done.drop("mark"), audit_path, **kept)
        if marks_path and mark_col:
            write_table(done.select("table_name", "mark", "load_epoch"), marks_path, **kept)

    epochs: list[int] = []
    query = run_available_files(spark, source_dir, schema, transform, sink, checkpoint, fmt=fmt)
    if not epochs:
        empty = audit_row(spark.createDataFrame([], "id int"), table, stage, as_of).withColumn("load_epoch", F.lit(-1))
        write_table(empty, audit_path, mode="overwrite_partitions", partition_by=["load_epoch"])
    return query
