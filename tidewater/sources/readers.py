"""Readers (S1-S12): parquet with pruning, partition windows, typed delimited text, path columns, prefixes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidewater.functions.names import clean_names


def read_table(spark: SparkSession, path: str | Sequence[str], columns: Sequence[str] | None = None,
               where: Column | str | None = None, merge_schema: bool = False, recursive: bool = False,
               base_path: str | None = None) -> DataFrame:
    """Read parquet; ``columns`` prunes the scan, ``where`` is pushed down
    (a predicate on hive partition columns prunes directories).

    ``base_path`` keeps partition columns when reading a sub-folder; ``merge_schema``
    reconciles files written with evolving schemas (K6); ``recursive`` reads nested folders
    without partition discovery (S5).
    """
    reader = spark.read
    if merge_schema:
        reader = reader.option("mergeSchema", "true")
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    if base_path:
        reader = reader.option("basePath", base_path)
    paths = [path] if isinstance(path, str) else list(path)
    df = reader.parquet(*paths)
    if where is not None:
        df = df.where(where)
    if columns is not None:
        df = df.select(*columns)
    return df


def read_partitions(spark: SparkSession, base: str, predicate: Column, columns: Sequence[str] | None = None) -> DataFrame:
    """Read a hive-partitioned folder keeping only partitions matching ``predicate``.

    Absent partitions simply do not appear; nothing is listed by hand.
    """
    return read_table(spark, base, columns=columns, where=predicate)


def typed_ingest(spark: SparkSession, path: str | Sequence[str], schema: StructType | str, sep: str = ",",
                 header: bool = True, clean: bool = True, date_format: str | None = None,
                 encoding: str = "UTF-8") -> DataFrame:
    """Delimited text read with a declared schema (no inference pass).

    Values that do not fit the declared type become null (``mode=PERMISSIVE``, N10).
    Column names are cleaned (K10) unless ``clean=False``.
    """
    reader = (spark.read.schema(schema).option("header", str(header).lower()).option("sep", sep)
              .option("mode", "PERMISSIVE").option("encoding", encoding))
    if date_format:
        reader = reader.option("dateFormat", date_format)
    paths = [path] if isinstance(path, str) else list(path)
    df = reader.csv(paths)
    return clean_names(df) if clean else df


def with_path_columns(df: DataFrame, parts: Mapping[str, int], strip_prefix: Mapping[str, str] | None = None) -> DataFrame:
    """Columns taken from the file path (``_metadata.file_path``).

    ``parts`` maps an output name to a path segment index (1-based, negative from the end,
    ``-1`` = file name); a path without it gives null. ``strip_prefix`` removes a ``key=`` style prefix from a segment.
    """
    segs = F.split(F.col("_metadata.file_path"), "/")
    cols = {}
    for name, idx in parts.items():
        c = F.try_element_at(segs, F.lit(idx))
        if strip_prefix and name in strip_prefix:
            c = F.regexp_replace(c, "^" + strip_prefix[name], "")
        cols[name] = c
    return df.withColumns(cols)


def file_prefixes(df: DataFrame, depth_from_end: int = 2, out: str = "prefix") -> DataFrame:
    """Distinct folder names at a given depth above the data files.

    Reads only file metadata (``_metadata.file_path``), not data columns.
    """
    segs = F.split(F.col("_metadata.file_path"), "/")
    return df.select(F.try_element_at(segs, F.lit(-depth_from_end)).alias(out)).distinct()


def literal_table(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A small literal table (labels, month names, groups), marked for broadcast.

    Its size is fixed by the rows written in code, which is the proven bound that makes broadcasting it
    safe at any data scale; a list built from data does not belong here.
    """
    return F.broadcast(spark.createDataFrame(list(rows), schema))


def jdbc_table(spark: SparkSession, url: str, table: str, properties: Mapping[str, str],
               partition_column: str | None = None, lower: int | None = None, upper: int | None = None,
               num_partitions: int | None = None) -> DataFrame:
    """A relational table read in parallel ranges of ``partition_column``.

    The reference pushed whole T-SQL queries to the server; here base tables are read
    and the query is rebuilt as DataFrame operations (see ``plans.employment``).
    """
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    for k, v in properties.items():
        reader = reader.option(k, v)
    if partition_column:
        reader = (reader.option("partitionColumn", partition_column).option("lowerBound", lower)
                  .option("upperBound", upper).option("numPartitions", num_partitions or 8))
    return reader.load()
