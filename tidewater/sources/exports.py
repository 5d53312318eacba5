"""Staging of many export files in one pass: what a file is about is taken from its path."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.functions.names import clean_names
from tidewater.sources.paths import exists, hadoop, stored_partitions
from tidewater.sources.sinks import write_table


@dataclass(frozen=True)
class PathPart:
    """One segment of a file's path below the base folder: ``index`` counts from 0, from the end where negative (-1: the file name).
    ``before`` keeps the text before the first of that separator, ``after`` that behind a ``key=`` prefix."""

    index: int
    before: str | None = None
    after: str | None = None

    def column(self, segments: Column) -> Column:
        c = F.try_element_at(segments, F.lit(self.index + 1 if self.index >= 0 else self.index))
        if self.after:
            c = F.when(c.startswith(self.after), F.substring(c, len(self.after) + 1, 1 << 20)).otherwise(c)
        return F.substring_index(c, self.before, 1) if self.before else c


def read_exports(spark: SparkSession, base: str, schema: T.StructType | str, parts: Mapping[str, PathPart], name_part: str | None = None,
                 sep: str = ",", header: bool = True, clean: bool = False, date_format: str | None = None) -> DataFrame:
    """Every delimited export file below ``base``, read with one declared schema in one distributed scan, with a column per
    ``parts`` from its path (null where the path is shorter). ``name_part`` keeps only files whose name contains it."""
    base = base.rstrip("/")
    glob = f"*{name_part}*" if name_part else "*.csv*"
    reader = (spark.read.schema(schema).option("header", str(header).lower()).option("sep", sep).option("mode", "PERMISSIVE")
              .option("recursiveFileLookup", "true").option("pathGlobFilter", glob))
    if date_format:
        reader = reader.option("dateFormat", date_format)
    fs, p = hadoop(spark, base)
    root = fs.makeQualified(p).toUri().getPath()
    # the path as Spark reports it is a URI: the part behind the base folder, percent signs undone
    local = F.regexp_replace(F.col("_metadata.file_path"), r"^[A-Za-z0-9+.-]+:(//[^/]*(?=/))?/*", "/")
    below = F.substring(F.try_url_decode(F.regexp_replace(local, r"\+", "%2B")), len(root.rstrip("/")) + 2, 1 << 20)
    segments = F.split(below, "/")
    out = reader.csv(base)
    named = out.withColumns({c: part.column(segments) for c, part in parts.items()})
    return clean_names(named) if clean else named


def write_targets(df: DataFrame, base: str, target: str, partition_by: Sequence[str] = (), mode: str = "overwrite_partitions",
                  compression: str = "gzip", database: str | None = None) -> None:
    """K2/K4/K5/K7: rows routed to several partitioned tables in one write. Column ``target`` names each row's table; the table is the folder
    ``base/<target>=<name>``, partitioned by ``partition_by``. ``overwrite_partitions`` replaces only the partitions (of only the tables) that
    occur in ``df``; a null name is refused. With ``database`` every table that is stored is registered there."""
    named = df.withColumn(target, F.coalesce(F.col(target), F.raise_error(F.lit(f"no {target} in a file's path"))))
    write_table(named, base, mode=mode, partition_by=[target, *partition_by], compression=compression)
    if database:
        from tidewater.sources.evolution import refresh_table

        spark = df.sparkSession
        fields = [f for f in df.schema.fields if f.name != target]
        schema = T.StructType([f for f in fields if f.name not in partition_by] + [f for f in fields if f.name in partition_by])
        for r in stored_partitions(spark, base, [target]).distinct().collect():       # one row per table
            refresh_table(spark, f"{database}.{r[0].lower()}", target_path(base, target, r[0]), schema, partition_by)


def target_path(base: str, target: str, name: str) -> str:
    return f"{base.rstrip('/')}/{target}={name}"


def read_target(spark: SparkSession, base: str, target: str, name: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """One table that ``write_targets`` has written; the partition columns named here as the text of their folders."""
    path = target_path(base, target, name)
    if not exists(spark, path):
        raise FileNotFoundError(path)
    schema = spark.read.parquet(path).schema
    return spark.read.schema(T.StructType([T.StructField(f.name, T.StringType()) if f.name in partition_by else f for f in schema.fields])).parquet(path)
