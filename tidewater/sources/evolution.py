"""Schema evolution on write (K6) and the catalog table that follows it (K7).

A target's schema is kept beside it in ``<path>.schema``, one small JSON line per change. A write reconciles it with the schema of the new
rows before any data is written: new columns are added, types are widened where the stored files can be read as the wider
type, everything else is refused. Stored files stay as they are; they are read with the reconciled schema.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.sources.paths import exists
from tidewater.sources.sinks import write_table

# Types in ascending order of width; a file of an earlier one can be read as any later one of the same line.
WIDENS = [[T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType()],
          [T.ByteType(), T.ShortType(), T.IntegerType(), T.DoubleType()],
          [T.FloatType(), T.DoubleType()],
          [T.DateType(), T.TimestampNTZType()]]
WHOLE_DIGITS = {T.ByteType(): 3, T.ShortType(): 5, T.IntegerType(): 10, T.LongType(): 19}
KEPT = "n int, schema string"


class SchemaConflict(ValueError):
    """Columns whose stored and new types have no common wider type."""


def wider(a: T.DataType, b: T.DataType) -> T.DataType | None:
    """The least type that both can be read as without loss; None if there is none. ``NullType`` (a column of nulls) fits any."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    for line in WIDENS:
        if a in line and b in line:
            return line[max(line.index(a), line.index(b))]
    parts = [(x.precision - x.scale, x.scale) if isinstance(x, T.DecimalType) else (WHOLE_DIGITS[x], 0) if x in WHOLE_DIGITS else None for x in (a, b)]
    if any(isinstance(x, T.DecimalType) for x in (a, b)) and None not in parts:
        whole, scale = max(p[0] for p in parts), max(p[1] for p in parts)
        return T.DecimalType(whole + scale, scale) if whole + scale <= 38 else None
    return None


def reconcile(stored: T.StructType, new: T.StructType, fixed: Sequence[str] = ()) -> T.StructType:
    """The stored columns in their order, widened, then the new ones; names are compared without case. ``fixed`` columns (partition
    columns, whose values are folder names) keep their stored type."""
    have = {f.name.lower(): f for f in new.fields}
    out, bad = [], []
    for f in stored.fields:
        other = have.pop(f.name.lower(), None)
        kind = f.dataType if other is None or f.name in fixed else wider(f.dataType, other.dataType)
        if kind is None:
            bad.append(f"{f.name}: {f.dataType.simpleString()} stored, {other.dataType.simpleString()} new")
        out.append(T.StructField(f.name, kind or f.dataType, True))
    out += [T.StructField(f.name, f.dataType, True) for f in new.fields if f.name.lower() in have]
    void = [f.name for f in out if isinstance(f.dataType, T.NullType)]
    if bad or void:
        raise SchemaConflict("; ".join([*bad, *(f"{c}: no type" for c in void)]))
    return T.StructType(out)


def align(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The columns of ``schema``, cast to its types, null where ``df`` lacks them."""
    have = {c.lower(): c for c in df.columns}
    return df.select(*[(F.col(f"`{have[f.name.lower()]}`") if f.name.lower() in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields])


def _log(path: str) -> str:
    return path.rstrip("/") + ".schema"


def stored_schema(spark: SparkSession, path: str) -> T.StructType | None:
    """The schema kept beside ``path``; for data written without one, that of its files; None where nothing is stored."""
    if exists(spark, _log(path)):
        last = spark.read.schema(KEPT).json(_log(path)).orderBy(F.desc("n")).first()
        if last is not None:
            return T.StructType.fromJson(json.loads(last["schema"]))
    return spark.read.option("mergeSchema", "true").parquet(path).schema if exists(spark, path) else None


def evolve_table(df: DataFrame, path: str, mode: str = "append", partition_by: Sequence[str] = (), compression: str = "snappy",
                 table: str | None = None) -> T.StructType:
    """K6/K7: write ``df`` to ``path`` under the reconciled schema and return it.

    ``append`` and ``overwrite_partitions`` keep stored rows, whose files stay as they are; ``overwrite`` replaces rows and schema. The schema is kept
    before the data is written: if the write fails, stored rows are read as before, with null columns to come. With ``table`` the
    catalog table over ``path`` gets the schema and the partitions that are stored now. Raises ``SchemaConflict`` before anything is written."""
    spark = df.sparkSession
    stored = stored_schema(spark, path) if mode != "overwrite" else None
    schema = reconcile(stored or T.StructType([]), df.schema, partition_by)
    ordered = [f for f in schema.fields if f.name not in partition_by] + [schema[c] for c in partition_by]
    schema = T.StructType(ordered)
    if schema != stored or not exists(spark, _log(path)):
        last = spark.read.schema(KEPT).json(_log(path)).agg(F.max("n")).first()[0] if exists(spark, _log(path)) else None
        line = spark.createDataFrame([((last or 0) + 1, json.dumps(schema.jsonValue()))], KEPT)
        line.coalesce(1).write.mode("append").json(_log(path))
    write_table(align(df, schema), path, mode=mode, partition_by=partition_by, compression=compression)
    if table:
        refresh_table(spark, table, path, schema, partition_by)
    return schema


def read_evolved(spark: SparkSession, path: str) -> DataFrame:
    """All rows of ``path`` under its schema, whatever file they were written to."""
    return spark.read.schema(stored_schema(spark, path)).parquet(path)


def refresh_table(spark: SparkSession, table: str, path: str, schema: T.StructType, partition_by: Sequence[str] = ()) -> None:
    """K7: the external catalog table over ``path`` with this schema and the partitions found there. The definition is replaced where its
    schema differs; data is not touched."""
    have = spark.table(table).schema if spark.catalog.tableExists(table) else None
    names = lambda s: [(f.name, f.dataType) for f in s.fields]
    if have is None or names(have) != names(schema):
        spark.sql(f"DROP TABLE IF EXISTS {table}")
        cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        parts = f"PARTITIONED BY ({', '.join(f'`{c}`' for c in partition_by)})" if partition_by else ""
        location = path.replace("'", "\\'")
        spark.sql(f"CREATE TABLE {table} ({cols}) USING parquet {parts} LOCATION '{location}'")
    if partition_by:
        spark.sql(f"MSCK REPAIR TABLE {table}")
    spark.catalog.refreshTable(table)
