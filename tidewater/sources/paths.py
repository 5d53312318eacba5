"""Paths of any store that Spark reads: Hadoop's file system for single objects, listings that run in tasks for many."""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.session import written

LISTED = "base string, path string, name string, is_file boolean, size bigint"
ROWS = 10_000
cloudpickle.register_pickle_by_value(sys.modules[__name__])      # executors need no copy of the package
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"        # fixed value: how a null partition value is written
TASK_SCHEMES = {"": "", "file": "file", "hdfs": "hdfs", "s3": "s3", "s3a": "s3", "gs": "gs", "abfs": "abfs", "abfss": "abfss"}


def hadoop(spark: SparkSession, path: str):
    """(file system, path) of Hadoop's API for one object; for small bookkeeping files, not for data."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = hadoop(spark, path)
    return fs.exists(p)


def scheme_of(path: str) -> str:
    head = path.split("/", 1)[0]
    return head[:-1] if head.endswith(":") else ""


def _children(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task function over (base, folder): what lies directly in each folder, hidden names left out."""
    from pyarrow import fs
    schema = pa.schema([("base", pa.string()), ("path", pa.string()), ("name", pa.string()), ("is_file", pa.bool_()), ("size", pa.int64())])
    for batch in batches:
        for base, folder in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            scheme, rest = scheme_of(folder), folder.split(":", 1)[-1] if scheme_of(folder) else folder
            if scheme in ("", "file"):
                store, root = fs.LocalFileSystem(), "/" + rest.lstrip("/")
            else:
                store, root = fs.FileSystem.from_uri(TASK_SCHEMES[scheme] + ":" + rest)
            found = [x for x in store.get_file_info(fs.FileSelector(root)) if not x.base_name.startswith(("_", "."))]
            for at in range(0, len(found), ROWS):
                part = found[at:at + ROWS]
                yield pa.RecordBatch.from_pylist([{"base": base, "path": f"{folder.rstrip('/')}/{x.base_name}", "name": x.base_name,
                                                   "is_file": x.type == fs.FileType.File, "size": x.size} for x in part], schema=schema)


def children(folders: DataFrame) -> DataFrame:
    """(base, path, name, is_file, size) of what lies directly in the folders of column ``path``; ``base`` is passed on. Folders are
    dealt out and listed in tasks."""
    return folders.select("base", "path").repartition("path").mapInArrow(_children, LISTED)


def _seeds(spark: SparkSession, bases: Sequence[str]) -> DataFrame:
    return spark.createDataFrame([(b, b) for b in bases], "base string, path string")


def files_below(spark: SparkSession, base: str | Sequence[str]) -> DataFrame:
    """(base, path, folder, size) of every file below ``base`` (or below each of several); ``folder`` is relative to it. The listing goes
    level by level, each level a written table whose folders the tasks of the next one list, so no list of files passes through
    the driver. A store that only Spark's own readers open (another scheme) is listed by them."""
    bases = [b.rstrip("/") for b in ([base] if isinstance(base, str) else base)]
    out = None
    for b in bases:
        if scheme_of(b) not in TASK_SCHEMES:
            listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(b).select("path", F.col("length").alias("size"))
            listed = listed.select(F.lit(b).alias("base"), "path", F.regexp_extract("path", _after(b) + "/?(?:(.*)/)?[^/]*$", 1).alias("folder"), "size")
            out = listed if out is None else out.union(listed)
    folders = _seeds(spark, [b for b in bases if scheme_of(b) in TASK_SCHEMES])
    below = F.regexp_replace(F.substring(F.col("path"), F.length("base") + 2, F.length("path")), "/?[^/]*$", "").alias("folder")
    while not folders.isEmpty():
        level = written(children(folders), "listing")
        files = level.where("is_file").select("base", "path", below, "size")
        out = files if out is None else out.union(files)
        folders = level.where(~F.col("is_file"))
    return out


def _after(base: str) -> str:
    return "".join("\\" + c if c in r"\.[]{}()*+?^$|" else c for c in base.split(":", 1)[-1].lstrip("/"))


def stored_partitions(spark: SparkSession, base: str, keys: Sequence[str]) -> DataFrame:
    """The partitions that a hive-partitioned folder holds, one row of text values per partition (null for the null
    partition), from folder names alone: one listing per key, no data file is opened."""
    level = _seeds(spark, [base.rstrip("/")])
    cols: list[str] = []
    for key in keys:
        found = level.drop("base").withColumnRenamed("path", "__up")
        listed = children(level).where(~F.col("is_file") & F.col("name").startswith(f"{key}="))
        value = F.substring(F.col("name"), len(key) + 2, 1 << 20)
        value = F.when(value != NULL_PARTITION, F.try_url_decode(F.regexp_replace(value, r"\+", "%2B")))
        up = F.regexp_replace("path", "/[^/]*$", "")
        level = listed.withColumn("__up", up).select("base", "path", "__up", value.alias(key)).join(found, "__up").select("base", "path", *cols, key)
        cols.append(key)
        level = written(level, "partitions")
    return level.select(*cols)

