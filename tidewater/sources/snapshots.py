"""Published versions of a table that a job both reads and rewrites.

``<path>/data/<id>`` holds one version's rows, ``<path>/commits/<number>`` names the id. A version exists from the moment its commit file
is there: rows are written first, under a fresh id, and the file is created exclusively. A job that dies in between leaves the
former version in place; its rows are unnamed and go with ``discard_unpublished``. Readers of an older version keep their files.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from tidewater.sources.paths import hadoop
from tidewater.sources.sinks import write_table

ID_CHARS = 32


class Outdated(RuntimeError):
    """Another version was published since the one that the rows were made from."""


def _names(spark: SparkSession, folder: str) -> list[str]:
    fs, p = hadoop(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def _commits(spark: SparkSession, path: str) -> dict[int, str | None]:
    """Number -> id; None for a commit file whose writer died before its content was there."""
    out = {}
    for name in _names(spark, f"{path}/commits"):
        if name.isdigit():
            fs, p = hadoop(spark, f"{path}/commits/{name}")
            stream = fs.open(p)
            try:
                text = bytes(stream.readNBytes(ID_CHARS)).decode()
            finally:
                stream.close()
            out[int(name)] = text if len(text) == ID_CHARS else None
    return out


def current_version(spark: SparkSession, path: str) -> int | None:
    """The number of the newest published version; None before the first."""
    return max((n for n, i in _commits(spark, path.rstrip("/")).items() if i), default=None)


def read_version(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The rows of a published version, the newest one by default."""
    path = path.rstrip("/")
    commits = {n: i for n, i in _commits(spark, path).items() if i}
    if not commits or (version is not None and version not in commits):
        raise FileNotFoundError(f"{path}: version {version if version is not None else '1'} is not published")
    return spark.read.parquet(f"{path}/data/{commits[max(commits) if version is None else version]}")


def stage_version(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> str:
    """Write rows that are not published yet; returns their id."""
    name = uuid.uuid4().hex
    write_table(df, f"{path.rstrip('/')}/data/{name}", partition_by=partition_by)
    return name


def commit_version(spark: SparkSession, path: str, name: str, based_on: int | None) -> int:
    """Publish staged rows made from version ``based_on`` (None: from nothing). Creating the commit file is the one atomic step; raises
    ``Outdated`` if another version was published meanwhile."""
    path = path.rstrip("/")
    commits = _commits(spark, path)
    newest = max((n for n, i in commits.items() if i), default=None)
    if newest != based_on:
        raise Outdated(f"{path}: made from version {based_on}, the newest is {newest}")
    number = max(commits, default=0) + 1
    fs, p = hadoop(spark, f"{path}/commits/{number:010d}")
    try:
        out = fs.create(p, False)
    except Exception as e:
        raise Outdated(f"{path}: version {number} was published by another job") from e
    try:
        out.write(bytearray(name.encode()))
    finally:
        out.close()
    return number


def publish(df: DataFrame, path: str, based_on: int | None, partition_by: Sequence[str] = ()) -> int:
    """Write ``df``, which may have been made from version ``based_on`` of the same table, and publish it as the next version."""
    return commit_version(df.sparkSession, path, stage_version(df, path, partition_by), based_on)


def unpublished(spark: SparkSession, path: str) -> list[str]:
    """Ids of rows that no commit names: of jobs that died, or that are running now."""
    path = path.rstrip("/")
    named = set(_commits(spark, path).values())
    return [n for n in _names(spark, f"{path}/data") if n not in named]


def discard_unpublished(spark: SparkSession, path: str) -> list[str]:
    """Remove unpublished rows; call it while no other job writes to the table."""
    gone = unpublished(spark, path)
    for name in gone:
        fs, p = hadoop(spark, f"{path.rstrip('/')}/data/{name}")
        fs.delete(p, True)
    return gone
