"""Query catalogue over the driver tables (``region nation customer supplier part orders lineitem
events documents embeddings pages benchmark labels conversations``).

Each entry maps one operator or named job onto those tables: a Spark function
``(spark, sf_dir) -> DataFrame`` built from the library, and, where SQL can say the same
thing, an independent DuckDB SQL text with identical column names. Every query reads whole
tables; dates that a job would take from the clock are fixed ``as_of`` values.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

# Fixed dates standing in for "today" (jobs never read the clock).
AS_OF_ORDERS = "2001-09-01"
AS_OF_EVENTS = "2024-02-01"


def register(name: str, sql: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


class Tables:
    """Lazy access to the driver tables of one scale factor: ``Tables(spark, d).lineitem``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")


def _load_all():
    from tidewater.plans.catalog import aggregates, io, jobs, relational, reshape, scalar, staging, storage  # noqa: F401


_load_all()
