"""Helpers shared by the training-data operators: written intermediate tables and connected components."""

from __future__ import annotations

import ctypes

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.session import shared_dir

WORD_SPLIT = r"[\x20\x09-\x0D]+"
BLANKS = " \t\n\x0b\x0c\r"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


CLEAN_SHUFFLE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once into the shared folder and read it back: cuts the lineage, so a lost
    executor costs a re-read and not the work before it, and gives the next plan real sizes. The shuffle files of the
    write go when it ends: what comes after reads the table, so a job of many steps holds the files of one of them at a time."""
    spark = df.sparkSession
    path, before = shared_dir(spark, name), spark.conf.get(CLEAN_SHUFFLE, "false")
    spark.conf.set(CLEAN_SHUFFLE, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEAN_SHUFFLE, before)
    return spark.read.schema(df.schema).parquet(path)


def release_memory() -> None:
    """Give the system back what Arrow's and the C library's allocators keep of freed memory. A Python worker lives on from task to
    task and from stage to stage; else it holds the most that it ever used."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)       # glibc has it
    if trim is not None:
        trim(0)


def only(df: DataFrame, *names: str) -> DataFrame:
    """Exactly these columns; an input may carry others of any name."""
    return df.select(*[F.col(n) for n in names])


def row_name(docs: DataFrame) -> DataFrame:
    """(doc_id, text) with a doc_id that tells rows apart: the given one and XXH64 of the text. Equal rows share a name; a null doc_id or
    one that several texts carry does not join them."""
    return docs.select(F.struct(F.col("doc_id"), F.xxhash64("text").alias("text_hash")).alias("doc_id"), F.col("text"))


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have."""
    while name.lower() in {c.lower() for c in df.columns}:
        name = "_" + name
    return name


def _fold(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
    return row["n"], int(row["h"] or 0)


def _smaller(edges: DataFrame) -> DataFrame:
    return (edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, label) for every node of the long pairs (u, v); label is the smallest node reachable.

    Alternating large-star and small-star steps: each round points every neighbour at the smallest
    one, the edge list never grows past its first size and shrinks to one star per component in
    about log(diameter) rounds. Minima are aggregates (combined before the shuffle); a node with very many
    neighbours is a skewed equi-join that AQE splits. Every round is a written table. Raises if
    ``max_rounds`` did not suffice; it never returns a half-finished labelling.
    """
    cur = materialize(_smaller(edges.select(F.col("u").cast("bigint").alias("u"), F.col("v").cast("bigint").alias("v"))), "cc")
    state = _fold(cur)
    for _ in range(max_rounds):
        if state[0] == 0:
            break
        both = cur.union(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        big = _smaller(large)
        least = big.groupBy("u").agg(F.min("v").alias("m"))
        small = (big.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(least.select("u", F.col("m").alias("v"))))
        cur = materialize(_smaller(small), "cc")
        now = _fold(cur)
        if now == state:
            break
        state = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return cur.select(F.col("u").alias("node"), F.col("v").alias("label")).union(
        cur.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct())
