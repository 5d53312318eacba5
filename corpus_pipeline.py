"""The corpus pipeline: ``documents`` through five stages, each written as Parquet and read again.

1. language: documents without a language go (no letter, or a script that no labelled text has)
2. lines: repeated lines are taken out of the texts; no document goes
3. near_duplicates: one document of each SimHash component stays, the one of the smallest doc_id
4. decontamination: documents that contain a benchmark item go
5. packing: what is left, cut and packed into sequences of at most 4096 tokens

Each stage function takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidewater.llm import decontaminate, langid, linededup, packing, simhash
from tidewater.llm.common import materialize, read_table


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told. The model learns from the labelled ones among them that are not held out."""
    return langid.accept(docs, langid.train(docs))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines that have come before (within two edits), however much of a document they are. An exact copy
    stays equal to its original, so that the next stage takes it out whole."""
    return linededup.dedup_lines(docs, max_share=None, alike=True)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose three-word SimHashes are linked at two bits or fewer."""
    return simhash.keep_one(docs, shingle=3, max_bits=2)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item (five-word shingles, similarity 0.8 or more)."""
    return decontaminate.without_leaks(docs, read_table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of a packed sequence."""
    return packing.pack(docs)


STAGES = [("language", language), ("lines", lines), ("near_duplicates", near_duplicates),
          ("decontamination", decontamination), ("packing", pack)]

# Suffix automata, edit joins and token ids are beyond SQL; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents of ``sf_dir``."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
