"""Benchmark decontamination, with built-in functions only.

A benchmark item is compared with windows of its own length in words. Windows and items carry a SimHash of their five-word
shingles; the 64 bits are cut into blocks, and items are indexed under every block value within ``BLOCK_BITS`` bits of
theirs, so by the pigeonhole principle each window within the radius of an item of its length meets it in at least one block.
Exact weighted-shingle similarity (counts of shingles, sum of minima over sum of maxima) decides.

Only windows that begin with a shingle of some item of that length are fingerprinted. That loses nothing: moving a
window right to its first shared shingle keeps all it shares and its length, so the most similar window begins so
(at the end of a text the window is cut short, which only helps).
"""

from __future__ import annotations

import itertools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import fresh, materialize, only, row_name
from tidewater.llm.quality import let, window_hashes

SHINGLE = 5
SIMILARITY = 0.8
BLOCKS = 8
BLOCK_BITS = 2
RADIUS = BLOCKS * (BLOCK_BITS + 1) - 1          # 23: the largest distance the blocks guarantee
BROADCAST_ROWS = 2_000_000                      # item shingles broadcast at once (some 64 MB)
BROADCAST_IDS = 1_000_000                       # document ids broadcast at most (some 16 MB)


def plain_words(text: Column) -> Column:
    """Lower-cased runs of letters and digits; punctuation and symbols only separate. Null: none."""
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), "")


def with_simhash(rows: DataFrame, key: str) -> DataFrame:
    """``rows`` (one per ``key``, shingle hashes in column sh) with fp: a bit is set where more than half of the hashes have it; repeats
    count. Sixty-four sums per row instead of a loop over bits."""
    ones = rows.select(key, F.explode("sh").alias("h")).groupBy(key).agg(
        F.count(F.lit(1)).alias("c"), *[F.sum(F.getbit("h", F.lit(b)).cast("int")).alias(f"b{b}") for b in range(64)])
    bits = [F.when(2 * F.col(f"b{b}") > F.col("c"), F.lit(1 << b if b < 63 else -(1 << 63)).cast("bigint")).otherwise(F.lit(0).cast("bigint")) for b in range(64)]
    fp = F.aggregate(F.array(*bits), F.lit(0).cast("bigint"), lambda a, x: a.bitwiseOR(x))
    return rows.join(ones.select(key, fp.alias("fp")), key)


def tagged(hashes: Column) -> Column:
    """Shingles with the number of equal ones before them, so that set operations count repeats."""
    def of(h: Column) -> Column:
        seen = lambda x, i: F.size(F.filter(F.slice(h, F.lit(1), i), lambda y: y == x))
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.transform(h, lambda x: F.struct(x.alias("h"), F.lit(0).alias("k")))) \
            .otherwise(F.transform(h, lambda x, i: F.struct(x.alias("h"), seen(x, i).alias("k"))))
    return let(hashes, of)


def weighted_similarity(a: Column, b: Column) -> Column:
    """Sum of minima over sum of maxima of the shingle counts of two shingle arrays."""
    both = F.size(F.array_intersect(tagged(a), tagged(b)))
    return both / (F.size(a) + F.size(b) - both)


def _block(fp: str, i: int) -> Column:
    return F.shiftrightunsigned(fp, 64 // BLOCKS * i).bitwiseAND(F.lit((1 << 64 // BLOCKS) - 1).cast("bigint"))


def benchmark_items(benchmark: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(item, item_id, n, sh, fp): items of at least ``shingle`` words with their shingle hashes. Shorter items (null and
    empty texts too) cannot be told from ordinary phrases and never match; repeated items are one."""
    rows = only(benchmark, "item_id", "text").select("item_id", plain_words(F.col("text")).alias("w"))
    items = (rows.select("item_id", F.size("w").alias("n"), window_hashes(F.col("w"), shingle).alias("sh"))
             .where(F.col("n") >= shingle).distinct().withColumn("item", F.xxhash64("item_id", "n", "sh")))
    return with_simhash(items, "item")


def _starts(docs: DataFrame, items: DataFrame, shingle: int) -> DataFrame:
    """(doc_id, windows): places and lengths of the windows to fingerprint, per document that has any. The item shingles are
    broadcast in blocks of a checked size."""
    known = materialize(items.select(F.explode("sh").alias("h"), "n").distinct(), "decon-shingles")
    count = known.count()
    blocks = max(1, -(-count // BROADCAST_ROWS))
    places = (docs.select("doc_id", window_hashes(plain_words(F.col("text")), shingle).alias("sh"))
              .select("doc_id", F.posexplode("sh").alias("at", "h")))
    found = None
    for b in range(blocks):
        part = known if blocks == 1 else known.where(F.pmod("h", F.lit(blocks)) == b)
        hit = places.join(F.broadcast(part), "h").select("doc_id", "at", "n")
        found = hit if found is None else found.union(hit)
    return materialize(found.distinct().groupBy("doc_id").agg(F.collect_list(F.struct("at", "n")).alias("windows")), "decon-starts")


def leaks(docs: DataFrame, benchmark: DataFrame, shingle: int = SHINGLE, similarity: float = SIMILARITY) -> DataFrame:
    """Pairs of documents and benchmark items they contain: doc_id, item_id, start (words before the window), n_words,
    similarity; per pair the most similar window, the first of equals.

    Defined cases: null and empty texts contain nothing; rows of one doc_id are searched each and reported as one; a null
    doc_id is reported as null; an empty table on either side gives no rows; other columns are ignored. A passage that many
    documents share is fingerprinted once: equal windows are one row of the join."""
    docs = only(docs, "doc_id", "text")
    items = materialize(benchmark_items(benchmark, shingle), "decon-items")
    starts = _starts(docs, items, shingle).withColumnRenamed("doc_id", "found_doc")
    same = F.col("doc_id").eqNullSafe(F.col("found_doc"))
    ids = starts.select("found_doc")
    few = docs.join(F.broadcast(ids), same, "left_semi") if ids.count() <= BROADCAST_IDS else docs
    cut = (few.join(starts, same)
           .select("doc_id", "windows", window_hashes(plain_words(F.col("text")), shingle).alias("sh")))
    each = (cut.select("doc_id", F.explode(let(F.col("sh"), lambda h: F.transform("windows", lambda w: F.struct(
        w["at"].alias("at"), w["n"].alias("n"), F.slice(h, w["at"] + 1, w["n"] - (shingle - 1)).alias("sh"))))).alias("w"))
        .select("doc_id", "w.*").where(F.size("sh") > 0))
    each = materialize(each.withColumn("key", F.xxhash64("sh", "n")), "decon-windows")
    windows = materialize(with_simhash(each.groupBy("key").agg(F.any_value("n").alias("n"), F.any_value("sh").alias("sh")), "key"), "decon-prints")
    masks = [0] + [sum(1 << b for b in c) for k in range(1, BLOCK_BITS + 1) for c in itertools.combinations(range(64 // BLOCKS), k)]

    def values(i: int) -> Column:
        every = F.array(*[F.lit(m).cast("bigint") for m in masks])
        return F.transform(every, lambda m: F.struct(F.lit(i).alias("block"), _block("fp", i).bitwiseXOR(m).alias("value")))

    near = F.explode(F.flatten(F.array(*[values(i) for i in range(BLOCKS)])))
    index = items.select("item", F.col("n").alias("i_n"), F.col("fp").alias("i_fp"), near.alias("i"))
    probe = windows.select("key", "n", "fp", F.explode(F.array(*[F.struct(F.lit(i).alias("block"), _block("fp", i).alias("value"))
                                                                       for i in range(BLOCKS)])).alias("p"))
    close = ((F.col("n") == F.col("i_n")) & (F.col("p.block") == F.col("i.block")) & (F.col("p.value") == F.col("i.value"))
             & (F.bit_count(F.col("fp").bitwiseXOR(F.col("i_fp"))) <= RADIUS))
    texts = items.select("item", "item_id", F.col("sh").alias("i_sh"))
    pairs = (probe.join(index, close).select("key", "item").distinct().join(windows.select("key", "sh"), "key").join(texts, "item")
             .select("key", "item_id", weighted_similarity(F.col("sh"), F.col("i_sh")).alias("similarity"))
             .where(F.col("similarity") >= similarity))
    best = F.max_by(F.struct("at", "n", "similarity"), F.struct("similarity", -F.col("at")))
    return (each.select("doc_id", "key", "at", "n").join(pairs, "key").groupBy("doc_id", "item_id").agg(best.alias("b"))
            .select("doc_id", "item_id", F.col("b.at").cast("bigint").alias("start"), F.col("b.n").cast("bigint").alias("n_words"),
                    F.col("b.similarity").alias("similarity")))


def without_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` (all columns) that are in no leak. A leak takes out the rows of its doc_id and text alone: other texts
    under the same doc_id, or under a null one, stay."""
    doc, text_hash = fresh(docs, "leaky"), fresh(docs, "leaky_hash")
    bad = leaks(row_name(docs), benchmark).select(F.col("doc_id.doc_id").alias(doc), F.col("doc_id.text_hash").alias(text_hash)).distinct()
    return docs.join(bad, F.col("doc_id").eqNullSafe(F.col(doc)) & (F.xxhash64("text") == F.col(text_hash)), "left_anti")


def op8_decontamination(spark, sf_dir: str) -> DataFrame:
    from tidewater.llm.common import read_table

    return leaks(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"), SHINGLE, SIMILARITY)
