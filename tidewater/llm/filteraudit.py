"""Filter interaction audit with wide packed counters.

Which filters a document fails is a mask. Every mask is mapped to big integers, one per outcome, each with a field for every step of
every order of the filters (120 orders of five filters: 600 fields). A field is 1 where the document has that outcome at that step. The
integers are summed per part, in each task first, and unpacked at the end. A field has 64 bits and a sum is at most the number of rows, so
no field runs over into the next.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import materialize, only
from tidewater.llm.quality import words_of

FIELD_BITS = 64
OUTCOMES = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost"]
HELD_PARTS = 1000         # parts that a task holds sums of before it hands them on
SALTS = 64                # tasks that add up one part's sums before the last one does
NAMES = "ABCDE"


def _outcome(name: str, mask: int, order: str, step: int, names: str) -> bool:
    fails = lambda f: mask >> names.index(f) & 1
    here, gone = fails(order[step]), any(map(fails, order[:step]))
    return bool({"kept": not here and not gone, "removed": here and not gone, "redundant": here and gone,
                 "unique_fails": mask == 1 << names.index(order[step])}[name])


def packed(name: str, mask: int, names: str = NAMES) -> int:
    """The big integer of a mask: field ``order * steps + step`` is 1 where a document of this mask has the outcome."""
    total = 0
    for field, (order, step) in enumerate(itertools.product(itertools.permutations(names), range(len(names)))):
        total |= _outcome(name, mask, "".join(order), step, names) << FIELD_BITS * field
    return total


def unpacked(value: int, fields: int) -> np.ndarray:
    return np.frombuffer(value.to_bytes(fields * FIELD_BITS // 8, "little"), "<u8").astype(np.int64)


def _sums(names: str):
    """Task function over (part, mask, good, toxic): (part, one packed sum per outcome)."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = [[packed(o, m, names) for m in range(1 << len(names))] for o in OUTCOMES[:4]]
        held: dict[str, list[int]] = {}

        def out() -> pa.RecordBatch:
            size = lambda x: x.to_bytes((x.bit_length() + 7) // 8, "little")
            cols = [pa.array(list(held), pa.string())] + [pa.array([size(v[k]) for v in held.values()], pa.binary()) for k in range(len(OUTCOMES))]
            held.clear()
            return pa.RecordBatch.from_arrays(cols, names=["part", *OUTCOMES])

        for batch in batches:
            part = batch.column(0).dictionary_encode()
            mask, good, toxic = (batch.column(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in (1, 2, 3))
            codes = ((part.indices.to_numpy(zero_copy_only=False).astype(np.int64) << len(names) | mask) << 2) | good << 1 | toxic
            counts = np.bincount(codes)
            for code in np.flatnonzero(counts).tolist():
                n, m = int(counts[code]), code >> 2 & (1 << len(names)) - 1
                sums = held.setdefault(part.dictionary[code >> 2 + len(names)].as_py(), [0] * len(OUTCOMES))
                for k in range(4):
                    sums[k] += n * table[k][m]
                if code & 2:
                    sums[4] += n * table[1][m]
                if code & 1:
                    sums[5] += n * table[1][m]
            if len(held) > HELD_PARTS:
                yield out()
        if held:
            yield out()

    return add


def _total(pdf: pd.DataFrame) -> list[int]:
    return [sum(int.from_bytes(b, "little") for b in pdf[o]) for o in OUTCOMES]


def interactions(masks: DataFrame, names: Sequence[str] = NAMES) -> DataFrame:
    """Per part of ``masks`` (part, mask, good, toxic; bit k of the mask: fails filter k), every order of the filters and every step: the
    numbers of rows kept after the step, removed in it, failing it but removed earlier, failing it alone, removed good and removed
    toxic ones, and shapley: rows its filter removes, summed over all orders.

    A part's sums come one per task; ``SALTS`` tasks add them up, then one adds theirs. Defined cases: no rows give no parts; a null part is
    the part ''; a null mask, good or toxic counts as 0."""
    names = "".join(names)
    orders = ["".join(p) for p in itertools.permutations(names)]
    steps, fields = len(names), len(orders) * len(names)
    rows = masks.select(F.coalesce("part", F.lit("")).alias("part"), F.coalesce(F.col("mask").cast("int"), F.lit(0)).alias("mask"),
                        *[F.coalesce(F.col(c).cast("int"), F.lit(0)).alias(c) for c in ("good", "toxic")])
    sums = "part string, " + ", ".join(f"{o} binary" for o in OUTCOMES)
    each = rows.mapInArrow(_sums(names), sums).withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(SALTS)))

    def some(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame([[key[0], *[v.to_bytes(fields * FIELD_BITS // 8, "little") for v in _total(pdf)]]], columns=["part", *OUTCOMES])

    def unpack(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        out = pd.DataFrame({"part": key[0], "filter_order": np.repeat(orders, steps), "step": np.tile(np.arange(1, steps + 1, dtype=np.int32), len(orders))})
        for o, v in zip(OUTCOMES, _total(pdf), strict=True):
            out[o] = unpacked(v, fields)
        letter = [o[s] for o in orders for s in range(steps)]
        out["shapley"] = out["removed"].groupby(np.array(letter)).transform("sum")
        return out

    done = "part string, filter_order string, step int, " + ", ".join(f"{o} long" for o in [*OUTCOMES, "shapley"])
    return each.groupBy("part", "salt").applyInPandas(some, sums).groupBy("part").applyInPandas(unpack, done)


def text_fails() -> list[Column]:
    """Filters A to D over a non-null text ``t`` with words ``w``."""
    n = F.size("w")
    capitals = F.length(F.regexp_replace("t", "[^A-Z]+", ""))
    return [n < 200, 100 * F.size(F.array_distinct("w")) < 50 * n, 100 * capitals > 3 * F.length("t"), F.col("t").rlike(r"[#$%&*|]")]


def fail_masks(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, good, toxic) per row of ``docs``. Text is read once; what is left of it is two 64-bit hashes and its length. A copy is a row
    whose doc_id is greater than the smallest one of its text: the rows of smallest doc_id are joined back by doc_id and hashes, so a
    text with very many copies is one row of that join."""
    words = only(docs, "doc_id", "text", "lang").select("doc_id", F.coalesce("lang", F.lit("")).alias("part"), F.coalesce("text", F.lit("")).alias("t"))
    bits = lambda flags: sum((F.when(f, F.lit(1 << k)).otherwise(F.lit(0)) for k, f in enumerate(flags)), F.lit(0))
    seen = materialize(words.withColumn("w", words_of(F.col("t"))).select(
        "doc_id", "part", bits(text_fails()).alias("fails"), F.xxhash64("t").alias("h1"), F.xxhash64(F.lit(0x5EED), F.col("t")).alias("h2"),
        F.length("t").alias("n")), "audit-rows")
    text = ["h1", "h2", "n"]
    first = (seen.groupBy(*text).agg(F.min("doc_id").alias("doc_id")).where(F.col("doc_id").isNotNull()).withColumn("first", F.lit(True)))
    marks = (only(labels, "doc_id", "quality", "toxic").groupBy("doc_id")
             .agg(F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"), F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic")))
    copy = F.col("doc_id").isNotNull() & F.col("first").isNull()
    return (seen.join(first, ["doc_id", *text], "left").join(marks, "doc_id", "left")
            .select("part", (F.col("fails") + F.when(copy, F.lit(16)).otherwise(F.lit(0))).alias("mask"), "good", "toxic"))


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The interactions of the filters A to E (``text_fails``; E: a copy of a smaller doc_id's text) per language.

    Defined cases: a null text is empty, and all empty texts are copies of each other; a null lang is the part ''; a row without a doc_id is
    no copy and has no labels; rows of one doc_id and text are judged alike; several labels of a doc_id count if any is 1; empty
    documents give no rows, empty labels zeros; other columns are ignored."""
    return interactions(fail_masks(docs, labels), NAMES)


def op12_filters(spark, sf_dir: str) -> DataFrame:
    from tidewater.llm.common import read_table

    return audit(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


OP12_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w, min(doc_id) OVER (PARTITION BY t) AS first FROM d),
f AS (SELECT part, doc_id,
    (CASE WHEN len(w) < 200 THEN 'A' ELSE '' END)
    || (CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 'B' ELSE '' END)
    || (CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t) THEN 'C' ELSE '' END)
    || (CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END)
    || (CASE WHEN doc_id > first THEN 'E' ELSE '' END) AS mask FROM w),
l AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
m AS (SELECT part, mask, count(*) AS n, count(*) FILTER (WHERE good) AS good, count(*) FILTER (WHERE toxic) AS toxic
      FROM f LEFT JOIN l ON f.doc_id = l.doc_id GROUP BY part, mask),
c(x) AS (VALUES ('A'), ('B'), ('C'), ('D'), ('E')),
o AS (SELECT a.x || b.x || c3.x || d4.x || e.x AS filter_order FROM c a, c b, c c3, c d4, c e
      WHERE len(list_distinct([a.x, b.x, c3.x, d4.x, e.x])) = 5),
s AS (SELECT filter_order, step, substr(filter_order, step, 1) AS x, substr(filter_order, 1, step - 1) AS before FROM o, range(1, 6) r(step)),
j AS (SELECT part, filter_order, step, x, n, good, toxic, mask, contains(mask, x) AS fails,
      length(translate(before, mask, '')) < length(before) AS gone FROM m, s),
g AS (SELECT part, filter_order, step, x,
      sum(CASE WHEN NOT fails AND NOT gone THEN n ELSE 0 END) AS kept, sum(CASE WHEN fails AND NOT gone THEN n ELSE 0 END) AS removed,
      sum(CASE WHEN fails AND gone THEN n ELSE 0 END) AS redundant, sum(CASE WHEN mask = x THEN n ELSE 0 END) AS unique_fails,
      sum(CASE WHEN fails AND NOT gone THEN good ELSE 0 END) AS good_lost, sum(CASE WHEN fails AND NOT gone THEN toxic ELSE 0 END) AS toxic_lost
      FROM j GROUP BY ALL)
SELECT part, filter_order, step::INTEGER AS step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
    unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
    (sum(removed) OVER (PARTITION BY part, x))::BIGINT AS shapley FROM g
"""
