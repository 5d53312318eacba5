"""Quality rules as a short-circuit cascade, with built-in functions only.

Every rule is a boolean column that says "reject". A bounded sample is timed and counted per rule; the rules are then
chained with the best rejection per cost first, and a document is tried against a rule only if all before it let it pass.
The verdict is the conjunction of all rules, so it does not depend on the order; only the cost does.
"""

from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import BLANKS, WORD_SPLIT, only

SAMPLE_ROWS = 2000        # documents a rule's cost and selectivity are estimated on, about
WINDOW = 5
MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def let(value: Column, body) -> Column:
    """``body(value)`` with value computed once per row, also where body uses it inside a lambda and the optimizer puts
    the expression behind value in its place (a filter pushed below a projection does)."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words_of(text: Column) -> Column:
    """Words of a text, split at ASCII blanks; null and blank texts have none."""
    bare = F.btrim(text, F.lit(BLANKS))
    return F.when(F.length(bare) > 0, F.split(bare, WORD_SPLIT)).otherwise(F.array().cast("array<string>"))


def window_hashes(words: Column, size: int = WINDOW) -> Column:
    """XXH64 chain of each run of ``size`` words."""
    none = F.array().cast("array<int>")
    return let(words, lambda w: F.transform(F.when(F.size(w) >= size, F.sequence(F.lit(0), F.size(w) - size)).otherwise(none),
                                            lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(size)])))


def repeat_words(hashes: Column, size: int = WINDOW) -> Column:
    """Words covered by windows that occur more than once, the first included. Windows are told apart by a 64-bit hash, sorted with
    their places: n log n for a text of n words."""

    def covered(s: Column) -> Column:
        twice = F.filter(s, lambda x, i: F.coalesce(x["h"] == F.get(s, i - 1)["h"], F.lit(False))
                         | F.coalesce(x["h"] == F.get(s, i + 1)["h"], F.lit(False)))
        return let(F.array_sort(F.transform(twice, lambda x: x["i"])),
                   lambda p: F.aggregate(F.transform(p, lambda v, i: F.least(F.lit(size), F.coalesce(F.get(p, i + 1) - v, F.lit(size)))),
                                         F.lit(0), lambda a, b: a + b))

    def count(hs: Column) -> Column:
        some = let(F.array_sort(F.transform(hs, lambda h, i: F.struct(h.alias("h"), i.alias("i")))), covered)
        return F.when(F.size(F.array_distinct(hs)) == F.size(hs), F.lit(0)).otherwise(some).cast("bigint")

    return let(hashes, count)


def measured(docs: DataFrame) -> DataFrame:
    """(doc_id, text, n_lines and MEASURES) per row; null text: as the empty text."""
    text = F.coalesce("text", F.lit(""))
    first = only(docs, "doc_id", "text").select(
        "doc_id", text.alias("text"), words_of(text).alias("words"),
        F.filter(F.split(text, "\n"), lambda x: F.length(F.btrim(x, F.lit(BLANKS))) > 0).alias("lines"))
    hashed = first.select("*", window_hashes(F.col("words")).alias("hashes"))
    return hashed.select(
        "doc_id", "text", F.size("words").cast("bigint").alias("n_words"),
        F.length(F.array_join("words", "")).cast("bigint").alias("word_chars"),
        F.regexp_count("text", F.lit("[#*$%&|<>]")).cast("bigint").alias("n_symbols"),
        F.size("lines").cast("bigint").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        repeat_words(F.col("hashes")).alias("n_repeat_words"))


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def default_rules() -> dict[str, Column]:
    """Name -> reject; over the columns of ``measured``. Marks that running prose never reaches."""
    upper = F.regexp_count("text", F.lit("[A-ZÀ-ÖØ-Þ]"))
    shout = F.regexp_count("text", F.lit(r"[!?]{2,}"))
    digits = F.regexp_count("text", F.lit("[0-9]"))
    unending = F.regexp_count("text", F.lit(r"(?:\.\.\.|…)[\x20\t]*(?:\n|$)"))
    return {
        "word_length": (F.col("word_chars") < 2 * F.col("n_words")) | (F.col("word_chars") > 20 * F.col("n_words")),
        "symbols": 10 * F.col("n_symbols") > F.col("word_chars"),
        "repeated_lines": 2 * F.col("n_dup_lines") > F.col("n_lines"),
        "upper_case": 2 * upper > F.col("word_chars"),
        "shouting": 10 * shout > 3 * F.col("n_words"),
        "digits": 2 * digits > F.col("word_chars"),
        "unended_lines": 10 * unending > 3 * F.greatest("n_lines", F.lit(3)),
    }


def cascade_order(sample: DataFrame, rules: dict[str, Column]) -> list[tuple[str, float, float]]:
    """(rule, seconds, share rejected) with the most rejection per second first. One pass over the sample per rule; the cost of
    a pass without a rule is taken off."""
    def run(reject: Column) -> tuple[float, int, int]:
        began = time.perf_counter()
        row = sample.agg(F.count_if(F.coalesce(reject, F.lit(False))).alias("bad"), F.count(F.lit(1)).alias("n")).first()
        return time.perf_counter() - began, row["bad"], row["n"]

    run(F.length("text") < 0)
    bare = run(F.length("text") < 0)[0]
    got = []
    for name, reject in rules.items():
        took, bad, n = run(reject)
        got.append((name, max(took - bare, 1e-4), bad / n if n else 0.0))
    return sorted(got, key=lambda x: (-x[2] / x[1], x[1], x[0]))


def verdict(order: list[str], rules: dict[str, Column]) -> Column:
    """True where no rule rejects; a rule after the first that rejects is not evaluated. A rule that is null does not reject."""
    out, first = F.lit(True), True
    for name in order:
        reject = F.coalesce(rules[name], F.lit(False))
        out = F.when(reject, F.lit(False)) if first else out.when(reject, F.lit(False))
        first = False
    return out if first else out.otherwise(F.lit(True))


def judge(docs: DataFrame, rules: dict[str, Column] | None = None, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """One row per row of ``docs``: doc_id, MEASURES, base_failed, kept.

    Defined cases: a null, empty or blank text has no words and fails the base rule; repeated rows are judged alike; null doc_ids are
    kept as they are; an empty table gives no rows; other columns are ignored. The sample (about ``sample_rows`` documents)
    decides the order of the rules alone, never a verdict."""
    rules = default_rules() if rules is None else rules
    n = docs.count()
    sample = measured(docs.sample(min(1.0, sample_rows / n), seed=7) if n > sample_rows else docs).persist()
    try:
        order = [name for name, _, _ in cascade_order(sample, rules)]
    finally:
        sample.unpersist()
    return measured(docs).select("doc_id", *MEASURES, F.coalesce(base_failed(), F.lit(False)).alias("base_failed"),
                                 F.when(base_failed(), F.lit(False)).otherwise(verdict(order, rules)).alias("kept"))


def op3_quality(spark, sf_dir: str) -> DataFrame:
    from tidewater.llm.common import read_table

    return judge(read_table(spark, sf_dir, "documents"))


OP3_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents
), w AS (
  SELECT rid, doc_id, t, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls
  FROM d
), win AS (
  SELECT rid, i, list_slice(ws, i, i + 4) AS g
  FROM (SELECT rid, ws, unnest(range(1, len(ws) - 3)) AS i FROM w WHERE len(ws) >= 5)
), rep AS (
  SELECT rid, unnest(range(i, i + 5)) AS p
  FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS c FROM win) WHERE c > 1
), r AS (
  SELECT rid, count(DISTINCT p) AS n FROM rep GROUP BY rid
), m AS (
  SELECT w.doc_id, w.t, len(ls) AS n_lines, len(ws) AS n_words, coalesce(length(array_to_string(ws, '')), 0) AS word_chars,
         len(regexp_extract_all(t, '[#*$%&|<>]')) AS n_symbols, len(ls) - len(list_distinct(ls)) AS n_dup_lines,
         coalesce(r.n, 0) AS n_repeat_words
  FROM w LEFT JOIN r USING (rid)
), b AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m
)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
       n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, base_failed,
       NOT (base_failed
            OR word_chars < 2 * n_words OR word_chars > 20 * n_words
            OR 10 * n_symbols > word_chars
            OR 2 * n_dup_lines > n_lines
            OR 2 * len(regexp_extract_all(t, '[A-ZÀ-ÖØ-Þ]')) > word_chars
            OR 10 * len(regexp_extract_all(t, '[!?]{2,}')) > 3 * n_words
            OR 2 * len(regexp_extract_all(t, '[0-9]')) > word_chars
            OR 10 * len(regexp_extract_all(t, '(\.\.\.|…)[\x20\t]*(\n|$)')) > 3 * greatest(n_lines, 3)) AS kept
FROM b
"""
