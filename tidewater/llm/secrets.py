r"""Secret scan with a randomness test battery, with built-in functions only.

Base patterns (assignments, access keys, hex runs) are found everywhere and stay. The battery adds runs that look drawn at random:
each run of 16 or more key characters gets an encoding inferred from its characters (digits, hex, base32, base62, base64) and three
tests of uniform randomness over that alphabet: chi-squared on equal classes of it, runs above and below its middle, and
lag-one serial correlation, joined by Fisher's method into a score, the logarithm of the p-value, which is near 0 for random strings
and far below for others.

False discoveries are controlled per length class against a control group: runs of letters, which are words, take the same tests over the
base62 alphabet (as if one digit had joined them). Runs are ranked by their empirical p-value: the share of controls that score as high. Where
few or no controls do, that share is carried on by the exponential tail that the highest tenth of them has, so its fineness is not bounded by
their number, and random strings that are rare among very many ordinary runs are still found. Each class is cut at the lowest score at which
the expected number of ordinary runs above it is at most ``SHARE`` of those found (Benjamini and Hochberg's rule). A class with few control
words borrows those of shorter classes: the tests only gain power with length.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import materialize, only
from tidewater.llm.quality import let

ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
RUN = r"[A-Za-z0-9+/_-]{16,}(?:={1,2}(?![A-Za-z0-9+/_=-]))?"     # `=` only as padding: a value after a name and `=` is a run of its own
KINDS = ["assign", "access", "hex", "random"]
LENGTHS = [16, 20, 24, 32, 48, 64]
ALPHA = 0.02              # a run whose randomness is rejected at this level is never reported (3 to 4 % of random strings: the tests depend on each other)
CONTROLS = 50             # control words a length class needs, its own or borrowed
TAIL = 0.1                # share of the controls, the highest, that the tail is fitted to (20 at least)
SHARE = 0.05              # accepted share of ordinary strings among the reports of a length class
BIN, LOWEST = 0.05, -60.0 # scores are counted in bins of this width; all below the lowest are one
DIGITS, UPPER, LOWER = "0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ALPHABETS = {"word": DIGITS + UPPER + LOWER, "digits": DIGITS, "hex": DIGITS + "abcdef", "base32": UPPER + "234567", "base62": DIGITS + UPPER + LOWER,
             "base64": "+/" + DIGITS + UPPER + LOWER}
BLOCK = 256


def _places(text: Column, pattern: str, group: int = 0) -> Column:
    """Leftmost non-overlapping matches as structs (start, n, s): code points before the match, code points of the match, and the
    text of ``group``. The gaps between matches come from a split at the same pattern; starts are prefix sums in
    two levels, so a text of n matches costs n * (n / 256 + 256) additions at most."""
    total = lambda a: F.aggregate(a, F.lit(0), lambda x, y: x + y)
    parts = F.struct(F.transform(F.split(text, pattern, -1), lambda x: F.length(x)).alias("gap"),
                     F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda x: F.length(x)).alias("len"),
                     F.regexp_extract_all(text, F.lit(pattern), F.lit(group)).alias("s"))

    def placed(p: Column) -> Column:
        step = F.transform(p["len"], lambda n, i: n + F.get(p["gap"], i))

        def from_steps(u: Column) -> Column:
            blocks = F.transform(F.sequence(F.lit(0), F.floor(F.size(u) / BLOCK).cast("int")), lambda b: total(F.slice(u, b * BLOCK + 1, F.lit(BLOCK))))
            return let(blocks, lambda v: F.transform(p["len"], lambda n, i: F.struct(
                (total(F.slice(v, F.lit(1), F.floor(i / BLOCK).cast("int"))) + total(F.slice(u, F.floor(i / BLOCK).cast("int") * BLOCK + 1, i % BLOCK))
                 + F.get(p["gap"], i)).alias("start"), n.alias("n"), F.get(p["s"], i).alias("s"))))

        return let(step, from_steps)

    none = F.array().cast("array<struct<start:int,n:int,s:string>>")
    return F.when(text.rlike(pattern), let(parts, placed)).otherwise(none)


def _spans(places: Column, kind: int) -> Column:
    return F.transform(places, lambda p: F.struct(p["start"].alias("start"), F.lit(kind).alias("kind"), (p["start"] + p["n"]).alias("end")))


def encoding(run: Column) -> Column:
    """The smallest alphabet a run fits (padding taken off), ``word`` for letters in a word's case."""
    return (F.when(run.rlike("^[0-9]*$"), F.lit("digits"))
            .when(run.rlike("^[A-Z]?[a-z]+$|^[A-Z]+$"), F.lit("word"))
            .when(run.rlike("^[0-9a-f]+$|^[0-9A-F]+$"), F.lit("hex"))
            .when(run.rlike("^[A-Z2-7]+$"), F.lit("base32"))
            .when(run.rlike("^[0-9A-Za-z]+$"), F.lit("base62"))
            .otherwise(F.lit("base64")))


def _tail(z: Column) -> Column:
    """Upper tail of the standard normal distribution (logistic form, error below 2e-4)."""
    return 1 / (1 + F.exp(F.least(F.greatest(1.5976 * z + 0.070565992 * z * z * z, F.lit(-700.0)), F.lit(700.0))))


def _battery(run: Column, enc: Column) -> Column:
    """P-value of the hypothesis that the run's characters are drawn independently and uniformly from its alphabet."""
    letters = F.when(enc == "hex", F.lower(run)).otherwise(F.translate(run, "-_", "+/"))
    table = F.lit("")
    for name, chars in ALPHABETS.items():
        table = F.when(enc == name, F.lit(chars)).otherwise(table)

    def tests(x: Column) -> Column:
        v, k = x["v"], x["k"]
        n = F.size(v).cast("double")
        m = F.greatest(F.lit(2), F.least(k, F.floor(n / 5).cast("int")))

        def chi(m: Column) -> Column:
            def term(j: Column) -> Column:
                want = n * (F.ceil((j + 1) * k / m) - F.ceil(j * k / m)) / k
                seen = F.size(F.filter(v, lambda c: F.floor(c * m / k) == j))
                return (seen - want) * (seen - want) / want
            stat = F.aggregate(F.transform(F.sequence(F.lit(0), m - 1), term), F.lit(0.0), lambda a, b: a + b)
            f = (m - 1).cast("double")
            return _tail((F.pow(stat / f, F.lit(1 / 3)) - (1 - 2 / (9 * f))) / F.sqrt(2 / (9 * f)))

        high = F.transform(v, lambda c: 2 * c >= k)
        up = F.size(F.filter(high, lambda h: h)).cast("double")
        runs = 1 + F.size(F.filter(high, lambda h, i: (i > 0) & (h != F.get(high, i - 1)))).cast("double")
        mean = 1 + 2 * up * (n - up) / n
        var = (mean - 1) * (mean - 2) / (n - 1)
        p_runs = F.when(var > 0, 2 * _tail(F.abs(runs - mean) / F.sqrt(var))).otherwise(F.lit(0.0))
        half = (k - 1) / 2.0
        dot = F.aggregate(F.transform(v, lambda c, i: F.when(i == 0, F.lit(0.0)).otherwise((c - half) * (F.get(v, i - 1) - half))), F.lit(0.0), lambda a, b: a + b)
        p_serial = 2 * _tail(F.abs(dot) / ((k * k - 1) / 12.0) / F.sqrt(n))
        logs = [F.log(F.greatest(p, F.lit(1e-300))) for p in (let(m, chi), F.least(p_runs, F.lit(1.0)), F.least(p_serial, F.lit(1.0)))]
        return let(-(logs[0] + logs[1] + logs[2]), lambda h: F.exp(-h) * (1 + h + h * h / 2))

    chars = F.filter(F.split(letters, ""), lambda c: c != "")
    return let(F.struct(F.transform(chars, lambda c: F.call_function("instr", table, c) - 1).alias("v"), F.length(table).alias("k")), tests)


def scanned(docs: DataFrame) -> DataFrame:
    """(doc_id, base, runs) per row. base: spans (start, kind, end); runs: tested runs (start, end, class, word, p)."""
    t = only(docs, "doc_id", "text").select("doc_id", F.coalesce("text", F.lit("")).alias("t"))
    # the value of group 2 decides an assignment; a match that fails still takes its place in the text
    assign = F.filter(_places(F.col("t"), ASSIGN, 2), lambda p: F.length(p["s"]) >= 12)
    found = t.select("doc_id", assign.alias("a"), _places(F.col("t"), ACCESS).alias("k"), _places(F.col("t"), HEX).alias("h"), _places(F.col("t"), RUN).alias("r"))

    def test(p: Column) -> Column:
        bare = F.rtrim(F.translate(p["s"], "=", " "))
        return let(F.struct(bare.alias("s"), encoding(bare).alias("e")), lambda q: F.struct(
            p["start"].alias("start"), (p["start"] + p["n"]).alias("end"),
            F.aggregate(F.array(*[F.lit(n) for n in LENGTHS]), F.lit(0), lambda a, n: F.when(F.length(q["s"]) >= n, n).otherwise(a)).alias("class"),
            (q["e"] == "word").alias("word"),
            _battery(q["s"], q["e"]).alias("p")))

    return found.select("doc_id", F.array_sort(F.concat(_spans(F.col("a"), 0), _spans(F.col("k"), 1), _spans(F.col("h"), 2))).alias("base"),
                        F.filter(F.transform("r", test), lambda r: r["p"].isNotNull() & (r["class"] > 0)).alias("runs"))


def score(p: Column) -> Column:
    return F.log(F.greatest(p, F.lit(1e-300)))


def cut(controls: dict[int, int], runs: dict[int, int], share: float = SHARE, alpha: float = ALPHA) -> int | None:
    """The lowest bin of scores from which a class is reported; None if there is none. ``controls`` and ``runs``: counts by bin."""
    n, m = sum(controls.values()), sum(runs.values())
    if n < CONTROLS or not m:
        return None
    # the tail begins at the highest bin that holds the wanted share of controls, and falls as their mean excess over it does
    want, held, begin = max(20.0, TAIL * n), 0, 0
    for b in sorted(controls, reverse=True):
        held, begin = held + controls[b], b
        if held >= want:
            break
    excess = sum((b - begin + 0.5) * c for b, c in controls.items() if b >= begin) * BIN / held
    slope = max(excess * (1 + 2 / math.sqrt(held)), BIN)
    floor = max(begin, math.ceil((math.log(alpha) - LOWEST) / BIN))
    above, seen, best = 0, 0, None
    for b in sorted(set(runs) | {k for k in controls if k >= floor}, reverse=True):
        if b < floor:
            break
        above, seen = above + controls.get(b, 0), seen + runs.get(b, 0)
        tail = max(above / n, held / n * math.exp(-(b - begin) * BIN / slope))
        if seen and tail * m <= share * seen:
            best = b
    return best


def thresholds(found: DataFrame, share: float = SHARE, alpha: float = ALPHA) -> dict[int, float]:
    """Length class -> the lowest score that is reported. Counts are over all documents; what reaches the driver is a count per class, kind of
    run and bin of scores, a number that does not grow with the corpus."""
    place = F.greatest(F.floor((score(F.col("r.p")) - LOWEST) / BIN), F.lit(0)).cast("int")
    rows = found.select(F.explode("runs").alias("r")).groupBy("r.class", "r.word", place.alias("bin")).agg(F.count(F.lit(1)).alias("n")).collect()
    controls: dict[int, dict[int, int]] = {c: {} for c in LENGTHS}
    runs: dict[int, dict[int, int]] = {c: {} for c in LENGTHS}
    for r in rows:
        (controls if r["word"] else runs)[r["class"]][r["bin"]] = r["n"]
    out = {}
    for k, c in enumerate(LENGTHS):
        pool: dict[int, int] = {}
        for shorter in reversed(LENGTHS[:k + 1]):
            for b, n in controls[shorter].items():
                pool[b] = pool.get(b, 0) + n
            if sum(pool.values()) >= CONTROLS:
                break
        b = cut(pool, runs[c], share, alpha)
        if b is not None:
            out[c] = LOWEST + b * BIN
    return out


def scan(docs: DataFrame, share: float = SHARE, alpha: float = ALPHA) -> DataFrame:
    """One row per row of ``docs``: doc_id, base and spans as arrays of (start, kind, end), by start and kind; offsets in code points, ends
    exclusive. ``spans`` are the base spans and the random runs (also those that a base span holds: what the tests say is kept).

    Defined cases: a null text is empty and has no spans; repeated rows and null doc_ids are scanned like others; an
    empty table gives no rows; without control words no random run is reported; other columns are ignored."""
    found = materialize(scanned(docs), "secrets")
    cuts = thresholds(found, share, alpha)

    def reported(r: Column) -> Column:
        ok = F.lit(False)
        for c, least in cuts.items():
            ok = F.when(r["class"] == c, score(r["p"]) >= least).otherwise(ok)
        return ~r["word"] & ok

    random = F.transform(F.filter("runs", reported),
                         lambda r: F.struct(r["start"].alias("start"), F.lit(3).alias("kind"), r["end"].alias("end")))
    return found.select("doc_id", "base", F.array_sort(F.concat("base", random)).alias("spans"))


def _text(spans: str) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def op9_secrets(spark, sf_dir: str) -> DataFrame:
    from tidewater.llm.common import read_table

    n = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint")
    found = scan(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", n(0).alias("n_assign"), n(1).alias("n_access"), n(2).alias("n_hex"),
                        F.sha2(_text("base").cast("binary"), 256).alias("base_sha256"), _text("spans").alias("spans"))
