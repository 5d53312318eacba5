r"""Source divergence audit: how far the term frequencies of a (lang, source) group are from those of its language and of its other sources.

A language's vocabulary, the terms in at least ``MIN_DOCS`` of its documents, is found by iceberg prefix refinement. Terms are byte strings
with a zero byte at their end, cut at 6, 16, 32, 64, ... bytes. At each width the documents that hold a prefix are counted, per
language, and prefixes below the threshold are discarded: only terms whose shorter prefix is left are cut at the next width, until every prefix
that is left is a complete term. Counts per source are taken only of those.

Tasks know the prefixes that are left by a bit set of fixed size (``PRUNE_BITS``), and prefixes of more than 16 bytes by 127 bits of hash. Where
two prefixes share a bit or a hash, one that should go may stay; it goes by its exact count in the end, so the result does not depend on that.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.broadcast import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.llm.common import materialize, only

MIN_DOCS = 3
TOP_TERMS = 200
SCALE = 1_000_000_000
WIDTHS = [6, 16]           # then twice as many bytes each time
PRUNE_BITS = 26            # the bit set has 2^26 bits: 8 MB, whatever the corpus
SLICE = 3_000_000          # bytes of text that are cut into terms at a time (a longer text is taken whole)
HELD_ROWS = 1_000_000      # sums that a task holds before it hands them on
PAIR_ROWS = 500_000        # counts of a task of the pair sums, about
BLOCK = 1024               # sources of a language that a task of the pair sums compares with so many others

_BYTES = np.arange(256, dtype=np.uint8)
_TERM = ((_BYTES >= 0x41) & (_BYTES <= 0x5A)) | ((_BYTES >= 0x61) & (_BYTES <= 0x7A)) | (_BYTES >= 0x80)
_LOWER = np.where((_BYTES >= 0x41) & (_BYTES <= 0x5A), _BYTES + 32, _BYTES).astype(np.uint8)
_MASK = np.array([0] + [((1 << 8 * k) - 1) << 8 * (8 - k) for k in range(1, 9)], np.uint64)


def _terms(text: pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased bytes of the texts, and per term its first byte, its length and the number of its text."""
    offsets = np.frombuffer(text.buffers()[1], np.int64)[text.offset:text.offset + len(text) + 1]
    base, size = int(offsets[0]), int(offsets[-1] - offsets[0])
    data = np.zeros(size + 16, np.uint8)
    if size:
        data[:size] = _LOWER[np.frombuffer(text.buffers()[2], np.uint8)[base:base + size]]
    bounds = offsets - base
    inside = _TERM[data[:size]]
    before, after = np.zeros(size, bool), np.zeros(size, bool)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    full = bounds[1:] > bounds[:-1]
    before[bounds[:-1][full]] = False
    after[bounds[1:][full] - 1] = False
    start = np.flatnonzero(inside & ~before)
    length = np.flatnonzero(inside & ~after) + 1 - start
    return data, start, length, np.searchsorted(bounds[1:], start, side="right")


def _words(data: np.ndarray, start: np.ndarray, length: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``width`` bytes of each term as two big-endian words, zeros after its end."""
    eight = np.ndarray(len(data) - 7, ">u8", data, 0, (1,))
    first = eight[start].astype(np.uint64) & _MASK[np.minimum(length, min(width, 8))]
    if width <= 8:
        return first, np.zeros(len(start), np.uint64)
    return first, eight[start + 8].astype(np.uint64) & _MASK[np.clip(length - 8, 0, width - 8)]


def _bit(lang: np.ndarray, first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """The bit of a prefix of a language (XXH64 of its name)."""
    x = (first ^ lang) * np.uint64(0x9E3779B97F4A7C15)
    x = ((x ^ x >> np.uint64(29)) + second) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ x >> np.uint64(32)) * np.uint64(0x94D049BB133111EB)
    return x >> np.uint64(64 - PRUNE_BITS)


def _lang_hash(names: list[str]) -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest(n.encode()) for n in names], np.uint64)


def _numbers(first: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each prefix as a small number, and the words of each number."""
    a, firsts = pd.factorize(first)
    if not second.any():
        return a, firsts, np.zeros(len(firsts), np.uint64)
    b, seconds = pd.factorize(second)
    number, both = pd.factorize(a * len(seconds) + b)
    return number, firsts[both // len(seconds)], seconds[both % len(seconds)]


def _counts(number: np.ndarray, doc: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(number, group, occurrences, documents) of prefixes that occur in documents of ``group``."""
    rank = np.empty(len(group), np.int64)
    order = np.argsort(group, kind="stable")
    rank[order] = np.arange(len(group))
    keys = np.sort(number * len(group) + rank[doc])
    head = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    pair = keys[head]
    n = np.diff(np.append(head, len(keys)))
    of, in_group = pair // len(group), group[order][pair % len(group)]
    at = np.flatnonzero(np.concatenate([[True], (of[1:] != of[:-1]) | (in_group[1:] != in_group[:-1])])) if len(pair) else np.zeros(0, np.int64)
    total = np.add.reduceat(n, at) if len(at) else n
    return of[at], in_group[at], total, np.diff(np.append(at, len(pair)))


def _slices(batch: pa.RecordBatch) -> Iterator[tuple[pa.LargeStringArray, np.ndarray, list[str], np.ndarray, list[str]]]:
    """Texts of about SLICE bytes together, with the numbers and names of their languages and sources."""
    text, lang, source = (pc.fill_null(batch.column(k).cast(pa.large_string()), "") for k in range(3))
    if not len(text):
        return
    lang, source = lang.dictionary_encode(), source.dictionary_encode()
    codes = [x.indices.to_numpy(zero_copy_only=False).astype(np.int64) for x in (lang, source)]
    names = [x.dictionary.to_pylist() for x in (lang, source)]
    at, offsets = 0, np.frombuffer(text.buffers()[1], np.int64)[text.offset:text.offset + len(text) + 1]
    while at < len(text):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + SLICE, side="right")) - 1)
        yield text.slice(at, to - at), codes[0][at:to], names[0], codes[1][at:to], names[1]
        at = to


def _left(bits: np.ndarray, lang: np.ndarray, first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Which prefixes are left. ``lang``: the language's hash."""
    bit = _bit(lang, first, second)
    return (bits[bit >> np.uint64(6)] >> (bit & np.uint64(63)) & np.uint64(1)).astype(bool)


class _Held:
    """Sums of a task by (first, second, group), handed on once it is done or they are too many."""

    def __init__(self) -> None:
        self.names: dict[tuple, int] = {}
        self.parts: list[tuple[np.ndarray, ...]] = []
        self.rows = 0

    def add(self, first: np.ndarray, second: np.ndarray, group: np.ndarray, names: list[tuple], n: np.ndarray, docs: np.ndarray) -> bool:
        codes = np.array([self.names.setdefault(x, len(self.names)) for x in names], np.int64)
        self.parts.append((first, second, codes[group], n, docs))
        self.rows += len(first)
        if self.rows <= HELD_ROWS:
            return False
        self.parts = [self.summed()]
        self.rows = len(self.parts[0][0])
        return self.rows > HELD_ROWS // 2

    def summed(self) -> tuple[np.ndarray, ...]:
        first, second, group, n, docs = (np.concatenate(c) for c in zip(*self.parts, strict=True))
        number, firsts, seconds = _numbers(first, second)
        row, rows = pd.factorize(number * len(self.names) + group)
        add = lambda v: np.bincount(row, v, len(rows)).astype(np.int64)  # noqa: E731  sums of a task stay far below 2^53
        number, group = rows // len(self.names), rows % len(self.names)
        return firsts[number], seconds[number], group, add(n), add(docs)

    def take(self) -> tuple[list[pa.Array], np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The names' columns of each row, its two words, n and docs."""
        first, second, group, n, docs = self.summed()
        columns = [pa.array(c, pa.string()).take(pa.array(group)) for c in zip(*self.names, strict=True)]
        self.__init__()
        return columns, first, second, n, docs


def _hashed(data: np.ndarray, start: np.ndarray, length: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Two words of hash per prefix of ``width`` bytes, of the term and its end if it is shorter; the lowest bit is set if it is not."""
    first, second = np.empty(len(start), np.uint64), np.empty(len(start), np.uint64)
    for k, (a, n) in enumerate(zip(start.tolist(), length.tolist(), strict=True)):
        cut = data[a:a + width].tobytes() if n >= width else data[a:a + n].tobytes() + b"\0"
        h = xxhash.xxh3_128_intdigest(cut)
        first[k], second[k] = h >> 64, h & 0xFFFFFFFFFFFFFFFE | (n >= width)
    return first, second


def _prefixes(width: int, before: int | None, known: Broadcast | None):
    """Task function: (lang, first, second, docs) of the prefixes of ``width`` bytes, of terms that are left at ``before`` bytes."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = _Held()

        def out() -> pa.RecordBatch:
            columns, first, second, _, docs = held.take()
            return pa.RecordBatch.from_arrays([*columns, pa.array(first.view(np.int64)), pa.array(second.view(np.int64)), pa.array(docs)],
                                              names=["lang", "first", "second", "docs"])

        for batch in batches:
            for text, lang, langs, _, _ in _slices(batch):
                data, start, length, doc = _terms(text)
                if before:                              # shorter ones are complete and counted
                    keep = length >= before
                    start, length, doc = start[keep], length[keep], doc[keep]
                    keep = _left(known.value, _lang_hash(langs)[lang[doc]], *(_words if before <= 16 else _hashed)(data, start, length, before))
                    start, length, doc = start[keep], length[keep], doc[keep]
                number, first, second = _numbers(*(_words if width <= 16 else _hashed)(data, start, length, width))
                of, group, n, docs = _counts(number, doc, lang)
                if held.add(first[of], second[of], group, [(x,) for x in langs], n, docs):
                    yield out()
        if held.rows:
            yield out()

    return cut


def _occurrences(known: Broadcast):
    """Task function: (lang, source, term, n, docs) of terms that are left: those that end within 16 bytes by their words, longer ones as strings."""
    names = ["lang", "source", "term", "n", "docs"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = _Held()

        def out() -> pa.RecordBatch:
            columns, first, second, n, docs = held.take()
            raw = np.stack([first, second], axis=1).astype(">u8").view(np.uint8).reshape(len(n), 16)
            ends = np.concatenate([[0], np.cumsum((raw != 0).sum(axis=1))]).astype(np.int32)
            terms = pa.StringArray.from_buffers(len(n), pa.py_buffer(ends), pa.py_buffer(raw[raw != 0].tobytes()))
            return pa.RecordBatch.from_arrays([*columns, terms, pa.array(n), pa.array(docs)], names=names)

        for batch in batches:
            for text, lang, langs, source, sources in _slices(batch):
                data, start, length, doc = _terms(text)
                of_lang, short = _lang_hash(langs)[lang[doc]], length < 16
                first, second = _words(data, start[short], length[short], 16)
                keep = _left(known.value, of_lang[short], first, second)
                number, first, second = _numbers(first[keep], second[keep])
                of, at, n, docs = _counts(number, doc[short][keep], lang * len(sources) + source)
                if held.add(first[of], second[of], at, [(x, y) for x in langs for y in sources], n, docs):
                    yield out()
                start, length, doc, of_lang = start[~short], length[~short], doc[~short], of_lang[~short]
                keep = np.flatnonzero(_left(known.value, of_lang, *_hashed(data, start, length, 1 << 62)))
                if len(keep):
                    terms = pa.array([data[start[k]:start[k] + length[k]].tobytes().decode() for k in keep.tolist()], pa.string()).dictionary_encode()
                    of, at, n, docs = _counts(terms.indices.to_numpy().astype(np.int64), doc[keep], lang * len(sources) + source)
                    columns = [pa.array(x, pa.string()).take(pa.array(i)) for x, i in ((langs, at // len(sources)), (sources, at % len(sources)))]
                    yield pa.RecordBatch.from_arrays([*columns, terms.dictionary.take(pa.array(of)), pa.array(n), pa.array(docs)], names=names)
        if held.rows:
            yield out()

    return cut


def _bits_of(prefixes: DataFrame) -> Broadcast:
    """The bit set of prefixes that are left. Its words reach the driver: 2^PRUNE_BITS / 64 at most, whatever the number of prefixes."""
    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lang = batch.column(0).dictionary_encode()
            hashes = _lang_hash(lang.dictionary.to_pylist())[lang.indices.to_numpy(zero_copy_only=False)] if len(batch) else np.zeros(0, np.uint64)
            bit = _bit(hashes, *(batch.column(k).to_numpy(zero_copy_only=False).view(np.uint64) for k in (1, 2)))
            yield pa.RecordBatch.from_arrays([pa.array((bit >> np.uint64(6)).astype(np.int64)),
                                              pa.array((np.uint64(1) << (bit & np.uint64(63))).view(np.int64))], names=["word", "bits"])

    words = (prefixes.select("lang", "first", "second").mapInArrow(mark, "word long, bits long")
             .groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow())
    out = np.zeros(1 << PRUNE_BITS - 6, np.uint64)
    out[words.column("word").to_numpy()] = words.column("bits").to_numpy().view(np.uint64)
    return prefixes.sparkSession.sparkContext.broadcast(out)


def kept_terms(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """(lang, term, n_lang, counts) of the terms in at least ``min_docs`` documents (rows) of their language: occurrences there, and an array of
    (source, n) of the sources that have the term; an array has one entry per source of the language at most."""
    texts = only(docs, "text", "lang", "source")
    before, width, sent, ends = None, WIDTHS[0], [], None
    while True:
        parts = texts.mapInArrow(_prefixes(width, before, sent[-1] if sent else None), "lang string, first long, second long, docs long")
        held = materialize(parts.groupBy("lang", "first", "second").agg(F.sum("docs").alias("docs")).where(F.col("docs") >= min_docs), "divergence-prefixes")
        last = F.shiftrightunsigned("second" if width > 8 else "first", 8 * (-width % 8)).bitwiseAND(F.lit(255 if width <= 16 else 1).cast("bigint"))
        ended = held.where(last == 0)            # complete terms: no later width changes what they are known by
        ends = ended if ends is None else ends.union(ended)
        if held.where(last != 0).isEmpty():
            break
        sent.append(_bits_of(held))
        before, width = width, WIDTHS[len(sent)] if len(sent) < len(WIDTHS) else 2 * width
    sent.append(_bits_of(ends))
    # dealt out by (lang, term) once, for the sums per source and those of the language
    raw = texts.mapInArrow(_occurrences(sent[-1]), "lang string, source string, term string, n long, docs long").repartition("lang", "term")
    each = raw.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    kept = (each.groupBy("lang", "term").agg(F.sum("n").alias("n_lang"), F.sum("docs").alias("held"), F.collect_list(F.struct("source", "n")).alias("counts"))
            .where(F.col("held") >= min_docs).drop("held"))
    kept = materialize(kept, "divergence-terms")
    for b in sent:
        b.unpersist()
    return kept


def _share(n: str, total: str, terms: str) -> Column:
    """1 + floor(SCALE * (n + 1) / (total + terms)), exact: in decimals where 64 bits do not hold the product; 1 where there is no term."""
    small = F.expr(f"1 + ({SCALE}L * ({n} + 1)) div ({total} + {terms})")
    large = F.expr(f"1 + (cast({SCALE} as decimal(10,0)) * cast({n} + 1 as decimal(20,0))) div (cast({total} as decimal(20,0)) + cast({terms} as decimal(20,0)))")
    return F.when(F.col(terms) == 0, F.lit(1)).when(F.col(n) < 9 * SCALE, small).otherwise(large).cast("bigint")


def _pair_sums(key: tuple, table: pa.Table) -> pa.Table:
    """Sums over the terms of one group (lang, part, i, j), for all sources of block i (as groups) and block j (as items), against ``absent``, the
    value of a term that neither source has. Rows with a null ``n_lang`` name a source and its total."""
    lang, _, i, j = (k.as_py() for k in key)
    table = table.combine_chunks()
    is_head = pc.is_null(table["n_lang"])
    heads, body = table.filter(is_head), table.filter(pc.invert(is_head))
    names = heads["source"].to_pylist()
    flat = body["counts"].combine_chunks().flatten()
    entry = np.repeat(np.arange(len(body)), pc.list_value_length(body["counts"]).to_numpy())
    col = pc.index_in(flat.field("source"), value_set=pa.array(names, pa.string())).to_numpy(zero_copy_only=False).astype(np.int64)
    n = flat.field("n").to_numpy(zero_copy_only=False)
    terms, whole = heads["terms"][0].as_py(), heads["total"].to_numpy().astype(np.int64) + heads["terms"][0].as_py()
    if len(n) and n.max() >= 9 * SCALE:                  # beyond 64 bits
        n, of = n.astype(object), whole.astype(object)[col]
    else:
        of = whole[col]
    p = (1 + SCALE * (n + 1) // of).astype(np.int64)
    zero = 1 + SCALE // whole if terms else np.ones(len(whole), np.int64)
    block = heads["block"].to_numpy()
    left, right = np.flatnonzero(block == i), np.flatnonzero(block == j)
    sums = np.zeros((len(right), len(left)), np.int64)
    chunk = max(1, 2_000_000 // len(zero))
    for at in range(0, len(body), chunk):
        a, b = np.searchsorted(entry, [at, at + chunk])
        grid = np.tile(zero, (min(chunk, len(body) - at), 1))
        grid[entry[a:b] - at, col[a:b]] = p[a:b]
        grid = np.ascontiguousarray(grid.T)
        group = grid[left]
        for r, item in enumerate(right):
            gap = group - grid[item]
            gap *= gap
            gap //= grid[item]
            sums[r] += gap.sum(axis=1)
    absent = (zero[left][None, :] - zero[right][:, None]) ** 2 // zero[right][:, None]
    source, item = np.tile(left, len(right)), np.repeat(right, len(left))
    out = pa.table({"lang": pa.array([lang] * len(source), pa.string()), "source": pa.array(names, pa.string()).take(pa.array(source)),
                    "item": pa.array(names, pa.string()).take(pa.array(item)), "value": pa.array(sums.ravel()),
                    "seen": pa.array(np.full(len(source), len(body))), "absent": pa.array(absent.ravel())})
    return out.filter(pa.array(source != item))


def divergence(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP_TERMS) -> DataFrame:
    """Rows (lang, source, part, item, value, rank) for every occurring (lang, source). Part ``pair``: the divergence of the source's term shares
    from those of each other source of the language. Part ``term``: the ``top`` terms that the source has more of than its language.

    All arithmetic is exact; a pair's sum stays below (SCALE + terms)^2, within 64 bits up to 2 * 10^9 terms a language. Defined cases: null
    text, lang and source are empty strings; every row is a document, repeated rows too; a language without kept terms has pairs of
    value 0 and no terms; a language with one source has no pairs; ties go by the item's UTF-8 bytes; an empty table gives no
    rows; other columns are ignored."""
    kept = kept_terms(docs, min_docs)
    each = kept.select("lang", "term", "n_lang", F.explode("counts").alias("c")).select("lang", "c.source", "term", "n_lang", "c.n")
    named = only(docs, "lang", "source").select(*[F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source")]).distinct()
    langs = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("terms"), F.sum("n_lang").alias("lang_total"))
    groups = materialize(named.join(each.groupBy("lang", "source").agg(F.sum("n").alias("total")), ["lang", "source"], "left").join(langs, "lang", "left")
                         .select("lang", "source", *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("total", "terms", "lang_total")]), "divergence-groups")
    best = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    more = (each.join(groups, ["lang", "source"])
            .select("lang", "source", F.col("term").alias("item"), _share("n", "total", "terms").alias("p"), _share("n_lang", "lang_total", "terms").alias("q"))
            .where("p > q").select("lang", "source", "item", F.expr("((p - q) * (p - q)) div q").alias("value"))
            .withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
            .select("lang", "source", F.lit("term").alias("part"), "item", "value", "rank"))

    # pairs: terms are dealt out by hash; each part gets its terms' counts and one head row of every source
    entries = kept.agg(F.sum(F.size("counts").cast("bigint")).alias("n")).first()["n"] or 0
    most = groups.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n").alias("n")).first()["n"] or 0
    n_parts, blocks = max(1, -(-entries // PAIR_ROWS)), max(1, -(-most // BLOCK))
    numbers = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    block = lambda source: F.pmod(F.xxhash64(source), F.lit(blocks)).cast("int")
    none = F.array().cast(kept.schema["counts"].dataType)
    heads = groups.select("lang", numbers(n_parts).alias("part"), "source", "total", "terms", F.lit(None).cast("bigint").alias("n_lang"), none.alias("counts"))
    nothing = [F.lit(None).cast(t).alias(c) for c, t in (("source", "string"), ("total", "bigint"), ("terms", "bigint"))]
    body = kept.select("lang", F.pmod(F.xxhash64("term"), F.lit(n_parts)).cast("int").alias("part"), *nothing, "n_lang", "counts")
    dealt = heads.union(body).withColumn("block", block(F.col("source")))
    if blocks == 1:
        dealt = dealt.withColumns({"i": F.lit(0), "j": F.lit(0)})
    else:
        # every pair of blocks gets the heads and counts of its sources
        mine = lambda b: (b == F.col("i")) | (b == F.col("j"))
        dealt = (dealt.withColumn("i", numbers(blocks)).withColumn("j", numbers(blocks)).withColumn("counts", F.filter("counts", lambda c: mine(block(c["source"]))))
                 .where(F.when(F.col("n_lang").isNull(), mine(F.col("block"))).otherwise(F.size("counts") > 0)))
    found = dealt.groupBy("lang", "part", "i", "j").applyInArrow(_pair_sums, "lang string, source string, item string, value long, seen long, absent long")
    exact = lambda c: F.col(c).cast("decimal(38,0)")
    pairs = (found.groupBy("lang", "source", "item").agg(F.sum(exact("value")).alias("value"), F.sum("seen").alias("seen"), F.max("absent").alias("absent"))
             .join(groups.select("lang", "source", "terms"), ["lang", "source"])
             .select("lang", "source", F.lit("pair").alias("part"), "item",
                     (F.col("value") + (F.col("terms") - F.col("seen")).cast("decimal(18,0)") * F.col("absent").cast("decimal(19,0)")).cast("bigint").alias("value"))
             .withColumn("rank", F.row_number().over(best)))
    return pairs.select(*more.columns).union(more)


def op13_divergence(spark, sf_dir: str) -> DataFrame:
    from tidewater.llm.common import read_table

    return divergence(read_table(spark, sf_dir, "documents"), MIN_DOCS, TOP_TERMS)


OP13_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
w AS (SELECT r, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
k AS (SELECT lang, term, count(*) AS n_lang FROM w GROUP BY lang, term HAVING count(DISTINCT r) >= 3),
c AS (SELECT w.lang, w.source, w.term, count(*) AS n FROM w JOIN k ON w.lang = k.lang AND w.term = k.term GROUP BY ALL),
l AS (SELECT lang, count(*) AS v, sum(n_lang) AS n FROM k GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
s AS (SELECT lang, source, sum(n) AS n FROM c GROUP BY ALL),
full_p AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
    1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 1)) // (coalesce(s.n, 0)::HUGEINT + l.v) AS p,
    1 + (1000000000::HUGEINT * (k.n_lang + 1)) // (l.n::HUGEINT + l.v) AS q
    FROM g JOIN k ON g.lang = k.lang JOIN l ON g.lang = l.lang
    LEFT JOIN s ON g.lang = s.lang AND g.source = s.source
    LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
pairs AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
    FROM full_p a JOIN full_p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pair AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(p.value, 0)::BIGINT AS value
    FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source),
term AS (SELECT lang, source, 'term' AS part, term AS item, ((p - q) * (p - q) // q)::BIGINT AS value FROM full_p WHERE n > 0 AND p > q),
r AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM (SELECT * FROM pair UNION ALL SELECT * FROM term))
SELECT lang, source, part, item, value, rank::INTEGER AS rank FROM r WHERE part = 'pair' OR rank <= 200
"""
