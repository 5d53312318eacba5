"""Repeated passages: paragraph MinHash with tuned bands, and verbatim passages to their true edges.

Seeds say where to look: of every SPREAD consecutive runs of GRAM words the one with the smallest hash is a seed, so two texts that
share GRAM + SPREAD - 1 = 31 words share a seed, wherever their lines break. Only text around seeds that occur in two documents is looked
at further. Equal texts are one from the start.

Paragraphs are the lines of ``min_words`` words or more that hold such a seed, and the stretches over which such seeds follow each other
with a changed word between them at most. Each paragraph's five-word shingles give a MinHash; the bands are tuned to a stated recall at
the similarity threshold. Different paragraphs that collide in a band are joined and verified by exact Jaccard similarity (equal
ones are one node from the start), and clustered by components.

Verbatim passages need not fill a paragraph: every run of exactly ``min_words`` words around a seed is compared as a whole, and their
union has the true edges. A run with a seed inside that no other document has cannot be in one, so few runs are compared in vain. A document's passages are the unions of its paragraphs and runs that occur in other documents too,
documents that share one are one component, and all but the first occurrence are the removals.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewater.llm.common import connected_components, materialize, only

SHINGLE = 5
SIMILARITY = 0.8
RECALL = 0.99
MIN_WORDS = 51            # passages of over 50 words
GRAM = 12                 # words of a seed
SPREAD = 20               # one of so many neighbouring seeds is taken
BRIDGE = 2 * SPREAD - 1   # words between two seeds of a stretch: one changed word, and on either side those that may hold no seed
HOT = 2048                # different paragraphs of one bucket that are compared at once
PAIRS = 64                # of buckets up to this all similar pairs are links, of larger ones a spanning forest
BROADCAST_ROWS = 1_000_000  # text hashes broadcast at most (some 16 MB)
BLOCK_WORDS = 500_000


def tune_bands(similarity: float = SIMILARITY, recall: float = RECALL, most: int = 8) -> tuple[int, int]:
    """(bands, rows): the most rows per band for which ``most`` bands or fewer reach ``recall`` at ``similarity``; more rows
    mean fewer chance collisions."""
    best = (most, 1)
    for rows in range(1, 9):
        bands = math.ceil(math.log(1 - recall) / math.log(1 - similarity ** rows))
        if bands <= most:
            best = (bands, rows)
    return best


def _mix(x: np.ndarray, seed: int) -> np.ndarray:
    x = x ^ np.uint64((seed * 0x9E3779B97F4A7C15) & ((1 << 64) - 1))
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _ahead(x: np.ndarray, k: int) -> np.ndarray:
    return np.concatenate([x[k:], np.zeros(min(k, len(x)), x.dtype)])


def _runs_of(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of the ``n`` words from each place on: runs of 2, 4, 8, ... words, and two overlapping ones for the rest."""
    h, have = _mix(words, 3), 1
    while have < n:
        step = min(have, n - have)
        h = _mix(h * np.uint64(0x9E3779B97F4A7C15) + _ahead(h, step), 5 + have + step)
        have += step
    return h


def _words(texts: list, min_words: int):
    """Hashed words of the texts of ``min_words`` words or more, lower-cased in ASCII and cut at ASCII blanks: (text numbers, words, first word of
    each text, past the last of each, first word of each line, past the last of each line)."""
    h = xxhash.xxh64_intdigest
    some, words, ends, line_ends = [], [], [], []
    for i, t in enumerate(texts):
        if not isinstance(t, str):
            continue
        lines = [x.split() for x in t.encode("utf-8", "surrogatepass").lower().split(b"\n")]
        if sum(map(len, lines)) < min_words:
            continue
        for line in lines:
            words += line
            line_ends.append(len(words))
        some.append(i)
        ends.append(len(words))
    ends, line_ends = np.array(ends, np.int64), np.array(line_ends, np.int64)
    return (np.array(some, np.int64), np.fromiter(map(h, words), np.uint64, len(words)), np.append(0, ends)[:-1], ends,
            np.append(0, line_ends)[:-1], line_ends)


def _seeds(words: np.ndarray, first: np.ndarray, past: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(places, hashes, from, to) of the runs of GRAM words that are the smallest, the last of equals, of some SPREAD neighbours in a text:
    of those that begin at each place between from and to."""
    h = _runs_of(words, GRAM) | np.uint64(1)
    size = past - first
    valid = np.arange(len(words)) + GRAM <= np.repeat(past, size)
    # Texts lie SPREAD zeros apart, which no hash is beyond of: a neighbourhood never leaves its text.
    at = np.arange(len(words)) + np.repeat(np.arange(1, len(first) + 1) * SPREAD, size)
    wide = np.zeros(len(words) + (len(first) + 1) * SPREAD, np.uint64)
    wide[at] = np.where(valid, h, np.uint64(0))
    before, after = np.zeros(len(h), np.int64), np.zeros(len(h), np.int64)
    left, right = valid.copy(), valid.copy()
    for k in range(1, SPREAD):
        left &= wide[at - k] >= h
        right &= wide[at + k] > h
        before += left
        after += right
    places = np.flatnonzero(valid & (before + after + 1 >= SPREAD))
    return places, h[places], places - before[places], places + after[places] - (SPREAD - 1)


def seeds_of(texts: list, min_words: int = MIN_WORDS):
    """(text number, place, seed) of the seeds of many whole texts, and (text number, words) of the texts of ``min_words`` or more."""
    some, words, first, past, _, _ = _words(texts, min_words)
    places, h, _, _ = _seeds(words, first, past)
    text = np.searchsorted(past, places, side="right")
    return some[text], places - first[text], h.view(np.int64), some, past - first


def pieces_of(texts: list, seeds: list, bands: int, rows: int, min_words: int = MIN_WORDS):
    """What of many whole texts is compared, given the places of their shared seeds. Two tuples: runs of ``min_words`` words whose own
    seeds are all shared (text number, place, id), and paragraphs (text number, place, words, id, band keys, number of shingles of each, shingles one
    after another)."""
    some, words, first, past, line_first, line_past = _words(texts, min_words)
    size = len(words)
    here = np.concatenate([np.asarray(seeds[i], np.int64) + f for i, f in zip(some.tolist(), first.tolist())] or [np.zeros(0, np.int64)])
    here = np.sort(here)
    # What is the smallest of SPREAD neighbours inside a run is a seed wherever the run occurs: it must be shared for all of them.
    places, _, low, high = _seeds(words, first, past)
    alone = ~np.isin(places, here)
    turn = np.zeros(size + 1, np.int64)
    np.add.at(turn, low[alone], 1)
    np.add.at(turn, high[alone] + 1, -1)
    lone = np.append(0, np.cumsum(np.cumsum(turn[:-1]) > 0))
    at = np.flatnonzero(np.arange(size) + min_words <= np.repeat(past, past - first))
    at = at[lone[at + min_words - GRAM - SPREAD + 2] == lone[at]]
    run_text = np.searchsorted(past, at, side="right")
    runs = (some[run_text], at - first[run_text], _runs_of(words, min_words)[at].view(np.int64))

    owner = np.searchsorted(past, here, side="right")
    new = np.ones(len(here), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (here[1:] > here[:-1] + GRAM + BRIDGE)
    begin = here[new]
    end = here[np.append(np.flatnonzero(new)[1:] - 1, len(here) - 1)] + GRAM if len(here) else begin
    held = np.searchsorted(here, line_past - GRAM, side="right") > np.searchsorted(here, line_first, side="left")
    span = np.unique(np.concatenate([np.column_stack([begin, end]), np.column_stack([line_first, line_past])[held]]), axis=0)
    span = span[span[:, 1] - span[:, 0] >= min_words]
    start, stop = span[:, 0], span[:, 1]
    text = np.searchsorted(past, start, side="right")
    sh = _runs_of(words, SHINGLE)
    raw = words.tobytes()
    ids = np.array([xxhash.xxh64_intdigest(raw[8 * a:8 * b]) for a, b in zip(start.tolist(), stop.tolist())], np.uint64)
    count = stop - start - (SHINGLE - 1)
    where = np.repeat(start - np.append(0, np.cumsum(count))[:-1], count) + np.arange(count.sum())
    flat, cuts = sh[where], np.append(0, np.cumsum(count))[:-1]
    keys = np.zeros((len(start), bands), np.int64)
    for b in range(bands if len(start) else 0):
        key = np.full(len(start), b + 1, np.uint64)
        for r in range(rows):
            key = _mix(key + np.minimum.reduceat(_mix(flat, 100 + b * rows + r), cuts), 7)
        keys[:, b] = key.view(np.int64)
    return runs, (some[text], start - first[text], stop - start, ids.view(np.int64), keys, count, flat.view(np.int64))


def _blocks(batches: Iterator[pa.RecordBatch]):
    """Columns as lists in blocks of bounded length, whole texts each."""
    for batch in batches:
        from_, size = 0, 0
        texts = batch["text"].to_pylist()
        for i, t in enumerate(texts):
            size += len(t or "") // 6
            if size > BLOCK_WORDS or i + 1 == len(texts):
                part = batch.slice(from_, i + 1 - from_)
                yield part, texts[from_:i + 1]
                from_, size = i + 1, 0


def _lists(lengths: np.ndarray, flat: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(lengths)).astype(np.int32)), pa.array(flat))


def _collide(hot: int, similarity: float):
    """Task function over (key, id, sketch, n) rows sorted by key: candidate pairs of each key and the rows of keys with more than ``hot``
    different ids.

    Sets of n and m shingles with that similarity differ in at most (n + m) * (1 - similarity) / (1 + similarity) of them, so
    their parity sketches differ in no more bits; pairs beyond are not returned."""
    share = (1 - similarity) / (1 + similarity) + 1e-9

    def collide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, burning = np.zeros((0, 4), np.int64), None

        def batch_of(u, v, rows):
            null = lambda n: pa.nulls(n, pa.int64())
            cols = [pa.concat_arrays([pa.array(x), null(len(rows))]) for x in (u, v)]
            cols += [pa.concat_arrays([null(len(u)), pa.array(np.ascontiguousarray(rows[:, c]))]) for c in range(2)]
            return pa.RecordBatch.from_arrays(cols, ["u", "v", "key", "id"])

        def run(rows: np.ndarray, final: bool):
            """Pairs and rows of all keys but an unfinished last one, which is kept."""
            nonlocal held, burning
            rows = np.concatenate([held, rows])
            cuts = np.flatnonzero(rows[1:, 0] != rows[:-1, 0]) + 1
            first = np.concatenate([[0], cuts]) if len(rows) else np.zeros(0, np.int64)
            past = np.append(cuts, len(rows)) if len(rows) else first
            held, u, v, fire = np.zeros((0, 4), np.int64), [], [], []
            for k in np.flatnonzero((past - first > 1) | (np.arange(len(first)) == len(first) - 1) | (np.arange(len(first)) == 0)).tolist():
                part, key = rows[first[k]:past[k]], rows[first[k], 0]
                if burning == key:
                    fire.append(part)
                elif len(part) > hot:
                    fire.append(part)
                    burning = key
                elif not final and past[k] == len(rows):
                    held = part
                elif len(part) > 1:
                    i, j = np.triu_indices(len(part), 1)
                    near = np.bitwise_count((part[i, 2] ^ part[j, 2]).view(np.uint64)) <= (part[i, 3] + part[j, 3]) * share
                    u.append(part[i[near], 1])
                    v.append(part[j[near], 1])
            cat = lambda x, shape: np.concatenate(x) if x else np.zeros(shape, np.int64)
            return batch_of(cat(u, 0), cat(v, 0), cat(fire, (0, 4)))

        for batch in batches:
            if len(batch):
                yield run(np.column_stack([batch[c].to_numpy() for c in ("key", "id", "sketch", "n")]), False)
        yield run(np.zeros((0, 4), np.int64), True)

    return collide


def _forest(similarity: float):
    """Group function over paragraphs (id, sketch, sh, b, i, j) of two blocks of a bucket: edges of a spanning forest of the pairs that
    are as similar. Rows already in one tree are not compared again."""
    share = (1 - similarity) / (1 + similarity) + 1e-9

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        ids, b = pdf["id"].to_numpy(np.int64), pdf["b"].to_numpy()
        sets = [np.asarray(x, np.int64) for x in pdf["sh"]]
        n, sketch = np.array([len(x) for x in sets]), pdf["sketch"].to_numpy(np.int64)
        two, tree, edges = pdf["i"].iloc[0] != pdf["j"].iloc[0], np.arange(len(ids)), []
        for x in range(len(ids)):
            small, big = np.minimum(n, n[x]), np.maximum(n, n[x])
            near = (small >= similarity * big) & (np.bitwise_count((sketch ^ sketch[x]).view(np.uint64)) <= (n + n[x]) * share)
            near[:x + 1] = False
            if two:
                near &= b != b[x]
            for y in np.flatnonzero(near).tolist():
                if tree[x] != tree[y]:
                    same = len(np.intersect1d(sets[x], sets[y], assume_unique=True))
                    if same >= similarity * (n[x] + n[y] - same):
                        edges.append((ids[x], ids[y]))
                        tree[tree == max(tree[x], tree[y])] = min(tree[x], tree[y])
        return pd.DataFrame(np.array(edges, np.int64).reshape(-1, 2), columns=["u", "v"])

    return compare


def paragraph_links(marked: DataFrame, similarity: float = SIMILARITY, hot: int = HOT) -> DataFrame:
    """Pairs (u, v) of different paragraphs ``marked`` (id, keys: one per band, sh: shingles) that collide in a band and have a Jaccard
    similarity of at least ``similarity``; of buckets with more than ``PAIRS`` different shingle sets a spanning forest of such pairs,
    found in blocks of ``hot`` over many tasks. Paragraphs of equal shingle sets are linked as a star, and one of them goes on."""
    zero = F.lit(0).cast("bigint")
    each = marked.groupBy("id").agg(F.any_value("keys").alias("keys"), F.any_value("sh").alias("sh"))
    each = each.withColumn("sh", F.sort_array(F.array_distinct("sh"))).withColumn("set", F.xxhash64("sh"))
    each = materialize(each, "passages-paragraphs")
    one = each.groupBy("set").agg(F.min("id").alias("rep"))
    stars = each.select("id", "set").join(one, "set").where("id <> rep").select(F.col("rep").alias("u"), F.col("id").alias("v"))
    bit = lambda x: F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(x, F.lit(64)).cast("int"))
    parity = F.aggregate("sh", zero, lambda a, x: a.bitwiseXOR(bit(x)))
    reps = each.join(one.select(F.col("rep").alias("id")), "id", "left_semi").select("id", "sh", parity.alias("sketch"), F.explode("keys").alias("key"))
    entries = reps.select("key", "id", "sketch", F.size("sh").cast("bigint").alias("n")).distinct()
    entries = entries.repartition("key").sortWithinPartitions("key", "id")
    met = materialize(entries.mapInArrow(_collide(min(PAIRS, hot), similarity), "u long, v long, key long, id long"), "passages-met")
    sets = each.select("id", "sh", parity.alias("sketch"))
    both = (met.where("u is not null").select("u", "v").distinct().join(sets.select(F.col("id").alias("u"), F.col("sh").alias("a")), "u")
            .join(sets.select(F.col("id").alias("v"), F.col("sh").alias("b")), "v"))
    same = F.size(F.array_intersect("a", "b"))
    links = both.where(same >= similarity * (F.size("a") + F.size("b") - same)).select("u", "v").union(stars)
    burning = met.where("key is not null").select("key", "id")
    if not burning.isEmpty():
        blocks = burning.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / F.lit(max(1, hot // 2))).cast("bigint").alias("blocks"))
        dealt = burning.join(blocks, "key").withColumn("b", F.pmod(F.xxhash64("id", F.lit(1)), F.col("blocks")))
        dealt = dealt.select("key", "id", "b", F.explode(F.sequence(zero, F.col("blocks") - 1)).alias("o")).join(sets, "id")
        dealt = dealt.select("key", "id", "b", "sketch", "sh", F.least("b", "o").alias("i"), F.greatest("b", "o").alias("j"))
        links = links.union(dealt.groupBy("key", "i", "j").applyInPandas(_forest(similarity), "u long, v long"))
    return links


def _few(rows: DataFrame) -> DataFrame:
    """``rows`` for a broadcast if their counted number allows it; beyond it they are shuffled."""
    return F.broadcast(rows) if rows.count() <= BROADCAST_ROWS else rows


def _hits(texts: DataFrame, similarity: float, recall: float, min_words: int) -> DataFrame:
    """(doc_id, row, at, n, first_doc): runs and paragraphs of the distinct ``texts`` (row, doc_id, last: smallest and largest doc_id, text) that
    occur in two documents, whole texts among them, with the smallest doc_id that has them."""
    bands, rows = tune_bands(similarity, recall) if similarity < 1 else (1, 1)
    who = ["doc_id", "last", "row"]

    def seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, some in _blocks(batches):
            text, at, seed, whole, n = seeds_of(some, min_words)
            copied = (part["doc_id"].to_numpy() < part["last"].to_numpy())[whole]
            owner = pa.array(np.append(text, whole[copied]))
            yield pa.RecordBatch.from_arrays([*(part[c].take(owner) for c in who), pa.array(np.append(at, n[copied]), pa.int32()),
                                              pa.concat_arrays([pa.array(seed), pa.nulls(int(copied.sum()), pa.int64())])], [*who, "at", "seed"])

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        longs = pa.list_(pa.int64())
        for part, some in _blocks(batches):
            (rt, ra, rid), (pt, pat, n, pid, keys, count, flat) = pieces_of(some, part["seeds"].to_pylist(), bands, rows, min_words)
            for t, cols in ((rt, [pa.array(ra, pa.int32()), pa.array(np.full(len(ra), min_words), pa.int32()), pa.array(rid), pa.nulls(len(ra), longs), pa.nulls(len(ra), longs)]),
                            (pt, [pa.array(pat, pa.int32()), pa.array(n, pa.int32()), pa.array(pid), _lists(np.full(len(n), bands), keys.ravel()), _lists(count, flat)])):
                yield pa.RecordBatch.from_arrays([*(part[c].take(pa.array(t)) for c in who), *cols], [*who, "at", "n", "id", "keys", "sh"])

    found = materialize(texts.mapInArrow(seeds, "doc_id long, last long, row long, at int, seed long"), "passages-seeds")
    span = [F.min("doc_id").alias("lo"), F.max("last").alias("hi")]
    seeded = found.where("seed is not null")
    # A seed that one text alone has tells nothing, even where the text has copies: those are whole passages.
    common = (seeded.groupBy("seed").agg(*span, F.min("row").alias("r"), F.max("row").alias("s")).where("lo < hi and r <> s").select("seed"))
    places = materialize(seeded.join(common, "seed").groupBy("row").agg(F.collect_set("at").alias("seeds")), "passages-places")
    cut = texts.join(_few(places.select("row")), "row", "left_semi").join(places, "row").select(*who, "text", "seeds")
    cut = materialize(cut.mapInArrow(pieces, "doc_id long, last long, row long, at int, n int, id long, keys array<long>, sh array<long>"), "passages-pieces")
    plain = cut.where("keys is null").select(*who, "at", "n", "id")
    verbatim = plain.join(plain.groupBy("id").agg(*span).where("lo < hi").select("id", F.col("lo").alias("first_doc")), "id")
    marked = cut.where("keys is not null")
    comps = materialize(connected_components(paragraph_links(marked.select("id", "keys", "sh"), similarity)), "passages-classes")
    near = marked.select(*who, "at", "n", "id").join(comps.withColumnRenamed("node", "id"), "id", "left")
    near = near.withColumn("class", F.coalesce("label", "id")).drop("id", "label")
    near = near.join(near.groupBy("class").agg(*span).where("lo < hi").select("class", F.col("lo").alias("first_doc")), "class")
    names = ["doc_id", "row", "at", "n", "first_doc"]
    whole = found.where("seed is null").select("doc_id", "row", F.lit(0).alias("at"), F.col("at").alias("n"), F.col("doc_id").alias("first_doc"))
    return verbatim.select(*names).union(near.select(*names)).union(whole)


def repeated_passages(docs: DataFrame, similarity: float = SIMILARITY, recall: float = RECALL, min_words: int = MIN_WORDS) -> DataFrame:
    """Passages that occur in other documents too: doc_id, row (XXH64 of the text), start (words before it), n_words, earlier (False:
    the passage; True: a part of one that a smaller doc_id has too), links (smallest doc_ids that have a part of it, itself included).

    A passage is a longest run of words each of which is in ``min_words`` words that occur verbatim in another doc_id, or in a paragraph
    linked to one of another doc_id."""
    if min_words < GRAM + SPREAD - 1:
        raise ValueError(f"passages of fewer than {GRAM + SPREAD - 1} words may hold no seed")
    docs = only(docs, "doc_id", "text").select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("row"), "text")
    docs = docs.where("doc_id is not null and text is not null")
    copied = materialize(docs.groupBy("row").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("last")).where("lo < last"), "passages-equal")
    texts = (docs.join(_few(copied), "row", "left").where("lo is null or doc_id = lo")
             .select("row", "doc_id", F.coalesce("last", "doc_id").alias("last"), "text"))
    hits = materialize(_hits(texts, similarity, recall, min_words), "passages-hits")
    hits = hits.withColumn("earlier", F.col("first_doc") < F.col("doc_id")).withColumn("end", F.col("at") + F.col("n"))
    order = Window.partitionBy("doc_id", "row").orderBy("at", "end", "first_doc")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    fresh = lambda end: F.coalesce(F.col("at") > F.max(end).over(before), F.lit(True))
    hits = hits.withColumns({"new": fresh(F.col("end")), "new_e": F.col("earlier") & fresh(F.when(F.col("earlier"), F.col("end")))})
    hits = hits.withColumns({"run": F.sum(F.col("new").cast("int")).over(order), "run_e": F.sum(F.col("new_e").cast("int")).over(order)})
    parts = materialize(hits.groupBy("doc_id", "row", "run", "run_e", "earlier").agg(
        F.min("at").alias("at"), F.max("end").alias("end"), F.collect_set("first_doc").alias("links")), "passages-parts")

    def merged(rows: DataFrame, run: str, earlier: bool) -> DataFrame:
        return rows.groupBy("doc_id", "row", run).agg(
            F.min("at").cast("bigint").alias("start"), (F.max("end") - F.min("at")).cast("bigint").alias("n_words"), F.lit(earlier).alias("earlier"),
            F.array_distinct(F.flatten(F.collect_list("links"))).alias("links")).drop(run)

    whole = hits.where("at = 0 and doc_id = first_doc").groupBy("row").agg(F.max("n").cast("bigint").alias("n_words"))
    copies = docs.select("doc_id", "row").join(_few(copied), "row").where("doc_id > lo").distinct().join(whole, "row")
    copies = copies.select("doc_id", "row", F.lit(0).cast("bigint").alias("start"), "n_words", F.explode(F.array(F.lit(False), F.lit(True))).alias("earlier"),
                           F.array("lo").alias("links"))
    return merged(parts, "run", False).union(merged(parts.where("earlier"), "run_e", True)).union(copies)


def passage_components(docs: DataFrame, similarity: float = SIMILARITY, recall: float = RECALL, min_words: int = MIN_WORDS) -> DataFrame:
    """One row per doc_id: component_id (the smallest doc_id reachable over shared passages, itself included), n_passages, n_removed
    and n_removed_words, and removed: ``start:words`` of what has an earlier occurrence, comma-joined.

    Defined cases: null, empty and texts of fewer than ``min_words`` words have no passage and are components of their own; equal rows of a
    doc_id are one, other texts under it are told apart but are the same document; rows with a null doc_id link to nothing and are
    returned once with a null component; an empty table gives no rows; other columns are ignored."""
    found = materialize(repeated_passages(docs, similarity, recall, min_words), "passages-found")
    edges = found.where("not earlier").select(F.col("doc_id").alias("u"), F.explode("links").alias("v")).where("u <> v").distinct()
    comps = connected_components(edges)
    gone = F.when(F.col("earlier"), F.struct("start", "n_words"))
    per = found.groupBy("doc_id").agg(F.count_if(~F.col("earlier")).alias("n_passages"), F.count_if("earlier").alias("n_removed"),
                                      F.sum(F.when(F.col("earlier"), F.col("n_words")).otherwise(0)).alias("n_removed_words"),
                                      F.sort_array(F.collect_list(gone)).alias("spans"))
    zero = F.lit(0).cast("bigint")
    text = F.array_join(F.transform("spans", lambda s: F.concat_ws(":", s["start"].cast("string"), s["n_words"].cast("string"))), ",")
    return (docs.select(F.col("doc_id").cast("bigint").alias("doc_id")).distinct().join(per, "doc_id", "left")
            .join(comps.withColumnRenamed("node", "doc_id"), "doc_id", "left")
            .select("doc_id", F.coalesce("label", "doc_id").alias("component_id"), F.coalesce("n_passages", zero).alias("n_passages"),
                    F.coalesce("n_removed", zero).alias("n_removed"), F.coalesce("n_removed_words", zero).alias("n_removed_words"),
                    F.coalesce(text, F.lit("")).alias("removed")))


def op10_passages(spark, sf_dir: str) -> DataFrame:
    from tidewater.llm.common import read_table

    return passage_components(read_table(spark, sf_dir, "documents"), SIMILARITY, RECALL, MIN_WORDS)
