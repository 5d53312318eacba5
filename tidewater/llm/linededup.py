"""Line deduplication by a segment-partition edit join.

Two lines within ``edits`` edits of each other share one of ``edits + 1`` even segments of the one, exactly, at nearly the same
place of the other (pigeonhole). Every distinct line is indexed under its segments, keyed by its length and
the segment's number, and probes the indexes of its own length and of up to ``edits`` less with the few
substrings that the position and multi-match rules leave. Pairs that meet are verified with a banded bit-parallel
edit distance, many pairs at a time.

Entries carry a sketch of their line, the parities of its character pairs: an edit changes four pairs at most, so two lines
that meet are a candidate only if their sketches differ in ``4 * edits`` bits or fewer, which no true pair fails and hardly any
other passes. A segment that very many lines share is not compared out: its lines drop that segment, of which nothing
can differ, and are partitioned anew by what remains. What still shares a key after ``DEPTH`` partitions is compared block by block, every
pair of blocks a task of its own that returns a spanning forest. Exact copies, of lines of any length, are one node from the start.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import BLANKS, connected_components, fresh, materialize, only, row_name
from tidewater.llm.quality import let

EDITS = 2
MIN_CHARS = 20            # shorter lines are repeated only if they are equal
MAX_SHARE = 0.5           # by default a document with more than this share of its characters in repeated lines is left whole; None: no such bound
HOT = 2048                # lines of one key that are compared at once
SKETCH = 48               # bits of a line's sketch
DEPTH = 6                 # partitions of a hot key before its lines are compared block by block
BROADCAST_IDS = 1_000_000  # line numbers broadcast at most (some 16 MB)
CELLS = 4_000_000         # characters verified at once
INDEX, PROBE, REST = 1, 2, 4


def segment_slots(length: int, edits: int = EDITS) -> list[tuple[int, int, int, int, int]]:
    """What a line of ``length`` characters is looked up by: (indexed length, segment, role, first character, characters).

    Segments are those of an even partition into edits + 1, the last ones longer. Role INDEX enters a line, PROBE looks for
    others; the segments of the line's own length do both. Probes for segment i of lines ``d`` shorter begin within the
    multi-match window around its place: from max(-i, d - (edits - i)) to min(i, d + edits - i) characters away."""
    out = []
    for d in range(edits + 1):
        other = length - d
        if other <= edits:
            continue
        short, longer = divmod(other, edits + 1)
        for i in range(edits + 1):
            start = short * i + max(0, i - (edits + 1 - longer))
            n = short + (i >= edits + 1 - longer)
            for shift in range(max(-i, d - (edits - i)), min(i, d + edits - i) + 1):
                at = start + shift
                if 0 <= at and at + n <= length:
                    out.append((other, i, INDEX | PROBE if d == 0 and shift == 0 else PROBE, at, n))
    return out


def sketches(lines: list[str]) -> np.ndarray:
    """Per line the parities of its pairs of neighbouring characters, hashed into SKETCH bits."""
    lens = np.array([len(x) for x in lines], np.int64)
    out = np.zeros(len(lines), np.int64)
    codes = np.frombuffer("".join(lines).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    if len(codes) < 2:
        return out
    pair = (codes[:-1] * np.uint64(0x9E3779B97F4A7C15) + codes[1:]) * np.uint64(0xD6E8FEB86659FD93)
    bit = np.left_shift(np.int64(1), ((pair >> np.uint64(40)) % np.uint64(SKETCH)).astype(np.int64))
    ends = np.cumsum(lens)
    bit[ends[:-1][(ends[:-1] > 0) & (ends[:-1] <= len(bit))] - 1] = 0        # pairs across two lines
    some = np.flatnonzero(lens > 1)
    if len(some):
        first = ends[some] - lens[some]
        cuts = np.column_stack([first, ends[some] - 1]).ravel()
        cuts = cuts[:-1] if cuts[-1] >= len(bit) else cuts
        out[some] = np.bitwise_xor.reduceat(bit, cuts)[::2]
    return out


def _entries(edits: int, cut: bool):
    """Task function: rows (id, line, key, slot, role) -> entries (id, key, mark[, line]); a mark packs sketch, slot and role. With ``cut`` a line first loses the
    segment of its slot and its entries continue the key; what is left of it is returned with them."""

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slots: dict[int, list] = {}
        h, mask = xxhash.xxh64_intdigest, (1 << 64) - 1
        for batch in batches:
            for at0 in range(0, len(batch), 5000):
                part = batch.slice(at0, 5000)
                lines = part["line"].to_pylist()
                ids = part["id"].to_numpy()
                prefix = part["key"].to_pylist() if cut else [0] * len(lines)
                marks = part["mark"].to_pylist() if cut else []
                mine = [m & 7 for m in marks] if cut else [INDEX | PROBE] * len(lines)
                for k, m in enumerate(marks):
                    _, _, _, at, n = segment_slots(len(lines[k]), edits)[m >> 3 & 255]
                    lines[k] = lines[k][:at] + lines[k][at + n:]
                sketch = sketches(lines)
                owner, key, number, role = [], [], [], []
                for k, line in enumerate(lines):
                    size = len(line)
                    if size <= edits:          # too short to cut: such rests are within ``edits`` of each other anyway
                        owner.append(k)
                        key.append(h(b"", (prefix[k] - 1) & mask))
                        number.append(0)
                        role.append(REST)
                        continue
                    if size not in slots:
                        slots[size] = segment_slots(size, edits)
                    data = line.encode() if line.isascii() else None
                    for j, (other, i, r, at, n) in enumerate(slots[size]):
                        if r & mine[k]:
                            piece = data[at:at + n] if data is not None else line[at:at + n].encode("utf-8", "surrogatepass")
                            owner.append(k)
                            key.append(h(piece, (prefix[k] + 16 * other + i) & mask))
                            number.append(j)
                            role.append(r & mine[k])
                own = np.array(owner, np.int64)
                mark = sketch[own] << 11 | np.array(number, np.int64) << 3 | np.array(role, np.int64)
                cols = [pa.array(ids[own]), pa.array(np.array(key, np.uint64).view(np.int64)), pa.array(mark)]
                if cut:
                    cols.append(pa.array(lines, pa.string()).take(pa.array(own)))
                yield pa.RecordBatch.from_arrays(cols, ["id", "key", "mark", "line"][:len(cols)])

    return entries


def within(a: list[str], b: list[str], edits: int) -> np.ndarray:
    """Whether each pair is within ``edits`` edits: banded bit-parallel edit distance, all pairs in step.

    Bit r of a word stands for the row that lies r - edits below the main diagonal; VP and VN are the rows that are
    one more or less than the row above them. The score follows the diagonal of the last cell, on which it never falls, so a pair
    is dropped as soon as it passes the bound."""
    m = np.array([len(x) for x in a], np.int64)
    n = np.array([len(x) for x in b], np.int64)
    out = np.zeros(len(a), bool)
    todo = np.flatnonzero(np.abs(m - n) <= edits)
    todo = todo[np.argsort(n[todo], kind="stable")]
    while len(todo):
        wide = np.maximum(m, n)[todo] + 2 * edits + 2
        take = max(1, int(np.searchsorted(np.maximum.accumulate(wide) * np.arange(1, len(todo) + 1), CELLS)))
        now, todo = todo[:take], todo[take:]
        width = int(wide[:take].max())
        rows = np.zeros((take, width), np.uint32)                    # pattern after ``edits`` empty cells
        cols = np.full((take, int(n[now].max()) or 1), 0xFFFFFFFF, np.uint32)
        for k, i in enumerate(now.tolist()):
            rows[k, edits:edits + m[i]] = np.frombuffer(a[i].encode("utf-32-le", "surrogatepass"), "<u4")
            cols[k, :n[i]] = np.frombuffer(b[i].encode("utf-32-le", "surrogatepass"), "<u4")
        full = np.uint64((1 << (2 * edits + 1)) - 1)
        one, top = np.uint64(1), np.uint64(1 << (2 * edits))
        live, mm, nn = now, m[now], n[now]
        vp = np.full(take, int(full) >> (edits + 1) << (edits + 1), np.uint64)
        vn = np.zeros(take, np.uint64)
        last = (edits + mm - nn).astype(np.uint64)
        score = np.abs(mm - nn)
        done = nn == 0
        out[live[done & (score <= edits)]] = True
        for j in range(cols.shape[1]):
            eq = np.zeros(len(live), np.uint64)
            for r in range(2 * edits + 1):
                at = j + r                                           # row j + 1 - edits + r, shifted by ``edits`` cells
                if at < rows.shape[1]:
                    eq |= (rows[:, at] == cols[:, j]).astype(np.uint64) << np.uint64(r)
            vp, vn = (vp >> one) | top, vn >> one
            d0 = ((((eq & vp) + vp) ^ vp) | eq | vn) & full
            hp, hn = (vn | ~(d0 | vp)) & full, d0 & vp
            hp, hn = (hp << one) | one, hn << one
            vp, vn = (hn | ~(d0 | hp)) & full, d0 & hp
            counts = (j + 1 + mm - nn > 0) & (j < nn)
            score = score + np.where(counts, 1 - ((d0 >> last) & one).astype(np.int64), 0)
            ended = j + 1 == nn
            if ended.any():
                out[live[ended & (score <= edits)]] = True
            if j % 16 == 15 or ended.any():
                keep = (j + 1 < nn) & (score <= edits)
                if not keep.any():
                    break
                if not keep.all():
                    rows, cols = rows[keep], cols[keep]
                    live, mm, nn, vp, vn, last, score = (x[keep] for x in (live, mm, nn, vp, vn, last, score))
    return out


def lines_of(docs: DataFrame) -> DataFrame:
    """(doc_id, pos, line): the lines of each text that have a word, without blanks at their ends; pos counts all lines from 0."""
    parts = only(docs, "doc_id", "text").select("doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    return parts.select("doc_id", "pos", F.btrim("line", F.lit(BLANKS)).alias("line")).where(F.length("line") > 0)


def _named(lines: DataFrame) -> DataFrame:
    return lines.withColumns({"k1": F.xxhash64("line"), "k2": F.xxhash64(F.lit(0x5EED), F.col("line"))})


def _meet(hot: int, edits: int):
    """Task function over rows sorted by key: pairs of each key with up to ``hot`` rows, and the rows of larger ones. Runs are
    followed across batches; no more than one small key is held."""

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, burning = [], None

        def out(pairs, rows):
            u, v = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (list(zip(*pairs)) or ([], [])))
            rows = rows or [np.zeros((0, 3), np.int64)]
            r = np.concatenate(rows)
            null = lambda n: pa.nulls(n, pa.int64())
            cols = [pa.concat_arrays([pa.array(u), null(len(r))]), pa.concat_arrays([pa.array(v), null(len(r))])]
            cols += [pa.concat_arrays([null(len(u)), pa.array(np.ascontiguousarray(r[:, c]))]) for c in range(3)]
            return pa.RecordBatch.from_arrays(cols, ["u", "v", "key", "id", "mark"])

        def close(group: np.ndarray, pairs: list) -> None:
            ids, role = group[:, 1], group[:, 2] & 7
            if (role == REST).any():
                ids = np.unique(ids[role == REST])
                if len(ids) > 1:
                    pairs.append((np.full(len(ids) - 1, ids[0]), ids[1:]))
                return
            a, b = group[role & INDEX > 0], group[role & PROBE > 0]
            for at in range(0, len(a), 256):
                some = a[at:at + 256]
                apart = np.bitwise_count((some[:, None, 2] ^ b[None, :, 2]) >> 11)
                i, j = np.nonzero(apart <= 4 * edits)
                u, v = some[i, 1], b[j, 1]
                pairs.append((u[u != v], v[u != v]))

        for batch in batches:
            new = np.column_stack([batch[c].to_numpy().astype(np.int64) for c in ("key", "id", "mark")])
            if not len(new):
                continue
            pairs, rows = [], []
            cuts = np.flatnonzero(new[1:, 0] != new[:-1, 0]) + 1
            starts, ends = np.concatenate([[0], cuts]), np.append(cuts, len(new))
            for which in np.flatnonzero((ends - starts > 1) | (np.arange(len(starts)) == 0) | (np.arange(len(starts)) == len(starts) - 1)).tolist():
                part = new[starts[which]:ends[which]]
                key = part[0, 0]
                if burning is not None and burning != key:
                    burning = None
                if held and held[0][0, 0] != key:
                    close(np.concatenate(held), pairs)
                    held = []
                if burning == key:
                    rows.append(part)
                    continue
                held.append(part)
                size = sum(map(len, held))
                if size > hot and part[0, 2] & 7 != REST:
                    rows += held
                    held, burning = [], key
                elif ends[which] < len(new):
                    if size > 1:
                        close(np.concatenate(held), pairs)
                    held = []
            yield out(pairs, rows)
        if held:
            pairs = []
            close(np.concatenate(held), pairs)
            yield out(pairs, [])

    return meet


MEET = "u long, v long, key long, id long, mark long"


def _candidates(entries: DataFrame, name: str, hot: int, edits: int) -> DataFrame:
    return materialize(entries.repartition("key").sortWithinPartitions("key").mapInArrow(_meet(hot, edits), MEET), name)


def _texts(lines: DataFrame, ids: DataFrame) -> DataFrame:
    """(id, line) of the numbered lines, by a broadcast of the numbers up to a checked count, else by a shuffle."""
    n = ids.count()
    wanted = F.broadcast(ids) if n <= BROADCAST_IDS else ids
    return (_named(lines).select(F.col("k1").alias("id"), "line").join(wanted, "id", "left_semi")
            .groupBy("id").agg(F.min("line").alias("line")))


def _compare(edits: int):
    """Group function over entries (key, id, mark, line, block, i, j) of two blocks of a key: edges of a spanning forest of the pairs within
    ``edits``. What remains of two lines after equal cuts is as far apart as the lines. Rows already in one tree are not compared again; the
    first steps take few rows, after which variants of one line mostly are."""

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.drop_duplicates(["id", "mark"])
        ids, node = np.unique(pdf["id"].to_numpy(np.int64), return_inverse=True)
        mark, block, lines = pdf["mark"].to_numpy(np.int64), pdf["block"].to_numpy(), pdf["line"].to_numpy(object)
        two = pdf["i"].iloc[0] != pdf["j"].iloc[0]
        a, b = np.flatnonzero(mark & INDEX), np.flatnonzero(mark & PROBE)
        tree, edges, at, take = np.arange(len(ids)), [], 0, 1
        while at < len(a):
            some, at = a[at:at + take], at + take
            take = min(2 * take, 256)
            apart = np.bitwise_count((mark[some, None] ^ mark[None, b]) >> 11) <= 4 * edits
            apart &= tree[node[some]][:, None] != tree[node[b]][None, :]
            if two:
                apart &= block[some][:, None] != block[b][None, :]
            i, j = np.nonzero(apart)
            for cut in range(0, len(i), 1 << 16):
                x, y = some[i[cut:cut + (1 << 16)]], b[j[cut:cut + (1 << 16)]]
                new = tree[node[x]] != tree[node[y]]
                x, y = x[new], y[new]
                close = np.flatnonzero(within(lines[x].tolist(), lines[y].tolist(), edits))
                for k in close.tolist():
                    u, v = tree[node[x[k]]], tree[node[y[k]]]
                    if u != v:
                        tree[tree == max(u, v)] = min(u, v)
                        edges.append((node[x[k]], node[y[k]]))
        u, v = np.array(edges, np.int64).reshape(-1, 2).T
        return pd.DataFrame({"u": ids[u], "v": ids[v]})

    return compare


def _blocks(rows: DataFrame, hot: int, edits: int) -> DataFrame:
    """Edges (u, v) over the entries (key, id, mark, line) of hot keys: a key of n rows is dealt into about n / hot blocks, and every two blocks
    (or one with itself) meet in a group."""
    sizes = rows.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / hot).cast("int").alias("blocks"))
    dealt = rows.join(sizes, "key").withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    met = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    met = met.select("key", "id", "mark", "line", "block", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"))
    return met.groupBy("key", "i", "j").applyInPandas(_compare(edits), "u long, v long")


def line_links(docs: DataFrame, edits: int = EDITS, min_chars: int = MIN_CHARS, hot: int = HOT) -> DataFrame:
    """Pairs (u, v) of different lines (XXH64 of the line) of ``min_chars`` characters or more within ``edits`` edits. They span the same
    components as all such pairs: lines whose rest is shorter than a segment are linked as a star, those of keys that stay hot by forests."""
    lines = lines_of(docs).where(F.length("line") >= min_chars)
    distinct = lines.groupBy("line").agg(F.count(F.lit(1)).alias("n"))
    first = distinct.select(F.xxhash64("line").alias("id"), "line").mapInArrow(_entries(edits, False), "id long, key long, mark long")
    found = _candidates(first, "lines-met", hot, edits)
    pairs = found.where("u is not null").select("u", "v")
    burning, depth, named = found.where("key is not null").select("id", "key", "mark"), 1, None
    while depth < DEPTH and not burning.isEmpty():
        if named is None:
            texts = materialize(_texts(lines, burning.select("id").distinct()), "lines-hot")
            left = burning.join(texts, "id")
        else:
            left = burning.join(named, ["id", "key", "mark"])
        named = materialize(left.select("id", "line", "key", "mark")
                            .mapInArrow(_entries(edits, True), "id long, key long, mark long, line string").distinct(), "lines-rest")
        found = _candidates(named.select("id", "key", "mark"), "lines-met", hot, edits)
        pairs = pairs.union(found.where("u is not null").select("u", "v"))
        burning, depth = found.where("key is not null").select("id", "key", "mark"), depth + 1
    forest = None
    if not burning.isEmpty():
        forest = materialize(_blocks(burning.join(named if named is not None else _hot_texts(lines, burning), ["id", "key", "mark"]), hot, edits), "lines-forest")
    pairs = materialize(pairs.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct(), "lines-pairs")
    texts = materialize(_texts(lines, pairs.select(F.col("u").alias("id")).union(pairs.select("v")).distinct()), "lines-texts")
    both = (pairs.join(texts.select(F.col("id").alias("u"), F.col("line").alias("a")), "u")
            .join(texts.select(F.col("id").alias("v"), F.col("line").alias("b")), "v"))

    def verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pdf.loc[within(pdf["a"].tolist(), pdf["b"].tolist(), edits), ["u", "v"]]

    verified = both.mapInPandas(verify, "u long, v long")
    return verified if forest is None else verified.union(forest)


def _hot_texts(lines: DataFrame, burning: DataFrame) -> DataFrame:
    """(id, key, mark, line) of hot entries that no partition has cut yet."""
    return burning.join(_texts(lines, burning.select("id").distinct()), "id")


def line_classes(docs: DataFrame, edits: int = EDITS, min_chars: int = MIN_CHARS) -> DataFrame:
    """(doc_id, pos, length, again) per line with a word: ``again`` where the line, or one linked to it over near-equal lines, has
    come before (smaller doc_id, then smaller pos). Rows of one doc_id are one document."""
    named = materialize(_named(lines_of(docs)).select("doc_id", "pos", "k1", "k2", F.length("line").alias("length")), "lines")
    exact = (named.groupBy("k1", "k2")
             .agg(F.min(F.struct("doc_id", "pos")).alias("first"), F.countDistinct("doc_id", "pos").alias("n")))
    comps = materialize(connected_components(line_links(docs, edits, min_chars)), "line-classes")
    marked = exact.join(comps.withColumnRenamed("node", "k1"), "k1", "left")
    label = {"c1": F.coalesce("label", "k1"), "c2": F.when(F.col("label").isNull(), F.col("k2")).otherwise(F.lit(0))}
    marked = materialize(marked.where("n > 1 or label is not null").withColumns(label), "line-classes")
    first = marked.groupBy("c1", "c2").agg(F.min("first").alias("class_first"))
    repeated = marked.join(first, ["c1", "c2"]).select("k1", "k2", "class_first")
    joined = named.join(repeated, ["k1", "k2"], "left")
    again = F.col("class_first").isNotNull() & ~F.struct("doc_id", "pos").eqNullSafe(F.col("class_first"))
    return joined.select("doc_id", "pos", "length", again.alias("again"))


def line_report(docs: DataFrame, edits: int = EDITS, min_chars: int = MIN_CHARS, max_share: float | None = MAX_SHARE) -> DataFrame:
    """One row per document that has a line: doc_id, n_lines, n_repeated, repeated_chars, chars, removed (positions of the lines to take out).

    Repeated lines are taken out unless they hold more than ``max_share`` of the document's characters; with None they are
    taken out of every document. Defined cases: null, empty and blank texts have no line and give no row; rows of one doc_id (or of a
    null one) are one document, and equal rows count once; an empty table gives no rows; other columns are ignored."""
    at = F.sort_array(F.collect_set(F.when(F.col("again"), F.col("pos"))))
    lines = line_classes(docs, edits, min_chars).distinct()
    found = lines.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("n_lines"), F.count_if("again").alias("n_repeated"), F.sum("length").alias("chars"),
        F.coalesce(F.sum(F.when(F.col("again"), F.col("length"))), F.lit(0)).alias("repeated_chars"), at.alias("at"))
    minor = F.lit(True) if max_share is None else F.col("repeated_chars") <= max_share * F.col("chars")
    return found.select("doc_id", "n_lines", "n_repeated", "chars", "repeated_chars",
                        F.when(minor, F.col("at")).otherwise(F.array().cast("array<int>")).alias("removed"))


def _copies(named: DataFrame) -> DataFrame:
    """(copy, original): names of rows (``row_name``) and the smallest name that has the same text, where that is another one."""
    key = F.struct(F.xxhash64("text").alias("a"), F.xxhash64(F.lit(0x5EED), F.col("text")).alias("b"))
    named = materialize(named.where("text is not null").select("doc_id", key.alias("k")).distinct(), "lines-copies")
    first = named.groupBy("k").agg(F.min("doc_id").alias("original"), F.count(F.lit(1)).alias("n")).where("n > 1").select("k", "original")
    return named.join(first, "k").where("doc_id <> original").select(F.col("doc_id").alias("copy"), "original")


def dedup_lines(docs: DataFrame, edits: int = EDITS, min_chars: int = MIN_CHARS, max_share: float | None = MAX_SHARE, alike: bool = False) -> DataFrame:
    """``docs`` with repeated lines taken out of text, and n_chars, where it is a column, set to the new length.

    With ``alike`` an exact copy of a whole document loses the lines that its original loses and no others, so the two stay equal and
    a document-level step can take the copy out; it must follow. No row is dropped. Defined cases: null and empty texts have no lines and
    stay; lines shorter than ``min_chars`` go only if they are equal to an earlier one; equal rows are one document; rows of one doc_id, or of a null one, with different
    texts are documents of their own, first the one of the smaller text hash; an empty table gives no rows; other columns pass through
    whatever their names."""
    doc, text_hash, removed, parts = (fresh(docs, n) for n in ("removed_doc", "removed_hash", "removed_lines", "all_lines"))
    named = row_name(docs)
    found = line_report(named, edits, min_chars, max_share).select("doc_id", "removed")
    if alike:
        copies, found = materialize(_copies(named), "lines-copies"), materialize(found, "lines-removed")
        found = (found.join(copies, F.col("doc_id") == F.col("copy"), "left_anti")
                 .union(copies.join(found, F.col("original") == F.col("doc_id")).select("copy", "removed")))
    gone = (found.where(F.size("removed") > 0)
            .select(F.col("doc_id.doc_id").alias(doc), F.col("doc_id.text_hash").alias(text_hash), F.col("removed").alias(removed)))
    joined = docs.join(gone, F.col("doc_id").eqNullSafe(F.col(doc)) & (F.xxhash64("text") == F.col(text_hash)), "left")
    lines = F.split("text", "\n")
    kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col(removed))
    text = F.when(F.col(removed).isNull(), F.col("text")).otherwise(
        let(F.col(parts), lambda p: F.array_join(F.transform(kept, lambda k: F.get(p, k)), "\n")))
    out = joined.withColumn(parts, F.when(F.col(removed).isNotNull(), lines)).withColumn("text", text)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col(removed).isNull(), F.col("n_chars")).otherwise(F.length("text").cast(docs.schema["n_chars"].dataType)))
    return out.select(*docs.columns)


def op5_lines(spark, sf_dir: str) -> DataFrame:
    from tidewater.llm.common import read_table

    found = line_report(read_table(spark, sf_dir, "documents"), EDITS, MIN_CHARS, max_share=None)
    return found.select("doc_id", "n_lines", "n_repeated", F.size("removed").cast("bigint").alias("n_removed"), "chars", "repeated_chars",
                        F.array_join(F.transform("removed", lambda p: p.cast("string")), ",").alias("removed"))
