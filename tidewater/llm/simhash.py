"""SimHash near-duplicates: fingerprints of word shingles, linked by a binary-trie self-join.

The 64-bit fingerprints are the leaves of one binary trie. The join walks pairs of trie nodes from
the root: a pair carries the number of bits in which the two paths differ, a pair beyond the error
budget is dropped with everything below it, and a pair of leaves that arrives is a link. The bits
are read in an order that puts the most balanced ones first (Hamming distance does not depend on the
order), which keeps the upper nodes even. The first levels of the walk are done by Spark: each
top node is one group that holds its own leaves and visits from the smaller top nodes within the
budget. The rest of each walk runs inside the group on sorted arrays, depth first in blocks of bounded size.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.llm.common import connected_components, fresh, materialize, only

BITS = 64
TOP_LEAVES = 1 << 17      # leaves a top node should hold at most (1 MB)
TOP_DEPTH = (4, 24)       # levels of the trie that Spark deals out
BLOCK = 1 << 20           # node pairs walked at once
TEXTS = 500               # texts fingerprinted at once


def text_fingerprints(texts, shingle: int = 3, seed: int = 42) -> np.ndarray:
    """SimHash per text as unsigned 64-bit integers; A-Z lower-cased, words split at ASCII blanks,
    XXH64 of the space-joined shingles, a bit set where more than half of the hashes have it.
    Fewer words than a shingle: the whole sequence is the one shingle; no word or null: zero."""
    h = xxhash.xxh64_intdigest
    out = np.zeros(len(texts), np.uint64)
    where, parts, size = [], [], 0

    def flush():
        if where:
            lens = np.array([len(p) for p in parts])
            bits = np.unpackbits(np.concatenate(parts).astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
            counts = np.add.reduceat(bits, np.concatenate([[0], np.cumsum(lens)[:-1]]), axis=0, dtype=np.int32)
            on = (2 * counts > lens[:, None])
            out[where] = np.packbits(on, axis=1).view(">u8").ravel().astype(np.uint64)
        where.clear()
        parts.clear()

    for i, text in enumerate(texts):
        words = text.encode("utf-8", "surrogatepass").lower().split() if isinstance(text, str) else []
        if not words:
            continue
        joined = b" ".join(words)
        if len(words) <= shingle:
            hashes = [h(joined, seed)]
        else:
            ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
            starts = np.concatenate([[0], ends[:-shingle] + 1]).tolist()
            hashes = [h(joined[a:b], seed) for a, b in zip(starts, ends[shingle - 1:].tolist())]
        where.append(i)
        parts.append(np.array(hashes, np.uint64))
        size += len(hashes)
        if size > 100_000:
            flush()
            size = 0
    flush()
    return out


def with_fingerprint(docs: DataFrame, shingle: int = 3, seed: int = 42) -> DataFrame:
    """(doc_id, fp): the fingerprint of each whole text as a signed long; one narrow pass."""

    def fp(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # a few texts at a time are Python strings; the batch itself stays in Arrow's memory
            for at in range(0, len(batch), TEXTS):
                part = batch.slice(at, TEXTS)
                found = text_fingerprints(part.column(1).to_pylist(), shingle, seed).view(np.int64)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(found)], names=["doc_id", "fp"])

    docs = only(docs, "doc_id", "text")
    return docs.mapInArrow(fp, T.StructType([docs.schema["doc_id"], T.StructField("fp", T.LongType())]))


def _reorder(fps: np.ndarray, order: list[int]) -> np.ndarray:
    """Fingerprints with bit order[0] moved to the top, order[1] next, and so on."""
    out = np.zeros(len(fps), np.uint64)
    for bit in order:
        out = (out << np.uint64(1)) | ((fps >> np.uint64(bit)) & np.uint64(1))
    return out


def _popcount(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x).astype(np.int8)


class _Forest:
    """Minimum-label forest over leaf numbers; pairs are added block by block."""

    def __init__(self, n: int):
        self.label = np.arange(n)

    def add(self, i: np.ndarray, j: np.ndarray) -> None:
        while len(i):
            a, b = self.label[i], self.label[j]
            apart = a != b
            if not apart.any():
                return
            i, j, a, b = i[apart], j[apart], a[apart], b[apart]
            np.minimum.at(self.label, np.maximum(a, b), np.minimum(a, b))
            while True:
                up = self.label[self.label]
                if (up == self.label).all():
                    break
                self.label = up


def trie_links(leaves: np.ndarray, home: np.ndarray, depth: int, budget: int) -> np.ndarray:
    """Join one top node with itself and its visitors: for each of the sorted distinct ``leaves`` the number of the
    leaf it hangs from (itself if none). ``home`` marks the node's own leaves; visitors are not joined with each other."""
    n = len(leaves)
    forest = _Forest(n)
    own = np.flatnonzero(home)
    if not len(own):
        return forest.label
    top = leaves >> np.uint64(BITS - depth)
    lo = np.flatnonzero(np.concatenate([[True], top[1:] != top[:-1]]))
    hi = np.append(lo[1:], n)
    h0, h1 = own[0], own[-1] + 1
    err = _popcount(top[lo] ^ top[h0])
    near = err <= budget
    stack = [(depth, np.full(near.sum(), h0), np.full(near.sum(), h1), lo[near], hi[near], err[near])]
    splits: dict[int, np.ndarray] = {}
    while stack:
        level, a0, a1, b0, b1, e = stack.pop()
        if len(e) > BLOCK:
            cut = len(e) // 2
            stack.append((level, *(x[:cut] for x in (a0, a1, b0, b1, e))))
            stack.append((level, *(x[cut:] for x in (a0, a1, b0, b1, e))))
            continue
        single = ((a1 - a0) == 1) & ((b1 - b0) == 1)
        if single.any():
            i, j = a0[single], b0[single]
            linked = (i != j) & (_popcount(leaves[i] ^ leaves[j]) <= budget)
            forest.add(i[linked], j[linked])
            go = ~single
            a0, a1, b0, b1, e = a0[go], a1[go], b0[go], b1[go], e[go]
        if not len(e) or level == BITS:
            continue
        if level not in splits:
            keep = np.uint64(((1 << BITS) - 1) ^ ((1 << (BITS - level)) - 1))
            splits[level] = np.searchsorted(leaves, (leaves & keep) | np.uint64(1 << (BITS - 1 - level)))
        am, bm = splits[level][a0], splits[level][b0]
        twin = a0 == b0
        other = ~twin
        child = [np.concatenate(x) for x in zip(
            (a0, am, b0, bm, e),
            (am, a1, bm, b1, e),
            (a0, am, bm, b1, e + 1),
            tuple(x[other] for x in (am, a1, b0, bm, e + 1)))]
        ok = (child[0] < child[1]) & (child[2] < child[3]) & (child[4] <= budget)
        ok &= ~((child[0] == child[2]) & (child[1] - child[0] == 1))
        if ok.any():
            stack.append((level + 1, *(x[ok] for x in child)))
    return forest.label


def _top_depth(fps: DataFrame, order: list[int]) -> int:
    """The first depth at which no top node holds more than TOP_LEAVES (one number per depth reaches the driver)."""
    n = fps.count()
    depth = max(TOP_DEPTH[0], min(TOP_DEPTH[1], (max(n, 1) // TOP_LEAVES).bit_length()))
    while depth < TOP_DEPTH[1]:
        most = fps.groupBy(_prefix(order, depth).alias("p")).count().agg(F.max("count")).first()[0] or 0
        if most <= TOP_LEAVES:
            break
        depth = min(TOP_DEPTH[1], depth + 2)
    return depth


def _prefix(order: list[int], depth: int):
    out = F.lit(0).cast("bigint")
    for bit in order[:depth]:
        out = F.shiftleft(out, 1).bitwiseOR(F.shiftrightunsigned("fp", bit).bitwiseAND(F.lit(1).cast("bigint")))
    return out


def fingerprint_links(fps: DataFrame, max_bits: int = 2) -> DataFrame:
    """Pairs (u, v) of fingerprints that span the same components as all pairs within ``max_bits`` bits.

    ``fps``: distinct long fingerprints (column fp). Each group returns at most one pair per leaf (a
    spanning forest of the links it found), so the result stays linear however dense a cluster is.
    """
    ones = fps.agg(*[F.avg(F.shiftrightunsigned("fp", b).bitwiseAND(F.lit(1).cast("bigint"))).alias(f"b{b}") for b in range(BITS)]).first()
    order = sorted(range(BITS), key=lambda b: (abs((ones[f"b{b}"] or 0.0) - 0.5), b))
    depth = _top_depth(fps, order)
    masks = [0] + [sum(1 << b for b in c) for k in range(1, max_bits + 1) for c in itertools.combinations(range(depth), k)]
    visits = (fps.select("fp", _prefix(order, depth).alias("p"))
              .select("fp", "p", F.explode(F.expr(f"filter(transform(array({','.join(f'{m}L' for m in masks)}), m -> p ^ m), q -> q >= p)")).alias("node")))

    def walk(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        fp = pdf["fp"].to_numpy().view(np.uint64)
        path = _reorder(fp, order)
        at = np.argsort(path)
        fp, path = fp[at], path[at]
        home = (path >> np.uint64(BITS - depth)) == np.uint64(key[0])
        label = trie_links(path, home, depth, max_bits)
        hung = np.flatnonzero(label != np.arange(len(label)))
        return pd.DataFrame({"u": fp[hung].view(np.int64), "v": fp[label[hung]].view(np.int64)})

    return visits.groupBy("node").applyInPandas(walk, "u long, v long")


def near_duplicates(docs: DataFrame, shingle: int = 3, max_bits: int = 2, seed: int = 42) -> DataFrame:
    """One row per row of ``docs``: doc_id, fp (long), component_id.

    Fingerprints within ``max_bits`` differing bits are linked; component_id is the smallest doc_id
    reachable over links. Equal fingerprints (exact copies among them) are one node of the graph, so
    copies are never paired. Defined cases: null or blank text has fingerprint zero and links like any
    other; a repeated row is returned as often as it comes; rows with a null doc_id get their
    component's smallest non-null doc_id (null if it has none); an empty table gives an empty result;
    columns other than doc_id and text are ignored.
    """
    marked = materialize(with_fingerprint(docs, shingle, seed), "simhash-docs")
    fps = materialize(marked.groupBy("fp").agg(F.min("doc_id").alias("rep")), "simhash-fps")
    comps = connected_components(fingerprint_links(fps.select("fp"), max_bits))
    labelled = materialize(fps.join(comps.withColumnRenamed("node", "fp"), "fp", "left")
                           .select("fp", "rep", F.coalesce("label", "fp").alias("label")), "simhash-labels")
    least = labelled.groupBy("label").agg(F.min("rep").alias("component_id"))
    named = materialize(labelled.join(least, "label").select("fp", "component_id"), "simhash-named")
    return marked.join(named, "fp").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, shingle: int = 3, max_bits: int = 2) -> DataFrame:
    """The rows of ``docs`` whose doc_id is their component's smallest; the other rows of a component go. Of several rows
    with that doc_id the first by text stays. Rows with a null doc_id stay, since nothing tells them apart. All columns
    of ``docs`` are returned."""
    from pyspark.sql import Window

    found = near_duplicates(docs, shingle, max_bits)
    keep = found.where("doc_id = component_id").select("doc_id").distinct()
    again = Window.partitionBy("doc_id").orderBy("text")
    nth = fresh(docs, "nth")
    named = (docs.join(keep, "doc_id", "left_semi").select(*docs.columns)
             .withColumn(nth, F.row_number().over(again)).where(F.col(nth) == 1).drop(nth))
    return named.union(docs.where("doc_id is null"))


def op2_simhash(spark, sf_dir: str) -> DataFrame:
    from tidewater.llm.common import read_table

    found = near_duplicates(read_table(spark, sf_dir, "documents"), shingle=3, max_bits=2, seed=42)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
