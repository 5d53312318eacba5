"""Harmonic packing of token sequences.

A piece of ``n`` tokens belongs to class ``capacity // n``; a bin of class k takes exactly k pieces, so it is never overfull
and a worker needs no more than one open bin per class, whatever the others do. Documents may be cut: a rest
that would leave more than ``slack`` tokens of its bin empty gives up a head of ``capacity // (k + 1)`` tokens, which
fills the next class to within k tokens, and its shorter tail is classed again. Bins that a worker could not fill go
to fewer workers, round after round; the last few thousand pieces are packed best-fit decreasing.
"""

from __future__ import annotations

import bisect
import math
import zlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import materialize, only
from tidewater.llm.tokens import END_ID, TOKENIZER, document_ids, encoder

CAPACITY = 4096
SLACK = 32                # empty tokens a bin may have before a piece is cut
COLUMNS = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def cut(n: int, capacity: int = CAPACITY, slack: int = SLACK) -> list[int]:
    """Piece lengths of a document of ``n`` tokens, in order."""
    out = [capacity] * (n // capacity)
    n %= capacity
    while n:
        k = capacity // n
        if capacity - k * n <= slack:
            out.append(n)
            break
        head = capacity // (k + 1)
        out.append(head)
        n -= head
    return out


class Bins:
    """One worker's open bins, one per class; numbers are unique per round and worker."""

    def __init__(self, round_no: int, worker: int, capacity: int):
        self.next = (round_no << 56) | (worker << 28)
        self.capacity = capacity
        self.open: dict[int, list[tuple]] = {}

    def add(self, piece: tuple, out: list[tuple]) -> None:
        """piece: (doc_id, start, length, crc, doc_tokens); a full bin's pieces go to ``out``."""
        k = self.capacity // piece[2]
        mine = self.open.setdefault(k, [])
        mine.append(piece)
        if len(mine) == k:
            out += self.close(mine)
            mine.clear()

    def close(self, pieces: list[tuple]) -> list[tuple]:
        at, rows = 0, []
        for p in pieces:
            rows.append((*p, self.next, at))
            at += p[2]
        self.next += 1
        return rows

    def left(self) -> list[tuple]:
        return [(*p, None, None) for mine in self.open.values() for p in mine]


def _frame(rows: list[tuple]) -> pd.DataFrame:
    pdf = pd.DataFrame(rows, columns=COLUMNS)
    return pdf.astype({c: "Int64" for c in COLUMNS})


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(COLUMNS)
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], COLUMNS)


def _again(round_no: int, capacity: int):
    def fill(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bins = Bins(round_no, TaskContext.get().partitionId(), capacity)
        for pdf in batches:
            out: list[tuple] = []
            for piece in pdf[COLUMNS[:5]].astype(object).where(pdf[COLUMNS[:5]].notna(), None).itertuples(index=False, name=None):
                bins.add(piece, out)
            yield _frame(out)
        yield _frame(bins.left())
    return fill


def best_fit(lengths: list[int], capacity: int = CAPACITY) -> list[int]:
    """Bin number per length, longest first into the fullest bin that takes it."""
    room: list[tuple[int, int]] = []
    out = [0] * len(lengths)
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        at = bisect.bisect_left(room, (lengths[i], -1))
        free, b = room.pop(at) if at < len(room) else (capacity, len(room))
        out[i] = b
        bisect.insort(room, (free - lengths[i], b))
    return out


def _last(round_no: int, capacity: int):
    def fill(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pieces = [p for pdf in batches for p in
                  pdf[COLUMNS[:5]].astype(object).where(pdf[COLUMNS[:5]].notna(), None).itertuples(index=False, name=None)]
        bins = Bins(round_no, TaskContext.get().partitionId(), capacity)
        by: dict[int, list[tuple]] = {}
        for p, b in zip(pieces, best_fit([p[2] for p in pieces], capacity)):
            by.setdefault(b, []).append(p)
        yield _frame([row for mine in by.values() for row in bins.close(mine)])
    return fill


def pack(docs: DataFrame, capacity: int = CAPACITY, tokenizer: str = TOKENIZER, end_id: int = END_ID,
         slack: int = SLACK) -> DataFrame:
    """Pack whole documents into sequences of at most ``capacity`` tokens: one row per piece.

    doc_id, start (the document's ids before the piece), length, ids_crc32 (of the piece's ids as little-endian unsigned
    32-bit integers), doc_tokens (with the end id), sequence_id, offset (place in the sequence, without gaps from 0). Only
    lengths and checksums are shuffled, never ids, and only those of unfilled bins. Defined cases: a null or
    empty text is one piece, the end id; repeated rows and null doc_ids are packed like any other row; an empty table gives
    no rows; other columns are ignored.
    """

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins, enc = Bins(0, TaskContext.get().partitionId(), capacity), encoder(tokenizer)
        for batch in batches:
            out: list[tuple] = []
            for doc, data in zip(batch["doc_id"].to_pylist(), document_ids(enc, batch["text"], end_id)):
                total, at = len(data) // 4, 0
                for n in cut(total, capacity, slack):
                    bins.add((doc, at, n, zlib.crc32(data[4 * at:4 * (at + n)]), total), out)
                    at += n
            yield _batch(out)
        yield _batch(bins.left())

    bare = only(docs, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("bigint"))
    rows = materialize(bare.mapInArrow(first, SCHEMA), "packed")
    packed = [rows.where("sequence_id is not null")]
    left, round_no = rows.where("sequence_id is null"), 1
    # A worker leaves k - 1 pieces of a class at most: the sum over all classes is below this number, so each round
    # leaves a fifth of its pieces at most and the last task's share does not depend on the input.
    most = math.ceil(capacity * (1 + math.log(capacity)))
    while (n := left.count()) > most:
        rows = materialize(left.coalesce(-(-n // (5 * most))).mapInPandas(_again(round_no, capacity), SCHEMA), "packed")
        packed.append(rows.where("sequence_id is not null"))
        left, round_no = rows.where("sequence_id is null"), round_no + 1
    packed.append(left.coalesce(1).mapInPandas(_last(round_no, capacity), SCHEMA))
    out = packed[0]
    for more in packed[1:]:
        out = out.union(more)
    return out


def op6_packing(spark, sf_dir: str) -> DataFrame:
    from tidewater.llm.common import read_table

    return pack(read_table(spark, sf_dir, "documents"), capacity=CAPACITY, tokenizer=TOKENIZER, end_id=END_ID)
