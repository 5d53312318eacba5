"""Binary token shards with a minimal-perfect-hash index.

Documents are dealt out in key order; each task writes one shard of two files in the output folder:

``shard-NNNNNNN.ids``  the raw token ids of its documents one after another, little-endian, 2 bytes each
                       when the vocabulary fits, else 4
``shard-NNNNNNN.idx``  magic, a JSON header and arrays: the bit sets of the hash levels with their ranks
                       (a key's slot is the rank of the one bit it hit alone), per slot a 32-bit fingerprint
                       of the key, its first document and number of documents, and the start of each document

A lookup hashes the key through the levels (one on average), compares the stored fingerprint and reads one
slice: no keys are stored and nothing is searched.
"""

from __future__ import annotations

import json
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewater.llm.common import materialize, only
from tidewater.llm.tokens import END_ID, TOKENIZER, document_ids, encoder
from tidewater.session import shared_dir

MAGIC = b"TWIX1\n"
SPARSE = 2.0              # bits per key and level
LEVELS = 200              # distinct keys part long before


def mix(keys: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit permutation of the keys per seed (splitmix64 finaliser)."""
    x = keys + np.uint64((0x9E3779B97F4A7C15 * (2 * seed + 1)) & ((1 << 64) - 1))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class PerfectHash:
    """Minimal perfect hash of distinct 64-bit keys: at each level every key left over hashes into a bit set, keys that
    hit a bit alone are settled there; a key's slot is the number of settled bits before its own."""

    def __init__(self, sizes: list[int], words: np.ndarray):
        self.sizes, self.words = sizes, words
        self.ranks = np.concatenate([[0], np.cumsum(np.bitwise_count(words).astype(np.int64))])

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        sizes, words, left = [], [np.zeros(0, np.uint64)], keys
        while len(left):
            if len(sizes) == LEVELS:
                raise ValueError("keys are not distinct")
            size = 64 * (int(SPARSE * len(left)) // 64 + 1)
            at = (mix(left, len(sizes)) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(at, minlength=size) == 1
            words.append(np.packbits(alone, bitorder="little").view("<u8").astype(np.uint64))
            sizes.append(size)
            left = left[~alone[at]]
        return cls(sizes, np.concatenate(words))

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """Slot per key; -1 if it hits no settled bit. A key that was not built in may get any slot."""
        out = np.full(len(keys), -1, np.int64)
        todo, base = np.arange(len(keys)), 0
        for level, size in enumerate(self.sizes):
            if not len(todo):
                break
            at = base + (mix(keys[todo], level) % np.uint64(size)).astype(np.int64)
            word, bit = self.words[at >> 6], (at & 63).astype(np.uint64)
            hit = (word >> bit) & np.uint64(1) == 1
            below = np.bitwise_count(word & ((np.uint64(1) << bit) - np.uint64(1))).astype(np.int64)
            out[todo[hit]] = (self.ranks[at >> 6] + below)[hit]
            todo, base = todo[~hit], base + size
        return out


def fingerprints(keys: np.ndarray) -> np.ndarray:
    return (mix(keys, 977) >> np.uint64(32)).astype(np.uint32)


def open_folder(uri: str):
    """(filesystem, path) of a folder named by a path or a URI."""
    from pyarrow import fs

    if uri.startswith("file:"):
        uri = "/" + uri[5:].lstrip("/")
    return fs.FileSystem.from_uri(uri)


def _name(shard: int, kind: str) -> str:
    return f"shard-{shard:07d}.{kind}"


def write_index(out, keys: np.ndarray, first: np.ndarray, count: np.ndarray, starts: np.ndarray, width: int, null_docs: int) -> None:
    """The index of one shard. keys: distinct, with the number of their first document and of their documents; the
    shard's first ``null_docs`` documents have no key."""
    mph = PerfectHash.build(keys)
    slot = mph.slots(keys)
    order = np.empty(len(keys), np.int64)
    order[slot] = np.arange(len(keys))
    arrays = {"words": mph.words.astype("<u8"), "prints": fingerprints(keys)[order].astype("<u4"),
              "first": first[order].astype("<u4"), "count": count[order].astype("<u4"), "starts": starts.astype("<u8")}
    head = json.dumps({"width": width, "null_docs": null_docs, "n_docs": len(starts) - 1, "n_tokens": int(starts[-1]),
                       "sizes": mph.sizes, "arrays": {k: [v.dtype.str, len(v)] for k, v in arrays.items()}}).encode()
    out.write(MAGIC + len(head).to_bytes(4, "little") + head)
    for v in arrays.values():
        out.write(v.tobytes())


class Shard:
    """Keyed access to one written shard."""

    def __init__(self, fs, path: str, shard: int):
        with fs.open_input_file(f"{path}/{_name(shard, 'idx')}") as f:
            if f.read(len(MAGIC)) != MAGIC:
                raise ValueError(f"not a shard index: {path}/{_name(shard, 'idx')}")
            self.head = json.loads(f.read(int.from_bytes(f.read(4), "little")))
            got = {k: np.frombuffer(f.read(np.dtype(t).itemsize * n), t) for k, (t, n) in self.head["arrays"].items()}
        self.mph = PerfectHash(self.head["sizes"], got["words"].astype(np.uint64))
        self.prints, self.first, self.count, self.starts = got["prints"], got["first"], got["count"], got["starts"].astype(np.int64)
        self.file = fs.open_input_file(f"{path}/{_name(shard, 'ids')}")

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per key its first document and number of documents; (-1, 0) where the fingerprint says it is not here."""
        if not len(self.prints):
            return np.full(len(keys), -1, np.int64), np.zeros(len(keys), np.int64)
        slot = self.mph.slots(keys)
        ok = (slot >= 0) & (self.prints[slot] == fingerprints(keys))
        return np.where(ok, self.first[slot], -1).astype(np.int64), np.where(ok, self.count[slot], 0).astype(np.int64)

    def ids(self, doc: int) -> np.ndarray:
        """The ids of a document by its number in the shard, from the payload file."""
        w = self.head["width"]
        a, b = int(self.starts[doc]), int(self.starts[doc + 1])
        return np.frombuffer(self.file.read_at(w * (b - a), w * a), f"<u{w}").astype("<u4")


def write_shards(docs: DataFrame, folder: str, tokenizer: str = TOKENIZER, end_id: int = END_ID) -> DataFrame:
    """Write ``docs`` as shards in ascending doc_id order and return the directory: one row (shard, doc_id) per distinct key
    and shard, written as a table. Files get a name of their own attempt first, so a task that runs twice does no harm."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = open_folder(folder)
        fs.create_dir(path, recursive=True)
        shard, enc = TaskContext.get().partitionId(), encoder(tokenizer)
        width = 2 if max(len(enc.ends), end_id + 1) <= 1 << 16 else 4
        part = f"{path}/.part-{shard}-{uuid.uuid4().hex}"
        keys, runs, lens, nulls = [], [], [], 0
        out = None
        for batch in batches:
            if not len(batch):
                continue
            out = out or fs.open_output_stream(part + ".ids")
            for data in document_ids(enc, batch["text"], end_id):
                ids = np.frombuffer(data, "<u4")
                lens.append(len(ids))
                out.write(ids.astype(f"<u{width}").tobytes())
            nulls += batch["doc_id"].null_count
            keys.append(batch["doc_id"].drop_null().to_numpy())
        if out is None:
            return
        out.close()
        every = np.concatenate(keys)
        new = np.flatnonzero(np.concatenate([[True], every[1:] != every[:-1]])) if len(every) else np.zeros(0, np.int64)
        runs = np.diff(np.append(new, len(every)))
        with fs.open_output_stream(part + ".idx") as f:
            write_index(f, every[new].view(np.uint64), new + nulls, runs, np.concatenate([[0], np.cumsum(lens)]), width, nulls)
        for kind in ("ids", "idx"):
            fs.move(f"{part}.{kind}", f"{path}/{_name(shard, kind)}")
        found = ([None] if nulls else []) + every[new].tolist()
        yield pa.RecordBatch.from_arrays([pa.array([shard] * len(found), pa.int64()), pa.array(found, pa.int64())], ["shard", "doc_id"])

    dealt = (only(docs, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("bigint"))
             .repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text"))
    return materialize(dealt.mapInArrow(write, "shard long, doc_id long"), "token-directory")


def read_shards(directory: DataFrame, folder: str) -> DataFrame:
    """Look every key of the directory up in its shard: one row per document (doc_id, start, n_tokens, ids_crc32), all read
    from the files. A key that its shard does not know ends the job."""

    def heads(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, path = open_folder(folder)
        for pdf in batches:
            yield pd.DataFrame({"shard": pdf["shard"], "total": [Shard(fs, path, int(s)).head["n_tokens"] for s in pdf["shard"]]})

    def look(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, path = open_folder(folder)
        now, shard = None, None
        for pdf in batches:
            for number, part in pdf.groupby("shard", sort=False):
                if number != now:
                    now, shard = number, Shard(fs, path, int(number))
                known = part["doc_id"].notna().to_numpy()
                keys = part["doc_id"][known].to_numpy(np.int64)
                first, count = shard.find(keys.view(np.uint64))
                if (count == 0).any():
                    raise KeyError(f"shard {number} does not know {keys[count == 0][:5]}")
                owner = np.repeat(np.arange(len(keys)), count)
                doc = np.repeat(first - np.concatenate([[0], np.cumsum(count)[:-1]]), count) + np.arange(count.sum())
                names = pd.array(keys[owner], "Int64")
                if not known.all():
                    doc = np.concatenate([np.arange(shard.head["null_docs"]), doc])
                    names = pd.array([None] * shard.head["null_docs"] + names.tolist(), "Int64")
                yield pd.DataFrame({"shard": np.full(len(doc), number), "doc_id": names, "at": shard.starts[doc],
                                    "n_tokens": shard.starts[doc + 1] - shard.starts[doc],
                                    "ids_crc32": np.array([zlib.crc32(shard.ids(d).tobytes()) for d in doc], np.int64)})

    # One row per written file: what the tasks of one job wrote, a few bytes each.
    totals = (directory.select("shard").distinct().mapInPandas(heads, "shard long, total long")
              .withColumn("base", F.sum("total").over(Window.orderBy("shard")) - F.col("total")).drop("total"))
    found = directory.mapInPandas(look, "shard long, doc_id long, at long, n_tokens long, ids_crc32 long")
    return (found.join(F.broadcast(totals), "shard")
            .select("doc_id", (F.col("base") + F.col("at")).alias("start"), "n_tokens", "ids_crc32"))


def token_shards(docs: DataFrame, folder: str | None = None, tokenizer: str = TOKENIZER, end_id: int = END_ID) -> DataFrame:
    """Encode, write and read back ``docs``: one row per document (doc_id, start, n_tokens, ids_crc32).

    ``start`` counts the ids of all documents before it in ascending doc_id order; n_tokens includes the end id;
    ids_crc32 is over the ids as unsigned 32-bit integers. Defined cases: a null or empty text is the end id alone; rows of
    one doc_id come in text order under one key; rows with a null doc_id come first and are read by position; an
    empty table writes nothing and returns no row; other columns are ignored.
    """
    folder = folder or shared_dir(docs.sparkSession, "token-shards")
    return read_shards(write_shards(docs, folder, tokenizer, end_id), folder)


def op4_tokens(spark, sf_dir: str) -> DataFrame:
    from tidewater.llm.common import read_table

    return token_shards(read_table(spark, sf_dir, "documents"), tokenizer=TOKENIZER, end_id=END_ID)
