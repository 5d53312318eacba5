r"""WARC archives and their fixity audit by Merkle trees.

Pages are written as WARC records, each a gzip member of its own, in key order into several files; a manifest lists the byte
range of each record. An archive's tree has the SHA-256 of every stored range as leaves, in offset order; a node hashes
its first offset, its end and the hashes of up to ``FAN`` children; file roots, in file order, are the leaves of the
archive's top tree. Two replicas are compared at their root, and only children of nodes that differ are
compared further down, to the damaged records.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import materialize, only
from tidewater.llm.tokenbin import open_folder
from tidewater.session import shared_dir

FAN = 16


def record_bytes(page_id, url: str | None, html: str | None) -> bytes:
    """One WARC response record; a null url or body is empty, a null page_id gives an empty number."""
    body = (html or "").encode("utf-8", "surrogatepass")
    head = (f"WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>\r\n"
            f"WARC-Target-URI: {url or ''}\r\nContent-Length: {len(body)}\r\n\r\n")
    return head.encode("utf-8", "surrogatepass") + body + b"\r\n\r\n"


def stored(record: bytes) -> bytes:
    """The record as a gzip member without a time stamp."""
    z = zlib.compressobj(1, zlib.DEFLATED, 31)
    return z.compress(record) + z.flush()


def file_name(number: int) -> str:
    return f"pages-{number:07d}.warc.gz"


def write_archive(pages: DataFrame, folder: str) -> DataFrame:
    """Write the archive; returns its manifest (file, no, page_id, offset, length, record_length, record_sha256) as a written table. Files
    appear under their names when whole, so a task that runs twice does no harm."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = open_folder(folder)
        fs.create_dir(path, recursive=True)
        number, out, at, no = TaskContext.get().partitionId(), None, 0, 0
        part = f"{path}/.part-{number}-{uuid.uuid4().hex}"
        for batch in batches:
            rows = []
            for page, url, html in zip(*(batch[c].to_pylist() for c in ("page_id", "url", "html"))):
                out = out or fs.open_output_stream(part, compression=None)
                record = record_bytes(page, url, html)
                data = stored(record)
                out.write(data)
                rows.append((number, no, page, at, len(data), len(record), hashlib.sha256(record).hexdigest()))
                at, no = at + len(data), no + 1
            if rows:
                kinds = [pa.int64()] * 6 + [pa.string()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)],
                                                 ["file", "no", "page_id", "offset", "length", "record_length", "record_sha256"])
        if out is not None:
            out.close()
            fs.move(part, f"{path}/{file_name(number)}")

    dealt = (only(pages, "page_id", "url", "html").withColumn("page_id", F.col("page_id").cast("bigint"))
             .repartitionByRange("page_id").sortWithinPartitions("page_id", "url", "html"))
    return materialize(dealt.mapInArrow(write, "file long, no long, page_id long, offset long, length long, record_length long, record_sha256 string"), "warc-manifest")


def copy_archive(manifest: DataFrame, source: str, target: str, damage: Column | None = None) -> int:
    """Copy the archive file by file; records where ``damage`` (over the manifest) is true get one byte of their range changed. For
    tests and drills. Returns the number of files."""
    files = manifest.select("file", "offset", "length", F.coalesce(damage if damage is not None else F.lit(False), F.lit(False)).alias("hit"))
    per = files.groupBy("file").agg(F.sort_array(F.collect_list(F.when(F.col("hit"), F.col("offset") + F.floor(F.col("length") / 2)))).alias("bytes"))

    def copy(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, a = open_folder(source)
        _, b = open_folder(target)
        fs.create_dir(b, recursive=True)
        for pdf in batches:
            for number, places in zip(pdf["file"], pdf["bytes"]):
                part = f"{b}/.part-{number}-{uuid.uuid4().hex}"
                with fs.open_input_stream(f"{a}/{file_name(number)}", compression=None) as src, fs.open_output_stream(part, compression=None) as out:
                    at, left = 0, [int(p) for p in places]
                    while chunk := src.read(1 << 20):
                        chunk = bytearray(chunk)
                        while left and left[0] < at + len(chunk):
                            chunk[left.pop(0) - at] ^= 0x20
                        out.write(bytes(chunk))
                        at += len(chunk)
                fs.move(part, f"{b}/{file_name(number)}")
            yield pdf[["file"]]

    return materialize(per.repartition("file").mapInPandas(copy, "file long"), "warc-copied").count()


def leaves(manifest: DataFrame, folder: str, replica: int) -> DataFrame:
    """(replica, file, level, no, start, stop, hash): the level-0 nodes: the SHA-256 of each byte range as it is stored now; empty hash where the file or range is missing."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, path = open_folder(folder)
        name, f = None, None
        for pdf in batches:
            out = []
            for number, offset, length in zip(pdf["file"], pdf["offset"], pdf["length"]):
                if number != name:
                    name = number
                    try:
                        f = fs.open_input_file(f"{path}/{file_name(number)}")
                    except FileNotFoundError:
                        f = None
                data = f.read_at(int(length), int(offset)) if f is not None else b""
                out.append(hashlib.sha256(data).hexdigest() if len(data) == length else "")
            yield pd.DataFrame({"replica": replica, "file": pdf["file"], "level": 0, "no": pdf["no"], "start": pdf["offset"],
                                "stop": pdf["offset"] + pdf["length"], "hash": out})

    return manifest.select("file", "no", "offset", "length").mapInPandas(read, "replica long, file long, level long, no long, start long, stop long, hash string")


def _parents(nodes: DataFrame, level: int) -> DataFrame:
    """The next level up; a group has at most FAN rows."""
    grouped = nodes.select("replica", "file", F.col("no").alias("kid"), F.floor(F.col("no") / FAN).alias("no"), "start", "stop", "hash")
    return (grouped.groupBy("replica", "file", "no").agg(F.min("start").alias("start"), F.max("stop").alias("stop"), F.sort_array(F.collect_list(F.struct("kid", "hash"))).alias("kids"))
            .select("replica", "file", F.lit(level).cast("bigint").alias("level"), "no", "start", "stop",
                    F.sha2(F.concat_ws(",", F.col("start").cast("string"), F.col("stop").cast("string"), F.col("kids.hash")), 256).alias("hash")))


def build_tree(leaf_nodes: DataFrame) -> tuple[list[DataFrame], int]:
    """Written levels from the leaves to the single root of each replica, and the number of the level where the file roots go on
    as nodes of file -1."""
    levels = [materialize(leaf_nodes, "warc-tree")]

    def climb() -> None:
        while (levels[-1].agg(F.max("no")).first()[0] or 0) > 0:
            levels.append(materialize(_parents(levels[-1], len(levels)), "warc-tree"))

    climb()
    roots = levels[-1].select("replica", F.lit(-1).cast("bigint").alias("file"), F.lit(len(levels)).cast("bigint").alias("level"),
                              F.col("file").alias("no"), F.col("file").alias("start"), (F.col("file") + 1).alias("stop"), "hash")
    top = len(levels)
    levels.append(materialize(roots, "warc-tree"))
    climb()
    return levels, top


def _differ(nodes: DataFrame) -> DataFrame:
    """(file, no) where the two replicas' nodes are unequal or one has none."""
    return (nodes.groupBy("file", "no").agg(F.min("hash").alias("a"), F.max("hash").alias("b"), F.count(F.lit(1)).alias("n"))
            .where("a <> b or n <> 2 or a = ''").select("file", "no"))


def audit(manifest: DataFrame, replica_a: str, replica_b: str) -> DataFrame:
    """(file, no) of the records whose stored bytes differ between two replicas or are missing in one.

    The roots are compared first; equal roots end the audit. From there only children of unequal nodes are compared,
    level by level, each step an equi-join on the parents' numbers. Defined cases: an empty manifest differs nowhere; a missing
    or short file makes all its affected records differ."""
    levels, top = build_tree(leaves(manifest, replica_a, 0).union(leaves(manifest, replica_b, 1)))
    bad = _differ(levels[-1])
    for k in range(len(levels) - 2, -1, -1):
        if k + 1 == top:                # from the archive's top tree into the files: a node's number is its file
            kids = levels[k].join(bad.select(F.col("no").alias("file")), "file", "left_semi")
        else:
            up = bad.select("file", F.col("no").alias("__up"))
            kids = levels[k].withColumn("__up", F.floor(F.col("no") / FAN)).join(up, ["file", "__up"], "left_semi").drop("__up")
        bad = materialize(_differ(kids), "warc-differ")
    return bad


def op7_warc(spark, sf_dir: str) -> DataFrame:
    """Archive the whole ``pages`` table, copy it with a byte changed in every page whose page_id leaves 3 when divided by 97, audit
    the copy against the archive: one row per page with what the audit says."""
    from tidewater.llm.common import read_table

    a, b = shared_dir(spark, "warc-a"), shared_dir(spark, "warc-b")
    manifest = write_archive(read_table(spark, sf_dir, "pages"), a)
    copy_archive(manifest, a, b, F.pmod("page_id", F.lit(97)) == 3)
    found = audit(manifest, a, b).withColumn("corrupt", F.lit(True))
    return (manifest.join(found, ["file", "no"], "left")
            .select("page_id", "record_length", "record_sha256", F.coalesce("corrupt", F.lit(False)).alias("corrupt")))


OP7_SQL = r"""
WITH r AS (
  SELECT page_id, 'WARC/1.0' || chr(13) || chr(10) || 'WARC-Type: response' || chr(13) || chr(10)
         || 'WARC-Record-ID: <urn:page:' || coalesce(page_id::VARCHAR, '') || '>' || chr(13) || chr(10)
         || 'WARC-Target-URI: ' || coalesce(url, '') || chr(13) || chr(10)
         || 'Content-Length: ' || strlen(coalesce(html, '')) || chr(13) || chr(10) || chr(13) || chr(10)
         || coalesce(html, '') || chr(13) || chr(10) || chr(13) || chr(10) AS t
  FROM pages
)
SELECT page_id, strlen(t)::BIGINT AS record_length, sha256(t) AS record_sha256, coalesce(page_id % 97 = 3, false) AS corrupt FROM r
"""
