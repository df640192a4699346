"""Token ids in files of compressed planes.

File: MAGIC, chunks, index, index size (unsigned 32 bit), MAGIC. A chunk holds BLOCK ids (the last one fewer), taken
apart into planes: plane k has byte k of each id ("byte"), or bit k of each id, eight to a byte ("bit"). Each plane is
compressed alone with zstandard; planes of zeros only take no space. The index has for each chunk its place, number of
ids and plane sizes, and the ids and lengths of the documents in order.
"""

from __future__ import annotations

import json
import re
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import bounded_batches
from tessera.llm.tokens import encoder, slices

MAGIC = b"IDPLANE1"
BLOCK = 1 << 16


def filesystem(path: str):
    """The file system of a path or URI, and the path in it."""
    from pyarrow import fs

    return (fs.LocalFileSystem(), path) if not urlparse(path).scheme else fs.FileSystem.from_uri(path)


def qualified(spark, path: str) -> str:
    """A path without a scheme as a URI of Spark's own default file system, which all executors share."""
    if urlparse(path).scheme:
        return path
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    full = p.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(p).toString()
    return re.sub("^file:/+", "file:///", full)


def split_planes(ids: np.ndarray, mode: str) -> list[bytes]:
    """Planes of unsigned 32-bit ids, lowest first; b'' for zeros only."""
    b = np.ascontiguousarray(ids.astype("<u4")).view(np.uint8).reshape(-1, 4)
    if mode == "bit":
        b = np.packbits(np.unpackbits(b, axis=1, bitorder="little"), axis=0, bitorder="little").T
    else:
        b = b.T
    return [p.tobytes() if p.any() else b"" for p in np.ascontiguousarray(b)]


def join_planes(planes: list[bytes], n: int, mode: str) -> np.ndarray:
    width = -(-n // 8) if mode == "bit" else n
    b = np.stack([np.frombuffer(p, np.uint8) if p else np.zeros(width, np.uint8) for p in planes])
    if mode == "bit":
        b = np.packbits(np.unpackbits(b.T, axis=0, count=n, bitorder="little"), axis=1, bitorder="little")
        return np.ascontiguousarray(b).view("<u4").ravel()
    return np.ascontiguousarray(b.T).view("<u4").ravel()


@dataclass
class Writer:
    out: object
    mode: str
    level: int
    at: int = 0
    n_ids: int = 0
    held: list = field(default_factory=list)
    n_held: int = 0
    chunks: list = field(default_factory=list)
    keys: list = field(default_factory=list)
    lengths: list = field(default_factory=list)

    def __post_init__(self):
        import zstandard

        self.zstd = zstandard.ZstdCompressor(level=self.level)
        self._put(MAGIC)

    def _put(self, b: bytes) -> None:
        self.out.write(b)
        self.at += len(b)

    def add(self, key, ids: bytes) -> None:
        self.keys.append(key)
        self.lengths.append(len(ids) // 4)
        self.held.append(ids)
        self.n_held += len(ids) // 4
        self.n_ids += len(ids) // 4
        if self.n_held >= BLOCK:
            self._flush(False)

    def _flush(self, rest: bool) -> None:
        a = np.frombuffer(b"".join(self.held), "<u4")
        whole = len(a) if rest else len(a) // BLOCK * BLOCK
        for i in range(0, whole, BLOCK):
            part = a[i : min(i + BLOCK, whole)]
            place, sizes = self.at, []
            for p in split_planes(part, self.mode):
                c = self.zstd.compress(p) if p else b""
                sizes.append(len(c))
                self._put(c)
            self.chunks.append([place, len(part), sizes])
        self.held, self.n_held = [a[whole:].tobytes()], len(a) - whole

    def close(self) -> None:
        self._flush(True)
        index = self.zstd.compress(json.dumps({"mode": self.mode, "chunks": self.chunks, "keys": self.keys, "lengths": self.lengths}).encode())
        self._put(index)
        self._put(struct.pack("<I", len(index)) + MAGIC)


def read_file(path: str) -> Iterator[tuple[object, list[bytes]]]:
    """(key, parts of the document's ids as bytes) of each document in turn; one chunk is in memory at a time besides the current document."""
    import zstandard

    fs, p = filesystem(path)
    z = zstandard.ZstdDecompressor()
    with fs.open_input_file(p) as f:
        size = f.size()
        tail = f.read_at(12, size - 12)
        if tail[4:] != MAGIC:
            raise ValueError(f"{path} is not a whole file of id planes")
        (n,) = struct.unpack("<I", tail[:4])
        index = json.loads(z.decompress(f.read_at(n, size - 12 - n)))

        def blocks():
            for place, count, sizes in index["chunks"]:
                raw, planes, at = f.read_at(sum(sizes), place), [], 0
                for s in sizes:
                    planes.append(z.decompress(raw[at : at + s]) if s else b"")
                    at += s
                yield join_planes(planes, count, index["mode"]).tobytes()

        source, have, at = blocks(), b"", 0
        for key, length in zip(index["keys"], index["lengths"]):
            need, parts = 4 * length, []
            while need:
                if at == len(have):
                    have, at = next(source), 0
                parts.append(have[at : at + need])
                at += len(parts[-1])
                need -= len(parts[-1])
            yield key, parts


def file_name(part: int, number: int) -> str:
    return f"ids-{part:08d}-{number:06d}.planes"


def write(df: DataFrame, folder: str, vocabulary: str, end_id: int, text: str = "text", key: str = "doc_id", mode: str = "byte", level: int = 3, file_ids: int = 1 << 26, file_docs: int = 1 << 18) -> list[tuple[int, str, int, int]]:
    """Encode whole texts, append end_id to each, and write files in ascending key order, one or more for each range of the key.

    A file ends with the document that brings it to file_ids ids or file_docs documents, which bounds what a writer and
    its index hold, whatever a range's size is. Returns (start, path, documents, ids) of each file in order, start being
    the ids in files before it: one small row a file. Null texts are empty; null keys come first; rows with equal keys are ordered by their texts' hashes, so
    repeated rows are all written; other columns are not read. key: an integer. A file appears whole, by a rename, under a name its partition alone
    has: a task that runs again writes the same file.
    """
    bounded_batches(df.sparkSession)
    folder = qualified(df.sparkSession, folder)
    tie = F.xxhash64(F.coalesce(text, F.lit("")))
    rows = df.select(F.col(key).cast("long").alias("k"), F.col(text).alias("t")).repartitionByRange("k", tie.alias("h").asc()).sortWithinPartitions(F.col("k").asc_nulls_first(), F.xxhash64(F.coalesce("t", F.lit(""))), "t")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e, w, end = encoder(vocabulary), None, struct.pack("<I", end_id)
        task = TaskContext.get()
        part = task.partitionId()
        fs, base = filesystem(folder)
        number = 0

        def ended() -> pa.RecordBatch:
            w.close()
            w.out.close()
            fs.move(own(), f"{base}/{file_name(part, number)}")
            return pa.RecordBatch.from_pydict({"part": [part], "number": [number], "docs": [len(w.keys)], "ids": [w.n_ids]})

        def own() -> str:
            return f"{base}/.ids-{part:08d}-{number:06d}-{task.taskAttemptId()}"

        for b in batches:
            sizes = [n or 0 for n in pc.binary_length(b.column(1)).to_pylist()]
            for i, j in slices(b.num_rows, sizes):
                for k, ids in zip(b.column(0).slice(i, j - i).to_pylist(), e.ids(b.column(1).slice(i, j - i).to_pylist())):
                    if w is None:
                        fs.create_dir(base, recursive=True)
                        w = Writer(fs.open_output_stream(own()), mode, level)
                    w.add(k, ids + end)
                    if w.n_ids >= file_ids or len(w.keys) >= file_docs:
                        yield ended()
                        w, number = None, number + 1
        if w is not None:
            yield ended()

    got = sorted(tuple(r) for r in rows.mapInArrow(run, "part long, number long, docs long, ids long").collect())
    out, start = [], 0
    for part, number, docs, ids in got:
        out.append((start, f"{folder}/{file_name(part, number)}", docs, ids))
        start += ids
    return out


def read(spark, files: list[tuple[int, str, int, int]], key: str = "doc_id", ids: bool = False) -> DataFrame:
    """One row for each document of the files: key, start (ids of all documents before it), n_tokens, ids_crc32, and its ids if asked for; a task for each file."""
    source = spark.createDataFrame([(s, p) for s, p, _, _ in files], "start long, path string")
    source = source.repartitionByRange(len(files), "start") if len(files) > 1 else source

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for start, path in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                cols: list[list] = [[], [], [], [], []]
                for k, parts in read_file(path):
                    crc, n = 0, 0
                    for p in parts:
                        crc, n = zlib.crc32(p, crc), n + len(p) // 4
                    for c, v in zip(cols, (k, start, n, crc, np.frombuffer(b"".join(parts), "<i4") if ids else None)):
                        c.append(v)
                    start += n
                    if len(cols[0]) == 2000:
                        yield batch(cols)
                        cols = [[], [], [], [], []]
                yield batch(cols)

    def batch(cols):
        arrays = [pa.array(c, pa.int64()) for c in cols[:4]] + ([pa.array(cols[4], pa.list_(pa.int32()))] if ids else [])
        return pa.RecordBatch.from_arrays(arrays, names=[key, "start", "n_tokens", "ids_crc32"] + ["ids"] * ids)

    return source.mapInArrow(run, f"{key} long, start long, n_tokens long, ids_crc32 long" + ", ids array<int>" * ids)
