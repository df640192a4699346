"""Helpers of the corpus operators: table reading, shared storage, words, hashes."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word: a longest run without space, tab, line feed, vertical tab, form feed or carriage return.
WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors see (spark.checkpoint.dir). Where that is unset, a local session gets a folder of its machine; a cluster must name one."""
    got = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not got:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir is unset: executors need a shared folder")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tessera-"))
        got = spark.sparkContext.getCheckpointDir()
    return f"{got.rstrip('/')}/tessera-{spark.sparkContext.applicationId}"


def new_path(spark: SparkSession, tag: str) -> str:
    return f"{shared_dir(spark)}/{tag}-{uuid.uuid4().hex[:12]}"


def materialise(df: DataFrame, tag: str) -> DataFrame:
    """Cut the lineage: write to the shared folder as Parquet and read that table."""
    spark = df.sparkSession
    path = new_path(spark, tag)
    df.write.parquet(path)
    got = spark.read.schema(df.schema).parquet(path)
    got.written_at = path
    return got


def discard(*tables: DataFrame) -> None:
    """Delete written tables that nothing will read again: what was made of them has been written too."""
    for t in tables:
        path = t.sparkSession._jvm.org.apache.hadoop.fs.Path(t.written_at)
        path.getFileSystem(t.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def free_name(df: DataFrame, name: str) -> str:
    """name, or name with the first number after it that no column has."""
    have, n = {c.lower() for c in df.columns}, 0
    while (got := f"{name}{n or ''}").lower() in have:
        n += 1
    return got


def fmix64(h: np.ndarray) -> np.ndarray:
    """Bijective mixing of 64-bit values."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def odd_multipliers(n: int, seed: int) -> np.ndarray:
    """n odd 64-bit multipliers."""
    return fmix64(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(2 * seed + 0x9E3779B97F4A7C15)) | np.uint64(1)


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner drop the shuffle files of steps whose result has been written."""
    import gc

    gc.collect()
    spark.sparkContext._jvm.System.gc()


#: Caches of this worker by name.
CACHES: dict[str, dict] = {}


def trimmed(run, keeps: str = ""):
    """run, a function of batches, for workers that outlive tasks: before it all caches but the named one are emptied, after it free memory goes back to the system."""

    def then(batches):
        import ctypes

        for name, cache in CACHES.items():
            if name != keeps:
                cache.clear()
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc
        if trim:
            trim(0)

    return then


#: Arrow batches end at about this many bytes, whatever the rows' sizes are.
BATCH_BYTES = 4 << 20


def bounded_batches(spark: SparkSession) -> None:
    """Bound the session's Arrow batches by BATCH_BYTES, where they are not bounded lower: rows of text have no usual size."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(name))
    if not 0 < now <= BATCH_BYTES:
        spark.conf.set(name, f"{BATCH_BYTES}b")


def column_udf(run, kind: str, keeps: str = ""):
    """run, a function of Arrow arrays, as a column function: rows go to Python by the argument only, and each runs once."""
    inner = trimmed(run, keeps)

    def column(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        yield from inner(batches)

    return F.arrow_udf(column, kind).asNondeterministic()


class WordHashes(dict):
    """Words (bytes) to 64-bit hashes; emptied at `most` entries."""

    most = 100_000

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) >= self.most:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


_HASHES = CACHES["words"] = WordHashes()


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words))


def linear_hash(x: np.ndarray, width: int, seed: int) -> np.ndarray:
    """A hash of each run of `width` values of x: their sum under fixed odd factors, mixed; empty if x is shorter."""
    n = len(x) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    h = np.zeros(n, np.uint64)
    for j, m in enumerate(odd_multipliers(width, seed)):
        h += x[j : j + n] * m
    return fmix64(h)


def zipped(df: DataFrame, keys: list[str], text: str, name: str = "z") -> DataFrame:
    """keys and the text compressed with zstandard: what a shuffle of texts should carry. A null text is empty."""

    bounded_batches(df.sparkSession)

    def run(batches):
        import zstandard

        c = zstandard.ZstdCompressor(level=1)
        for b in batches:
            z = pa.array([c.compress((t.as_py() or "").encode()) for t in b.column(len(keys))], pa.binary())
            yield pa.RecordBatch.from_arrays([*b.columns[: len(keys)], z], names=[*keys, name])

    kinds = ", ".join(f"{k} {df.schema[k].dataType.simpleString()}" for k in keys)
    return df.select(*keys, F.col(text)).mapInArrow(trimmed(run, "words"), f"{kinds}, {name} binary")


def unzip(z: bytes) -> bytes:
    import zstandard

    return zstandard.ZstdDecompressor().decompress(z) if z else b""
