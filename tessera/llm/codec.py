"""Encode and decode a column of texts with the trie encoder."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from tessera.llm.common import bounded_batches
from tessera.llm.tokens import encoder, slices
from tessera.llm.trie_bpe import TrieEncoder


def encode(df: DataFrame, path: str, text: str = "text", key: str = "doc_id", ids: bool = True, digests: bool = False) -> DataFrame:
    """One row for each row: key, ids (array<int>, if asked for), n_tokens, and with digests the sha256 of the ids and of the decoded text.

    Null and empty texts have no ids. Repeated rows are encoded alike; an empty table gives no rows; other columns are
    not read. Whole texts are encoded, in blocks that bound a worker's memory.
    """
    bounded_batches(df.sparkSession)
    kind = df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(path, TrieEncoder)
        for b in batches:
            sizes = [n or 0 for n in pc.binary_length(b.column(1)).to_pylist()]
            for i, j in slices(b.num_rows, sizes):
                got = e.ids(b.column(1).slice(i, j - i).to_pylist())
                cols = [b.column(0).slice(i, j - i)]
                if ids:
                    cols.append(pa.array([np.frombuffer(x, "<i4") for x in got], pa.list_(pa.int32())))
                cols.append(pa.array([len(x) // 4 for x in got], pa.int64()))
                if digests:
                    cols.append(pa.array([hashlib.sha256(x).hexdigest() for x in got]))
                    cols.append(pa.array([hashlib.sha256(e.decode(x).encode()).hexdigest() for x in got]))
                yield pa.RecordBatch.from_arrays(cols, names=names)

    fields = [(key, kind)] + [("ids", "array<int>")] * ids + [("n_tokens", "long")] + [("ids_sha256", "string"), ("decoded_sha256", "string")] * digests
    names = [n for n, _ in fields]
    return df.select(key, text).mapInArrow(run, ", ".join(f"{n} {t}" for n, t in fields))


def decode(df: DataFrame, path: str, ids: str = "ids", key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each row: key and the decoded text; null ids give a null text."""
    kind = df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(path, TrieEncoder)
        for b in batches:
            out = [None if x is None else e.decode(np.asarray(x, "<u4").tobytes()) for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.string())], names=[key, text])

    return df.select(key, ids).mapInArrow(run, f"{key} {kind}, {text} string")
