"""Language identification by string kernels.

A text is the set of its byte 2- to 4-grams (lower case, signs and digits as one space), hashed to DIM places. The
blended-spectrum presence kernel of two texts is the size of their common part over the geometric mean of their sizes.
Landmarks give Nystrom features; kernel ridge regression, one language against the rest, gives the weights. Texts are
scored in blocks by two matrix products.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import bounded_batches, column_udf, free_name, trimmed

DIM = 1 << 13
GRAMS = (2, 3, 4)
BLOCK = 256
UNKNOWN = "und"
#: Landmarks of each language at least, where its sample has so many rows.
LANDMARKS_A_LANGUAGE = 4
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[:128] = [c if chr(c).isalpha() else 32 for c in range(128)]


def presence(text: str | None, out: np.ndarray) -> None:
    """Mark in out (DIM booleans) the n-grams of the whole text; none for null and empty texts."""
    b = _FOLD[np.frombuffer(f" {(text or '').lower()} ".encode(), np.uint8)]
    b = b[np.append(True, (b[1:] != 32) | (b[:-1] != 32))].astype(np.uint32)  # one space for several
    h = b
    for n in range(2, max(GRAMS) + 1):
        h = h[:-1] * np.uint32(0x01000193) ^ b[n - 1 :]
        if n in GRAMS:
            out[(h * np.uint32(0x9E3779B1)) >> np.uint32(32 - DIM.bit_length() + 1)] = True


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    landmarks: np.ndarray  # DIM x landmarks, float32 0/1
    sizes: np.ndarray
    weights: np.ndarray  # landmarks x languages
    sharpness: float = 6.0

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        langs, scores = [], []
        for i in range(0, len(texts), BLOCK):
            part = texts[i : i + BLOCK]
            x = np.zeros((len(part), DIM), bool)
            for row, t in zip(x, part):
                presence(t, row)
            k = kernel(x.astype(np.float32), x.sum(1), self.landmarks, self.sizes)
            f = k @ self.weights
            p = np.exp(self.sharpness * (f - f.max(1, keepdims=True)))
            p /= p.sum(1, keepdims=True)
            for t, j, s in zip(part, p.argmax(1), p.max(1)):
                known = bool(t) and any(map(str.isalpha, t))  # Unicode letters
                langs.append(self.languages[j] if known else UNKNOWN)
                scores.append(round(float(min(1.0, s)), 9) if known else 0.0)  # sums differ in the last digits by place in a block
        return langs, scores


def kernel(x: np.ndarray, nx: np.ndarray, landmarks: np.ndarray, nl: np.ndarray) -> np.ndarray:
    return (x @ landmarks) / np.sqrt(np.maximum(nx, 1)[:, None] * np.maximum(nl, 1)[None, :])


def fit(docs: DataFrame, lang: str = "lang", text: str = "text", key: str = "doc_id", per_language: int = 300, landmarks: int = 160, ridge: float = 1e-3, max_languages: int = 1000, sample_rows: int = 60_000) -> Model | None:
    """Learn from the rows given (hold out rows before the call); rows without language, id or text do not count.

    A bounded sample: the max_languages most frequent languages, of each per_language rows, or as many as leave
    sample_rows in all, but 20 at least: those with the least hash in each part of the rows. Ids are picked without
    reading texts, twice as many as wanted for those that turn out to have no text. Executors turn the texts into
    presence bits; the driver gets these bits (DIM / 8 bytes a row) and works through them in blocks. None if there is
    no labelled row.
    """
    has = docs.filter(F.col(lang).isNotNull() & F.col(key).isNotNull()).select(key, lang)
    top = [r[0] for r in has.groupBy(lang).count().orderBy(F.desc("count"), lang).limit(max_languages).collect()]
    wanted = max(20, min(per_language, sample_rows // max(1, len(top))))
    h = F.xxhash64(key)
    parted = has.filter(F.col(lang).isin(top)).groupBy(lang, F.pmod(h, F.lit(2 * wanted)).alias("p"))
    ids = parted.agg(F.min(F.struct(h.alias("h"), F.col(key).alias("k"))).alias("m")).select(F.col("m.k").alias(key))
    sample = docs.select(key, lang, text).join(F.broadcast(ids.distinct()), key).filter(F.col(lang).isNotNull() & F.col(text).isNotNull())  # 2 * sample_rows ids at most, or 40 a language

    def bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for t in b.column(2):
                row = np.zeros(DIM, bool)
                presence(t.as_py(), row)
                out.append(np.packbits(row).tobytes())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(out, pa.binary())], names=["k", "lang", "bits"])

    kind = docs.schema[key].dataType.simpleString()
    got = sorted(((r.k, r.lang, bytes(r.bits)) for r in sample.mapInArrow(trimmed(bits), f"k {kind}, lang string, bits binary").collect()), key=lambda r: (hash_order(r[0]), r[1], r[2]))
    turn_of: dict[str, int] = {}
    rows = []  # (turn in its language, language, bits)
    for _, name, b in got:
        turn = turn_of[name] = turn_of.get(name, -1) + 1
        if turn < wanted:
            rows.append((turn, name, b))
    if not rows:
        return None
    names = tuple(sorted({r[1] for r in rows}))
    place = {name: j for j, name in enumerate(names)}
    y = np.array([place[r[1]] for r in rows])
    block = lambda part: np.stack([np.unpackbits(np.frombuffer(r[2], np.uint8)) for r in part]).astype(np.float32)
    # landmarks in turn from each language
    pick = np.lexsort((y, [r[0] for r in rows]))[: max(landmarks, LANDMARKS_A_LANGUAGE * len(names))]
    lm = block([rows[i] for i in pick])
    nl = lm.sum(1)
    values, vectors = np.linalg.eigh(kernel(lm, nl, lm.T, nl).astype(np.float64))
    good = values > 1e-6 * values.max()
    root = vectors[:, good] / np.sqrt(values[good])
    weight = 1.0 / np.bincount(y, minlength=len(names))[y]
    weight *= len(y) / weight.sum()
    left, right = ridge * len(y) * np.eye(root.shape[1]), np.zeros((root.shape[1], len(names)))
    for i in range(0, len(rows), 4 * BLOCK):
        x, own = block(rows[i : i + 4 * BLOCK]), y[i : i + 4 * BLOCK]
        phi = kernel(x, x.sum(1), lm.T, nl) @ root
        weighted = (phi * weight[i : i + 4 * BLOCK, None]).T
        left += weighted @ phi
        right += weighted @ np.where(own[:, None] == np.arange(len(names)), 1.0, -1.0 / max(1, len(names) - 1))
    return Model(names, np.ascontiguousarray(lm.T), nl, (root @ np.linalg.solve(left, right)).astype(np.float32))


def hash_order(k) -> int:
    import zlib

    return zlib.crc32(str(k).encode())


def identify(df: DataFrame, model: Model | None, text: str = "text", lang: str = "lang_pred", score: str = "lang_score") -> DataFrame:
    """All columns of df, the language and its score (0 to 1). Null texts and texts without a Unicode letter: 'und', 0.

    Columns of df with these names are replaced; no other is touched, and only the text goes to Python. Repeated rows
    get the same language, whole texts of any length are read, an empty table gives no rows.
    """
    bounded_batches(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(model)  # DIM * landmarks floats

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        m = shared.value
        for b in (whole.slice(i, BLOCK) for whole in batches for i in range(0, len(whole), BLOCK)):
            texts = b.to_pylist()
            langs, scores = m.predict(texts) if m else ([UNKNOWN] * len(texts), [0.0] * len(texts))
            yield pa.StructArray.from_arrays([pa.array(langs, pa.string()), pa.array(scores, pa.float64())], names=["lang", "score"])

    both = free_name(df, "_language")
    got = df.withColumn(both, column_udf(run, "struct<lang string, score double>")(F.col(f"`{text}`")))
    return got.withColumns({lang: F.col(f"{both}.lang"), score: F.col(f"{both}.score")}).drop(both)
