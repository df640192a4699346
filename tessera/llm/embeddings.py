"""Near duplicates among embeddings: int8 tile products with error bounds, doubtful pairs again in double precision.

Equal vectors form classes. Class representatives are quantised once: unit vectors to int8 with one scale each, and the
norm of what quantisation loses bounds the error of every product: for u = s c + r and v = t k + q,
|u v - s t c k| <= |r| + |q| + 3 |r| |q|. Representatives go to blocks, and only codes, scales and bounds are exchanged,
one bounded group for each pair of blocks. Pairs whose lower bound reaches the threshold are links; a group returns
their counts and a spanning forest, not the links. Pairs whose upper bound alone reaches it are doubtful: these come out
as pairs and are computed again from the vectors in double precision.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import materialise
from tessera.llm.components import components

TILE = 1024


def quantise(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """int8 codes of the unit vectors of x, their scales, and upper bounds of the norms of the errors."""
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    s = np.abs(u).max(1) / 127
    c = np.rint(u / s[:, None])
    return c.astype(np.int8), s, np.linalg.norm(u - s[:, None] * c, axis=1) * (1 + 1e-9) + 1e-12


def tile_links(qa, qb, threshold: float, same: bool):
    """Index pairs (i, j) that are surely links, and those that are doubtful; i < j if both sides are the same tile.

    Sums of int8 products in float32 are exact up to 2**24, so long vectors are summed in parts of 1024 components.
    """
    (ca, sa, ea), (cb, sb, eb) = qa, qb
    d = ca.shape[1]
    dot = np.zeros((len(ca), len(cb)), np.float32 if d <= 1024 else np.float64)
    for k in range(0, d, 1024):
        dot += ca[:, k : k + 1024].astype(np.float32) @ cb[:, k : k + 1024].astype(np.float32).T
    value = dot * sa[:, None] * sb[None, :]
    slack = ea[:, None] + eb[None, :] + 3 * ea[:, None] * eb[None, :] + 1e-12
    possible = value + slack >= threshold
    if same:
        possible = np.triu(possible, 1)
    i, j = np.nonzero(possible)
    sure = value[i, j] - slack[i, j] >= threshold
    return (i[sure], j[sure]), (i[~sure], j[~sure])


def hook(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Unite i and j in label, where label[x] <= x names x's set by its smallest member after flattening."""
    while True:
        differ = label[i] != label[j]
        if not differ.any():
            return
        i, j = i[differ], j[differ]
        a, b = label[i], label[j]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while (label[label] != label).any():
            label[:] = label[label]


#: Pairs of blocks are dealt over this many partitions at most; a partition takes its pairs one by one.
MOST_PARTITIONS = 10_000


def classes_of(df: DataFrame, key: str, vec: str) -> DataFrame:
    """(id, h, v): the vector's doubles as bytes, brought near 1 by a power of two, and a hash of its values; both null for vectors that link with nothing.

    The power changes no cosine, and no norm overflows or vanishes, whatever the components' size is.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists, hs, vs = b.column(1), [], []
            whole = lists.values.is_valid().to_numpy(zero_copy_only=False)
            flat = lists.values.cast(pa.float64()).fill_null(0.0).to_numpy(zero_copy_only=False) + 0.0  # no negative zero
            at, there = lists.offsets.to_numpy(), lists.is_valid().to_numpy(zero_copy_only=False)
            for ok, i, j in zip(there, at[:-1], at[1:]):
                a = flat[i:j]
                good = bool(ok and j > i and whole[i:j].all() and np.isfinite(a).all() and a.any())
                hs.append(hashlib.blake2b(a.tobytes(), digest_size=16).digest() if good else None)
                vs.append(np.ldexp(a, -np.frexp(np.abs(a).max())[1]).tobytes() if good else None)
            yield pa.RecordBatch.from_arrays([b.column(0).cast(pa.int64()), pa.array(hs, pa.binary()), pa.array(vs, pa.binary())], names=["id", "h", "v"])

    return df.select(key, vec).mapInArrow(run, "id long, h binary, v binary")


def coded(reps: DataFrame) -> DataFrame:
    """(c, n, codes, s, e) of (c, n, v): the int8 codes of each vector, its scale and its error bound."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            codes, scales, errors = [], [], []
            for v in b.column(2):
                q, s, e = quantise(np.frombuffer(v.as_py(), np.float64)[None, :])
                codes.append(q.tobytes())
                scales.append(s[0])
                errors.append(e[0])
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(codes, pa.binary()), pa.array(scales, pa.float64()), pa.array(errors, pa.float64())], names=["c", "n", "codes", "s", "e"])

    return reps.select("c", "n", "v").mapInArrow(run, "c long, n long, codes binary, s double, e double")


def confirmed(pairs: DataFrame, reps: DataFrame, threshold: float) -> DataFrame:
    """(a, b, na, nb) of the pairs (a, b) whose cosine reaches the threshold in double precision."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ok = []
            for x, y in zip(b.column(4), b.column(5)):
                x, y = np.frombuffer(x.as_py(), np.float64), np.frombuffer(y.as_py(), np.float64)
                ok.append(bool(x @ y / (np.linalg.norm(x) * np.linalg.norm(y)) >= threshold))
            yield pa.RecordBatch.from_arrays(b.columns[:4], names=["a", "b", "na", "nb"]).filter(pa.array(ok, pa.bool_()))

    of = reps.select("c", "n", "v")
    two = pairs.join(of.toDF("a", "na", "va"), "a").join(of.toDF("b", "nb", "vb"), "b").select("a", "b", "na", "nb", "va", "vb")
    return two.mapInArrow(run, "a long, b long, na long, nb long")


def near_duplicates(df: DataFrame, threshold: float = 0.9, key: str = "vec_id", vec: str = "embedding", block: int = 8192) -> DataFrame:
    """One row for each row with an id: key, n_links, component_id, kept.

    All pairs are compared. Vectors that are null, empty, zero or hold null or non-finite components link with nothing;
    so do vectors of different lengths. Rows with equal vectors link with each other (they count as other vectors even
    with equal ids). Rows without an id have no place in a component and get none: they are returned with nulls. An
    empty table gives no rows. Other columns are not read. block: class representatives in a block at most; a group
    holds two blocks. Small tables get up to 8 blocks, so that there are groups for all cores.
    """
    rows = materialise(classes_of(df, key, vec), "vectors")
    reps = rows.filter("h IS NOT NULL AND id IS NOT NULL").groupBy("h").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("n"), F.first("v").alias("v"))
    reps = materialise(reps.withColumn("c", F.monotonically_increasing_id()), "vector-classes")
    count = reps.count()
    blocks = max(1, -(-count // block), min(8, count // 1024))
    mine = F.pmod(F.xxhash64("c"), F.lit(blocks)).cast("int")
    codes = materialise(coded(reps).withColumn("k", mine), "vector-codes")
    pairs = codes.withColumn("o", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).withColumns({"a": F.least("k", "o"), "b": F.greatest("k", "o")})

    def compare(t: pa.Table) -> pa.Table:
        ids, n, k = (t.column(x).to_numpy() for x in ("c", "n", "k"))
        a, b = t.column("a")[0].as_py(), t.column("b")[0].as_py()
        own = t.column("codes").combine_chunks()
        scale, error = t.column("s").to_numpy(), t.column("e").to_numpy()
        at = np.frombuffer(own.buffers()[1], np.int32)[own.offset : own.offset + len(own) + 1]
        sizes, starts = np.diff(at), at[:-1]
        flat = np.frombuffer(own.buffers()[2], np.int8)
        order = np.lexsort((ids, k, sizes))
        label, links = np.arange(len(ids)), np.zeros(len(ids), np.int64)
        left, right = [], []
        for d in np.unique(sizes):
            of = order[sizes[order] == d]
            x = flat[starts[of][:, None] + np.arange(d)[None, :]]
            tiles = []
            for s in (a,) if a == b else (a, b):
                at = np.nonzero(k[of] == s)[0]
                tiles.append([(of[p], (x[p], scale[of[p]], error[of[p]])) for p in (at[i : i + TILE] for i in range(0, len(at), TILE))])
            for p, (ra, qa) in enumerate(tiles[0]):
                for q, (rb, qb) in enumerate(tiles[-1]):
                    if a == b and q < p:
                        continue
                    (i, j), (doubt_i, doubt_j) = tile_links(qa, qb, threshold, a == b and p == q)
                    left.append(ids[ra[doubt_i]])
                    right.append(ids[rb[doubt_j]])
                    if len(i):
                        i, j = ra[i], rb[j]
                        np.add.at(links, i, n[j])
                        np.add.at(links, j, n[i])
                        hook(label, np.minimum(i, j), np.maximum(i, j))
        some = np.nonzero(links)[0]
        left, right = (np.concatenate(x or [np.zeros(0, np.int64)]) for x in (left, right))
        return pa.table({"c": np.append(ids[some], left), "links": np.append(links[some], np.full(len(left), -1)), "other": np.append(ids[label[some]], right)})

    tasks = blocks * (blocks + 1) // 2
    # The work is in the groups, not in their bytes: they are spread over more partitions than their bytes ask for.
    dealt = pairs.select("a", "b", "c", "n", "k", "codes", "s", "e").repartition(min(2 * tasks, MOST_PARTITIONS), "a", "b")
    got = materialise(dealt.groupBy("a", "b").applyInArrow(compare, "c long, links long, other long"), "vector-links")
    more = materialise(confirmed(got.filter("links < 0").select(F.col("c").alias("a"), F.col("other").alias("b")), reps, threshold), "vector-links")
    got = got.filter("links >= 0").union(more.selectExpr("a", "nb", "b")).union(more.selectExpr("b", "na", "a"))
    parts = components(got, "c", "other").toDF("c", "part")
    links = got.groupBy("c").agg(F.sum("links").alias("links"))
    of = reps.select("h", "c", "id", "n").join(links, "c", "left").join(parts, "c", "left").withColumn("part", F.coalesce("part", "c"))
    of = materialise(of.select("h", "part", "id", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links")), "vector-parts")
    low = of.groupBy("part").agg(F.min("id").alias("low"))  # classes are numbered apart from ids
    out = rows.select("id", "h").join(of.join(low, "part").select("h", "n_links", "low"), "h", "left")
    known = F.col("id").isNotNull()
    return out.select(F.col("id").alias(key), F.when(known, F.coalesce("n_links", F.lit(0))).cast("long").alias("n_links"), F.when(known, F.coalesce("low", "id")).alias("component_id")).withColumn("kept", F.col(key) == F.col("component_id"))
