"""Near-duplicate documents by HyperMinHash.

One hash of each shingle: its top bits name a bucket, the least remainder in a bucket is stored as a count of leading
zeros and the mantissa bits after them (16 bits together). Empty buckets borrow from others in a fixed random order.
Bands of registers bring candidates together; the share of equal registers, corrected for equal registers by chance,
gives an estimate of the Jaccard similarity that drops pairs far below the threshold; the rest are confirmed on full
shingle sets.

Equal sets form classes, and only representatives are compared. In each band group every member is first compared with
the one that shares most bands with others, a hub; then with a hub of another component; then only members of groups
that still hold several components are compared across components. So a large group of copies costs about one comparison a member, and no two texts that share a band stay untested and apart.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import bounded_batches, discard, linear_hash, materialise, release, trimmed, unzip, word_hashes, zipped
from tessera.llm.components import components

BUCKET_BITS, MANTISSA = 8, 10
BUCKETS = 1 << BUCKET_BITS
BAND = 6
BANDS = BUCKETS // BAND
#: For each bucket, the order in which it borrows from others when it is empty.
_BORROW = np.stack([np.random.default_rng(1000 + j).permutation(BUCKETS) for j in range(BUCKETS)])
#: The chance that two registers of different minima are equal is near 2**-MANTISSA / 2.
BY_CHANCE = 2.0 ** -(MANTISSA + 1)


def shingles(text: bytes, width: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's word shingles, A-Z in lower case; the whole sequence if it is shorter; none without words."""
    words = text.lower().split()  # bytes: ASCII letters, ASCII white space
    if not words:
        return np.zeros(0, np.uint64)
    return np.unique(linear_hash(word_hashes(words), min(width, len(words)), len(words) if len(words) < width else 0))


def registers(h: np.ndarray) -> bytes:
    """The registers of a set of at least one hash, 16 bits each."""
    bucket = (h >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)
    first = np.append(True, bucket[1:] != bucket[:-1])  # h is sorted
    v = (h[first] & np.uint64((1 << (64 - BUCKET_BITS)) - 1)) >> np.uint64(3)
    bits = np.frexp(v.astype(np.float64))[1]  # v has 53 bits at most, so this is exact
    mantissa = np.where(bits > MANTISSA, v >> np.maximum(bits - 1 - MANTISSA, 0).astype(np.uint64), v << np.maximum(MANTISSA + 1 - bits, 0).astype(np.uint64)) & np.uint64((1 << MANTISSA) - 1)
    out = np.zeros(BUCKETS, np.uint16)
    own = bucket[first]
    out[own] = ((64 - BUCKET_BITS - 3 - bits) << MANTISSA).astype(np.uint16) | mantissa.astype(np.uint16)
    full = np.zeros(BUCKETS, bool)
    full[own] = True
    if len(own) < BUCKETS:
        empty = np.nonzero(~full)[0]
        out[empty] = out[_BORROW[empty, full[_BORROW[empty]].argmax(1)]]
    return out.tobytes()


def estimate(a: bytes, b: bytes) -> float:
    """Jaccard similarity from two registers, corrected for registers that are equal by chance."""
    same = np.count_nonzero(np.frombuffer(a, np.uint16) == np.frombuffer(b, np.uint16)) / BUCKETS
    return max(0.0, (same - BY_CHANCE) / (1 - BY_CHANCE))


def fingerprint(h: np.ndarray) -> bytes:
    """128 bits of a set."""
    return hashlib.blake2b(h.tobytes(), digest_size=16).digest()


def signatures(df: DataFrame, width: int, text: str, key: str) -> DataFrame:
    """(id, n, fp, regs): set size, 128-bit fingerprint of the set, registers; fp and regs are null for empty sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, fp, regs = [], [], []
            for t in b.column(1):
                h = shingles((t.as_py() or "").encode(), width)
                n.append(len(h))
                fp.append(fingerprint(h) if len(h) else None)
                regs.append(registers(h) if len(h) else None)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(fp, pa.binary()), pa.array(regs, pa.binary())], names=["id", "n", "fp", "regs"])

    return df.select(F.col(key).cast("long").alias("id"), text).mapInArrow(trimmed(run, "words"), "id long, n long, fp binary, regs binary")


def _estimated(pairs: DataFrame, sigs: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) whose estimate is not five standard deviations below the threshold."""
    j = percent / 100
    least = j - 5 * (j * (1 - j) / BUCKETS) ** 0.5

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ok = [estimate(x.as_py(), y.as_py()) >= least for x, y in zip(b.column(2), b.column(3))]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], names=["a", "b"]).filter(pa.array(ok, pa.bool_()))

    s = sigs.select("id", "regs")
    two = pairs.join(s.toDF("a", "ra"), "a").join(s.toDF("b", "rb"), "b")
    return two.select("a", "b", "ra", "rb").mapInArrow(trimmed(run, "words"), "a long, b long")


def _confirmed(pairs: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """Pairs (a, b) with 100 * intersection >= percent * union on full sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, kept = None, None
        for b in batches:
            ok = []
            for k, za, zb in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), b.column(3).to_pylist()):
                if k != last:
                    last, kept = k, shingles(unzip(zb), width)
                s = shingles(unzip(za), width)
                common = len(np.intersect1d(s, kept, assume_unique=True))
                ok.append(100 * common >= percent * (len(s) + len(kept) - common))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], names=["a", "b"]).filter(pa.array(ok, pa.bool_()))

    two = pairs.join(texts.toDF("a", "za"), "a").join(texts.toDF("b", "zb"), "b")
    return two.select("a", "b", "za", "zb").mapInArrow(trimmed(run, "words"), "a long, b long")


#: How often groups of several components get a new hub before all across components are compared.
STAR_TURNS = 1
#: Parity bitmaps of shingle sets, as longs w0, w1, ...
BITS = tuple(f"w{i}" for i in range(32))


def parity(h: np.ndarray) -> np.ndarray:
    """Of each of 2048 bins, whether an odd number of the hashes falls in it, as 32 longs.

    Bins that differ between two sets hold an element that only one of them has, so their number is never more than the
    size of the symmetric difference: a bound that loses no pair.
    """
    n = 64 * len(BITS)
    odd = np.bincount((h % np.uint64(n)).astype(np.int64), minlength=n) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _bits(texts: DataFrame, width: int) -> DataFrame:
    """(id, w0, ...) of (id, z)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            w = np.array([parity(shingles(unzip(z.as_py()), width)) for z in b.column(1)], np.int64).reshape(-1, len(BITS))
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(w[:, k]) for k in range(len(BITS)))], names=["id", *BITS])

    return texts.select("id", "z").mapInArrow(trimmed(run, "words"), "id long, " + ", ".join(f"{w} long" for w in BITS))


def _fingerprinted(texts: DataFrame, width: int) -> DataFrame:
    """(k, fp, z) of (k, z)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = pa.array([fingerprint(shingles(unzip(z.as_py()), width)) for z in b.column(1)], pa.binary())
            yield pa.RecordBatch.from_arrays([b.column(0), fp, b.column(1)], names=["k", "fp", "z"])

    return texts.select("k", "z").mapInArrow(trimmed(run, "words"), "k long, fp binary, z binary")


def _texts(df: DataFrame, classes: DataFrame, repeated: DataFrame, width: int, text: str, key: str) -> DataFrame:
    """(id, z): a text of each class (id, rep, fp), which is a row of its rep; of reps that stand in several rows, one of this set."""
    rows = df.select(F.col(key).cast("long").alias("k"), F.col(text).alias("t"))
    wanted = classes.select("id", F.col("rep").alias("k"), "fp")
    once = zipped(rows, ["k"], "t").join(wanted.join(repeated, "k", "left_anti"), "k").select("id", "z")
    several = _fingerprinted(zipped(rows.join(repeated, "k", "left_semi"), ["k"], "t"), width)
    return once.union(several.join(wanted, ["k", "fp"]).select("id", "z").dropDuplicates(["id"]))


def _most_linked(c):
    """The member of a group with the greatest degree, least id on ties, as struct h."""
    return F.max(F.struct("degree", (-F.col("id")).alias("i"), F.col("id"), F.col("n"), c.alias("c"))).alias("h")


def _mixed(groups: DataFrame, part: DataFrame) -> DataFrame:
    """(g, id, n, degree, c) of the groups that hold several components."""
    at = groups.join(part, "id", "left").select("g", "id", "n", "degree", F.coalesce("c", "id").alias("c"))
    return at.join(at.groupBy("g").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).filter("lo != hi").select("g"), "g")


def near_duplicates(df: DataFrame, width: int = 5, percent: int = 80, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row for each row with an id: key, n_shingles, component_id (smallest id reachable), kept.

    Null and empty texts and texts without words have empty sets and link with nothing. Rows with equal ids are one
    document if their sets are equal, and linked by their id in any case; each set of an id is compared with the others,
    so what is near one of them is linked to all. Rows without an id are returned with a null
    component and kept: nothing can stand for them. An empty table gives no rows. Other columns are not read.
    """
    bounded_batches(df.sparkSession)
    spark, written = df.sparkSession, []

    def keep(t: DataFrame, tag: str) -> DataFrame:
        written.append(materialise(t, tag))
        return written[-1]

    sigs = materialise(signatures(df, width, text, key), "signatures")
    # an id may hold several sets, so classes have numbers of their own; written once, these stay the same
    classes = keep(sigs.filter("fp IS NOT NULL AND id IS NOT NULL").groupBy("fp").agg(F.min("id").alias("rep")).withColumn("class", F.monotonically_increasing_id()), "sets")
    member = keep(sigs.select("id", "fp").filter("fp IS NOT NULL AND id IS NOT NULL").join(classes, "fp").select("id", "rep"), "classes")
    of = classes.select(F.col("rep").alias("id"), F.col("fp").alias("f"), "class")
    reps = keep(sigs.join(of, "id").filter("fp = f").dropDuplicates(["class"]).select(F.col("class").alias("id"), F.col("id").alias("rep"), "n", "fp", "regs"), "representatives")
    bands = reps.select("id", F.explode(F.expr(f"transform(sequence(0, {BANDS - 1}), b -> xxhash64(b, substring(regs, b * {2 * BAND} + 1, {2 * BAND})))")).alias("g"))
    sizes = bands.groupBy("g").agg(F.count(F.lit(1)).alias("c")).filter("c > 1")
    groups = keep(bands.join(sizes, "g"), "bands")  # only groups of two members or more
    release(spark)
    # written tables have a known size: Spark broadcasts these ids if they are few and joins by sorting if they are not
    involved = keep(groups.select("id").distinct(), "involved")
    reps = keep(reps.join(involved, "id", "left_semi").select("id", "rep", "n", "fp", "regs"), "registers")
    repeated = keep(sigs.filter("id IS NOT NULL").groupBy("id").count().filter("count > 1").select(F.col("id").alias("k")), "repeated")
    texts = keep(_texts(df, reps, repeated, width, text, key), "texts")
    # the text that copies were made from shares more bands with them than they do with each other
    degree = groups.groupBy("id").agg(F.sum("c").alias("degree"))
    groups = keep(groups.select("g", "id").join(degree.join(reps.select("id", "n"), "id"), "id"), "groups")
    release(spark)
    near = f"100 * least(n, m) >= {percent} * greatest(n, m)"
    hub = groups.groupBy("g").agg(_most_linked(F.lit(0))).select("g", F.col("h.id").alias("b"), F.col("h.n").alias("m"))
    first = groups.join(hub, "g").filter(f"id != b AND {near}").select(F.greatest("id", "b").alias("a"), F.least("id", "b").alias("b"))
    tested = keep(first.distinct(), "pairs")
    links = keep(_confirmed(_estimated(tested, reps, percent), texts, width, percent), "links")
    written.append(components(links, "a", "b"))
    part = written[-1].toDF("id", "c")
    for _ in range(STAR_TURNS):  # a hub outside the first one's component, so that the last comparison has little left
        at = keep(_mixed(groups, part), "mixed")
        top = at.groupBy("g").agg(_most_linked(F.col("c"))).select("g", F.col("h.c").alias("e"))
        hub = at.join(top, "g").filter("c != e").groupBy("g").agg(_most_linked(F.col("c"))).select("g", F.col("h.id").alias("b"), F.col("h.n").alias("m"), F.col("h.c").alias("d"))
        star = at.join(hub, "g").filter(f"c != d AND {near}").select(F.greatest("id", "b").alias("a"), F.least("id", "b").alias("b")).distinct()
        more = keep(star.join(tested, ["a", "b"], "left_anti"), "pairs")
        tested = tested.union(more)
        links = links.union(keep(_confirmed(_estimated(more, reps, percent), texts, width, percent), "links"))
        written.append(components(links, "a", "b"))
        part = written[-1].toDF("id", "c")
    # what still holds several components is compared across them
    at = keep(_mixed(groups, part), "mixed")
    bits = keep(_bits(texts.join(at.select("id").distinct(), "id", "left_semi"), width), "bits")
    at = keep(at.select("g", "id", "n", "c").join(bits, "id"), "mixed")
    other = at.select("g", *(F.col(c).alias(f"{c}_") for c in ("id", "n", "c", *BITS)))
    alike = f"{100 + percent} * (" + " + ".join(f"bit_count({w} ^ {w}_)" for w in BITS) + f") <= {100 - percent} * (n + n_)"
    cross = at.join(other, (at["g"] == other["g"]) & F.expr(f"id > id_ AND c != c_ AND 100 * least(n, n_) >= {percent} * greatest(n, n_) AND {alike}")).select(F.col("id").alias("a"), F.col("id_").alias("b")).distinct()
    more = keep(cross.join(tested, ["a", "b"], "left_anti"), "pairs")
    links = links.union(keep(_confirmed(_estimated(more, reps, percent), texts, width, percent), "links"))
    rep = reps.select("id", "rep")
    links = links.join(rep.toDF("a", "ra"), "a").join(rep.toDF("b", "rb"), "b").select(F.col("ra").alias("a"), F.col("rb").alias("b"))
    part = components(links.union(member.select("id", "rep")), "a", "b").toDF("id", "c")
    discard(*written)  # what follows reads sigs and part alone
    out = sigs.select("id", "n").join(part, "id", "left")
    return out.select(F.col("id").alias(key), F.col("n").alias("n_shingles"), F.coalesce("c", "id").alias("component_id")).withColumn("kept", F.col(key).isNull() | (F.col(key) == F.col("component_id")))
