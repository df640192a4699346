"""Exact substring deduplication by seed and extend.

Seeds: of each window of `width` words, the k-gram with the least hash is its anchor, so equal windows have equal anchors
at equal places, and only about one word in seven is an anchor. The windows of one anchor occurrence are a run.

1. Each block of documents is combined before the exchange. Of runs that are equal the first is kept; every other one is
   a seed that is compared with it word by word and extended both ways to a maximal match, which is cut at once. An
   anchor with different runs in the block sends its windows on and one mark.
2. Runs meet by anchor, in aggregates that are joined back: what they keep of an anchor is one row, however common it is.
   Equal runs: all but the first are cut. An anchor with different runs: each first run is asked for its windows, where
   matches end inside a run.
3. Those windows, read from the texts, meet by their hash; all but the first are cut.

A document's cuts join to its maximal repeats. The order of occurrences is (document, start). Between blocks words are
not compared: equality there is that of 64-bit hashes of runs or windows inside an anchor of 64 bits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import WORDS, bounded_batches, discard, fmix64, linear_hash, materialise, release, trimmed, unzip, word_hashes, zipped
from tessera.llm.tokens import slices

RUN, MARK, CUT, WINDOW = 0, 1, 2, 3
_SCHEMA = "kind int, key long, sub long, d long, h long, s int, r int"


def gram(width: int) -> int:
    return max(1, width * 2 // 5)


def runs_of(x: np.ndarray, start: np.ndarray, width: int):
    """(first window, windows, anchor hash, run hash) of all runs, and the window hashes; start: where each document's words begin, and the end."""
    k = gram(width)
    w = width - k + 1
    g = linear_hash(x, k, 11)
    n = len(x) - width + 1
    none = np.zeros(0, np.int64)
    if n <= 0:
        return none, none, none.astype(np.uint64), none.astype(np.uint64), np.zeros(0, np.uint64), g
    best, at = g[:n].copy(), np.zeros(n, np.int64)
    for j in range(1, w):
        c = g[j : j + n]
        less = c < best
        best[less] = c[less]
        at[less] = j
    at += np.arange(n)
    left = np.repeat(start[1:], np.diff(start))[:n] - np.arange(n)  # words from here to the document's end
    valid = np.nonzero(left >= width)[0]
    wh = linear_hash(x, width, 13)
    if not len(valid):
        return none, none, none.astype(np.uint64), none.astype(np.uint64), wh, g
    a = at[valid]
    first = np.append(True, a[1:] != a[:-1])
    i = np.nonzero(first)[0]
    s, r = valid[i], np.diff(np.append(i, len(valid)))
    total = np.add.reduceat(fmix64(wh[valid]), i)
    run = fmix64(total ^ (r.astype(np.uint64) << np.uint64(8) | (a[i] - s).astype(np.uint64)))
    return s, r, g[a[i]], run, wh, g


def _emit(kind, key, sub, d, h, s, r) -> pa.RecordBatch:
    n = len(s)
    cols = [np.full(n, kind, np.int32), key.astype(np.uint64).view(np.int64), sub.astype(np.uint64).view(np.int64), d, h, s.astype(np.int32), r.astype(np.int32)]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=["kind", "key", "sub", "d", "h", "s", "r"])


def extend(words: list[bytes], start: list[int], seeds, width: int):
    """(document, first window, windows) of the matches that seeds grow to: maximal, but for what an earlier match of the document covers.

    words: of all documents in turn; start: where each begins, and the end; seeds: (document, place, document of the
    earlier occurrence, its place, words), in order of document and place. A seed inside what has been found is passed
    by and growth to the left ends where found windows begin, so a document costs its length, however often it repeats.
    """
    now, reach = -1, 0
    for d, b, e, a, n in seeds:
        if d != now:
            now, reach = d, 0
        if b + n <= reach:
            continue
        if words[a : a + n] != words[b : b + n]:
            continue  # equal hashes of other words
        low = max(start[d], reach - width + 1)
        while a > start[e] and b > low and words[a - 1] == words[b - 1]:
            a, b, n = a - 1, b - 1, n + 1
        while a + n < start[e + 1] and b + n < start[d + 1] and words[a + n] == words[b + n]:
            n += 1
        reach = b + n
        yield d, b - start[d], n - width + 1


def _block(d: np.ndarray, h: np.ndarray, texts: list[str], width: int) -> Iterator[pa.RecordBatch]:
    order = np.lexsort((h, d))
    keep = np.append(True, (d[order][1:] != d[order][:-1]) | (h[order][1:] != h[order][:-1])) if len(order) else order
    order = order[keep]
    own = [(texts[i] or "").encode().split() for i in order]
    start = np.append(0, np.cumsum([len(w) for w in own])).astype(np.int64)
    words = [w for ws in own for w in ws]
    del own
    x = word_hashes(words)
    s, r, anchor, run, wh, _ = runs_of(x, start, width)
    if not len(s):
        return
    doc = np.searchsorted(start, s, "right") - 1
    dd, hh, at = d[order][doc], h[order][doc], s - start[doc]
    # runs are in order of (document, start); equal runs: the first stays
    o = np.lexsort((np.arange(len(s)), run, anchor))
    new_run = np.append(True, (run[o][1:] != run[o][:-1]) | (anchor[o][1:] != anchor[o][:-1]))
    new_anchor = np.append(True, anchor[o][1:] != anchor[o][:-1])
    kept = o[new_run]
    first = np.empty(len(s), np.int64)
    first[o] = kept[np.cumsum(new_run) - 1]
    cut = np.sort(o[~new_run])
    which = np.cumsum(new_anchor)[new_run] - 1
    several = np.bincount(which)[which] > 1
    zero = np.zeros
    if len(cut):
        seeds = zip(*(v.tolist() for v in (doc[cut], s[cut], doc[first[cut]], s[first[cut]], r[cut] + width - 1)))
        found = np.array(list(extend(words, start.tolist(), seeds, width)), np.int64).reshape(-1, 3)
        fd, fh = d[order][found[:, 0]], h[order][found[:, 0]]
        yield _emit(CUT, fd.view(np.uint64), fh.view(np.uint64), fd, fh, found[:, 1], found[:, 2])
    one = kept[~several]
    yield _emit(RUN, anchor[one], run[one], dd[one], hh[one], at[one], r[one])
    many = kept[several]
    if len(many):
        marks = np.unique(anchor[many])
        z = zero(len(marks), np.int64)
        yield _emit(MARK, marks, zero(len(marks), np.uint64), z, z, z, z)
        inner = np.arange(r[many].sum()) - np.repeat(np.cumsum(r[many]) - r[many], r[many])
        i = np.repeat(many, r[many])
        yield _emit(WINDOW, wh[s[i] + inner], anchor[i], dd[i], hh[i], at[i] + inner, np.ones(len(i), np.int64))


def _scan(df: DataFrame, width: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sizes = [n or 0 for n in pc.binary_length(b.column(2)).to_pylist()]
            for i, j in slices(b.num_rows, sizes, 2_000_000):
                yield from _block(b.column(0).to_numpy()[i:j], b.column(1).to_numpy()[i:j], b.column(2).slice(i, j - i).to_pylist(), width)

    return df.select("d", "h", "t").mapInArrow(trimmed(run, "words"), _SCHEMA)


def _windows(asked: DataFrame, width: int) -> DataFrame:
    """Window rows of the runs asked for; asked: (d, h, z, runs array<struct<key, s, r>>)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for d, h, z, runs in zip(*(c.to_pylist() for c in b.columns)):
                wh = linear_hash(word_hashes(unzip(z).split()), width, 13)
                i = np.concatenate([np.arange(q["s"], q["s"] + q["r"]) for q in runs])
                key = np.repeat(np.array([q["key"] for q in runs], np.int64), [q["r"] for q in runs]).view(np.uint64)
                yield _emit(WINDOW, wh[i], key, np.full(len(i), d, np.int64), np.full(len(i), h, np.int64), i, np.ones(len(i), np.int64))

    return asked.mapInArrow(trimmed(run, "words"), _SCHEMA)


def find_cuts(rows: DataFrame, zips: DataFrame, width: int) -> DataFrame:
    """(d, h, s, r): runs of windows of document (d, h) whose words also start earlier. rows: (d, h, t); zips: (d, h, z)."""
    spark = rows.sparkSession
    me, mark = F.struct("d", "h", "s"), F.col("kind") == MARK
    low, high = F.lit(-(1 << 63)).cast("long"), F.lit((1 << 63) - 1).cast("long")
    scan = materialise(_scan(rows, width), "scan")
    # counted before the exchange, so an anchor that stands in every block sends a row a task; a mark stands for different runs
    meet = scan.filter(f"kind <= {MARK}").groupBy("key").agg(F.count(F.lit(1)).alias("c"), F.min(F.when(mark, low).otherwise(F.col("sub"))).alias("lo"), F.max(F.when(mark, high).otherwise(F.col("sub"))).alias("hi"))
    shared = materialise(meet.filter("c > 1").select("key", F.expr("lo != hi").alias("several")), "anchors")
    release(spark)
    met = materialise(scan.filter(f"kind = {RUN}").join(shared, "key"), "met")
    release(spark)
    later = me > F.col("first")
    kind = F.when(later, CUT).when(F.col("several"), RUN)
    firsts = met.groupBy("key", "sub").agg(F.min(me).alias("first"))
    judged = met.join(firsts, ["key", "sub"]).withColumn("kind", kind).filter("kind IS NOT NULL")
    columns = ("kind", "key", "sub", "d", "h", "s", "r")
    some = materialise(judged.select(*columns).unionByName(scan.filter(f"kind > {MARK}").select(*columns)), "runs")
    discard(scan, shared, met)
    release(spark)
    asked = some.filter(f"kind = {RUN}").groupBy("d", "h").agg(F.collect_list(F.struct("key", "s", "r")).alias("runs"))  # bounded by the document
    read = zips.join(asked, ["d", "h"]).select("d", "h", "z", "runs")
    windows = materialise(some.filter(f"kind = {WINDOW}").unionByName(_windows(read, width)), "windows")
    release(spark)
    firsts = windows.groupBy("key", "sub").agg(F.min(me).alias("first"), F.count(F.lit(1)).alias("c")).filter("c > 1").drop("c")
    cuts = windows.join(firsts, ["key", "sub"]).filter(later).select("d", "h", "s", "r")
    return some.filter(f"kind = {CUT}").select("d", "h", "s", "r").union(cuts)


def dedup(df: DataFrame, width: int = 20, text: str = "text", key: str = "doc_id", keep: bool = True) -> DataFrame:
    """One row for each row: all its columns, n_words, n_removed, kept_sha256 and, if keep, the text without removed words.

    A window is `width` consecutive words of one document; each word covered by a window whose words also start earlier
    (smaller id, or the same document and an earlier start) is removed; windows are judged on the input. Where something
    is removed, the text becomes its kept words joined by one space, else it is unchanged. Null and empty texts and texts
    of fewer words have no window. A null id comes before all others. Rows of one id with different texts are told apart
    by their texts' hashes, which order them; repeated rows (same id, same text) are one document and give equal results.
    An empty table gives no rows. Columns named n_words, n_removed and kept_sha256 are replaced.
    """
    low = F.lit(-(1 << 63)).cast("long")
    others = [c for c in df.columns if c not in (text, "n_words", "n_removed", "kept_sha256")]
    d, h = F.coalesce(F.col(key).cast("long"), low).alias("d"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("h")
    bounded_batches(df.sparkSession)
    base = df.select(d, h, F.col(text).alias("t"))
    zips = zipped(base, ["d", "h"], "t")
    cuts = find_cuts(base, zips, width)
    spans = cuts.groupBy("d", "h").agg(F.collect_set(F.struct("s", "r")).alias("spans"))  # bounded by the document
    carried = df.select(d, h, F.col(text).isNull().alias("none"), F.struct(*others).alias("o"), F.coalesce(text, F.lit("")).alias("t"))
    full = zipped(carried, ["d", "h", "none", "o"], "t").join(spans, ["d", "h"], "left").select("o", "none", "z", "spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, gone, sha, texts = [], [], [], []
            for none, z, spans in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), b.column(3).to_pylist()):
                t = unzip(z).decode()
                words = WORDS.findall(t)
                kept = words
                if spans:
                    edge = np.zeros(len(words) + 1, np.int64)
                    np.add.at(edge, [q["s"] for q in spans], 1)
                    np.add.at(edge, [q["s"] + q["r"] - 1 + width for q in spans], -1)
                    kept = [words[i] for i in np.nonzero(np.cumsum(edge[:-1]) == 0)[0]]
                joined = " ".join(kept)
                n.append(len(words))
                gone.append(len(words) - len(kept))
                sha.append(hashlib.sha256(joined.encode()).hexdigest())
                texts.append(None if none else joined if spans else t)
            cols = [b.column(0), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(sha, pa.string())]
            yield pa.RecordBatch.from_arrays(cols + ([pa.array(texts, pa.string())] if keep else []), names=names)

    o = ", ".join(f"`{c}`: {df.schema[c].dataType.simpleString()}" for c in others)
    fields = [("o", f"struct<{o}>"), ("n_words", "long"), ("n_removed", "long"), ("kept_sha256", "string")] + [("t", "string")] * keep
    names = [x for x, _ in fields]
    out = full.mapInArrow(trimmed(run, "words"), ", ".join(f"{x} {t}" for x, t in fields))
    cols = [F.col("t").alias(text) if c == text else F.col("o")[c].alias(c) for c in df.columns if c in others or keep and c == text]
    return out.select(*cols, "n_words", "n_removed", "kept_sha256")
