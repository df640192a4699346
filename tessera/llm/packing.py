"""Packing token pieces into sequences of a fixed capacity: dominance reduction, then best fit.

Whole counts of lengths decide everything: a histogram has at most `capacity` entries whatever the input is. The driver
fixes small sets of lengths that provably dominate every alternative (Martello and Toth), packs the remainder best-fit
decreasing, both for all pieces of a length at once, and gets a few patterns with multiplicities. Pieces then find their
place by their rank among the pieces of their length, which is counted in salted parts. Pieces that fill a sequence need no rank.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, bisect_right
from collections import Counter, defaultdict
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tessera.llm.common import bounded_batches, free_name, trimmed
from tessera.llm.tokens import encoder, slices

Bins = Counter  # pattern (sorted tuple of (length, times)) -> number of sequences


def _pattern(*lengths: int) -> tuple:
    return tuple(sorted(Counter(lengths).items(), reverse=True))


def reduce_dominated(counts: dict[int, int], capacity: int) -> tuple[Bins, dict[int, int]]:
    """Fix sets that some optimal packing has; returns them and what is left.

    For a length j with room r beside it, the set {j}, or {j, k} with k the longest that fits, is fixed if it dominates
    every feasible set with j: nothing else fits; k fills r; only one more piece fits; or any two that fit beside j are
    together no longer than k, and three do not fit.
    """
    left = {s: n for s, n in counts.items() if n}
    bins: Bins = Counter()

    def take(n: int, *lengths: int) -> None:
        bins[_pattern(*lengths)] += n
        for s in lengths:
            left[s] -= n
            if not left[s]:
                del left[s]

    changed = True
    while changed:
        changed = False
        for j in sorted(left, reverse=True):
            while j in left:
                r = capacity - j
                others = sorted(s for s in left if s <= r and (s != j or left[j] > 1))
                if not others:
                    take(left[j], j)
                    changed = True
                    break
                k = others[-1]
                n = left[j] // 2 if k == j else min(left[j], left[k])
                smallest: list[int] = []  # the three shortest pieces other than one of j
                for s in others[:3]:
                    smallest += [s] * min(3, left[s] - (s == j))
                if not (k == r or len(smallest) < 2 or smallest[0] + smallest[1] > r or (len(smallest) < 3 or sum(smallest[:3]) > r) and _best_pair(others, left, j, r) <= k):
                    break
                take(n, j, k)
                changed = True
    return bins, left


def _best_pair(others: list[int], left: dict[int, int], j: int, r: int) -> int:
    """The greatest sum, r at most, of two pieces other than one of length j; 0 if no two fit."""
    best, lo, hi = 0, 0, len(others) - 1
    while lo <= hi:
        a, b = others[lo], others[hi]
        if a + b > r:
            hi -= 1
        else:
            if lo < hi or left[a] - (a == j) > 1:
                best = max(best, a + b)
            lo += 1
    return best


def best_fit(counts: dict[int, int], capacity: int) -> Bins:
    """Best-fit decreasing, all pieces of a length at once."""
    room: dict[int, Counter] = defaultdict(Counter)

    def put(p: tuple, n: int, space: int, s: int, times: int) -> None:
        if n:
            room[space - s * times][tuple(sorted((Counter(dict(p)) + Counter({s: times})).items(), reverse=True))] += n

    for s in sorted(counts, reverse=True):
        c = counts[s]
        for space in sorted(x for x in room if x >= s):
            q = space // s
            for p in sorted(room[space]):
                if not c:
                    break
                n = room[space].pop(p)
                full = min(n, c // q)
                put(p, full, space, s, q)
                c -= full * q
                n -= full
                if n and c:  # fewer than q are left
                    put(p, 1, space, s, c)
                    n, c = n - 1, 0
                if n:
                    room[space][p] += n
            if not room[space]:
                del room[space]
            if not c:
                break
        q = capacity // s
        put((), c // q, capacity, s, q)
        put((), bool(c % q), capacity, s, c % q)
    out: Bins = Counter()
    for x in room.values():
        out.update(x)
    return out


def solve(counts: dict[int, int], capacity: int) -> Bins:
    fixed, left = reduce_dominated(counts, capacity)
    return fixed + best_fit(left, capacity)


def token_pieces(df: DataFrame, vocabulary: str, end_id: int, capacity: int, text: str = "text", key: str = "doc_id", ids: bool = False) -> DataFrame:
    """Rows (key, piece, start, length, ids_crc32, and ids if asked for) of each document's ids with end_id after them.

    Documents of at most capacity ids are one piece; longer ones are cut into pieces of capacity, only the first of
    which may be shorter. Null and empty texts have end_id alone. Repeated rows are cut alike; an empty table gives none;
    other columns are not read.
    """
    bounded_batches(df.sparkSession)
    kind = df.schema[key].dataType.simpleString()
    end = end_id.to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        e = encoder(vocabulary)
        for b in batches:
            sizes = [n or 0 for n in pc.binary_length(b.column(1)).to_pylist()]
            for i, j in slices(b.num_rows, sizes):
                which, piece, start, length, crc, parts = [], [], [], [], [], []
                for row, got in enumerate(e.ids(b.column(1).slice(i, j - i).to_pylist()), i):
                    got += end
                    n, at, k = len(got) // 4, 0, 0
                    while at < n:
                        size = (n - at - 1) % capacity + 1
                        part = got[4 * at : 4 * (at + size)]
                        for c, v in zip((which, piece, start, length, crc), (row, k, at, size, zlib.crc32(part))):
                            c.append(v)
                        if ids:
                            parts.append(np.frombuffer(part, "<i4"))
                        at, k = at + size, k + 1
                cols = [b.column(0).take(pa.array(which, pa.int32())), pa.array(piece, pa.int32()), *(pa.array(c, pa.int64()) for c in (start, length, crc))]
                yield pa.RecordBatch.from_arrays(cols + ([pa.array(parts, pa.list_(pa.int32()))] if ids else []), names=names)

    fields = [(key, kind), ("piece", "int"), ("start", "long"), ("length", "long"), ("ids_crc32", "long")] + [("ids", "array<int>")] * ids
    names = [n for n, _ in fields]
    return df.select(key, text).mapInArrow(trimmed(run, "encoders"), ", ".join(f"{n} {t}" for n, t in fields))


def pack(pieces: DataFrame, capacity: int, length: str = "length", order: tuple[str, ...] = ("doc_id", "piece"), rows_a_salt: int = 200_000) -> DataFrame:
    """All columns and sequence_id, offset (long). pieces is read several times: give a materialised table.

    Lengths are from 1 to capacity; a piece of null, less or more raises. order: columns that tell pieces apart; rows
    equal in them are placed all the same, in any order among themselves. Columns sequence_id and offset are replaced;
    others are kept, whatever their names. An empty table gives no rows. Pieces of full capacity are sequences of their
    own and are not ranked; the pieces of another length are ranked in salted parts of about rows_a_salt rows, so no task
    grows with the input. The driver sees the counts of lengths, of at most rows / rows_a_salt + capacity parts, and the
    patterns, whose number is bounded by the lengths.
    """
    spark = pieces.sparkSession
    s_, p_, part_, rank_, at_ = (free_name(pieces, x) for x in ("_s", "_p", "_part", "_r", "_g"))
    size = F.col(f"`{length}`").cast("int")
    counts = {r.s: r["count"] for r in pieces.groupBy(size.alias("s")).count().collect()}  # capacity rows at most, else it raises
    for s in counts:
        if s is None or not 1 <= s <= capacity:
            raise ValueError(f"a piece has length {s}; lengths are from 1 to {capacity}")
    counts.pop(capacity, None)
    bins = solve(counts, capacity)
    segments: dict[int, list] = defaultdict(list)  # of each length: (first rank, first sequence, times in it, first offset)
    ranks, sequence = Counter(), 0
    for p in sorted(bins):
        at = 0
        for s, times in p:
            segments[s].append((ranks[s], sequence, times, at))
            ranks[s] += bins[p] * times
            at += s * times
        sequence += bins[p]
    salts = {s: -(-n // rows_a_salt) for s, n in counts.items()}
    table_of = F.create_map(*(F.lit(x) for kv in salts.items() for x in kv)) if salts else F.create_map().cast("map<int,int>")
    salt = F.pmod(F.xxhash64(*order), F.coalesce(F.try_element_at(table_of, size), F.lit(1)).cast("long")).cast("int")
    others = pieces.drop("sequence_id", "offset").filter(size != capacity).withColumns({s_: size, p_: salt})
    parts: dict[int, list] = defaultdict(list)
    for r in others.groupBy(s_, p_).count().collect():
        parts[r[0]].append((r[1], r["count"]))
    rows = []
    for s, x in parts.items():
        before = 0
        firsts = [g[0] for g in segments[s]]
        for p, n in sorted(x):  # a part gets the segments that its ranks meet
            rows.append((s, p, (before, [list(g) for g in segments[s][bisect_right(firsts, before) - 1 : bisect_left(firsts, before + n)]])))
            before += n
    places = spark.createDataFrame(rows, f"`{s_}` int, `{p_}` int, `{part_}` struct<before: bigint, segments: array<array<bigint>>>")
    got = others.join(F.broadcast(places), [s_, p_])  # as many rows as there are parts
    got = got.withColumn(rank_, F.col(part_)["before"] + F.row_number().over(Window.partitionBy(s_, p_).orderBy(*order)) - 1)
    got = got.withColumn(at_, F.element_at(F.filter(F.col(part_)["segments"], lambda g: g[0] <= F.col(rank_)), -1))
    g, inside = F.col(at_), F.col(rank_) - F.col(at_)[0]
    got = got.withColumns({"sequence_id": g[1] + F.floor(inside / g[2]), "offset": g[3] + (inside % g[2]) * size})
    full = pieces.drop("sequence_id", "offset").filter(size == capacity).withColumns({"sequence_id": F.monotonically_increasing_id() + sequence, "offset": F.lit(0).cast("long")})
    return full.unionByName(got.drop(s_, p_, part_, rank_, at_))


def sequences(packed: DataFrame, ids: str = "ids") -> DataFrame:
    """One row for each sequence: its ids in order. A sequence has capacity ids at most, so a group is bounded."""
    parts = F.array_sort(F.collect_list(F.struct(F.col("offset"), F.col(ids).alias("ids"))))
    return packed.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda p: p["ids"])).alias("ids"))
