"""Sharding by histogram sort, with DataFrame functions only.

Rows are ordered by a 64-bit key. Splitters between shards are found by counting exactly the bytes and rows below
candidate boundaries: a first histogram over the top bits of the key, then finer ones only inside the cells that hold a
splitter, until each splitter is within tolerance or its cell is a single key. The rows are exchanged once, for their
slots; the same counts give each cell's first slot, so a shard is never gathered in one task.
"""

from __future__ import annotations

from bisect import bisect_left
from itertools import accumulate

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import free_name

REFINE_BITS = 4


def _cells(df: DataFrame, key: str, size: str, depth: int, within: list[int] | None = None) -> list[tuple[int, int, int]]:
    """(cell, bytes, rows) in key order; at most 2**depth or len(within) * 2**REFINE_BITS rows."""
    if within is not None:
        df = df.filter(F.shiftright(key, 64 - depth + REFINE_BITS).isin(within))
    cell = F.shiftright(key, 64 - depth) if depth < 64 else F.col(key)
    got = df.groupBy(cell.alias("cell")).agg(F.sum(size).alias("b"), F.count(F.lit(1)).alias("n")).collect()
    return sorted((r.cell, r.b, r.n) for r in got)


def find_splitters(df: DataFrame, num_shards: int, key: str, size: str, tolerance: float, probe_bits: int):
    """First keys of shards 1 .. num_shards - 1 with the rows below each, and the first histogram."""
    first = _cells(df, key, size, probe_bits)
    total = sum(b for _, b, _ in first)
    allowed = tolerance * total / num_shards
    found: dict[int, tuple[int, int]] = {}
    # cells to look into: (depth, cells, bytes below, rows below, targets)
    work = [(probe_bits, first, 0, 0, [(j, total * j / num_shards) for j in range(1, num_shards)])]
    while work:
        finer: dict[int, list] = {}
        for depth, cells, b0, n0, targets in work:
            below = list(accumulate((b for _, b, _ in cells), initial=b0))
            rows = list(accumulate((n for _, _, n in cells), initial=n0))
            for j, t in targets:
                i = min(max(bisect_left(below, t) - 1, 0), len(cells) - 1)
                if not cells:
                    found[j] = (1 << 64, 0)
                    continue
                c = cells[i][0]
                low, high = abs(t - below[i]), abs(below[i + 1] - t)
                if min(low, high) <= allowed or depth == 64:
                    k = i if low <= high else i + 1
                    found[j] = ((c + (k > i)) << (64 - depth), rows[k])
                else:
                    finer.setdefault(depth, []).append((c, below[i], rows[i], (j, t)))
        work = []
        for depth, wanted in finer.items():
            active = sorted({c for c, *_ in wanted})
            children = _cells(df, key, size, depth + REFINE_BITS, active)
            for c in active:
                own = [x for x in wanted if x[0] == c]
                work.append((depth + REFINE_BITS, [x for x in children if x[0] >> REFINE_BITS == c], own[0][1], own[0][2], [x[3] for x in own]))
    return [found[j] for j in range(1, num_shards)], first


def shard_by_bytes(df: DataFrame, num_shards: int, key: str, size: str, order: tuple[str, ...] = (), tolerance: float = 0.001, probe_bits: int = 12) -> DataFrame:
    """Add shard (0 .. num_shards - 1) and slot (gapless from 0 in each shard) so that bytes per shard are near equal.

    key: a long, not null, hashed so that its values are spread; size: a long, not null. order: columns that order rows
    of equal keys. Rows with the same key stay together: whole repeats of a row share a shard. The scan is repeated
    for each round of counting (one or two), so give a materialised table. tolerance: the distance of a splitter from
    its target that is accepted, in shards; a single row or key above it is never cut. Empty input: no rows. Columns
    shard and slot are replaced; others are kept, whatever their names.
    probe_bits: a multiple of REFINE_BITS; the first histogram has at most 2**probe_bits cells.
    """
    splitters, histogram = find_splitters(df, num_shards, key, size, tolerance, probe_bits)
    keys = [k for k, _ in splitters]
    starts = [0] + [n for _, n in splitters]
    rows, n0 = [], 0
    for c, _, n in histogram:
        low, high = c << (64 - probe_bits), (c + 1) << (64 - probe_bits)
        base = sum(k <= low for k in keys)
        inner = [k for k in keys if low < k < high]
        rows.append((c, base, inner, [n0 - starts[base]] + [0] * len(inner)))
        n0 += n
    cell, base, inner, first, k, at = (free_name(df, x) for x in ("_cell", "_base", "_inner", "_first", "_k", "_at"))
    cells = df.sparkSession.createDataFrame(rows, f"{cell} long, {base} int, {inner} array<bigint>, {first} array<bigint>")
    got = df.drop("shard", "slot").withColumn(cell, F.shiftright(key, 64 - probe_bits)).join(F.broadcast(cells), cell)  # at most 2**probe_bits rows
    got = got.withColumn(k, F.size(F.filter(inner, lambda s: s <= F.col(key)))).withColumn("shard", F.col(base) + F.col(k))
    got = got.withColumn(at, F.row_number().over(Window.partitionBy(cell, "shard").orderBy(key, *order)))
    got = got.withColumn("slot", F.get(first, F.col(k)) + F.col(at) - 1)
    return got.drop(cell, base, inner, first, k, at)
