import random
from collections import Counter

import public_tokenizers
from tokenizers import Tokenizer

from tessera.llm import packing


def check(bins, counts, capacity):
    got = Counter()
    for p, n in bins.items():
        assert n > 0 and sum(s * t for s, t in p) <= capacity
        for s, t in p:
            got[s] += n * t
    assert got == Counter({s: n for s, n in counts.items() if n})


def optimum(items, capacity):
    """Fewest bins by search over all assignments, largest first."""
    items = sorted(items, reverse=True)
    best = len(items)

    def go(i, room):
        nonlocal best
        if len(room) >= best:
            return
        if i == len(items):
            best = len(room)
            return
        for r in sorted(set(room)):
            if r >= items[i]:
                k = room.index(r)
                go(i + 1, room[:k] + [r - items[i]] + room[k + 1 :])
        go(i + 1, [*room, capacity - items[i]])

    go(0, [])
    return best


def test_solve_uses_each_piece_once():
    r = random.Random(5)
    for _ in range(200):
        c = r.choice([5, 10, 50, 1024])
        counts = {r.randint(1, c): r.choice([0, 1, 2, 7, 1000]) for _ in range(r.randrange(12))}
        bins = packing.solve(counts, c)
        check(bins, counts, c)
        assert sum(bins.values()) >= -(-sum(s * n for s, n in counts.items()) // c)


def test_reduction_keeps_the_optimum():
    r = random.Random(7)
    for _ in range(150):
        items = [r.randint(1, 20) for _ in range(r.randrange(1, 9))]
        fixed, left = packing.reduce_dominated(dict(Counter(items)), 20)
        rest = [s for s, n in left.items() for _ in range(n)]
        assert sum(fixed.values()) + optimum(rest, 20) == optimum(items, 20), items
    assert packing.solve({}, 8) == Counter() and packing.solve({8: 3}, 8) == Counter({((8, 1),): 3})


def test_best_fit_matches_one_by_one():
    r = random.Random(9)
    for _ in range(100):
        items = sorted((r.randint(1, 30) for _ in range(40)), reverse=True)
        room = []
        for s in items:
            k = min((x for x in room if x >= s), default=None)
            if k is None:
                room.append(30 - s)
            else:
                room.remove(k)
                room.append(k - s)
        assert sum(packing.best_fit(dict(Counter(items)), 30).values()) == len(room)


def test_pack_places_every_piece(spark):
    path = public_tokenizers.path("byte_bpe_50k.json")
    t = Tokenizer.from_file(path)
    texts = [None, "", "same", "same", "long " * 300, "x" * 50, *(f"doc {i} " * (i % 90) for i in range(300))]
    rows = [(None if i == 4 else i - (i == 3), x) for i, x in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "0 as offset", "0 as length")
    pieces = packing.token_pieces(df, path, 2, 64, ids=True).cache()
    packed = packing.pack(pieces, 64)
    got = packed.collect()
    assert len(got) == pieces.count()
    by = {}
    for r in got:
        by.setdefault(r.sequence_id, []).append(r)
    for x in by.values():
        at = 0
        for r in sorted(x, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 64
    want = Counter(tuple(t.encode(x or "", add_special_tokens=False).ids + [2]) for _, x in rows)
    docs = {}
    for r in got:
        assert r.length == 64 or r.piece == 0
        docs.setdefault(r.doc_id, []).append(r)
    whole = Counter()
    for k, x in docs.items():
        if k != 2:
            whole[tuple(i for r in sorted(x, key=lambda r: r.start) for i in r.ids)] += 1
        else:  # two documents of this id, both one piece
            whole.update(tuple(r.ids) for r in x)
    assert whole == want
    total = sum(r.length for r in got)
    assert len(by) <= -(-total // 64) * 1.05 + 1
    assert sum(len(r.ids) for r in packing.sequences(packed).collect()) == total


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id long, piece int, length long")
    assert packing.pack(df, 64).count() == 0


def test_salted_parts_and_clashing_columns(spark):
    r = random.Random(3)
    rows = [(i // 3, i % 3, r.choice([1, 5, 5, 5, 7, 16, 16, 9, 2])) for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, piece int, length long").selectExpr("*", "'a' as _s", "'b' as _p", "'c' as _part", "'d' as _r", "'e' as _g", "0 as sequence_id")
    got = packing.pack(df, 16, rows_a_salt=50).collect()
    assert len(got) == 3000 and all((x._s, x._p, x._part, x._r, x._g) == tuple("abcde") for x in got)
    by = {}
    for x in got:
        by.setdefault(x.sequence_id, []).append((x.offset, x.length))
    for x in by.values():
        at = 0
        for o, n in sorted(x):
            assert o == at
            at += n
        assert at <= 16
    assert len(by) == sum(packing.solve(dict(Counter(x[2] for x in rows)), 16).values())
