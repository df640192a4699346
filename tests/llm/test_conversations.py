import hashlib
import heapq
import random
import re
import zlib
from itertools import count

import pytest

from tessera.llm import conversations as C

GRAMMAR = re.compile("(s?(ua)+)?")
#: How far a role string that the grammar can still complete has come: 0 begin, 1 after s, 2 after u, 3 after a.
AFTER = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (3, "u"): 2, (2, "a"): 3}


def plain_damage(rows):
    for conv, turn, role, text in rows:
        said = lambda x: " " if x is None else str(x)
        k = zlib.crc32(f"{said(conv)}:{said(turn)}".encode()) % 20
        role, text = "user" if k == 4 else said(role), "" if k == 1 else said(text)
        text = re.sub("[.!?]", "", text) if k == 2 else text
        yield from [(conv, turn, role, text)] * (0 if k == 0 else 2 if k == 3 else 1)


def cheapest_audit(rows):
    """Best-first search over edits of rows (initial, must go, extra cost): an independent way to the least (cost, audit)."""
    queue, seen = [(0, "", 0, 0)], set()
    while queue:
        cost, audit, at, state = heapq.heappop(queue)
        if (at, state) in seen:
            continue
        seen.add((at, state))
        if at == len(rows) and state in (0, 3):
            return cost, audit
        made = AFTER[state, "a" if state == 2 else "u"]
        heapq.heappush(queue, (cost + 3, audit + "I", at, made))
        if at < len(rows):
            initial, gone, extra = rows[at]
            heapq.heappush(queue, (cost + 4, audit + "D", at + 1, state))
            if not gone:
                heapq.heappush(queue, (cost + 3 + extra, audit + "R", at + 1, made))
                if (state, initial) in AFTER:
                    heapq.heappush(queue, (cost + extra, audit + "K", at + 1, AFTER[state, initial]))


def plain_repair(rows, ids=()):
    by = {k: [] for k in ids}
    for conv, turn, role, text in rows:
        by.setdefault(conv, []).append((turn is not None, turn or 0, " " if role is None else role, hashlib.sha256((" " if text is None else text).encode()).digest(), " " if text is None else text))
    for conv, found in by.items():
        found.sort()
        n, seen, symbols = dict.fromkeys(("blank", "duplicate", "truncated"), 0), set(), []
        for _, _, role, _, text in found:
            said = text.strip(" \t\n\v\f\r")
            fault = "blank" if not said else "duplicate" if (role, text) in seen else "truncated" if said[-1] not in ".!?" else ""
            seen.add((role, text))
            if fault:
                n[fault] += 1
            symbols.append((role[:1], fault in ("blank", "duplicate"), 3 * (fault == "truncated")))
        illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(symbols, symbols[1:]))
        cost, audit = cheapest_audit(symbols)
        turns = {t for there, t, *_ in found if there}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        system = (len(audit) - audit.count("D")) % 2
        out, at = [], 0
        for edit in audit:
            role, text = (None, None) if edit == "I" else (found[at][2], found[at][4])
            at += edit != "I"
            if edit in "RI":
                role = "assistant" if (len(out) - system) % 2 else "user"
            if edit != "D":
                out.append((role, text or ""))
        assert GRAMMAR.fullmatch("".join(r[:1] for r, _ in out))
        yield conv, gaps, *n.values(), illegal, cost, audit, hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest()


def random_rows(n, seed, convs=40):
    r = random.Random(seed)
    texts = ["", " ", "\t\n", None, "Yes.", "No", "Why? ", "é!", "tail\u00a0", "x." * 400]
    return [(r.choice([None, *range(convs)]), r.choice([None, *range(9)]), r.choice(["system", "user", "user", "assistant", "assistant", "tool", "", None]), r.choice(texts)) for _ in range(n)]


def test_layers_against_best_first_search():
    r = random.Random(4)
    for _ in range(4000):
        s = "".join(r.choice("suaoSUAOxua") for _ in range(r.randrange(12)))
        rows = [(x.lower(), x == "x", 3 * (x != x.lower())) for x in s]
        assert C.cheapest(C.walk(s, C.begin())) == cheapest_audit(rows), s


def test_parts_of_a_conversation_join_to_the_whole():
    r = random.Random(5)
    s = "".join(r.choice("suaoSUAOxua") for _ in range(3000))
    for width in (1, 7, 640):
        layer = C.begin()
        for i in range(0, len(s), width):
            layer = C.joined(layer, C.paths(s[i : i + width], False))
        assert layer == C.walk(s, C.begin())


@pytest.mark.parametrize("n, seed", [(300, 1), (1500, 2)])
def test_repair_of_random_rows(spark, n, seed):
    rows = random_rows(n, seed)
    df = spark.createDataFrame([(*x, 1) for x in rows], "conv_id long, turn int, role string, text string, audit int")
    ids = [r[0] for r in rows] + [7000]
    got = C.repair(df, spark.createDataFrame([(i,) for i in ids], "conv_id long"))
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, plain_repair(rows, set(ids))))
    damaged = C.damage(df).collect()
    assert sorted(map(str, map(tuple, damaged))) == sorted(map(str, plain_damage(rows)))


def test_one_conversation_over_many_partitions(spark):
    """A conversation that holds nearly all rows is cut into parts; ties and repeats lie on both sides of cuts."""
    r = random.Random(6)
    rows = [(1, r.choice([None, r.randrange(1500)]), r.choice(["user", "assistant", "system"]), f"{r.randrange(900)}{r.choice('.?x')}") for _ in range(4000)] + [(2, 0, "user", "a.")]
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    try:
        df = spark.createDataFrame(rows, "conv_id int, turn long, role string, text string")
        assert C._parts(df, "int").filter("conv_id = 1").count() > 5
        assert sorted(map(tuple, C.repair(df).collect())) == sorted(plain_repair(rows))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_repaired_rows_and_empty_table(spark):
    rows = [("c", 0, "assistant", "Hi."), ("c", 1, "user", "cut"), ("d", 0, "user", ""), ("e", 0, "system", "s."), ("e", 1, "user", "u."), ("e", 2, "assistant", "a.")]
    df = spark.createDataFrame(rows, "conv_id string, turn long, role string, text string")
    got = sorted(map(tuple, C.repair(df, output="rows").collect()))
    assert got == [("c", 0, "user", ""), ("c", 1, "assistant", "Hi."), ("e", 0, "system", "s."), ("e", 1, "user", "u."), ("e", 2, "assistant", "a.")]
    assert C.repair(df.limit(0), df.limit(0)).count() == 0
    assert C.repair(df.limit(0), df.select("conv_id")).filter("audit = '' AND cost = 0 AND gaps = 0").count() == 3
