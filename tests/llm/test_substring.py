import hashlib
import random

import pytest

from tessera.llm import substring
from tessera.llm.common import WORDS


def brute(rows, width):
    """rows: (id, text), ids told apart and ordered."""
    seen, out = set(), {}
    for k, t in sorted(rows, key=lambda r: -1 if r[0] is None else r[0]):
        w = WORDS.findall(t or "")
        gone = set()
        for i in range(len(w) - width + 1):
            x = tuple(w[i : i + width])
            if x in seen:
                gone.update(range(i, i + width))
            seen.add(x)
        out[k] = (len(w), len(gone), hashlib.sha256(" ".join(v for i, v in enumerate(w) if i not in gone).encode()).hexdigest())
    return out


@pytest.mark.parametrize("width", [1, 3, 8, 20])
def test_against_brute_force(spark, width):
    r = random.Random(width)
    pool = [f"w{i}é" for i in range(60 if width > 3 else 500)]
    passages = [[r.choice(pool) for _ in range(r.randrange(width, 5 * width + 2))] for _ in range(6)]
    rows = []
    for i in range(220):
        w = []
        for _ in range(r.randrange(5)):
            w += [r.choice(pool) for _ in range(r.randrange(30))]
            if r.random() < 0.5:
                p = r.choice(passages)
                a = r.randrange(len(p))
                w += p[a:] if r.random() < 0.3 else p
        rows.append((i * 3 % 1000, r.choice([" ", "\n", " \t"]).join(w)))
    rows += [(2000 + i, rows[3][1]) for i in range(40)] + [(3000, None), (3001, ""), (3002, "a " * 4000), (3003, "a b " * 300), (None, rows[5][1])]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7).selectExpr("*", "1 as d", "2 as h", "3 as n_words", "4 as t")
    got = substring.dedup(df, width)
    assert got.columns == ["doc_id", "text", "d", "h", "t", "n_words", "n_removed", "kept_sha256"]
    x = {g.doc_id: g for g in got.collect()}
    want = brute(rows, width)
    assert {k: (g.n_words, g.n_removed, g.kept_sha256) for k, g in x.items()} == want
    of = dict(rows)
    for k, g in x.items():
        assert g.text == of[k] if not g.n_removed else hashlib.sha256(g.text.encode()).hexdigest() == g.kept_sha256


def test_repeated_rows_and_empty(spark):
    t = " ".join(f"x{i}" for i in range(30))
    df = spark.createDataFrame([(1, t), (1, t), (2, t), (2, "other"), (None, "z")], "doc_id long, text string")
    got = sorted((g.doc_id or 0, g.n_words, g.n_removed) for g in substring.dedup(df, 20).collect())
    assert got == [(0, 1, 0), (1, 30, 0), (1, 30, 0), (2, 1, 0), (2, 30, 30)]
    assert substring.dedup(df.limit(0), 20).count() == 0


def test_seeds_grow_to_maximal_matches():
    r = random.Random(4)
    pool = [b"a", b"b", b"c"]
    for _ in range(200):
        docs = [[r.choice(pool) for _ in range(r.randrange(2, 12))] for _ in range(3)]
        words, start = [w for x in docs for w in x], [0]
        for x in docs:
            start.append(start[-1] + len(x))
        seeds = sorted((d, b, e, a, 2) for d in range(3) for b in range(start[d], start[d + 1] - 1) for e in range(d + 1) for a in range(start[e], start[e + 1] - 1) if a < b and words[a : a + 2] == words[b : b + 2])
        got = list(substring.extend(words, start, seeds, 2))
        covered = {(d, p + i) for d, p, n in got for i in range(n)}
        assert covered == {(d, b - start[d]) for d, b, *_ in seeds} and len(set(got)) <= len(seeds)
    assert list(substring.extend([b"a", b"b", b"c", b"d"], [0, 2, 4], [(1, 2, 0, 0, 2)], 2)) == []  # other words


def test_a_passage_in_every_block(spark, monkeypatch):
    r = random.Random(8)
    passage = [f"p{i}" for i in range(60)]
    plans, write = [], substring.materialise

    def written(df, tag):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return write(df, tag)

    monkeypatch.setattr(substring, "materialise", written)
    rows = []
    for i in range(300):
        own = [f"o{r.randrange(10**6)}" for _ in range(r.randrange(50))]
        a = r.randrange(30)
        cut = passage if i % 3 else passage[a : a + 20 + r.randrange(20)]
        at = r.randrange(len(own) + 1)
        rows.append((i, " ".join(own[:at] + cut + own[at:])))
    rows += [(400 + i, " ".join(passage)) for i in range(30)]
    out = substring.dedup(spark.createDataFrame(rows, "doc_id long, text string").repartition(60), 20)
    got = {g.doc_id: (g.n_words, g.n_removed, g.kept_sha256) for g in out.collect()}
    assert got == brute(rows, 20)
    plans.append(out._jdf.queryExecution().optimizedPlan().toString())
    assert len(plans) >= 5 and not any("Window [" in p for p in plans)
