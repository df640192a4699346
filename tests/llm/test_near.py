import random

import numpy as np

from tessera.llm import embeddings, minhash
from tessera.llm.components import components


def closure(ids, links):
    up = {i: i for i in ids}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def test_components(spark):
    r = random.Random(1)
    links = [(r.randrange(200), r.randrange(200)) for _ in range(120)] + [(i, i + 1) for i in range(300, 340)] + [(5, 5)]
    got = {x.id: x.component for x in components(spark.createDataFrame(links, "a long, b long"), "a", "b").collect()}
    want = closure({x for l in links for x in l}, links)
    assert got == {k: v for k, v in want.items() if k != v}
    assert components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


def sets(text, k):
    w = [x for x in (text or "").encode().lower().split()]
    return {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def test_minhash_against_brute_force(spark):
    r = random.Random(2)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(4))
    rows = []
    for base in range(12):
        w = [word() for _ in range(r.choice([3, 6, 20, 60, 200]))]
        for _ in range(r.randrange(1, 8)):
            v = list(w)
            for _ in range(r.randrange(0, 5)):
                v[r.randrange(len(v))] = word()
            rows.append(" ".join(v))
            if r.random() < 0.3:
                rows.append(" ".join(v).upper())
    rows += [None, "", "  \n", "one", "One", "two words", "a b c d", "a b c d e"]
    r.shuffle(rows)
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string").selectExpr("*", "doc_id as id", "1 as n", "2 as a")
    got = {x.doc_id: x for x in minhash.near_duplicates(df, width=4).collect()}
    s = [sets(t, 4) for t in rows]
    links = [(i, j) for i in range(len(s)) for j in range(i) if s[i] and s[j] and 100 * len(s[i] & s[j]) >= 80 * len(s[i] | s[j])]
    want = closure(range(len(rows)), links)
    assert {k: x.component_id for k, x in got.items()} == want
    assert all(x.n_shingles == len(s[k]) and x.kept == (k == want[k]) for k, x in got.items())
    assert minhash.near_duplicates(df.limit(0)).count() == 0


def test_minhash_rows_without_id_and_repeats(spark):
    df = spark.createDataFrame([(None, "x y z w v"), (None, None), (3, "q r s t u"), (3, "q r s t u"), (4, "Q r s t u")], "doc_id long, text string")
    got = sorted((x.doc_id or 0, x.component_id, x.kept) for x in minhash.near_duplicates(df).collect())
    assert got == [(0, None, True), (0, None, True), (3, 3, True), (3, 3, True), (4, 3, False)]


def test_minhash_ids_with_several_texts(spark):
    r = random.Random(5)
    rows = []
    for i in range(40):  # ids 0 to 39 hold two texts each, and a null one; near copies of both have ids of their own
        for far in (100, 200):
            w = ["".join(r.choice("abcdefgh") for _ in range(4)) for _ in range(80)]
            rows += [(i, " ".join(w)), (far + i, " ".join(w[:-1] + ["end"]))]
        rows.append((i, None))
    rows += [(300, rows[0][1]), (300, "another text of id three hundred"), (301, "another text of id three hundred")]  # its least ids differ
    for turn in range(2):
        df = spark.createDataFrame(rows, "doc_id long, text string")
        got = {(x.doc_id, x.component_id, x.kept) for x in minhash.near_duplicates(df, width=4).collect()}
        want = {k: 0 if k >= 300 else k % 100 for k, _ in rows}
        assert got == {(k, c, k == c) for k, c in want.items()}
        rows = rows[::-1]


def test_estimate_is_near_the_truth():
    r = np.random.default_rng(0)
    for j in (0.2, 0.5, 0.8, 0.95):
        err = []
        for _ in range(40):
            h = np.unique(r.integers(0, 2**64, 3000, dtype=np.uint64))
            n = round(2000 * j)
            a, b = np.sort(h[r.permutation(len(h))[:2000]]), None
            b = np.sort(np.concatenate([a[r.permutation(2000)[: round(2 * 2000 * j / (1 + j))]], r.integers(0, 2**64, 2000 - round(2 * 2000 * j / (1 + j)), dtype=np.uint64)]))
            err.append(minhash.estimate(minhash.registers(a), minhash.registers(b)) - j)
        assert abs(np.mean(err)) < 0.02 and np.std(err) < 0.05, (n, j)


def test_embeddings_against_brute_force(spark):
    r = np.random.default_rng(4)
    base = r.normal(size=(30, 16))
    x = np.concatenate([base[r.integers(0, 30, 250)] + 0.12 * r.normal(size=(250, 16)), base[:5], base[:5], 2 * base[:3]]).astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    rows += [(500, None), (501, [0.0] * 16), (502, [float("nan")] * 16), (503, [1.0, None] + [0.0] * 14), (504, []), (505, [1.0, 2.0]), (506, [2.0, 4.0]), (507, [float("inf")] * 16), (508, x[0].tolist())]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "1 as n", "2 as id", "3 as label")
    valid = {i: np.array(v, float) for i, v in rows if v and None not in v and np.isfinite(v).all() and any(v)}
    links = [(i, j) for i in valid for j in valid if i < j and len(valid[i]) == len(valid[j]) and valid[i] @ valid[j] / (np.linalg.norm(valid[i]) * np.linalg.norm(valid[j])) >= 0.9]
    want = closure([i for i, _ in rows], links)
    n = {i: 0 for i, _ in rows}
    for a, b in links:
        n[a] += 1
        n[b] += 1
    for block in (64, 8192):
        got = {g.vec_id: g for g in embeddings.near_duplicates(df, 0.9, block=block).collect()}
        assert {k: g.component_id for k, g in got.items()} == want
        assert {k: g.n_links for k, g in got.items()} == n
        assert all(g.kept == (k == want[k]) for k, g in got.items())
    assert embeddings.near_duplicates(df.limit(0)).count() == 0


def test_error_bound_is_never_too_small():
    r = np.random.default_rng(6)
    for d in (3, 64, 1500):
        x, y = r.normal(size=(100, d)), r.normal(size=(100, d))
        (ca, sa, ea), (cb, sb, eb) = embeddings.quantise(x), embeddings.quantise(y)
        true = (x / np.linalg.norm(x, axis=1)[:, None]) @ (y / np.linalg.norm(y, axis=1)[:, None]).T
        got = (ca.astype(int) @ cb.astype(int).T) * sa[:, None] * sb
        assert (np.abs(true - got) <= ea[:, None] + eb + 3 * ea[:, None] * eb + 1e-12).all()


def test_vectors_at_the_ends_of_the_double_range(spark):
    rows = [(1, [1e308, 1e308]), (2, [1.0, 1.0]), (3, [1e-200, 0.0]), (4, [5e-324, 0.0]), (5, [1.7e308, -1.7e308]), (6, [0.0, -0.0]), (7, [1e308, 1e308]), (8, [2e-308, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {r.vec_id: (r.n_links, r.component_id) for r in embeddings.near_duplicates(df, 0.9).collect()}
    assert got == {1: (2, 1), 2: (2, 1), 7: (2, 1), 3: (1, 3), 4: (1, 3), 5: (0, 5), 6: (0, 6), 8: (0, 8)}
