import random

import numpy as np

from tessera.llm import langid, quality, sharding, toxicity

ROWS = [None, "", " ", "one word", "a b c " * 30, "x" * 3000, "line\nline\nother\nline", "## $$ || <b>", "LOUD!! " * 60, "same", "same"]


def test_quality_figures_and_verdict(spark):
    df = spark.createDataFrame(list(enumerate(ROWS)), "doc_id long, text string").selectExpr("*", "1 as kept", "2 as n_words")
    got = {r.doc_id: r for r in quality.cascade(df, figures=("n_words", "n_dup_lines", "n_repeat_words", "n_symbols")).collect()}
    assert len(got) == len(ROWS)
    assert (got[4].n_words, got[4].n_repeat_words) == (90, 90) and not got[4].kept
    assert got[6].n_dup_lines == 2 and got[7].n_symbols == 8 and got[0].n_words == 0
    measured = quality.measure(ROWS, quality.RULES, (quality.TOO_SHORT,))
    assert {r.name for r in quality.order_rules(measured, quality.RULES)} == {r.name for r in quality.RULES}
    cheap, dear, idle = (quality.Rule(x, None) for x in ("cheap", "dear", "idle"))
    assert quality.order_rules({"idle": (0.1, 0), "dear": (9.0, 9), "cheap": (0.5, 5)}, (idle, dear, cheap)) == (cheap, dear, idle)
    assert quality.cascade(df.limit(0)).count() == 0


def test_costly_rules_and_short_circuit(spark):
    r = random.Random(3)
    words = [f"w{i}" for i in range(400)]
    passage = r.sample(words, 30)
    texts = [" ".join(r.choice(words) for _ in range(100)), " ".join(passage * 3 + ["end"] * 2), "one pair " + " ".join(f"{r.choice(words)} one pair" for _ in range(60))]
    df = spark.createDataFrame([*enumerate(texts), (None, texts[0]), (7, texts[0])], "doc_id long, text string")
    got = [(x.doc_id, x.kept, x.n_long_repeats, x.n_top_pair) for x in quality.cascade(df, figures=("n_long_repeats", "n_top_pair"), sample_rows=2).orderBy("doc_id").collect()]
    assert [g[1] for g in got] == [True, True, False, False, True] and got[2][2] == 90 and got[3][3] == 61
    seen = []
    never = quality.Rule("never", lambda s: bool(seen.append(s)))
    always = quality.Rule("always", lambda s: True)
    assert not any(quality.measure(["a b"], (never,), (always,))["never"]) and not seen


def test_toxicity_learns_stems_and_exceptions(spark):
    r = random.Random(1)
    word = lambda: "".join(r.choice("bcdfglmnprst") + r.choice("aeiou") for _ in range(3))
    rows = []
    for i in range(300):
        w = [word() for _ in range(40)]
        if i % 5 == 0:
            w[r.randrange(40)] = r.choice(["vileword", "vilewords", "v1leword"])
        rows.append((i, " ".join(w), int(i % 5 == 0)))
    rows += [(1000, None, 0), (1001, "", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxicity int")
    lex = toxicity.fit(docs, docs.select("doc_id", docs.toxicity.alias("toxic")), evidence=15.0)
    assert any(s.startswith(" vile") for s in lex.weights)
    got = {x.doc_id: x.toxicity for x in toxicity.score(docs, lex).collect()}
    assert all((got[k] >= 0.5) == bool(y) for k, _, y in rows)
    own = toxicity.Lexicon({" trash": 5.0}, ("trash can",), 1.0, 2.0)
    a = own.automaton()
    assert own.raw(a, "the trash can is full") == 0 and own.raw(a, "you TR4SH") > 0
    empty = docs.limit(0)
    assert toxicity.score(empty, toxicity.fit(empty, empty.selectExpr("doc_id", "1 as toxic"))).count() == 0


def test_toxicity_of_few_labels(spark):
    r = random.Random(2)
    word = lambda: "".join(r.choice("bcdfglmnprst") + r.choice("aeiou") for _ in range(5))
    rows = [(i, " ".join(word() for _ in range(40)) + (" vileword" if i % 8 == 0 and i < 48 else ""), int(i % 8 == 0)) for i in range(80)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    lex = toxicity.fit(docs, docs.select("doc_id", "toxic"))  # 6 of 10 toxic rows share a stem
    assert any(s.startswith(" vile") for s in lex.weights)
    got = {x.doc_id: x.toxicity >= 0.5 for x in toxicity.score(docs, lex).collect()}
    assert got == {k: "vileword" in t for k, t, _ in rows}
    none = toxicity.fit(docs, docs.filter("doc_id < 16").select("doc_id", "toxic"))  # 2 toxic rows: nothing to learn
    assert not none.weights and all(x.toxicity < 0.5 for x in toxicity.score(docs, none).collect())
    y = np.array([0.0, 1.0, 0.0, 1.0])
    for x in (np.zeros(4), np.full(4, 3.0), np.array([2.0, 0.0, 2.0, 0.0])):  # equal figures, and figures that point the other way
        curve = toxicity.Lexicon({}, (), *toxicity.logistic(x, y))
        assert all(curve.score(v) < 0.5 for v in (0.0, 3.0, 1e6))


def test_language(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    model = langid.fit(docs.filter("doc_id % 4 != 2"))
    got = langid.identify(docs.filter("doc_id % 4 = 2"), model).collect()
    assert sum(r.lang == r.lang_pred for r in got) >= 0.95 * len(got) and all(0 <= r.lang_score <= 1 for r in got)
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "12 34!"), (4, "x" * 200000)], "doc_id long, text string")
    assert [r.lang_pred == "und" for r in langid.identify(odd, model).orderBy("doc_id").collect()] == [True, True, True, False]
    assert langid.fit(docs.limit(0)) is None and langid.identify(docs.limit(0), None).count() == 0


def test_many_languages_have_landmarks(spark):
    r = random.Random(4)
    rows = []
    for j in range(190):
        own = ["".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(5)) for _ in range(30)]
        rows += [(6 * j + i, " ".join(r.choice(own) for _ in range(60)), f"l{j:03}") for i in range(6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.fit(docs.filter("doc_id % 6 != 5"))
    assert len(model.languages) == 190 and model.landmarks.shape[1] >= 4 * 190
    got = langid.identify(docs.filter("doc_id % 6 = 5"), model).collect()
    assert len(got) == 190 and sum(x.lang == x.lang_pred for x in got) >= 180


def test_shards_are_near_equal_and_gapless(spark):
    df = spark.range(5000).selectExpr("id", "xxhash64(id) as key", "if(id % 500 = 0, 20000L, 100 + id % 50) as size", "9 as shard", "8 as slot")
    got = sharding.shard_by_bytes(df, 24, "key", "size", order=("id",)).toPandas()
    by = got.groupby("shard")
    assert len(got) == 5000 and len(by) == 24
    assert by["size"].sum().max() - by["size"].sum().min() <= 2 * 20000
    assert all(sorted(g.slot) == list(range(len(g))) for _, g in by)
    assert sharding.shard_by_bytes(df.limit(0), 24, "key", "size").count() == 0
    same = spark.range(100).selectExpr("1L as key", "10L as size")
    assert sharding.shard_by_bytes(same, 4, "key", "size").select("shard").distinct().count() == 1


def test_toxicity_leaves_ordinary_words(spark):
    """Words that begin like a lexicon word do not match; beginnings that several toxic words share do; phrases of label 0 are taken off."""
    r = random.Random(7)
    word = lambda: "".join(r.choice("bcdfglmnprst") + r.choice("aeiou") for _ in range(3))
    rows = []
    for i in range(900):
        w = [word() for _ in range(30)]
        if i % 6 == 0:
            w[r.randrange(30)] = r.choice(["pathetic", "moron", "worthless", "disgusting", "grotesk", "groteskly", "groteske"])
        elif i % 120 == 1:
            w[:2] = ["moron", "mountain"]
        elif i % 6 == 2:
            w[3] = r.choice(["path", "worth", "more", "discover"])
        rows.append((i, " ".join(w), int(i % 6 == 0)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    lex = toxicity.fit(docs.select("doc_id", "text"), docs.select("doc_id", "toxic"), evidence=20.0)
    assert {" pathetic ", " worthless ", " disgusting "} <= lex.weights.keys() and not any(s in (" path", " wort", " worth", " disg", " moro") for s in lex.weights)
    assert any(" grotesk".startswith(s) for s in lex.weights) and "moron mountain " in lex.exceptions
    a = lex.automaton()
    tame = ["The path to the garden is worth a walk, a bright pathway worth discovering.", "Morocco is a country and the Moroccan coast is lovely", "up the moron mountain"]
    assert all(lex.score(lex.raw(a, t)) < 0.5 for t in tame)
    assert all(lex.score(lex.raw(a, t)) >= 0.5 for t in ("so pathetic", "you w0rthless thing", "groteskly put"))


def test_chosen_stems():
    got = toxicity.chosen([(" path", 5.0, 9), (" pathetic ", 5.1, 9), (" vile", 4.0, 9), (" vilewo", 4.2, 6), (" vileword ", 4.0, 3), (" vilest ", 9.0, 3)])
    assert got == {" pathetic ": 5.1, " vile": 4.0, " vilest ": 9.0}
