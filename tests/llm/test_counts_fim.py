import hashlib
import random
import re

import public_tokenizers
import pytest
import sentencepiece

from tessera.llm import counts, fim

PATH = public_tokenizers.path("piece_bpe_32k.model")
UNITS = re.compile("[A-Za-z]+|[^A-Za-z]")
TEXTS = [
    None, "", " ", "  ", "a", "Hello world", "<s> </s> <unk><0x0A>", "\x00a\n\n\tb", "日本語テスト 😀 ok", "▁▁ lit▁eral ▁", "1234 5,678", "aaaaaaaaaa" * 50,
    "ab" * 300, "ÇPA École naïve", "a<P>b", "<<S>", "<M", "P><S", "nb sp", "<P", "é", "é<", "x<M>y" * 3, "The end.\n" * 5000,
]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def texts(alphabet, n, most=80, seed=1):
    r = random.Random(seed)
    return ["".join(r.choice(alphabet) for _ in range(r.randrange(most))) for _ in range(n)]


@pytest.mark.parametrize("alphabet", ["abcdeéß THE the   \n\t.,!'s0193<|>日😀", "ab ", "aeiou nst", "abcdefghijklmnopqrstuvwxyz", "▁a b", "=-*/# \n", "的是不了人我在有他这 中国"])
def test_counts_of_random_texts(library, alphabet):
    found = texts(alphabet, 1500)
    assert counts.PieceCounter(PATH).counts(found) == [len(x) for x in library.encode(found)]


def test_counts_of_blanks_and_long_texts(library):
    c = counts.PieceCounter(PATH)
    found = [" " * n + w for n in range(70) for w in ("", "word", "\n", "1")] + [" " * 100_000, "a" * 100_000, texts("abcdefghijklmnopqrstuvwxyz", 1, 2, 3)[0] * 50_000]
    found += [" ".join(texts("abcdefgh  ", 60_000, 60)), "x" * (counts.BLOCK + 5), "y " * counts.BLOCK]
    assert c.counts(found) == [len(x) for x in library.encode(found)]
    assert all(len(t) <= counts.REMEMBERED for t in c.known)


def test_a_full_cache_is_emptied(library, monkeypatch):
    monkeypatch.setattr(counts, "CACHE_ENTRIES", 50)
    monkeypatch.setattr(counts, "BLOCK", 100)
    found = texts("abcdefghij   ", 300)
    c = counts.PieceCounter(PATH)
    assert c.counts(found) == [len(x) for x in library.encode(found)]


def test_count_column(spark, library):
    df = spark.createDataFrame([(i % 5 or None, x, "n") for i, x in enumerate(TEXTS)], "doc_id long, text string, n_tokens string")
    got = counts.count_tokens(df, PATH)
    assert sorted((r.text or "", r.n_tokens) for r in got.collect()) == sorted((x or "", len(library.encode(x or ""))) for x in TEXTS)
    assert counts.count_tokens(df.limit(0), PATH).count() == 0


def test_units_are_those_of_the_pattern():
    a = fim.automaton()
    for t in texts("ab cé<P>SM日1.\n\x00", 4000, 30) + TEXTS[1:]:
        u, found = fim.Units(t, a), UNITS.findall(t)
        assert u.n == len(found) and u.has_sentinel == any(s in t for s in fim.SENTINELS)
        for k in range(0, u.n + 1, 1 + u.n // 40):
            assert u.place(k) == len("".join(found[:k]))


def plain(key, text):
    text = text or ""
    found = UNITS.findall(text)
    x = hashlib.sha256(f"1:{'' if key is None else key}".encode()).hexdigest()
    h = [int(x[8 * i : 8 * i + 8], 16) for i in range(4)]
    a, z = sorted((h[0] % (len(found) + 1), h[1] % (len(found) + 1)))
    if not text or any(s in text for s in fim.SENTINELS) or h[2] % 100 >= 90:
        return len(found), "plain", None, None, text
    p, m, s = ("".join(y) for y in (found[:a], found[a:z], found[z:]))
    if h[3] % 100 < 20:
        return len(found), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(found), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def test_transform_and_restore(spark):
    rows = [(None if i % 50 == 0 else i % 400, x, "c") for i, x in enumerate(TEXTS + texts("ab cé<S>M日1.\n", 600, 60) + ["dup", "dup"])]
    df = spark.createDataFrame(rows, "doc_id long, text string, _cuts string")
    got = fim.transform(df).withColumn("back", fim.restore(fim.F.col("fim.output"), fim.F.col("fim.form"))).collect()
    key = lambda r: str(r)
    assert sorted(((r.doc_id, r.text, r._cuts, *r.fim) for r in got), key=key) == sorted(((*r, *plain(r[0], r[1])) for r in rows), key=key)
    assert all(r.back == (r.text or "") for r in got) and len({r.fim.form for r in got}) == 3
    assert fim.transform(df.limit(0)).count() == 0
