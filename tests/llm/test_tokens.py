import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tessera.llm import codec, planes
from tessera.llm.tokens import Encoder
from tessera.llm.trie_bpe import TrieEncoder

TEXTS = [
    None, "", " ", "\n", "a", "Hello world", "  two  spaces ", "tab\tand\r\nlines\n\n\nend ", "it's we'll 'S don't!!'s", "ÇPA!! École naïve ß ÿ × ÷ ª µ",
    "x<|endoftext|>y <|endoftext|>", " <|endoftext|>", "<|startoftext|> a", "nb sp a b", "é combining", "日本語 テスト 😀 ok", "1234 5,678.90 a1b2", "\x1cctl\x1f x",
    "!" * 500, "ab" * 3000, "price=$$$ %%% ||| ### <b>", "ΑΣ ΟΔΟΣ İstanbul", "a \n b", "trailing\n", "\nleading", "the line", "'", "don' t 's", "A" * 70 + " " * 70 + "b",
]


def random_texts(n, seed=3):
    r = random.Random(seed)
    return ["".join(r.choice("abcdeéß THE the   \n\t.,!'s0193<|>日😀") for _ in range(r.randrange(60))) for _ in range(n)]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
@pytest.mark.parametrize("kind", [Encoder, TrieEncoder])
def test_ids_are_those_of_the_library(name, kind):
    if kind is TrieEncoder and name.startswith("word"):
        return
    path = public_tokenizers.path(name)
    t, e = Tokenizer.from_file(path), kind(path)
    texts = TEXTS + random_texts(800)
    for x, got in zip(texts, e.ids(texts)):
        want = t.encode(x or "", add_special_tokens=False).ids
        assert np.frombuffer(got, "<u4").tolist() == want, x
        if kind is TrieEncoder:
            assert e.decode(got) == t.decode(want, skip_special_tokens=False)


@pytest.mark.parametrize("mode", ["bit", "byte"])
@pytest.mark.parametrize("n", [0, 1, 7, 8, 1000, 65536])
def test_planes_round_trip(mode, n):
    a = np.random.default_rng(n).integers(0, 2**32, n).astype("<u4")
    assert (planes.join_planes(planes.split_planes(a, mode), n, mode) == a).all() if n else True


@pytest.mark.parametrize("mode", ["bit", "byte"])
def test_files_give_back_all_ids(spark, tmp_path, mode):
    path = public_tokenizers.path("word_bpe_49k.json")
    t = Tokenizer.from_file(path)
    rows = [(i * 7 % 31, x) for i, x in enumerate(TEXTS)] + [(None, "no id"), (5, "same id"), (5, "same id"), (99, "very long " * 40000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as start", "text as ids")
    files = planes.write(df, f"file://{tmp_path}/x", path, 1, mode=mode)
    got = planes.read(spark, files, ids=True).orderBy("start").collect()
    assert [r.doc_id for r in got] == sorted((r[0] for r in rows), key=lambda k: -1 if k is None else k)
    at = 0
    want = sorted((-1 if k is None else k, t.encode(x or "", add_special_tokens=False).ids + [1]) for k, x in rows)
    assert sorted((-1 if r.doc_id is None else r.doc_id, list(r.ids)) for r in got) == want
    for r in got:
        assert r.start == at and r.n_tokens == len(r.ids) and r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        at += r.n_tokens


def test_files_end_at_their_limits(spark, tmp_path):
    """Several files a partition, a document over the limit, equal ids with different texts, a path without a scheme."""
    path = public_tokenizers.path("word_bpe_49k.json")
    t = Tokenizer.from_file(path)
    rows = [(i // 2, f"text number {i} " * (1 + i % 5)) for i in range(200)] + [(50, "long " * 3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    files = planes.write(df, f"{tmp_path}/small", path, 1, file_ids=100, file_docs=7)
    assert len(files) >= 29 and max(d for _, _, d, _ in files) == 7 and sum(d for _, _, d, _ in files) == 201 and all(p.startswith("file:///") for _, p, _, _ in files)
    got = planes.read(spark, files, ids=True).orderBy("start").collect()
    assert [r.doc_id for r in got] == sorted(k for k, _ in rows)
    assert sorted((r.doc_id, list(r.ids)) for r in got) == sorted((k, t.encode(x, add_special_tokens=False).ids + [1]) for k, x in rows)
    starts = np.cumsum([0] + [r.n_tokens for r in got])
    assert [r.start for r in got] == starts[:-1].tolist()


def test_empty_table(spark, tmp_path):
    path = public_tokenizers.path("word_bpe_49k.json")
    df = spark.createDataFrame([], "doc_id long, text string")
    assert planes.read(spark, planes.write(df, f"{tmp_path}/y", path, 1)).count() == 0
    assert codec.encode(df, public_tokenizers.path("byte_bpe_50k.json")).count() == 0


def test_codec_round_trip(spark):
    path = public_tokenizers.path("byte_bpe_50k.json")
    df = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    got = {r.doc_id: r.text for r in codec.decode(codec.encode(df, path), path).collect()}
    assert got == {i: x or "" for i, x in enumerate(TEXTS)}
