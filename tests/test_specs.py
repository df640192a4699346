"""Specification, verdict and incremental operators against plain versions."""

import difflib

from pyspark.sql import functions as F

from tessera.functions import models
from tessera.operators import specs, verdicts
from tessera.streaming import state


def test_similarity_and_folding(spark):
    rows = [("Intel Xeon", "xeon intel"), ("", ""), ("a", None)]
    got = spark.createDataFrame(rows, "a string, b string").select("a", "b", specs.similarity("a", "b").alias("r"), specs.nfkc(F.lit("Ａ ﬁ X")).alias("n")).collect()
    for r in got:
        assert r.n == "a fi x"
        assert r.r is None if r.b is None else abs(r.r - difflib.SequenceMatcher(None, r.a, r.b).ratio()) < 1e-12


def test_nested_value_edges(spark):
    rows = [(None,), ("",), ("[]",), ('{"chipset": ["a", 1]}',), ("{'CHIPSET': 'b'}",), ("[" * 3000,)]
    got = [r[0] for r in spark.createDataFrame(rows, "t string").coalesce(1).select(specs.nested_value(F.col("t"), "Chipset")).collect()]
    assert got == [None, None, None, '["a", 1]', "b", None]


def test_scoped_values_edges(spark):
    df = spark.createDataFrame([([], ["1TB"]), (["x"], []), (["1 tb: v", "1TB — w"], ["1TB", "2TB"])], "l array<string>, c array<string>")
    got = [r[0] for r in df.coalesce(1).select(specs.scoped_values(F.col("l"), F.col("c"))).collect()]
    assert got == [{"1TB": ""}, {}, {"1TB": "w"}]


def test_ranks_and_flags(spark):
    df = spark.createDataFrame([("x",), (None,)], "t string").coalesce(1)
    assert [r[0] for r in df.select(models.rank(F.col("t"))).collect()] == [None, None]
    assert [r[0] for r in df.select(verdicts.flags((F.col("t") == "x", "z"), (F.col("t") == "x", "a"))).collect()] == ["a & z", "match"]


def test_live_failures(spark):
    old = spark.createDataFrame([(1, "x"), (2, "x")], "k int, why string")
    new = spark.createDataFrame([(2, None), (3, "y")], "k int, why string")
    got = state.live_failures(old, new, "k", F.col("why").isNotNull())
    assert sorted((r.k, r.why) for r in got.collect()) == [(1, "x"), (3, "y")]


def test_append_stream(spark, tmp_path):
    src, out, at = (str(tmp_path / x) for x in ("src", "out", "at"))
    for rows in ([(1, "a"), (1, "a"), (None, "b")], [(1, "c"), (2, "d")]):
        spark.createDataFrame(rows, "k int, v string").write.mode("append").parquet(src)
        state.append_stream(spark.readStream.schema("k int, v string").parquet(src), out, "k", at).awaitTermination()
    assert sorted((r.k, r.v) for r in spark.read.parquet(out).collect()) == [(1, "a"), (2, "d")]
