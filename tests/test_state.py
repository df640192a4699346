"""State stores, retries and streaks."""

import pytest
from pyspark.sql import functions as F

from tessera.streaming import runs, state


def test_upsert_and_latest(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    assert sorted(map(tuple, state.upsert(old, spark.createDataFrame([(2, "c"), (3, "d")], "k int, v string"), "k").collect())) == [(1, "a"), (2, "c"), (3, "d")]
    events = spark.createDataFrame([(1, 5, "x"), (1, 7, "y"), (2, 1, "z"), (None, 9, "w")], "k int, ts int, v string")
    assert sorted(map(tuple, state.latest(events, "k", "ts").collect())) == [(1, 7, "y"), (2, 1, "z")]


def test_retries_bring_through_what_can_be(spark):
    tasks = spark.createDataFrame([("A",), ("B",), ("C",)], "url string")

    def attempt(df, n):  # A fails once, B always
        return df.withColumn("ok", (F.col("url") == "C") | ((F.col("url") == "A") & F.lit(n > 1)))

    history, failed = state.retry_rounds(tasks, "url", attempt, 2, lambda df: df.cache())
    assert sorted((r.url, r.attempt, r.ok) for r in history.collect()) == [("A", 1, False), ("A", 2, True), ("B", 1, False), ("B", 2, False), ("B", 3, False), ("C", 1, True)]
    assert [r.url for r in failed.collect()] == ["B"]


def test_rotation(spark):
    inputs = spark.createDataFrame([(i,) for i in range(5)], "k int")
    seen = spark.createDataFrame([(0, 10), (1, 5)], "k int, at int")
    sample = state.rotate(inputs, seen, "k", "at", 4)
    assert [r.k for r in sample.collect()] == [2, 3, 4, 1]
    after = state.mark_seen(seen, sample, "k", "at", F.lit(20))
    assert [r.k for r in state.rotate(inputs, after, "k", "at", 1).collect()] == [0]


def test_streaks_across_batches(spark, tmp_path):
    src, at = str(tmp_path / "src"), str(tmp_path / "at")
    for i, rows in enumerate(([(1, 1, False), (1, 2, False), (2, 1, True)], [(1, 3, False), (2, 2, False), (1, 4, True)])):
        spark.createDataFrame(rows, "k int, ts int, ok boolean").write.mode("append").parquet(src)
        q = state.streak_stream(spark.readStream.schema("k int, ts int, ok boolean").parquet(src), "k", "ok", 3)
        out = str(tmp_path / f"out{i}")
        q.writeStream.foreachBatch(lambda df, _, out=out: df.write.mode("append").parquet(out)).outputMode("update").option("checkpointLocation", at).trigger(availableNow=True).start().awaitTermination()
    got = {r.k: (r.n_events, r.streak, r.trips) for r in spark.read.parquet(str(tmp_path / "out1")).collect()}
    assert got == {1: (2, 0, 1), 2: (1, 1, 0)}


def test_a_run_goes_on_where_it_was_cut_off(spark, tmp_path):
    tasks = spark.createDataFrame([(u, i) for i, u in enumerate("abcdef")] + [(None, 9)], "url string, place int")
    good = {0: "ab", 1: "c", 2: "d"}
    seen = []

    def attempt(pending, n, broken=None):
        seen.append((n, sorted(r.url for r in pending.collect())))
        if n == broken:
            raise OSError("cut off")
        ok = F.col("url").isin(*good[n])
        return pending.withColumn("ok", ok).withColumn("reason", F.when(~ok, F.lit(f"t{n}")))

    root, whole = str(tmp_path / "cut"), str(tmp_path / "whole")
    with pytest.raises(OSError):
        runs.run_rounds(tasks, lambda p, n: attempt(p, n, broken=1), root, "url", "place")
    assert sorted(r.url for r in runs.failures(spark, root).collect()) == ["c", "d", "e", "f"]
    rows = lambda df: sorted(map(tuple, df.collect()))
    got = runs.run_rounds(tasks, attempt, root, "url", "place")
    assert seen == [(0, list("abcdef")), (1, list("cdef")), (1, list("cdef")), (2, list("def"))]
    want = [("a", True, None, 1), ("b", True, None, 1), ("c", True, None, 2), ("d", True, None, 3), ("e", False, "t2", 3), ("f", False, "t2", 3)]
    assert rows(got) == want == rows(runs.run_rounds(tasks, attempt, whole, "url", "place"))
    assert rows(runs.run_rounds(tasks, attempt, root, "url", "place")) == want and len(seen) == 7  # a finished run is not run again
    assert rows(runs.failures(spark, root)) == [w for w in want if not w[1]]
    assert rows(runs.pauses(runs.attempts(spark, root), "place", 2)) == [(0, 2), (1, 1), (2, 1)]
