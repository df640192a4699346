"""Published versions, growing tables, histories, failure stores over runs, numbered rows."""

import os

import pytest
from pyspark.sql import functions as F

from tessera.functions import text
from tessera.operators import reconcile
from tessera.plans import texts
from tessera.sources import growing, shared, tables
from tessera.streaming import state
from tests.test_catalogue import SF


def test_readers_see_the_old_or_the_new_version(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "t")
    assert shared.published(spark, root) is None
    shared.publish(spark.range(3), root)
    reader = shared.published(spark, root)
    put = shared.put_text
    seen = []

    def between(*args):  # the new version is written, the pointer not moved
        seen.append(shared.published(spark, root).count())
        put(*args)

    monkeypatch.setattr(shared, "put_text", between)
    shared.publish(shared.published(spark, root).filter("id > 0"), root)  # from itself
    assert seen == [3] and shared.published(spark, root).count() == 2 and reader.count() == 3

    def broken(*args):
        raise OSError("no pointer")

    monkeypatch.setattr(shared, "put_text", broken)
    with pytest.raises(OSError):
        shared.publish(spark.range(9), root)
    assert shared.published(spark, root).count() == 2
    monkeypatch.setattr(shared, "put_text", put)
    for n in (4, 5, 6):
        shared.publish(spark.range(n), root)
    assert shared.published(spark, root).count() == 6 and len([v for v in os.listdir(root) if v.startswith("v")]) == 2


def test_a_table_grows_by_new_columns(spark, tmp_path):
    root = str(tmp_path / "g")
    bags = lambda rows: spark.createDataFrame(rows, "pn string, bag map<string,string>")
    rows = lambda: sorted(map(tuple, growing.read_growing(spark, root).collect()))
    assert growing.read_growing(spark, root) is None
    assert growing.flush(bags([("A", {"Capacity": "1GB"}), ("A", {"Capacity": "1GB"}), (None, {"x": "1"})]), root, "pn", "bag") == ["pn", "Capacity"]
    names = {"status": "Status", "capacity": "Capacity"}
    assert growing.flush(bags([("B", {"capacity": "2GB", "Rank": "S"}), ("A", {"Capacity": "9", "Odd": "y"})]), root, "pn", "bag", names) == ["pn", "Capacity", "Rank"]
    assert growing.flush(bags([("C", {"status": "ok", "Status": ""}), ("D", None)]), root, "pn", "bag", names) == ["pn", "Capacity", "Rank", "Status"]
    want = [("A", "1GB", "", ""), ("B", "2GB", "S", ""), ("C", "", "", "ok"), ("D", "", "", "")]
    assert rows() == want
    growing.compact(spark, root)
    assert rows() == want and not os.path.exists(f"{root}/fresh")
    assert growing.flush(bags([("E", {"Rank": "D"})]), root, "pn", "bag") == ["pn", "Capacity", "Rank", "Status"]
    shared.publish(growing._rounds(spark, root).repartition(1), f"{root}/base")  # a compaction that stops before it clears its input
    assert rows() == [*want, ("E", "", "D", "")]


def test_a_flush_cut_off_before_the_registry(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "g")
    bag = lambda *rows: spark.createDataFrame(list(rows), "pn string, bag map<string,string>")
    growing.flush(bag(("A", {"x": "1"})), root, "pn", "bag")
    put = growing.put_text
    monkeypatch.setattr(growing, "put_text", lambda *a: (_ for _ in ()).throw(OSError()))
    with pytest.raises(OSError):
        growing.flush(bag(("B", {"y": "2"})), root, "pn", "bag")
    monkeypatch.setattr(growing, "put_text", put)
    assert sorted(map(tuple, growing.read_growing(spark, root).collect())) == [("A", "1"), ("B", "")]
    assert growing.flush(bag(("B", {"y": "3"}), ("C", {"z": "4"})), root, "pn", "bag") == ["pn", "x", "y", "z"]
    assert sorted(map(tuple, growing.read_growing(spark, root).collect())) == [("A", "1", "", ""), ("B", "", "2", ""), ("C", "", "", "4")]


def test_many_keys_go_to_a_map(spark):
    df = spark.createDataFrame([(1, {"a": "1", "b": "2"}), (2, {"b": "3", "c": "4"})], "id int, m map<string,string>")
    got = tables.dynamic_columns(df, ["id"], "m", ("k",), most=1)
    assert got.columns == ["id", "k", "b", "others"]
    assert sorted((r.id, r.k, r.b, str(r.others)) for r in got.collect()) == [(1, "", "2", "{'a': '1'}"), (2, "", "3", "{'c': '4'}")]


@pytest.mark.parametrize("shards", [8, 64])
def test_numbers_of_a_larger_table(spark, shards):
    n = 400_000
    df = spark.range(n).select(((F.col("id") * 7919) % n).alias("k"), F.concat(F.lit("v"), "id").alias("carried"))
    got = reconcile.numbered(df, [F.col("k")], shards=shards)
    assert got.count() == n and got.filter("row_no != k + 2").count() == 0 and got.columns == ["k", "carried", "row_no"]
    assert reconcile.numbered(df.limit(0), [F.col("k")]).count() == 0


def test_escapes_and_misread_text(spark):
    cells = {"Intel\\u00ae C621": "INTEL C621", "-- a\\x41\\101b\\n c\\\\u0041": "AAAB CU0041", "bad \\u12 \\x41": "BAD U12 X41", "end\\": "END", "a b": "A B", "nan": None, "\\q1": "Q1", "": None}
    got = spark.createDataFrame([(k,) for k in cells], "s string").select("s", text.alnum_upper(F.col("s")).alias("t")).collect()
    assert {r.s: r.t for r in got} == cells
    misread = lambda x: "".join(chr(b) if b in (0x81, 0x8D, 0x8F, 0x90, 0x9D) else bytes([b]).decode("cp1252") for b in x.encode())
    page = [chr(c) for c in [*range(0xA0, 0x800), *range(0x800, 0xD800, 97), 0x2122, 0x2014, 0xFFFD, 0x1F600]]
    page += [bytes([b]).decode("cp1252") for b in range(0x80, 0x100) if b not in (0x81, 0x8D, 0x8F, 0x90, 0x9D)]
    df = spark.createDataFrame([(x, f"{misread(x)} plain ™ é {misread(x)}") for x in page] + [(None, None), ("", " plain ™ é ")], "a string, b string")
    assert all(r.t == (None if r.a is None else f"{r.a} plain ™ é {r.a}") for r in df.select("a", text.fix_mojibake(F.col("b")).alias("t")).collect())
    assert [r[0] for r in spark.createDataFrame([("Â",), ("Ã¶ â€” ok",), ("naïve Â",)], "s string").select(text.fix_mojibake(F.col("s"))).collect()] == ["Â", "ö — ok", "naïve Â"]


def test_broken_literals_fall_back_on_the_record(spark, monkeypatch):
    part = {r.p_partkey: r for r in tables.read_table(spark, SF, "part").collect()}
    shown = {k: (r.p_brand, f'["{r.p_type}"]' if k % 2 == 0 else f'["{r.p_type}","z"]') for k, r in part.items()}
    said = lambda: {r.p_partkey: (r.brand, r.kinds, r.parsed) for r in texts.literal_dicts(spark, SF).collect()}
    assert said() == {k: (*v, k % 5 != 0) for k, v in shown.items()}
    monkeypatch.setattr(text, "literal_json", lambda cell: F.when(cell.isNull(), "").otherwise("{}"))
    assert set(said().values()) == {(None, None, True)}  # read, but without the keys: nothing stands in for them
    monkeypatch.setattr(text, "literal_json", lambda cell: F.nullif(cell, cell))
    assert said() == {k: (*v, False) for k, v in shown.items()}


def test_failures_over_two_runs(spark, tmp_path):
    src, at = str(tmp_path / "src"), str(tmp_path / "at")
    kind = "url string, ts int, ok boolean, reason string"
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    runs = [
        [("a", 1, False, "t/o"), ("b", 1, True, None), ("c", 1, False, "x"), ("c", 2, False, "y"), (None, 1, False, "z")],
        [("a", 3, True, None), ("c", 3, False, "z"), ("d", 5, True, None), ("d", 6, False, "late"), ("d", 4, False, "early")],
    ]
    seen = []
    for rows in runs:  # a restart between the runs
        spark.createDataFrame(rows, kind).coalesce(1).write.mode("append").parquet(src)
        out = state.failure_store(spark.readStream.schema(kind).parquet(src), "url", "ok", "ts", "reason")
        q = out.writeStream.foreachBatch(lambda df, _: seen.append({r.url: (r.failed, r.attempts, r.reason, r["at"]) for r in df.collect()})).outputMode("update").option("checkpointLocation", at).trigger(availableNow=True).start()
        q.awaitTermination()
    first, second = (s for s in seen if s)
    assert first == {"a": (True, 1, "t/o", 1), "b": (False, 0, None, 1), "c": (True, 2, "y", 2)}
    assert second == {"a": (False, 0, None, 3), "c": (True, 3, "z", 3), "d": (True, 1, "late", 6)}
    assert sorted(map(tuple, state.failures(spark, at).collect())) == [("c", 3, "z", 3), ("d", 1, "late", 6)]


def test_a_replayed_batch_adds_nothing(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "h")
    batch = lambda *rows: spark.createDataFrame(list(rows), "url string, ok boolean")
    assert state.append_history(batch(("a", False), ("a", False)), 0, root)
    assert not state.append_history(batch(("a", False), ("q", True)), 0, root)
    put = state.put_text
    monkeypatch.setattr(state, "put_text", lambda *a: (_ for _ in ()).throw(OSError()))
    with pytest.raises(OSError):  # the batch breaks off after its rows
        state.append_history(batch(("b", True)), 1, root)
    assert state.history(spark, root).count() == 2
    monkeypatch.setattr(state, "put_text", put)
    assert state.append_history(batch(("b", True), ("c", True)), 1, root)
    assert sorted((r.batch, r.url, r.ok) for r in state.history(spark, root).collect()) == [(0, "a", False), (0, "a", False), (1, "b", True), (1, "c", True)]
