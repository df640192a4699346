"""Sources and sinks on small files."""

import json

import pytest
from pyspark.sql import functions as F

from tessera.sources import tables


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_read_catalogue(spark, tmp_path):
    p = tmp_path / "a.csv"
    p.write_bytes(b'\xef\xbb\xbfname , n\n"a ""q""",1\n\xff,\n')
    df = tables.read_catalogue(spark, str(p))
    assert df.columns == ["name", "n"] and rows(df) == [('a "q"', "1"), ("�", None)]
    assert rows(tables.read_catalogue(spark, str(p), blanks=True)) == [('a "q"', "1"), ("�", "")]
    assert dict(tables.read_catalogue(spark, str(p), typed=True).dtypes)["n"] in ("int", "bigint")
    (tmp_path / "bad.csv").write_text("a,b\n1,2\n3\n4,5,6\n")
    assert tables.read_catalogue(spark, str(tmp_path / "bad.csv"), ["a", "b"], drop_malformed=True).count() < 3
    (tmp_path / "empty.csv").write_text("")
    assert tables.read_catalogue(spark, str(tmp_path / "empty.csv"), ["a"]).count() == 0
    gone = tables.read_catalogue(spark, str(tmp_path / "none.csv"), ["a", "b"], optional=True)
    assert gone.columns == ["a", "b"] and gone.count() == 0
    with pytest.raises(Exception):
        tables.read_catalogue(spark, str(tmp_path / "none.csv")).count()


def test_inputs_keys_and_documents(spark, tmp_path):
    df = spark.createDataFrame([(" A", "http://x/ "), (None, "http://y"), ("b", " "), ("c", None)], "`Server Name` string, server_url string")
    assert rows(tables.read_inputs(df)) == [("A", "http://x/"), ("http://y", "http://y")]
    with pytest.raises(ValueError):
        tables.read_inputs(df.select("Server Name"))
    with pytest.raises(ValueError):
        tables.require_columns(df, ["x"])
    k = spark.createDataFrame([("u/", 1), (" u", 2), ("", 3), (None, 4), ("v", 5)], "url string, pos int")
    assert rows(tables.keyed(k, "url", "pos")) == [("u", 2), ("v", 5)]
    for name in ("b.txt", "a.txt"):
        (tmp_path / name).write_text(f"two\nlines {name}")
    assert [tuple(r) for r in tables.read_documents(spark, str(tmp_path)).orderBy("file_name").collect()] == [("a.txt", "two\nlines a.txt"), ("b.txt", "two\nlines b.txt")]
    (tmp_path / "s.json").write_text(json.dumps({"u": {"status": "DONE", "updated_at": "t"}, "v": {"status": "FAILED"}}, indent=2))
    assert rows(tables.read_state(spark, str(tmp_path / "s.json"))) == [("u", "DONE", "t"), ("v", "FAILED", None)]
    assert tables.read_state(spark, str(tmp_path / "no.json")).count() == 0
    one = spark.range(1)
    assert one.select(tables.optional_column(one, "id"), tables.optional_column(one, "x")).first() == (0, None)


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, "a,b", "ok"), (2, 'c "d"', "bad")], "id int, text string, status string").coalesce(1)
    out = str(tmp_path / "out")
    tables.write_split(df, out, F.col("status") == "bad")
    assert rows(tables.read_catalogue(spark, f"{out}/report")) == [("1", "a,b", "ok"), ("2", 'c "d"', "bad")]
    assert rows(tables.read_catalogue(spark, f"{out}/problems")) == [("2", 'c "d"', "bad")]
    assert tables.field_faults(spark, f"{out}/report").count() == 0
    (tmp_path / "faulty.csv").write_text('a,b\n"1,2",3\n1,2,3\n')
    assert [(r.fields, r.expected) for r in tables.field_faults(spark, str(tmp_path / "faulty.csv")).collect()] == [(3, 2)]
    cells = spark.createDataFrame([('["a"]',), ("[a]",), ("a",)], "c string")
    assert rows(tables.bad_list_cells(cells, "c")) == [("[a]",)]
    tables.write_with_mark(df, f"{out}/mark")
    assert next((tmp_path / "out/mark").glob("*.csv")).read_bytes().startswith("﻿id".encode())
    assert tables.read_catalogue(spark, f"{out}/mark").columns == ["id", "text", "status"]
    tables.write_sheets({"Summary": df.limit(1), "All": df}, f"{out}/book")
    assert tables.read_catalogue(spark, f"{out}/book/All").count() == 2
    healed = tables.heal(df, ["status", "new", "id"])
    assert healed.columns == ["status", "new", "id"] and rows(healed) == [("bad", "", "2"), ("ok", "", "1")]


def test_dynamic_columns_and_swap(spark, tmp_path):
    df = spark.createDataFrame([(1, {"b": "x"}), (2, {"a": "y", "k": "z"}), (3, {})], "id int, m map<string,string>")
    got = tables.dynamic_columns(df, ["id"], "m", ("k",))
    assert got.columns == ["id", "k", "a", "b"] and rows(got) == [(1, "", "", "x"), (2, "z", "y", ""), (3, "", "", "")]
    path = str(tmp_path / "t")
    tables.replace_table(spark.range(3), path)
    tables.replace_table(spark.read.parquet(path).filter("id > 0"), path)
    assert rows(spark.read.parquet(path)) == [(1,), (2,)] and [p.name for p in tmp_path.iterdir()] == ["t"]


def test_reports(spark, tmp_path):
    from tessera.operators import audit

    df = spark.createDataFrame([(1, "ok"), (2, "a|bad"), (3, "bad")], "id int, status string")
    s = audit.summary(df, {"rows": F.count(F.lit(1)), "<b>": F.count_if(F.col("status") == "ok")})
    page = tables.html_report(s, "R & D")
    assert "<td>rows</td><td>3</td>" in page and "&lt;b&gt;" in page and "R &amp; D" in page
    for _ in range(2):
        tables.write_report(df, df.limit(1), str(tmp_path))
    assert spark.read.json(f"{tmp_path}/report").count() == 3 and spark.read.json(f"{tmp_path}/summaries").count() == 2
    assert audit.gate(df, "status", {"bad"}) == 2 and audit.gate(df, "status", {"none"}) == 0
