"""Edges of the document and page operators."""

from pyspark.sql import functions as F

from tessera.operators import documents, html, verdicts


def one(spark, rows, schema, *cols):
    return [tuple(r) for r in spark.createDataFrame(rows, schema).coalesce(1).select(*cols).collect()]


def test_lines_and_capacities(spark):
    rows = [(None,), ("",), ("[]",), ('{"a": [null, "1TB", "1024 gb"]}',), ('{"a": {"b": 1}}',), ('{"a": "x"}',)]
    lines = documents.lines_at(F.col("t"), "$.a")
    assert one(spark, rows, "t string", lines, documents.largest_capacity(lines)) == [([], None), ([], None), ([], None), (["1TB", "1024 gb"], "1TB"), ([], None), (["x"], None)]


def test_merge_values(spark):
    rows = [(None, "a"), ("", None), ("a", None), ('["a\\"b"]', '["c", null]'), ("[x]", "[y]")]
    assert [r[0] for r in one(spark, rows, "a string, b string", documents.merge_values(F.col("a"), F.col("b")))] == ["a", None, "a", '["a\\"b", "c", null]', "[x]; [y]"]


def test_flat_sections(spark):
    rows = [({"Z": {"k": "3"}, "G": {"k": "1"}, "H": None},), ({},), (None,)]
    got = [r[0] for r in one(spark, rows, "m map<string,map<string,string>>", documents.flat_sections(F.col("m"), ["G"]))]
    assert got == [{"k": "1", "Z k": "3"}, {}, None]


def test_embedded_object(spark):
    rows = [(None,), ("",), ("m",), ('m("x", {"a": "}"})',), ("m({'a': 1})",), ('m({"a": "open)',), ("m" + '{"a":' * 3000,)]
    assert [r[0] for r in one(spark, rows, "t string", documents.embedded_object(F.col("t"), "m"))] == [None, None, None, '{"a": "}"}', None, None, None]


def test_pages(spark):
    rows = [(None, None), ("", "u/"), ("<table><tr></tr><tr><td>a<td>b</table>" + "<div>" * 5000, "u"), ('<div class="c"><h3>h</h3><ul class="p"><li></ul></div>', "u")]
    got = one(spark, rows, "t string, u string", html.table_rows("t"), html.spec_cards(F.col("t"), "c", "p", "r"), html.product_head(F.col("t"), F.col("u")))
    assert [r[0] for r in got] == [[], [], [["a", "b"]], []]
    assert all(r[1] == [] for r in got)
    assert [tuple(r[2]) for r in got] == [(None, None, None, None), *[(None, None, None, "u")] * 3]


def test_row_pairs_and_details(spark):
    rows = [([["", "lost"], ["a", "1"], ["", "2"], ["b"], ["a", "3", "4"]],), ([],), (None,)]
    got = [r[0] and [tuple(p) for p in r[0]] for r in one(spark, rows, "r array<array<string>>", html.row_pairs(F.col("r")))]
    assert got == [[("a", "1 | 2 | 3 | 4")], [], None]
    rows = [([("Details", ["a\\b"])],), ([("x", ["1"]), ("y", ["1", "2"])],)]
    assert [r[0] for r in one(spark, rows, "a array<struct<label:string,items:array<string>>>", html.attrs_text(F.col("a")))] == ['["a\\\\b"]', 'x: 1; y: ["1", "2"]']


def test_compare_numbers(spark):
    rows = [("{}", "1", "1"), ("x", None, "1"), ("x", "8.0", "8 slots"), ("x", "none", "8"), (None, "1", "2")]
    got = one(spark, rows, "d string, a string, b string", verdicts.compare_numbers(F.col("d"), F.col("a"), F.col("b")))
    assert [r[0] for r in got] == ["Datas are not available", "missing", "match", "mismatch", "mismatch"]
