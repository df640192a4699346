"""Pages as a relation, listings to a fixed point, hierarchies as JSON."""

import json

from pyspark.sql import functions as F

from tessera.operators import crawl, hierarchy, nodes

TABS = """<div><a data-pgtab="Storage" data-tab="tabContent0_1">x</a><a data-pgtab="" data-tab="tabContent0_2">Solid-<b>state</b>
 drives</a><a data-tab="tabContent0_3">none</a></div><div id="tabContent0_1"><ul><li class="product-gallery-card" data-partnumber="A"><li class="product-gallery-card" data-partnumber="B" data-category="Memory"></ul>
<div id="tabContent0_2"><li class="product-gallery-card" data-partnumber="C"></div></div><div id="tabContent0_3"><li class="product-gallery-card" data-partnumber="D"></div><li class="product-gallery-card" data-partnumber="E">"""


def test_cards_take_the_nearest_tabs_label(spark):
    pages = spark.createDataFrame([(1, TABS), (2, None), (3, ""), (4, "<p>a<p>b<br>c</div>")], "page long, html string")
    found = nodes.page_nodes(pages, F.col("html"), "page").cache()
    assert sorted((r.panel, r.label) for r in nodes.tab_labels(found, "page").collect()) == [("tabContent0_1", "Storage"), ("tabContent0_2", "Solid-state drives")]
    cards = {r.attrs["data-partnumber"]: r.component_type for r in nodes.labelled_cards(found, "page").collect()}
    assert cards == {"A": "Storage", "B": "Memory", "C": "Solid-state drives", "D": "Component", "E": "Component"}
    rows = found.filter("page = 1").orderBy("pre").collect()
    assert [r.pre for r in rows] == list(range(len(rows))) and all(r.pre <= r["last"] < len(rows) for r in rows)
    assert [(r.tag, r.text) for r in found.filter("page = 4").orderBy("pre").collect()] == [("p", None), ("#text", "a"), ("p", None), ("#text", "b"), ("br", None), ("#text", "c")]
    assert found.filter("page IN (2, 3)").count() == 0 and nodes.page_nodes(pages.limit(0), F.col("html"), "page").count() == 0


def listings(spark, rows):
    return spark.createDataFrame(rows, "site string, page int, items array<string>, last_page int")


def test_crawl_stops_at_the_last_or_an_empty_page(spark):
    rows = [
        ("a", 1, ["x/", "y"], 3), ("a", 2, ["y", None], 9), ("a", 3, ["z"], 9), ("a", 4, ["w"], 9),
        ("b", 1, [], 9), ("b", 2, ["p"], 1), ("b", 3, None, 1), ("b", 4, ["q"], 1),
        ("c", 1, ["r"], None), ("c", 2, ["s"], None), ("d", 2, ["t"], 5), ("e", 1, ["u"], 3), ("e", 3, ["v"], 3), (None, 1, ["n"], 1),
    ]
    pages, links = crawl.crawl(listings(spark, rows))
    assert sorted(map(tuple, pages.collect())) == [("a", 1), ("a", 2), ("a", 3), ("b", 1), ("b", 2), ("c", 1), ("e", 1)]
    assert sorted(map(tuple, links.collect())) == [("a", "x/"), ("a", "y"), ("a", "z"), ("b", "p"), ("c", "r"), ("e", "u")]
    every, _ = crawl.crawl(listings(spark, rows), pager="every")
    assert sorted(map(tuple, every.filter("site = 'a'").collect())) == [("a", n) for n in (1, 2, 3, 4)]
    capped, _ = crawl.crawl(listings(spark, rows), max_pages=2)
    assert capped.filter("site = 'a'").count() == 2
    none, items = crawl.crawl(listings(spark, []))
    assert none.count() == 0 and items.count() == 0


def test_sections_as_json_of_any_depth(spark):
    rows = [
        (1, ["Memory", "Standard"], "0 MB (Removable)", 1), (1, ["Memory", "Maximum"], "8 GB", 2), (1, ["Storage", "Maximum"], '2 "TB"', 4), (1, ["CPU", "Details"], "Athlon", 5),
        (1, ["Storage", "Ports", "Front", "USB"], "a", 7), (1, ["Storage", "Ports", "Front", "USB"], "b", 8), (1, ["Storage", "Ports"], "own", 9), (1, ["Zip"], "", 0), (1, [], "gone", 1), (1, ["x", None], "gone", 1), (1, ["y"], None, 1),
        (2, ["é\n"], "\\", 1),
    ]
    df = spark.createDataFrame(rows, "k int, path array<string>, value string, place int")
    got = {r.k: r.document for r in hierarchy.nested_json(df, "k", "path", "value", "place", listed=("Details",)).collect()}
    one = json.loads(got[1])
    assert one == {"Zip": "", "Memory": {"Standard": "0 MB (Removable)", "Maximum": "8 GB"}, "Storage": {"Maximum": '2 "TB"', "Ports": {"": "own", "Front": {"USB": ["a", "b"]}}}, "CPU": {"Details": ["Athlon"]}}
    assert list(one) == ["Zip", "Memory", "Storage", "CPU"] and list(one["Storage"]) == ["Maximum", "Ports"]
    assert json.loads(got[2]) == {"é\n": "\\"}
    assert hierarchy.nested_json(df.limit(0), "k", "path", "value", "place").count() == 0
