"""Pages as a relation of elements: containment is an interval join on pre-order numbers."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.text import resolve_url, squeeze
from tessera.operators.html import Node, tree

NODE = "struct<pre:int,last:int,depth:int,tag:string,id:string,css:array<string>,attrs:map<string,string>,text:string>"
#: Rows from which a batch of elements is handed on.
ROWS = 4096
#: The tag of texts.
TEXT = "#text"
_NODE = pa.struct([("pre", pa.int32()), ("last", pa.int32()), ("depth", pa.int32()), ("tag", pa.string()), ("id", pa.string()), ("css", pa.list_(pa.string())), ("attrs", pa.map_(pa.string(), pa.string())), ("text", pa.string())])


def _rows(page: str | None) -> list[dict]:
    """Elements and texts of a page in document order; `last` is the number of the last row inside."""
    out: list[dict] = []
    rest: list = [(k, 1) for k in tree(page).kids[::-1]]
    open_: list[dict] = []
    while rest:
        node, depth = rest.pop()
        while open_ and open_[-1]["depth"] >= depth:
            open_.pop()
        row = {"pre": len(out), "last": len(out), "depth": depth, "tag": TEXT, "id": None, "css": [], "attrs": [], "text": None}
        if isinstance(node, Node):
            attrs = {k: v or "" for k, v in node.attrs.items()}
            row |= {"tag": node.tag, "id": attrs.get("id"), "css": attrs.get("class", "").split(), "attrs": list(attrs.items())}
            rest.extend((k, depth + 1) for k in node.kids[::-1])
        else:
            row["text"] = node
        out.append(row)
        open_.append(row)
        for o in open_:
            o["last"] = row["pre"]
    return out


def page_nodes(pages: DataFrame, html: Column, *keys: str) -> DataFrame:
    """One row for each element and text of each page: keys, pre, last, depth, tag (#text for texts), id, css, attrs, text (of texts).

    Rows are numbered in document order from 0; what is inside an element has numbers from pre + 1 to last. A null, empty
    or broken page gives the rows that can be read, maybe none; scripts and styles have no texts.
    """

    own = pages.select(*keys, html.alias("_html"))
    names = [f.name for f in _NODE]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows: list[dict] = []
            of: list[int] = []
            for at in range(b.num_rows):  # a batch holds ROWS rows and those of one page more at most
                found = _rows(b.column(len(keys))[at].as_py())
                rows += found
                of += [at] * len(found)
                if rows and (len(rows) >= ROWS or at == b.num_rows - 1):
                    own_keys = [b.column(i).take(pa.array(of)) for i in range(len(keys))]
                    yield pa.RecordBatch.from_arrays([*own_keys, *pa.array(rows, _NODE).flatten()], names=[*keys, *names])
                    rows, of = [], []

    kinds = [f"`{k}` {own.schema[k].dataType.simpleString()}" for k in keys]
    return own.mapInArrow(run, ", ".join([*kinds, NODE.removeprefix("struct<").removesuffix(">").replace(":", " ")]))


def inside(inner: DataFrame, outer: DataFrame, *keys: str, label: str = "label") -> DataFrame:
    """inner rows (keys, pre, ...) with the label of the nearest outer element (keys, pre, last, label) around each; null without any.

    The join is by page and by interval; nested outer elements give several hits, of which the one that begins last counts.
    """
    o = outer.select(*(F.col(k).alias(f"_{k}") for k in keys), F.col("pre").alias("_pre"), F.col("last").alias("_last"), F.col(label).alias("_label"))
    same = F.lit(True)
    for k in keys:
        same = same & (F.col(k) == F.col(f"_{k}"))
    hits = inner.select(*keys, "pre").join(o, same & (F.col("_pre") < F.col("pre")) & (F.col("pre") <= F.col("_last")))
    near = hits.groupBy(*keys, "pre").agg(F.max_by("_label", "_pre").alias(label))
    return inner.drop(label).join(near, [*keys, "pre"], "left")


def whole_text(elements: DataFrame, nodes: DataFrame, *keys: str) -> DataFrame:
    """elements with whole_text: all texts inside, in document order, white space squeezed; empty without any."""
    o = elements.select(*(F.col(k).alias(f"_{k}") for k in keys), F.col("pre").alias("_at"), F.col("last").alias("_last"))
    same = (F.col("pre") > F.col("_at")) & (F.col("pre") <= F.col("_last"))
    for k in keys:
        same = same & (F.col(k) == F.col(f"_{k}"))
    hits = nodes.filter(F.col("tag") == TEXT).select(*keys, "pre", "text").join(o, same)
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pre", "text"))), lambda x: x["text"]), "")
    text = hits.groupBy(*keys, F.col("_at").alias("pre")).agg(squeeze(joined).alias("whole_text"))
    return elements.join(text, [*keys, "pre"], "left").withColumn("whole_text", F.coalesce("whole_text", F.lit("")))


def tab_labels(nodes: DataFrame, *keys: str, target: str = "data-tab", name: str = "data-pgtab") -> DataFrame:
    """(keys, panel, label): the label of each tab panel, by the elements that carry both attributes: the name, or where it is
    empty the element's text. Of several tabs of a panel the last counts; tabs without a panel are left out."""
    tabs = nodes.filter(F.map_contains_key("attrs", target) & F.map_contains_key("attrs", name) & (F.col("attrs")[target] != ""))
    label = F.coalesce(F.nullif(F.col("attrs")[name], F.lit("")), "whole_text")
    return whole_text(tabs, nodes, *keys).groupBy(*keys, F.col("attrs")[target].alias("panel")).agg(F.max_by(label, "pre").alias("label"))


def labelled_cards(nodes: DataFrame, *keys: str, css: str = "product-gallery-card", panel: str = "tabContent") -> DataFrame:
    """Cards (keys, pre, attrs) with component_type: their category, or the label of the tab panel around them, or 'Component'."""
    panels = nodes.filter(F.col("id").startswith(panel)).join(tab_labels(nodes, *keys).withColumnRenamed("panel", "id"), [*keys, "id"], "left")
    cards = inside(nodes.filter((F.col("tag") == "li") & F.array_contains("css", css)), panels, *keys)
    blank = lambda c: F.nullif(F.trim(c), F.lit(""))
    return cards.select(*keys, "pre", "attrs", F.coalesce(blank(F.col("attrs")["data-category"]), blank(F.col("label")), F.lit("Component")).alias("component_type"))


def product_links(nodes: DataFrame, *keys: str, base: str = "", sheets: tuple[str, ...] = ("datasheet-link", "downLoadPdf"), name: str = "data-track-product-name") -> DataFrame:
    """(keys, datasheet, product_name) of product pages: the first link of the first class that has one, made absolute by base, and
    the first name that an element carries. Links that are empty or '#' do not count; both are null where a page has none."""
    href = F.trim(F.col("attrs")["href"])
    rank = F.coalesce(*(F.when(F.array_contains("css", c), i) for i, c in enumerate(sheets)))
    link = F.when((F.col("tag") == "a") & rank.isNotNull() & ~href.isin("", "#"), F.struct(rank.alias("rank"), F.col("pre"), href.alias("href")))
    said = F.when(F.map_contains_key("attrs", name), F.struct("pre", squeeze(F.col("attrs")[name]).alias("name")))
    got = nodes.groupBy(*keys).agg(F.min(link)["href"].alias("href"), F.nullif(F.min(said)["name"], F.lit("")).alias("product_name"))
    return got.select(*keys, F.when(F.col("href").isNotNull(), resolve_url(F.lit(base), F.col("href"))).alias("datasheet"), "product_name")
