"""Part cards of captured pages, the variants of a product, its specification tables, and product pages of several templates."""

from __future__ import annotations

import json
import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions import extract
from tessera.functions.arrays import let
from tessera.operators.audit import merged
from tessera.operators.html import Node, tree
from tessera.operators.specs import nested_value, scoped_values

#: Classes and attributes of the pages. Fixed values.
CARD = "product-gallery-card"
ATTRS = (("data-date", "Release Date"), ("data-capacity", "Capacity (GB)"), ("data-mktsegment", "Market Segment"), ("data-group", "Product Family"), ("data-category", "Category"))
CARD_TYPE = "struct<part_number:string,name:string,model:string,component_type:string,description:string,status:string,datasheet:string,url:string,attrs:map<string,string>>"
_STORAGE = "solid-state|ssd|storage"


def _by_class(node: Node, css: str) -> list[Node]:
    return [k for k in node.below() if isinstance(k, Node) and k.has(css)]


def _attr(node: Node, name: str) -> str:
    return " ".join((node.attrs.get(name) or "").split())


def _one_card(li: Node, label: str) -> dict:
    part = _attr(li, "data-partnumber")
    lines = [t for box in _by_class(li, "c-productCard4__details__content__longDesc") for x in box.all("li") if not x.all("a") and (t := x.text(" ")) and not t.lower().startswith("part number:")]
    lines = lines or [t for x in _by_class(li, "c-productCard4__details__shortDesc")[:1] if (t := x.text())]
    link = lambda css: next((a.attrs["href"] for a in li.all("a") if a.has(css) and a.attrs.get("href") not in (None, "", "#")), "")
    name = _attr(li, "data-name") or next((x.text() for x in _by_class(li, "c-productCard4__header__link__name")), "")
    return {
        "part_number": part, "name": name, "model": _attr(li, "data-group") or part.split("/")[0].strip(), "component_type": _attr(li, "data-category") or label or "Component", "description": "; ".join(dict.fromkeys(lines)),
        "status": next((x.text(" ") for x in _by_class(li, "c-productCard4__footer__string")), "") or "Available", "datasheet": link("downLoadPdf"), "url": link("learn-more"),
        "attrs": {label: v for key, label in ATTRS if (v := _attr(li, key)) and v.upper() != "ALL"},
    }


def page_cards(page: str | None) -> list[dict]:
    """Part cards of one page in order, one for each part number (or name, where it has none)."""
    root, found, seen = tree(page), [], set()
    labels = {x.attrs["data-tab"]: _attr(x, "data-pgtab") or x.text() for x in root.below() if isinstance(x, Node) and x.attrs.get("data-tab") and "data-pgtab" in x.attrs}

    def walk(node: Node, label: str) -> None:
        for k in node.kids:
            if not isinstance(k, Node):
                continue
            own = labels.get(k.attrs.get("id") or "", label) if (k.attrs.get("id") or "").startswith("tabContent") else label
            if k.tag == "li" and k.has(CARD) and _by_class(k, "c-productCard4"):
                card = _one_card(k, own)
                key = card["part_number"] or card["name"]
                if not key or key not in seen:
                    seen.add(key)
                    found.append(card)
            else:
                walk(k, own)

    walk(root, "")
    return found


def cards(html: Column) -> Column:
    """Part cards of a page as an array. The category of a card without one is the label of its tab. Null pages have none."""

    @F.pandas_udf(f"array<{CARD_TYPE}>")
    def parse(pages: pd.Series) -> pd.Series:
        return pd.Series([page_cards(page) for page in pages], dtype=object)

    return parse(html)


@F.udtf(returnType="part_number string, name string, component_type string, status string")
class CardRows:
    """A page's part cards as rows, for lateral joins in SQL: spark.udtf.register("card_rows", CardRows)."""

    def eval(self, html: str):
        for c in page_cards(html):
            yield c["part_number"], c["name"], c["component_type"], c["status"]


def is_storage(component_type: Column) -> Column:
    return F.lower(component_type).rlike(_STORAGE)


def memory_parts(cards_: DataFrame) -> DataFrame:
    """Part records of memory cards (columns of a card): attributes in the name, then in the description, win over those of the card."""
    specs = merged(merged(F.col("attrs"), extract.attributes(F.col("name"))), extract.attributes(F.col("description")))
    got = cards_.withColumn("specs", specs).withColumns({"capacity": F.coalesce(F.try_element_at("specs", F.lit("Capacity")), F.try_element_at("attrs", F.lit("Capacity (GB)")), F.lit("")), "form_factor": F.coalesce(F.try_element_at("specs", F.lit("Module Type")), F.lit(""))})
    blank = lambda c: F.nullif(F.col(c), F.lit(""))
    general = F.struct(blank("part_number").alias("Part Number"), blank("name").alias("Component Name"), blank("model").alias("Component Model"), blank("component_type").alias("Component Type"))
    sections = F.struct(general.alias("General"), F.when(F.size("specs") > 0, F.col("specs")).alias("Specifications"), blank("description").alias("Description"), blank("status").alias("Status"))
    text = F.array_join(F.transform(F.array_sort(F.map_entries("specs")), lambda e: F.concat(e["key"], F.lit(": "), e["value"])), "; ")
    return got.withColumns({"specifications": text, "sections": F.to_json(sections)})


_FILTERS = "struct<Filters:array<struct<Name:string,Items:array<struct<Name:string,PartNumbers:array<string>>>>>>"


def variants(catalog: Column) -> Column:
    """Variants of a product from its catalogue in JSON: array of (capacity, form_factor, part_number).

    Part numbers that a capacity and a form factor share; a combination that shares none does not exist. Without a form
    factor axis only capacities of one part number count, with a blank form factor. Order: capacities, form factors, part numbers.
    """
    axis = lambda axes, name: F.try_element_at(F.filter(axes, lambda f: F.lower(F.trim(f["Name"])) == name), F.lit(1))["Items"]
    none = F.array().cast("array<struct<capacity:string,form_factor:string,part_number:string>>")
    row = lambda c, f, pn: F.struct(c.alias("capacity"), f.alias("form_factor"), pn.alias("part_number"))

    def of(caps: Column, forms: Column) -> Column:
        both = F.flatten(F.transform(caps, lambda c: F.flatten(F.transform(forms, lambda f: F.transform(F.array_sort(F.array_intersect(c["PartNumbers"], f["PartNumbers"])), lambda pn: row(c["Name"], f["Name"], pn))))))
        alone = F.transform(F.filter(caps, lambda c: F.size(c["PartNumbers"]) == 1), lambda c: row(c["Name"], F.lit(""), c["PartNumbers"][0]))
        return F.coalesce(F.when(caps.isNull(), none).when(forms.isNull(), alone).otherwise(both), none)

    return let(F.from_json(catalog, _FILTERS)["Filters"], lambda axes: let(axis(axes, "capacity"), lambda caps: let(axis(axes, "form factor"), lambda forms: of(caps, forms))))


def spec_tables(html: Column, panel: str = "s-productDetails__additional__specificationPanel", tab: str = "l-tabView__tabs__tab") -> Column:
    """Specification tables of a page: array of (form_factor, rows), rows an array of (label, lines); one table for each tab, or one whose form factor is its own row of that name."""

    @F.pandas_udf("array<struct<form_factor:string,rows:array<struct<label:string,lines:array<string>>>>>")
    def parse(pages: pd.Series) -> pd.Series:
        def lines_of(cell: Node) -> list[str]:
            parts, now = [], []

            def walk(n: Node) -> None:
                for k in n.kids:
                    if isinstance(k, str):
                        now.append(k)
                    elif k.tag == "br":
                        parts.append("".join(now))
                        now.clear()
                    else:
                        walk(k)

            walk(cell)
            return [t for x in [*parts, "".join(now)] if (t := " ".join(x.split()))]

        def rows_of(table: Node) -> list[dict]:
            out = []
            for tr in table.all("tr"):
                tds = tr.all("td")
                if len(tds) == 2:
                    for p in [tds[0], *[n for n in tds[0].below() if isinstance(n, Node)]]:
                        p.kids = [k for k in p.kids if not (isinstance(k, Node) and k.tag == "sup")]  # footnote marks
                    if (label := tds[0].text()) and (lines := lines_of(tds[1])):
                        out.append({"label": label, "lines": lines})
            return out

        found = []
        for page in pages:
            got = []
            for box in _by_class(tree(page), panel)[:1]:
                tabs, nodes = _by_class(box, tab), {n.attrs["id"]: n for n in box.below() if isinstance(n, Node) and n.attrs.get("id")}
                if tabs:
                    for t in tabs:
                        at = nodes.get(t.attrs.get("aria-controls") or t.attrs.get("data-tab") or "")
                        tables = at.all("table") if at else []
                        if tables and t.text():
                            got.append({"form_factor": t.text(), "rows": rows_of(tables[0])})
                else:
                    for table in box.all("table")[:1]:
                        rows = rows_of(table)
                        own = next((r["lines"][0] for r in rows if r["label"].lower().startswith("form factor") and len(r["lines"]) == 1), "")
                        got.append({"form_factor": own, "rows": rows})
            found.append(got)
        return pd.Series(found, dtype=object)

    return parse(html)


def specs_of(tables: Column, form_factor: Column, capacity: Column) -> Column:
    """Map of label to value for one variant: its form factor's table, or the only table; of each row the value for its capacity, rows that name capacities but not this one left out."""
    hit = F.try_element_at(F.filter(tables, lambda t: t["form_factor"] == form_factor), F.lit(1))
    plain = lambda c: F.upper(F.regexp_replace(c, r"\s", ""))

    def named(rows: Column) -> Column:
        said = F.flatten(F.transform(F.filter(rows, lambda r: F.startswith(F.lower(r["label"]), F.lit("capacities"))), lambda r: F.transform(F.split(F.array_join(r["lines"], ","), ","), lambda c: F.trim(c))))
        return F.filter(F.coalesce(said, F.array().cast("array<string>")), lambda c: c != "")

    def spelled(capacities: Column) -> Column:
        return F.coalesce(let(plain(capacity), lambda p: F.try_element_at(F.filter(capacities, lambda c: plain(c) == p), F.lit(1))), capacity)

    def entries(rows: Column, every: Column, own: Column) -> Column:
        value = lambda r: F.try_element_at(scoped_values(r["lines"], every), own)
        return F.filter(F.transform(rows, lambda r: F.struct(r["label"].alias("key"), value(r).alias("value"))), lambda e: e["value"].isNotNull())

    # Each step is bound once: lambdas would work out what they name anew for each item.
    last = lambda es: F.filter(es, lambda e, i: ~F.exists(F.slice(es, i + 2, F.greatest(F.size(es), F.lit(1))), lambda o: o["key"] == e["key"]))
    of = lambda rows, caps: let(spelled(caps), lambda own: let(F.array_union(caps, F.array(own)), lambda every: let(entries(rows, every, own), last)))
    got = let(F.coalesce(hit, F.when(F.size(tables) == 1, tables[0]))["rows"], lambda rows: let(named(rows), lambda caps: of(rows, caps)))
    return F.coalesce(F.map_from_entries(got), F.create_map().cast("map<string,string>"))


def storage_parts(cards_: DataFrame, products: DataFrame, url: str = "url") -> DataFrame:
    """One row for each variant of a storage card's product, or one basic row with the reason in `extraction`.

    products: (url, variants, tables), one row of each canonical address. The address is made canonical and each product
    is looked up once: a left join, however many cards name it. Spark judges the products by the bytes of their files, of
    which pages are many times more, so the join says that they are not to be broadcast; cards without a link are dealt
    by their part number, not all to one task. extraction: SUCCESS, COMPONENT_URL_FAILED (no link),
    PRODUCT_PAGE_FAILED (no such page), VARIANT_EXTRACTION_FAILED, SPECIFICATION_EXTRACTION_FAILED.
    """
    from tessera.functions.text import strip_query

    canonical = F.nullif(strip_query(F.col(url)), F.lit(""))
    named = products.select(F.col("url").alias("_url"), F.xxhash64("url").alias("_deal"), "variants", "tables").hint("merge")
    got = cards_.withColumn("_url", canonical).withColumn("_deal", F.xxhash64(F.coalesce("_url", "part_number"))).join(named, ["_url", "_deal"], "left")
    reason = F.when(F.col("_url").isNull(), "COMPONENT_URL_FAILED").when(F.col("variants").isNull(), "PRODUCT_PAGE_FAILED").when(F.size("variants") == 0, "VARIANT_EXTRACTION_FAILED").when(F.size("tables") == 0, "SPECIFICATION_EXTRACTION_FAILED").otherwise("SUCCESS")
    one = got.withColumn("extraction", reason).withColumn("v", F.explode_outer(F.when(F.size("variants") > 0, F.col("variants"))))
    some = F.col("v").isNotNull()
    out = one.withColumns({
        "part_number": F.when(some, F.col("v.part_number")).otherwise(F.col("part_number")), "capacity": F.when(some, F.col("v.capacity")).otherwise(F.coalesce(F.try_element_at("attrs", F.lit("Capacity (GB)")), F.lit(""))),
        "form_factor": F.coalesce(F.col("v.form_factor"), F.lit("")), "specs": F.when(some & (F.size("tables") > 0), specs_of(F.col("tables"), F.col("v.form_factor"), F.col("v.capacity"))).when(some, F.create_map().cast("map<string,string>")).otherwise(F.col("attrs")),
    })
    return out.drop("_url", "_deal", "variants", "tables", "v")


# Headings of a system page and the columns they fill.
HEADINGS = {"memory": "memory", "storage": "storage", "expansions": "expansion", "expansion": "expansion", "cpu / chipsets": "processor", "cpu/chipsets": "processor", "cpu chipsets": "processor", "processor": "processor", "networking": "networking", "network": "networking", "upgrade path": "compatibility", "important configuration notes": "important_configuration_notes"}


def heading_columns(sections: Column) -> list[Column]:
    """Flat columns of sections (heading, attrs) by the headings' aliases, blank where a page has none."""
    from tessera.operators.html import attrs_text

    out = []
    for name in dict.fromkeys(HEADINGS.values()):
        out.append(F.coalesce(F.array_join(F.transform(_of(sections, name), lambda s: attrs_text(s["attrs"])), "; "), F.lit("")).alias(name))
    return out


def _of(sections: Column, name: str) -> Column:
    aliases = [h for h, c in HEADINGS.items() if c == name]
    return F.filter(sections, lambda s: F.lower(F.trim(s["heading"])).isin(*aliases))


_FOOTNOTE = re.compile(r"\[#\d+\]\s*$")


def product_specs(html: Column) -> Column:
    """Map of title to lines of a product page of any of three templates, the first of which a page shows; titles without footnote marks, repeated titles go on.

    Line breaks and list items end lines; other elements stay inside theirs.
    """

    @F.pandas_udf("map<string,array<string>>")
    def parse(pages: pd.Series) -> pd.Series:
        def lines_of(n: Node) -> list[str]:
            parts = [""]

            def walk(x: Node) -> None:
                for k in x.kids:
                    if isinstance(k, str):
                        parts[-1] += k
                    elif k.tag == "br":
                        parts.append("")
                    else:
                        if k.tag == "ul":
                            parts.append("")
                        walk(k)
                        if k.tag in ("li", "ul"):
                            parts.append("")

            walk(n)
            return [t for p in parts if (t := " ".join(re.sub("[™®°’‘]", "", p).split()))]

        out = []
        for page in pages:
            root, specs = tree(page), {}
            at = next((n for n in root.below() if isinstance(n, Node) and n.attrs.get("id") == "Specifications"), root)

            def add(title: str, n: Node, specs=specs) -> None:
                if title := " ".join(_FOOTNOTE.sub("", title).split()):
                    specs.setdefault(title, []).extend(lines_of(n))

            first = lambda n, css: next(iter(_by_class(n, css)), None)
            if items := _by_class(at, "SpecItem"):
                for x in items:
                    if (t := first(x, "Title")) and (d := first(x, "Desc")):
                        add(t.text(), d)
            elif boxes := _by_class(at, "tab-spec-item-box"):
                for box in boxes:
                    head = first(box, "tab-spec-item-box-title")
                    for x in _by_class(box, "tab-spec-item"):
                        if (t := first(x, "tab-spec-item-title")) and (d := first(x, "tab-spec-item-desc")):
                            add(f"{head.text()} - {t.text()}" if head and head.text() else t.text(), d)
            else:
                for tr in at.all("tr"):
                    if (t := first(tr, "spec-label")) and (d := first(tr, "spec-cell")):
                        add(t.text(), d)
            out.append(specs)
        return pd.Series(out, dtype=object)

    return parse(html)


# What a chipset's line holds besides the chipset.
CHIPSET_WORDS = r"(?i)®|\b(?:express\s+)?chipset\b|(?:north|south)\s+bridge\s*:\s*"
# End of fixed values.


def chipsets(spec: Column) -> Column:
    """Cleaned chipset lines under the key 'chipset' at any depth of a JSON text: words of CHIPSET_WORDS go, 'Z 790' becomes 'Z790'; a list is one line. Null without any."""
    clean = lambda x: F.trim(F.regexp_replace(F.regexp_replace(F.trim(F.regexp_replace(x, CHIPSET_WORDS, "")), r"\b([A-Z])\s+([0-9]+)\b", "$1$2"), r"\s{2,}", " "))
    said = lambda lines: F.filter(F.transform(lines, clean), lambda x: x != "")
    of = lambda value, listed: F.when(listed.isNotNull(), F.filter(F.array(F.array_join(said(listed), " ")), lambda x: x != "")).otherwise(said(F.split(value, r"\R")))
    lines = let(nested_value(spec, "chipset", loose=False), lambda v: let(F.from_json(F.when(v.startswith("["), v), "array<string>"), lambda ls: of(v, ls)))
    return let(lines, lambda ls: F.when(F.size(ls) > 0, ls))


def chipset_status(original: Column, found: Column) -> Column:
    """Whether both lists name the same chipsets, in any order, case and spacing, as often."""
    key = lambda a: F.array_sort(F.transform(a, lambda x: F.lower(F.regexp_replace(x, r"[\s®]", ""))))
    return F.when(original.isNull() | found.isNull(), "no chipset data is found in the serverspecification row").when(key(original) == key(found), "match").otherwise("mismatch")


def w_series(lines: Column) -> Column:
    """'Intel Xeon W-3500/W-3400' as one 'Intel Xeon W-... series processor' each, in order, distinct; other lines give none."""
    from tessera.functions.text import respelled

    plain = F.transform(lines, lambda x: F.trim(F.regexp_replace(x, "[®™©]", "")))
    shape = r"(?i)(intel\s+xeon)\s+(w-[0-9]+(?:/w-[0-9]+)+)"
    # Words are respelled one by one, so the brand is respelled once for all of a line's models and the ends are constant.
    named = lambda x: F.struct(respelled(F.regexp_extract(x, shape, 1)).alias("brand"), F.split(F.upper(F.regexp_extract(x, shape, 2)), "/").alias("models"))
    each = F.transform(F.filter(plain, lambda x: x.rlike(shape)), lambda x: let(named(x), lambda n: F.transform(n["models"], lambda w: F.concat_ws(" ", n["brand"], w, respelled(F.lit("Series Processors"))))))
    return F.array_distinct(F.flatten(each))
