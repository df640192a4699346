"""Facts from captured pages: title, first heading, links, block-page predicates."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.arrays import let

FACTS = T.StructType([T.StructField("title", T.StringType()), T.StructField("h1", T.StringType()), T.StructField("links", T.ArrayType(T.StringType()))])


#: Texts by which pages are told apart. Fixed values. The word captcha alone stands on real pages too.
BLOCK_TITLES = ("just a moment", "attention required", "access denied", "are you a human")
BLOCK_TEXTS = ("performing security verification", "cf-chl-widget", "cf-turnstile-response", "enable javascript and cookies to continue")
CONTENT_MARKS = ("c-configuratorresultscard", "product-gallery-card", "s-productdetails")


def _holds(text: Column, marks: tuple[str, ...]) -> Column:
    t = F.lower(F.coalesce(text, F.lit("")))
    out = F.contains(t, F.lit(marks[0]))
    for m in marks[1:]:
        out = out | F.contains(t, F.lit(m))
    return out


def looks_blocked(title: Column, html: Column, most: int = 20000) -> Column:
    """A page that refuses: a telling title, or a body of at most `most` characters with a strong marker."""
    return _holds(title, BLOCK_TITLES) | ((F.length(F.coalesce(html, F.lit(""))) <= most) & _holds(html, BLOCK_TEXTS))


def has_content(html: Column) -> Column:
    return _holds(html, CONTENT_MARKS)


def page_state(title: Column, html: Column, least: int = 500) -> Column:
    """CONTENT, BLOCKED, STRUCTURE_ERROR (under `least` characters) or UNKNOWN."""
    return F.when(has_content(html), "CONTENT").when(looks_blocked(title, html), "BLOCKED").when(F.length(F.coalesce(html, F.lit(""))) < least, "STRUCTURE_ERROR").otherwise("UNKNOWN")


class _Page(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.links: list[str] = []
        self.text: dict[str, str] = {}
        self.inside: str | None = None

    def handle_starttag(self, tag, attrs):
        if tag in ("title", "h1") and tag not in self.text:
            self.inside, self.text[tag] = tag, ""
        if tag == "a":
            self.links += [v for k, v in attrs if k == "href" and v]

    def handle_endtag(self, tag):
        if tag == self.inside:
            self.inside = None

    def handle_data(self, data):
        if self.inside:
            self.text[self.inside] += data


@F.pandas_udf(FACTS)
def page_facts(pages: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    """Title, first heading and distinct link targets in sorted order; nulls for null pages."""
    for s in pages:
        rows = []
        for html in s:
            p = _Page()
            if html is not None:
                p.feed(html)
            rows.append((p.text.get("title"), p.text.get("h1"), sorted(set(p.links)) if html is not None else None))
        yield pd.DataFrame(rows, columns=["title", "h1", "links"])


class Node:
    """An element: tag, attributes, children (elements and texts)."""

    def __init__(self, tag: str, attrs: dict[str, str | None]):
        self.tag, self.attrs, self.kids = tag, attrs, []

    def has(self, css: str) -> bool:
        return css in (self.attrs.get("class") or "").split()

    def below(self) -> Iterator[Node | str]:
        """Everything inside, in document order."""
        rest = self.kids[::-1]
        while rest:
            k = rest.pop()
            yield k
            if isinstance(k, Node):
                rest.extend(k.kids[::-1])

    def all(self, *tags: str) -> list[Node]:
        return [k for k in self.below() if isinstance(k, Node) and k.tag in tags]

    def text(self, between: str = "") -> str:
        return " ".join(between.join(k for k in self.below() if isinstance(k, str)).split())


_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
#: Elements that a new one of the key closes, and those that shield what is outside them.
_CLOSES = {"li": ({"li"}, {"ul", "ol"}), "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "p": ({"p"}, {"div", "li", "td"})}


class _Tree(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.open = [Node("", {})]

    def handle_starttag(self, tag, attrs):
        closes, shields = _CLOSES.get(tag, ((), ()))
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].tag in shields:
                break
            if self.open[i].tag in closes:
                del self.open[i:]
        node = Node(tag, dict(attrs))
        self.open[-1].kids.append(node)
        if tag not in _VOID:
            self.open.append(node)

    def handle_startendtag(self, tag, attrs):
        self.open[-1].kids.append(Node(tag, dict(attrs)))

    def handle_endtag(self, tag):
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].tag == tag:
                del self.open[i:]
                return

    def handle_data(self, data):
        if self.open[-1].tag not in ("script", "style"):
            self.open[-1].kids.append(data)


#: Plain tags and texts, which mean the same to any parser; pages of nothing else are cut by one pattern.
_PLAIN = re.compile(r'<(?:/([a-zA-Z][a-zA-Z0-9]*)|([a-zA-Z][a-zA-Z0-9]*)((?:[ \t\n]+[a-zA-Z][a-zA-Z0-9_-]*(?:="[^"<>&]*")?)*)[ \t\n]*(/?))>|([^<&]+)')
_ATTR = re.compile(r'([a-zA-Z][a-zA-Z0-9_-]*)(="([^"]*)")?')
#: Elements whose content is no markup.
_RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript plaintext".split())


def _plain_tree(html: str) -> Node | None:
    """The tree of a page of plain tags and texts, None of any other."""
    t, at = _Tree(), 0
    for m in _PLAIN.finditer(html):
        if m.start() != at:
            return None
        at = m.end()
        end, tag, attrs, closed, text = m.groups()
        if text is not None:
            t.open[-1].kids.append(text)
        elif end is not None:
            t.handle_endtag(end.lower())
        else:
            tag = tag.lower()
            if tag in _RAW:
                return None
            found = [(k.lower(), v if eq else None) for k, eq, v in _ATTR.findall(attrs)] if attrs else []
            (t.handle_startendtag if closed else t.handle_starttag)(tag, found)
    return t.open[0] if at == len(html) else None


def tree(html: str | None) -> Node:
    html = html or ""
    plain = _plain_tree(html)
    if plain is not None:
        return plain
    t = _Tree()
    t.feed(html)
    t.close()
    return t.open[0]


#: Label of what a card lists without labels.
DETAILS = "Details"


def _card(card: Node, items: list[Node]) -> dict[str, list[str]]:
    plain = lambda t: t.replace('"', "'")
    found: dict[str, list[str]] = {}
    loose: list[str] = []
    for li in items:
        label, values = li.all("h4"), [plain(t) for p in li.all("p") if (t := p.text())]
        if label and values:
            found.setdefault(plain(label[0].text()), []).append(" / ".join(values))
        else:
            loose += values or [t for t in [plain(li.text(" "))] if t]
    if loose:
        found[DETAILS] = loose
    return {k: list(dict.fromkeys(v)) for k, v in found.items()}


def spec_cards(html: Column, card: str, listing: str, fallback: str, ignored: tuple[str, ...] = ()) -> Column:
    """Sections of a page: array of (heading, attrs), attrs an array of (label, items).

    card: class of a section; listing: class of the lists whose direct items hold a label (h4) and values (p); fallback:
    class of rows whose items count where a card has no such list. Values of one item are joined by ' / ', repeated
    labels gather distinct items, items without a label go to DETAILS, texts in `ignored` are left out. Sections
    of one heading are merged, later labels count; without a heading or items there is none. A null page has no sections.
    """

    @F.pandas_udf("array<struct<heading:string,attrs:array<struct<label:string,items:array<string>>>>>")
    def parse(pages: pd.Series) -> pd.Series:
        out = []
        for page in pages:
            sections: dict[str, dict[str, list[str]]] = {}
            for c in tree(page).below():
                if isinstance(c, Node) and c.has(card) and (h := c.all("h3")):
                    items = [li for ul in c.all("ul") if ul.has(listing) for li in ul.kids if isinstance(li, Node) and li.tag == "li"]
                    items = items or [li for row in c.below() if isinstance(row, Node) and row.has(fallback) for li in row.all("li")]
                    attrs = _card(c, [li for li in items if li.text(" ") not in ignored])
                    if (heading := h[0].text()) and attrs:
                        sections.setdefault(heading, {}).update(attrs)
            out.append([{"heading": h, "attrs": [{"label": k, "items": v} for k, v in a.items()]} for h, a in sections.items()])
        return pd.Series(out, dtype=object)

    return parse(html)


def attrs_text(attrs: Column) -> Column:
    """'label: value; label: value'; several items, and DETAILS always, as a JSON array; DETAILS alone without its label."""
    listed = lambda a: F.concat(F.lit('["'), F.array_join(F.transform(a["items"], lambda x: F.replace(x, F.lit("\\"), F.lit("\\\\"))), '", "'), F.lit('"]'))
    value = lambda a: F.when((F.size(a["items"]) == 1) & (a["label"] != DETAILS), a["items"][0]).otherwise(listed(a))
    labelled = F.array_join(F.transform(attrs, lambda a: F.concat(a["label"], F.lit(": "), value(a))), "; ")
    return F.when((F.size(attrs) == 1) & (attrs[0]["label"] == DETAILS), value(attrs[0])).otherwise(labelled)


@F.pandas_udf(T.ArrayType(T.ArrayType(T.StringType())))
def table_rows(pages: pd.Series) -> pd.Series:
    """Cells of every row of every table, squeezed; rows without cells are left out. A null page has no rows."""
    rows = ([[c.text(" ") for c in r.all("td", "th")] for r in tree(p).all("tr")] for p in pages)
    return pd.Series([[r for r in page if r] for page in rows], dtype=object)


def row_pairs(rows: Column) -> Column:
    """Array of (label, value) of rows of a label and values; a row without label goes on with the one before; values of repeated labels are joined by ' | '."""
    zero = F.array().cast("array<struct<label:string,value:string>>")

    def step(done: Column, r: Column) -> Column:
        value = F.array_join(F.filter(F.slice(r, F.lit(2), F.greatest(F.size(r) - 1, F.lit(0))), lambda v: v != ""), " | ")
        label = F.coalesce(F.nullif(r[0], F.lit("")), F.try_element_at(done, F.lit(-1))["label"])
        return let(value, lambda v: let(label, lambda name: grow(done, name, v)))

    def grow(done: Column, label: Column, value: Column) -> Column:
        grown = F.transform(done, lambda d: F.struct(d["label"].alias("label"), F.when(d["label"] == label, F.concat_ws(" | ", d["value"], value)).otherwise(d["value"]).alias("value")))
        new = F.when(F.exists(done, lambda d: d["label"] == label), grown).otherwise(F.concat(done, F.array(F.struct(label.alias("label"), value.alias("value")))))
        return F.when(label.isNull() | (value == ""), done).otherwise(new)

    return F.aggregate(rows, zero, step)


def product_head(html: Column, url: Column, crumbs: str = "bread", root: str = "/products", copy: str = "copyLink") -> Column:
    """Struct of name, category, image and address of a product page.

    name: first heading; category: text of the first link below class `crumbs` that leads further than `root`; image:
    og:image, made absolute by the url; address: value of the element of id `copy`, else the url, without slashes at its
    end. name, category and image are null where a page has none.
    """

    @F.pandas_udf("struct<name:string,category:string,image:string,address:string>")
    def parse(pages: pd.Series, urls: pd.Series) -> pd.DataFrame:
        out = []
        for page, at in zip(pages, urls):
            nodes = [n for n in tree(page).below() if isinstance(n, Node)]
            links = [a for n in nodes if n.has(crumbs) for a in n.all("a")]
            category = next((a.text() for a in links if f"{root}/" in (a.attrs.get("href") or "").rstrip("/")), None)
            image = next((n.attrs.get("content") for n in nodes if n.tag == "meta" and n.attrs.get("property") == "og:image"), None)
            own = next((v for n in nodes if n.attrs.get("id") == copy and (v := n.attrs.get("value"))), at)
            name = next((n.text() for n in nodes if n.tag == "h1"), None)
            out.append((name, category, urljoin(at or "", image.strip()) if image else None, own.strip().rstrip("/") if own else None))
        return pd.DataFrame(out, columns=["name", "category", "image", "address"])

    return parse(html, url)
