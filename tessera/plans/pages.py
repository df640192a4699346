"""Queries of captured pages and product documents, with their DuckDB SQL. Pages are built from part."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, Window
from pyspark.sql import functions as F

from tessera.functions import text
from tessera.operators import crawl, hierarchy, html, nodes, parts, processors
from tessera.plans.catalogue import read_table, register, spread
from tessera.sources.shared import shared_dir, written
from tessera.streaming import runs

_CARDS = """concat('<button data-pgtab="Storage" data-tab="tabContent0_1">x</button><ul>',
  '<li class="product-gallery-card" data-partnumber="', p_name, '/', p_partkey, '" data-name="DDR4 ', 2000 + p_size, 'MT/s" data-group="ALL" data-capacity="', p_size, '" data-category="Memory"><div class="c-productCard4"><div class="c-productCard4__details__content__longDesc"><ul><li>', p_size, 'GB ECC DIMM</li><li>Part Number: x</li><li><a href="#">sheet</a></li></ul></div></div></li>',
  '<li class="product-gallery-card" data-partnumber="', p_name, '/', p_partkey, '"><div class="c-productCard4">again</div></li></ul>',
  '<div id="tabContent0_1"><ul><li class="product-gallery-card" data-partnumber="S', p_partkey, '" data-name="', p_brand, '"><div class="c-productCard4"><a class="learn-more" href="', CASE p_partkey % 5 WHEN 0 THEN '#' ELSE concat('http://x.example/p', p_partkey, '?q=', p_partkey) END, '">more</a><span class="c-productCard4__footer__string">Gone <b>soon</b></span></div></li></ul></div>')"""


def _cards(spark, sf):
    page = spread(read_table(spark, sf, "part")).select("p_partkey", F.explode(parts.cards(F.expr(_CARDS))).alias("c"))
    return page.select("p_partkey", "c.*")


@register("part_cards", """
SELECT p_partkey, p_name || '/' || p_partkey AS part_number, 'DDR4 ' || (2000 + p_size) || 'MT/s' AS name, 'ALL' AS model, 'Memory' AS component_type, p_size || 'GB ECC DIMM' AS description, 'Available' AS status, false AS storage FROM part
UNION ALL SELECT p_partkey, 'S' || p_partkey, p_brand, 'S' || p_partkey, 'Storage', '', 'Gone soon', true FROM part""")
def part_cards(spark, sf):
    return _cards(spark, sf).select("p_partkey", "part_number", "name", "model", "component_type", "description", "status", parts.is_storage(F.col("component_type")).alias("storage"))


@register("card_rows", """
SELECT p_partkey, p_name || '/' || p_partkey AS part_number, 'Memory' AS component_type FROM part UNION ALL SELECT p_partkey, 'S' || p_partkey, 'Storage' FROM part""")
def card_rows(spark, sf):
    """The same cards by a table function in a lateral join."""
    page = spread(read_table(spark, sf, "part")).select("p_partkey", F.expr(_CARDS).alias("html"))
    return page.lateralJoin(parts.CardRows(F.col("html").outer())).select("p_partkey", "part_number", "component_type")


@register("memory_parts", """
SELECT p_partkey, p_name || '/' || p_partkey AS part_number, p_size || 'GB' AS capacity, 'DIMM' AS form_factor, 'Capacity: ' || p_size || 'GB; Capacity (GB): ' || p_size || '; Category: Memory; ECC: ECC; Memory Type: DDR4; Module Type: DIMM; Speed: ' || (2000 + p_size) || 'MT/s' AS specifications, p_name || '/' || p_partkey AS in_sections FROM part""")
def memory_parts(spark, sf):
    got = parts.memory_parts(_cards(spark, sf).filter(~parts.is_storage(F.col("component_type"))))
    return got.select("p_partkey", "part_number", "capacity", "form_factor", "specifications", F.get_json_object("sections", "$.General['Part Number']").alias("in_sections"))


_CATALOG = """concat('{"Filters":[{"Name":"Capacity","Items":[{"Name":"256GB","PartNumbers":["A', k, '","B', k, '"]},{"Name":"512 GB","PartNumbers":["C', k, '"]},{"Name":"1TB","PartNumbers":["D', k, '"]}]}', CASE WHEN k % 2 = 0 THEN concat(',{"Name":"Form Factor","Items":[{"Name":"mSATA","PartNumbers":["A', k, '","C', k, '"]},{"Name":"M.2","PartNumbers":["B', k, '","C', k, '"]}]}') ELSE '' END, ']}')"""
_TABLES = """concat('<div class="s-productDetails__additional__specificationPanel"><button class="l-tabView__tabs__tab" data-tab="t0">mSATA</button><button class="l-tabView__tabs__tab" aria-controls="t1">M.2</button>',
 '<div id="t0"><table><tr><td>Capacities <sup>[2]</sup></td><td>256GB, 512 GB</td></tr><tr><td>Endurance</td><td>about<br>256GB — ', k, 'TB<br>512GB — 9TB</td></tr></table></div><div id="t1"><table><tr><td>Capacities</td><td>256GB, 512 GB, 1TB</td></tr><tr><td>Speed</td><td>256GB–1TB — ', 100 + k, '</td></tr></table></div></div>')"""


def _products(spark, sf):
    """A product page for each part; some could not be fetched, some have no tables."""
    p = spread(read_table(spark, sf, "part")).select(F.col("p_partkey").alias("k"))
    return p.select("k", F.concat(F.lit("http://x.example/p"), "k").alias("url"), F.when(F.col("k") % 7 != 6, parts.variants(F.expr(_CATALOG))).alias("variants"), F.when(F.col("k") % 7 == 4, F.array().cast("array<struct<form_factor:string,rows:array<struct<label:string,lines:array<string>>>>>")).otherwise(parts.spec_tables(F.expr(_TABLES))).alias("tables"))


_VARIANTS = """v AS (SELECT k, unnest(CASE WHEN k % 2 = 0 THEN [{'c': '256GB', 'f': 'mSATA', 'p': 'A' || k}, {'c': '256GB', 'f': 'M.2', 'p': 'B' || k}, {'c': '512 GB', 'f': 'mSATA', 'p': 'C' || k}, {'c': '512 GB', 'f': 'M.2', 'p': 'C' || k}] ELSE [{'c': '512 GB', 'f': '', 'p': 'C' || k}, {'c': '1TB', 'f': '', 'p': 'D' || k}] END) AS x FROM (SELECT p_partkey AS k FROM part WHERE p_partkey % 7 <> 6)),
s AS (SELECT k, x.c AS capacity, x.f AS form_factor, x.p AS part_number, CASE WHEN k % 7 = 4 THEN '' WHEN x.f = 'mSATA' AND x.c = '256GB' THEN 'Capacities: 256GB, 512 GB; Endurance: about | ' || k || 'TB' WHEN x.f = 'mSATA' THEN 'Capacities: 256GB, 512 GB; Endurance: about | 9TB' WHEN x.f = 'M.2' THEN 'Capacities: 256GB, 512 GB, 1TB; Speed: ' || (100 + k) ELSE '' END AS specs FROM v)"""
_SHOWN = "array_join(transform(array_sort(map_entries(specs)), e -> concat(e.key, ': ', e.value)), '; ')"


@register("product_variants", f"WITH {_VARIANTS} SELECT * FROM s")
def product_variants(spark, sf):
    got = _products(spark, sf).select("k", "tables", F.explode("variants").alias("v"))
    return got.select("k", "v.*", parts.specs_of(F.col("tables"), F.col("v.form_factor"), F.col("v.capacity")).alias("specs")).withColumn("specs", F.expr(_SHOWN)).select("k", "capacity", "form_factor", "part_number", "specs")


@register("storage_parts", f"""
WITH {_VARIANTS}, c AS (SELECT p_partkey, CASE WHEN p_partkey % 5 = 0 THEN NULL ELSE p_partkey END AS k FROM part)
SELECT p_partkey, CASE WHEN s.part_number IS NOT NULL THEN s.part_number ELSE 'S' || p_partkey END AS part_number, coalesce(s.capacity, '') AS capacity, coalesce(s.form_factor, '') AS form_factor, coalesce(s.specs, '') AS specs,
  CASE WHEN c.k IS NULL THEN 'COMPONENT_URL_FAILED' WHEN c.k % 7 = 6 THEN 'PRODUCT_PAGE_FAILED' WHEN c.k % 7 = 4 THEN 'SPECIFICATION_EXTRACTION_FAILED' ELSE 'SUCCESS' END AS extraction FROM c LEFT JOIN s ON c.k = s.k""")
def storage_parts(spark, sf):
    cards = _cards(spark, sf).filter(parts.is_storage(F.col("component_type")))
    return parts.storage_parts(cards, _products(spark, sf)).withColumn("specs", F.expr(_SHOWN)).select("p_partkey", "part_number", "capacity", "form_factor", "specs", "extraction")


_TEMPLATES = """CASE p_partkey % 3 WHEN 0 THEN concat('<div id="Specifications"><div class="SpecItem"><div class="Title">', p_name, ' [#1]</div><div class="Desc">', p_type, '<sup>™</sup> x<br/>', p_size, '</div></div><div class="SpecItem"><div class="Title">', p_name, '</div><div class="Desc"><ul><li>', p_brand, '</li></ul></div></div></div>')
  WHEN 1 THEN concat('<div class="tab-spec-item-box"><p class="tab-spec-item-box-title">', p_brand, '</p><div class="tab-spec-item"><p class="tab-spec-item-title">', p_name, '</p><p class="tab-spec-item-desc">', p_type, '</p></div></div>') ELSE concat('<table><tr><td class="spec-label">', p_name, '</td><td class="spec-cell">', p_size, '<br>', p_type, '</td></tr></table>') END"""


@register("product_templates", """
SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN p_name || '=' || p_type || ' x|' || p_size || '|' || p_brand WHEN 1 THEN p_brand || ' - ' || p_name || '=' || p_type ELSE p_name || '=' || p_size || '|' || p_type END AS specs FROM part""")
def product_templates(spark, sf):
    got = spread(read_table(spark, sf, "part")).select("p_partkey", parts.product_specs(F.expr(_TEMPLATES)).alias("m"))
    return got.select("p_partkey", F.expr("array_join(transform(array_sort(map_entries(m)), e -> concat(e.key, '=', array_join(e.value, '|'))), ';')").alias("specs"))


@register("chipset_search", """
SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN 'Z' || p_size WHEN 1 THEN 'Intel X' || p_size || '|C621' WHEN 2 THEN p_brand || ' A1' END AS chipsets, CASE WHEN p_partkey % 4 = 3 THEN 'no chipset data is found in the serverspecification row' WHEN p_partkey % 4 = 0 AND p_partkey % 3 = 0 THEN 'match' ELSE 'mismatch' END AS status,
  'Intel Xeon W-' || (2000 + p_size) || ' series processor|Intel Xeon W-' || (3000 + p_size) || ' series processor' AS w_series FROM part""")
def chipset_search(spark, sf):
    spec = F.expr("""CASE p_partkey % 4 WHEN 0 THEN concat('{"a": [{"b": {"Chipset ": "Z ', p_size, ' Express Chipset"}}]}') WHEN 1 THEN concat('{"chipset": "Intel® X', p_size, '\\\\n North Bridge: C621 chipset"}') WHEN 2 THEN concat('[{"CHIPSET": ["', p_brand, '", "®", "A 1"]}]') ELSE concat('{"chip": "', p_name) END""")
    got = spread(read_table(spark, sf, "part")).withColumn("c", parts.chipsets(spec))
    lines = F.array(F.expr("concat('INTEL xeon® w-', 2000 + p_size, '/W-', 3000 + p_size)"), F.expr("concat('Intel Xeon W-', 2000 + p_size, '/w-', 3000 + p_size, ' ')"), F.col("p_name"))
    original = F.array(F.expr("CASE WHEN p_partkey % 3 = 0 THEN concat('z ', p_size) ELSE p_name END"))
    return got.select("p_partkey", F.array_join("c", "|").alias("chipsets"), parts.chipset_status(original, F.col("c")).alias("status"), F.array_join(parts.w_series(lines), "|").alias("w_series"))


_PROCESSOR_CELLS = """CASE p_partkey % 8 WHEN 0 THEN concat('{"Superchip": ["- NVIDIA® Grace CPU ', p_size, '", "nvidia hopper gpu", "Nvidia Grace CPU"]}')
  WHEN 1 THEN concat('{"CPU": "Intel® Xeon® w-', 2000 + p_size, '/W-', 3000 + p_size, '"}') WHEN 2 THEN concat('{"CPU": ["AMD ryzen™ threadripper™ pro ', p_partkey, 'WX"]}')
  WHEN 3 THEN concat('{"CPU": ["AMD EPYC™ ', p_partkey, ' Series Processors", "AMD Ryzen™ ', p_size, ' Series Processors"], "APU": ["TDP up to ', p_size, 'W", "[Note] x"]}')
  WHEN 4 THEN concat('{"CPU": {"a": "Support for ', p_size, 'th and ', p_size + 1, 'th Generation: Intel® A', p_partkey, ' Processors / Intel B Processor in the LGA package"}}')
  WHEN 5 THEN concat('{"CPU": ["AmpereOne®", "Family Processors", "TDP up to ', p_size, 'W"]}') WHEN 6 THEN concat('{"CPU": ["Ampere", "Altra", "Max or Altra", "', p_size, ' nm technology"]}')
  ELSE concat('{"CPU": ["', p_name, '"') END"""


@register("processor_lists", """
SELECT p_partkey, CASE p_partkey % 8 WHEN 0 THEN 'NVIDIA Grace CPU|NVIDIA Hopper GPU' WHEN 1 THEN 'Intel Xeon W-' || (2000 + p_size) || ' series processor|Intel Xeon W-' || (3000 + p_size) || ' series processor'
  WHEN 2 THEN 'Ryzen Threadripper PRO ' || p_partkey || 'WX' WHEN 3 THEN 'AMD EPYC ' || p_partkey || ' Series processors|AMD Ryzen ' || p_size || ' Series processors'
  WHEN 4 THEN concat_ws('|', p_size || 'th Generation Intel A' || p_partkey || ' processors', p_size || 'th Generation Intel B processors', (p_size + 1) || 'th Generation Intel A' || p_partkey || ' processors', (p_size + 1) || 'th Generation Intel B processors')
  WHEN 5 THEN 'AmpereOne  Family processor' WHEN 6 THEN 'Ampere  Altra  Max or Ampere Altra  processor' END AS processors FROM part""")
def processor_lists(spark, sf):
    return spread(read_table(spark, sf, "part")).select("p_partkey", F.array_join(processors.processor_list(F.expr(_PROCESSOR_CELLS)), "|").alias("processors"))


@register("heading_columns", """
SELECT p_partkey, 'Max: ' || p_size || ' GB' AS memory, '' AS storage, '' AS expansion, '["' || p_name || '"]' AS processor, CASE WHEN p_partkey % 2 = 0 THEN 'Port: ' || p_type ELSE '' END AS networking, '' AS compatibility, '' AS important_configuration_notes FROM part""")
def heading_columns(spark, sf):
    page = """concat('<div class="card"><h3>Memory</h3><ul class="l"><li><h4>Max</h4><p>', p_size, ' GB</p></li></ul></div><div class="card"><h3>CPU / Chipsets</h3><ul class="l"><li><p>', p_name, '</p></li></ul></div>', CASE WHEN p_partkey % 2 = 0 THEN concat('<div class="card"><h3>Network</h3><ul class="l"><li><h4>Port</h4><p>', p_type, '</p></li></ul></div>') ELSE '' END)"""
    got = spread(read_table(spark, sf, "part")).withColumn("s", html.spec_cards(F.expr(page), "card", "l", "row"))
    return got.select("p_partkey", *parts.heading_columns(F.col("s")))


@register("page_states", """
SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN 'BLOCKED' WHEN 1 THEN 'BLOCKED' WHEN 2 THEN 'CONTENT' WHEN 3 THEN 'UNKNOWN' ELSE 'STRUCTURE_ERROR' END AS state, p_partkey % 5 < 2 AS blocked FROM part""")
def page_states(spark, sf):
    title = F.expr("CASE WHEN p_partkey % 5 = 0 THEN 'Just a moment...' ELSE p_name END")
    body = F.expr("CASE p_partkey % 5 WHEN 1 THEN concat(p_name, ' Performing security verification') WHEN 2 THEN concat('<li class=\"product-gallery-card\">', p_name) WHEN 3 THEN concat('captcha performing security verification', repeat('x', 20000)) ELSE p_name END")
    return read_table(spark, sf, "part").select("p_partkey", html.page_state(title, body).alias("state"), html.looks_blocked(title, body).alias("blocked"))


@register("crawl_links", r"""
SELECT DISTINCT regexp_replace(CASE WHEN regexp_matches(x, '^[a-z]+://') THEN x WHEN starts_with(x, '/') THEN regexp_extract(url, '^([a-z]+://[^/]+)') || x ELSE regexp_replace(regexp_replace(url, '[?#].*$', ''), '/+$', '') || '/' || x END, '/+$', '') AS url
FROM (SELECT url, unnest(list_distinct(regexp_extract_all(html, '<a href="([^"]*)"', 1))) AS x FROM pages) WHERE x <> '' AND contains(x, 'e')""")
def crawl_links(spark, sf):
    """A listing's pages to distinct product addresses."""
    links = read_table(spark, sf, "pages").select("url", F.explode(html.page_facts("html")["links"]).alias("x")).filter("x != '' AND contains(x, 'e')")
    return links.select(text.resolve_url(F.col("url"), F.col("x")).alias("url")).distinct()


_TABS = """concat('<main><nav>', array_join(transform(sequence(1, 1 + p_size % 4), i -> concat('<button data-tab="tabContent0_', i, '" data-pgtab="', CASE WHEN i % 2 = 0 THEN concat('Tab ', i) ELSE '' END, '"><i>', p_brand, '</i> no <b>', i, '</b></button>')), ''), '</nav>',
  array_join(transform(sequence(1, 1 + p_size % 4), i -> concat('<div id="tabContent0_', i, '"><section><ul>', array_join(transform(sequence(1, 1 + (p_size + i) % 3), j -> concat('<li class="x product-gallery-card" data-partnumber="', p_partkey, '-', i, '-', j, '"', CASE WHEN j = 2 THEN ' data-category="Memory"' ELSE '' END, '><p>card')), ''), '</ul></section></div>')), ''),
  '<li class="product-gallery-card" data-partnumber="', p_partkey, '-0-0"></li></main>')"""


@register("tab_cards", """
WITH t AS (SELECT p_partkey, p_size, p_brand, unnest(range(1, 2 + p_size % 4)) AS i FROM part), c AS (SELECT *, unnest(range(1, 2 + (p_size + i) % 3)) AS j FROM t)
SELECT p_partkey, concat(p_partkey, '-', i, '-', j) AS part_number, CASE WHEN j = 2 THEN 'Memory' WHEN i % 2 = 0 THEN 'Tab ' || i ELSE p_brand || ' no ' || i END AS component_type FROM c
UNION ALL SELECT p_partkey, concat(p_partkey, '-0-0'), 'Component' FROM part""")
def tab_cards(spark, sf):
    """Cards with the labels of the tab panels around them: the page as a relation of elements, containment as a join."""
    found = written(nodes.page_nodes(spread(read_table(spark, sf, "part")), F.expr(_TABS), "p_partkey"), "nodes")
    return nodes.labelled_cards(found, "p_partkey").select("p_partkey", F.col("attrs")["data-partnumber"].alias("part_number"), "component_type")


_BLOCKS = ("nav", "article", "footer")


@register("page_blocks", f"""
WITH b AS (SELECT page_id, b.block, regexp_extract(html, '(?s)<' || b.block || '>(.*)</' || b.block || '>', 1) AS part FROM pages, (VALUES {", ".join(f"('{b}')" for b in _BLOCKS)}) AS b(block)), t AS (SELECT *, unnest(['a', 'p', 'li']) AS tag FROM b),
n AS (SELECT page_id, block, tag, len(regexp_extract_all(part, '<' || tag || '[ >]')) AS n, CASE WHEN tag = 'a' THEN array_to_string(regexp_extract_all(part, '<a href="([^"]*)"', 1), ' ') END AS links FROM t)
SELECT page_id, block, tag, n, links FROM n WHERE n > 0""")
def page_blocks(spark, sf):
    """Links, paragraphs and list items of captured pages by the block around them."""
    pages = read_table(spark, sf, "pages")
    found = written(nodes.page_nodes(pages, F.col("html"), "page_id"), "nodes")
    blocks = found.filter(F.col("tag").isin(*_BLOCKS)).withColumn("label", F.col("tag"))
    held = nodes.inside(found.filter(F.col("tag").isin("a", "p", "li")), blocks, "page_id").filter("label IS NOT NULL")
    links = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pre", F.col("attrs")["href"].alias("href")))), lambda x: x["href"]), " ")
    return held.groupBy("page_id", F.col("label").alias("block"), "tag").agg(F.count("*").alias("n"), links.alias("links")).withColumn("links", F.when(F.col("tag") == "a", F.col("links")))


_LISTING = """l AS (SELECT regexp_extract(url, '^[a-z]+://([^/]+)', 1) AS site, page_id, html FROM pages), n AS (SELECT *, row_number() OVER (PARTITION BY site ORDER BY page_id) AS page, count(*) OVER (PARTITION BY site) AS total FROM l)"""


@register("listing_crawl", rf"""
WITH RECURSIVE {_LISTING}, s AS (SELECT site, page, least(total + 1, 4 * page) AS said, CASE WHEN page_id % 11 = 3 THEN [] ELSE regexp_extract_all(html, '<a href="([^"]*)"', 1) END AS items FROM n),
w(site, page, last) AS (SELECT site, page, said FROM s WHERE page = 1 UNION ALL SELECT w.site, s.page, greatest(w.last, s.said) FROM w JOIN s ON s.site = w.site AND s.page = w.page + 1 WHERE w.page < w.last AND len(s.items) > 0)
SELECT w.site, count(*) AS pages, count(DISTINCT u.url) AS links, min(u.url) AS first_link FROM w JOIN s USING (site, page) LEFT JOIN LATERAL (SELECT unnest(s.items) AS url) u ON true GROUP BY w.site""".replace("count(*) AS pages", "count(DISTINCT page) AS pages"))
def listing_crawl(spark, sf):
    """Listings of each host, a captured page each, walked by pagers that show some pages ahead, to the last page or an empty one."""
    facts = read_table(spark, sf, "pages").select(F.regexp_extract("url", "^[a-z]+://([^/]+)", 1).alias("site"), "page_id", F.when(F.col("page_id") % 11 == 3, F.array().cast("array<string>")).otherwise(F.regexp_extract_all("html", F.lit('<a href="([^"]*)"'), F.lit(1))).alias("items"))
    w = Window.partitionBy("site")
    listed = facts.withColumns({"page": F.row_number().over(w.orderBy("page_id")), "total": F.count("*").over(w)})
    visited, links = crawl.crawl(listed.withColumn("last_page", F.least(F.col("total") + 1, 4 * F.col("page"))), pager="every")
    found = links.groupBy("site").agg(F.count("*").alias("links"), F.min("url").alias("first_link"))
    got = visited.groupBy("site").agg(F.count("*").alias("pages")).join(found, "site", "left")
    return got.withColumn("links", F.coalesce("links", F.lit(0).cast("long")))


@register("section_documents", """
WITH o AS (SELECT o_orderkey, o_orderpriority FROM orders), l AS (SELECT l_orderkey, l_returnflag, list(l_partkey::VARCHAR ORDER BY l_linenumber, l_partkey) AS vs, min(l_linenumber * 1000000 + l_partkey) AS pos FROM lineitem GROUP BY ALL),
m AS (SELECT l_orderkey, string_agg(to_json(l_returnflag) || ':{"Part":' || CASE WHEN len(vs) = 1 THEN to_json(vs[1]) ELSE to_json(vs) END || '}', ',' ORDER BY pos, l_returnflag) AS j FROM l GROUP BY l_orderkey)
SELECT o_orderkey, '{"Order":{"Priority":' || to_json(o_orderpriority) || ',"Details":["#' || o_orderkey || '"]' || CASE WHEN j IS NULL THEN '' ELSE ',"Items":{' || j || '}' END || '}}' AS document FROM o LEFT JOIN m ON o_orderkey = l_orderkey""")
def section_documents(spark, sf):
    """Orders as documents: sections two to four names deep in the order of their rows, repeated values as lists."""
    o, l = read_table(spark, sf, "orders"), read_table(spark, sf, "lineitem")
    row = lambda df, key, names, value, at, within=(0, 0): df.select(F.col(key).alias("o_orderkey"), F.array(*names).alias("path"), value.cast("string").alias("value"), at.cast("long").alias("place"), F.struct(*(x if isinstance(x, Column) else F.lit(x) for x in within)).cast("struct<a:long,b:long>").alias("within"))
    name = F.lit
    rows = row(o, "o_orderkey", [name("Order"), name("Priority")], F.col("o_orderpriority"), F.lit(-2)).unionByName(row(o, "o_orderkey", [name("Order"), name("Details")], F.concat(F.lit("#"), "o_orderkey"), F.lit(-1)))
    rows = rows.unionByName(row(l, "l_orderkey", [name("Order"), name("Items"), F.col("l_returnflag"), name("Part")], F.col("l_partkey"), F.col("l_linenumber").cast("long") * 1000000 + F.col("l_partkey"), (F.col("l_linenumber"), F.col("l_partkey"))))
    return hierarchy.nested_json(rows, "o_orderkey", "path", "value", "place", listed=("Details",), within="within").select("o_orderkey", "document")


_SHEETS = """concat('<html><a class="downLoadPdf" href="', CASE WHEN p_partkey % 3 = 0 THEN '#' ELSE concat('/low/', p_partkey, '.pdf') END, '">x</a>', CASE WHEN p_partkey % 2 = 0 THEN concat('<p><a class="b datasheet-link" href=" ', CASE WHEN p_partkey % 5 = 0 THEN concat('https://cdn.example/', p_size, '.pdf') ELSE concat('/high/', p_size) END, ' ">sheet</a>') ELSE '' END,
  CASE WHEN p_partkey % 4 <> 1 THEN concat('<span data-track-product-name="', p_name, '   ', p_brand, '"></span><b data-track-product-name="other">') ELSE '' END)"""


@register("product_links", """
SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 AND p_partkey % 5 = 0 THEN 'https://cdn.example/' || p_size || '.pdf' WHEN p_partkey % 2 = 0 THEN 'https://shop.example/high/' || p_size WHEN p_partkey % 3 <> 0 THEN 'https://shop.example/low/' || p_partkey || '.pdf' END AS datasheet,
  CASE WHEN p_partkey % 4 <> 1 THEN p_name || ' ' || p_brand END AS product_name FROM part""")
def product_links(spark, sf):
    """Data sheet addresses and names of product pages."""
    found = nodes.page_nodes(spread(read_table(spark, sf, "part")), F.expr(_SHEETS), "p_partkey")
    return nodes.product_links(found, "p_partkey", base="https://shop.example")


_OUTCOME = "(page_id * 7 + {0} * {0} * page_id) % 5 > 1 AND page_id % 13 <> 4"
_TRIED = f"t AS (SELECT page_id, page_id % 4 AS worker, n, {_OUTCOME.format('n')} AS ok FROM pages, generate_series(0, 2) AS s(n)), a AS (SELECT * FROM t WHERE NOT EXISTS (SELECT 1 FROM t e WHERE e.page_id = t.page_id AND e.n < t.n AND e.ok))"


def _page_run(spark, sf):
    """Three passes over captured pages whose outcomes follow from their numbers; returns (outcomes, history)."""
    tasks = read_table(spark, sf, "pages").select("page_id", (F.col("page_id") % 4).alias("worker"))
    outcome = lambda pending, n: pending.withColumn("ok", F.expr(_OUTCOME.format(n))).withColumn("reason", F.when(~F.col("ok"), F.lit(f"pass {n}")))
    root = f"{shared_dir(spark)}/page-run-{uuid.uuid4().hex[:12]}"
    return runs.run_rounds(tasks, outcome, root, "page_id", "worker"), runs.attempts(spark, root)


@register("page_run", f"""
WITH {_TRIED} SELECT page_id, max_by(ok, n) AS ok, CASE WHEN NOT max_by(ok, n) THEN 'pass 2' END AS reason, count(*) AS tries FROM a GROUP BY page_id""")
def page_run(spark, sf):
    """Each page's last outcome after a pass and two more over what failed, from the history in the shared folder."""
    return _page_run(spark, sf)[0]


@register("page_run_pauses", f"""
WITH {_TRIED}, s AS (SELECT *, sum(CASE WHEN ok THEN 1 ELSE 0 END) OVER (PARTITION BY n, worker ORDER BY page_id) AS island FROM a), r AS (SELECT n, worker, island, count(*) FILTER (NOT ok) // 2 AS trips FROM s GROUP BY ALL)
SELECT n AS round, worker, sum(trips)::BIGINT AS pauses FROM r GROUP BY n, worker""")
def page_run_pauses(spark, sf):
    """How often each worker of a run paused: after every second failure in a row."""
    return runs.pauses(_page_run(spark, sf)[1], "page_id", 2, "worker")
