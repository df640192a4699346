"""Queries of normalisers, list cells and extractors, with their DuckDB SQL.

Input cells are built from part by expressions that both engines read.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import extract, numbers, text
from tessera.operators import specs
from tessera.plans.catalogue import read_table, register, spread


def sql_chain(cell: str, rules, lower: bool = True) -> str:
    out = f"lower({cell})" if lower else cell
    for pattern, repl in rules:
        out = f"regexp_replace({out}, '{pattern}', '{repl.replace('$', chr(92))}', 'g')"
    return f"trim({out})"


_NAME = "concat(CASE p_partkey % 4 WHEN 0 THEN '2x Dual ' WHEN 1 THEN 'Intel® ' WHEN 2 THEN 'AMD(R)  ' ELSE '' END, p_name, CASE p_partkey % 5 WHEN 0 THEN ' 3rd Generation Processors' WHEN 1 THEN '-soc (quad-core) i-series' WHEN 2 THEN ' with Radeon Graphics series' ELSE '  2nd-gen™ processor ' END, p_brand)"
_FORMS = {"product": text.PRODUCT_NAME, "server": text.SERVER_NAME, "tight": text.TIGHT_NAME, "generation": text.GENERATION_NAME, "speed": text.SPEED_NAME, "family": text.FAMILY, "key": text.KEY, "processor": text.PROCESSOR_KEY}


@register("name_normalisers", f"SELECT p_partkey, {', '.join(f'{sql_chain(_NAME, r)} AS {n}' for n, r in _FORMS.items())} FROM part")
def name_normalisers(spark, sf):
    part = read_table(spark, sf, "part")
    return part.select("p_partkey", *(text.chain(F.expr(_NAME), r).alias(n) for n, r in _FORMS.items()))


_CHIP = r"concat(CASE p_partkey % 3 WHEN 0 THEN '--' WHEN 1 THEN '- ' ELSE ' ' END, p_brand, CASE p_partkey % 4 WHEN 0 THEN '/X  (rev. ' WHEN 1 THEN ' C-' ELSE ' ' END, p_size, CASE p_partkey % 5 WHEN 1 THEN concat(chr(92), 'u00ae ', chr(92), 'x41') WHEN 2 THEN concat(' ', chr(92), 'u12') ELSE '' END)"
_URLISH = "concat('https://host.example/Image/', lower(p_type), '/V', p_size, '/', p_partkey, CASE WHEN p_partkey % 2 = 0 THEN '/png?w=1' ELSE '' END)"
_PAGE = "concat('https://shop.example/en/', p_size, '/', CASE WHEN p_partkey % 2 = 0 THEN '?q=1' ELSE '#top' END)"
_LINK = "CASE p_partkey % 3 WHEN 0 THEN concat('/part/', p_partkey, '/') WHEN 1 THEN concat('http://other.example/', p_partkey) ELSE concat('p', p_partkey) END"
_BOARD = "concat(p_brand, CASE p_partkey % 3 WHEN 0 THEN '- ' WHEN 1 THEN ' - ' ELSE ' ' END, p_name, CASE p_partkey % 4 WHEN 0 THEN ' Motherboard' WHEN 1 THEN ' blade server' WHEN 2 THEN ' Mini PC' ELSE '' END)"
_FIELD = "CASE p_partkey % 3 WHEN 0 THEN 'image_url' WHEN 1 THEN concat('specifications[', p_name, '  x]') ELSE p_type END"
_FILE = "concat('s3://in/', p_size, '/20-', lower(p_type), '_', p_partkey, '.csv')"


@register("label_texts", rf"""
WITH c AS (SELECT *, {_CHIP} AS chip, {_BOARD} AS board, {_PAGE} AS page, {_LINK} AS link FROM part)
SELECT p_partkey, nullif(upper(trim(regexp_replace(regexp_replace(regexp_replace(replace(replace(trim(chip), chr(92) || 'u00ae', ''), chr(92) || 'x41', 'A'), '^-+\s*', ''), '[^A-Za-z0-9 ]+', '', 'g'), '\s+', ' ', 'g'))), '') AS chip,
  upper(trim(chip)) AS upper_chip, CASE WHEN p_partkey % 3 < 2 THEN trim(split_part(board, '-', 1)) ELSE '' END AS brand, CASE WHEN p_partkey % 3 < 2 THEN trim(split_part(board, '-', 2)) ELSE board END AS model,
  CASE p_partkey % 4 WHEN 0 THEN 'Motherboard' WHEN 1 THEN 'Server' WHEN 2 THEN 'Mini PC' ELSE '' END AS machine,
  CASE p_partkey % 3 WHEN 0 THEN 'https://shop.example/part/' || p_partkey WHEN 1 THEN link ELSE 'https://shop.example/en/' || p_size || '/' || link END AS url,
  'https://shop.example/' || lower(regexp_replace(p_name || '-' || p_brand, '[^A-Za-z0-9]+', '-', 'g')) AS slug, lower(p_type) || '/V' || p_size || '/' || p_partkey AS image,
  CASE p_partkey % 3 WHEN 0 THEN 'Image URL' WHEN 1 THEN 'Specification: ' || p_name || ' x' ELSE p_type END AS label, p_type AS file_label, left(p_name, 6) AS clipped FROM c""")
def label_texts(spark, sf):
    part = read_table(spark, sf, "part").withColumn("b", text.brand_and_model(F.expr(_BOARD)))
    return part.select(
        "p_partkey", text.alnum_upper(F.expr(_CHIP)).alias("chip"), text.trim_upper(F.expr(_CHIP)).alias("upper_chip"), F.col("b.brand").alias("brand"), F.col("b.model").alias("model"), text.machine_type(F.expr(_BOARD)).alias("machine"),
        text.resolve_url(F.expr(_PAGE), F.expr(_LINK)).alias("url"), text.slug_url(F.lit("https://shop.example/"), F.concat_ws(" & ", "p_name", "p_brand")).alias("slug"), text.image_identity(F.expr(_URLISH)).alias("image"),
        text.field_label(F.expr(_FIELD)).alias("label"), text.file_label(F.expr(_FILE)).alias("file_label"), text.clipped(F.col("p_name"), 6).alias("clipped"),
    )


_SPELL = "concat('INTEL xeon ', p_name, ' w-', p_size, ' SCALABLE Processors ', 1 + p_size % 9, CASE WHEN p_partkey % 2 = 0 THEN 'th gen' ELSE 'thgen' END, ' ryzen PRO')"


@register("respelled_names", """
SELECT p_partkey, 'Intel Xeon ' || p_name || ' W-' || p_size || ' Scalable processor ' || (1 + p_size % 9) || CASE WHEN p_partkey % 2 = 0 THEN 'th gen' ELSE 'thgen' END || ' Ryzen PRO' AS respelled,
  'INTEL xeon ' || p_name || ' w-' || p_size || ' SCALABLE Processors ' || (1 + p_size % 9) || 'th Generation ryzen PRO' AS generation FROM part""")
def respelled(spark, sf):
    return read_table(spark, sf, "part").select("p_partkey", text.respelled(F.expr(_SPELL)).alias("respelled"), text.generation_words(F.expr(_SPELL)).alias("generation"))


@register("web_texts", """
SELECT p_partkey, p_name || CASE WHEN p_partkey % 2 = 0 THEN ' A1' ELSE ' A1TM' END || p_brand AS web, lower(p_name) || ' ' || lower(p_brand) AS product_key FROM part""")
def web_texts(spark, sf):
    web = "concat(p_name, CASE p_partkey % 3 WHEN 0 THEN '&nbsp A' WHEN 1 THEN '&nbsp;  A' ELSE ' �Ａ' END, CASE WHEN p_partkey % 2 = 0 THEN '¹' ELSE '1™' END, p_brand)"
    name = "concat(upper(p_name), CASE p_partkey % 4 WHEN 0 THEN 'â„¢ Processor ' WHEN 1 THEN '®  ' WHEN 2 THEN 'Â® processors ' ELSE ' ' END, p_brand)"
    return read_table(spark, sf, "part").select("p_partkey", text.web_text(F.expr(web)).alias("web"), text.product_key(F.expr(name)).alias("product_key"))


_LIST = """CASE p_partkey % 6 WHEN 0 THEN concat('["', p_name, '", ["', p_type, '"], "nan"]') WHEN 1 THEN concat('[''', p_name, ''', None, "it''s"]') WHEN 2 THEN p_brand WHEN 3 THEN concat('[‘', p_name, '’, ''', p_type, ''']') WHEN 4 THEN '  ' ELSE concat('[', p_name, ' broken') END"""
_CUT = "CASE p_partkey % 3 WHEN 0 THEN concat('[''', p_name, '''; \"', p_type, '\" | ]') WHEN 1 THEN concat(p_name, ',', p_brand) ELSE '' END"


@register("list_cells", rf"""
SELECT p_partkey, CASE p_partkey % 6 WHEN 0 THEN p_name || '|' || p_type WHEN 1 THEN p_name || '|it''s' WHEN 2 THEN p_brand WHEN 3 THEN p_name || '|' || p_type WHEN 4 THEN '' ELSE '[' || p_name || ' broken' END AS flat,
  array_to_string(list_filter(list_transform(string_split_regex(regexp_replace(trim({_CUT}), '^\[|\]$', '', 'g'), '[,;|]'), lambda x: trim(regexp_replace(trim(x), '^[''"]+|[''"]+$', '', 'g'))), lambda x: x <> ''), '|') AS cut,
  CASE p_partkey % 6 WHEN 1 THEN '[''' || p_name || ''', ''it\''s'']' WHEN 4 THEN '' WHEN 2 THEN '[''' || p_brand || ''']' WHEN 5 THEN '[''[' || p_name || ' broken'']' ELSE '[''' || p_name || ''', ''' || p_type || ''']' END AS shown,
  CASE WHEN p_partkey % 2 = 0 THEN p_size || 'A|' || (p_size + 100) || 'B' ELSE 'x' END AS retokenised FROM part""".replace("(p_size + 100) || 'B'", "(p_size + 100) || 'B'"))
def list_cells(spark, sf):
    items = text.flat_items(F.expr(_LIST))
    long = F.expr("CASE WHEN p_partkey % 2 = 0 THEN concat(p_size, 'A and something that is longer than fifty letters in all ', p_size + 100, 'B') ELSE 'x' END")
    again = text.retokenised(text.split_items(long), long, "[0-9]+[AB]")
    again = F.transform(F.array_sort(F.transform(again, lambda x: F.struct(F.regexp_extract(x, "([0-9]*)", 1).try_cast("int").alias("n"), x.alias("x")))), lambda s: s["x"])
    return read_table(spark, sf, "part").select("p_partkey", F.array_join(items, "|").alias("flat"), F.array_join(text.split_items(F.expr(_CUT)), "|").alias("cut"), text.list_text(items).alias("shown"), F.array_join(again, "|").alias("retokenised"))


@register("literal_dicts", """SELECT p_partkey, p_brand AS brand, CASE WHEN p_partkey % 2 = 0 THEN '["' || p_type || '"]' ELSE '["' || p_type || '","z"]' END AS kinds, p_partkey % 5 <> 0 AS parsed FROM part""")
def literal_dicts(spark, sf):
    cell = F.expr("CASE WHEN p_partkey % 5 = 0 THEN concat('{', p_brand) ELSE concat('{''brand'': ''', p_brand, ''', ''kinds'': {''', p_type, '''', CASE WHEN p_partkey % 2 = 0 THEN '' ELSE ', ''z''' END, '}, ''none'': None}') END")
    got = read_table(spark, sf, "part").withColumn("j", text.literal_json(cell))
    kinds = F.to_json(F.from_json(F.get_json_object("j", "$.kinds"), "array<string>"))
    parsed = F.col("j").isNotNull()  # a cell that is no literal falls back on the record's columns, one that lacks a key does not
    plain = F.expr("CASE WHEN p_partkey % 2 = 0 THEN concat('[\"', p_type, '\"]') ELSE concat('[\"', p_type, '\",\"z\"]') END")
    return got.select("p_partkey", F.when(parsed, F.get_json_object("j", "$.brand")).otherwise(F.col("p_brand")).alias("brand"), F.when(parsed, kinds).otherwise(plain).alias("kinds"), parsed.alias("parsed"))


_CPU = "concat(p_name, CASE p_partkey % 8 WHEN 0 THEN ' Intel Core i7-' WHEN 1 THEN ' Xeon Gold ' WHEN 2 THEN ' Xeon W-' WHEN 3 THEN ' E5-' WHEN 4 THEN ' Ryzen 7 ' WHEN 5 THEN ' EPYC ' WHEN 6 THEN ' Threadripper PRO ' ELSE ' chip ' END, 3000 + p_size, CASE p_partkey % 8 WHEN 2 THEN 'M' WHEN 3 THEN ' v4' ELSE '' END)"
_RE_CPU = r"""coalesce(CASE WHEN regexp_matches(t, '\bi[3579][-\s]?[0-9]{4,5}[a-z]{0,2}\b') THEN regexp_replace(regexp_extract(t, '\bi[3579][-\s]?[0-9]{4,5}[a-z]{0,2}\b'), '[-\s]', ' ') END,
  'w-' || nullif(regexp_extract(t, '\bxeon\s+w[-\s]?([0-9]{4,5}[a-z])\b', 1), ''),
  nullif(trim(regexp_extract(t, '\b([ewd][0-9])[-\s]?[0-9]{4}\b', 1) || ' ' || regexp_extract(t, '\b[ewd][0-9][-\s]?([0-9]{4})\b', 1) || ' ' || regexp_extract(t, '\b[ewd][0-9][-\s]?[0-9]{4}\s*(v[0-9])\b', 1)), ''),
  nullif(regexp_extract(t, '\bxeon\s+((gold|silver|platinum|bronze)\s+[0-9]{4,5}[a-z]{0,2})\b', 1), ''), nullif(regexp_extract(t, '\bryzen\s+([3579]\s+[0-9]{4}[a-z]{0,2})\b', 1), ''),
  nullif(regexp_extract(t, '\bepyc\s+[0-9]{4}\b'), ''), nullif(regexp_extract(t, '\bthreadripper(?:\s+pro)?\s+([0-9]{4,5}[a-z]{0,2})\b', 1), ''))"""


@register("model_extractors", rf"""
WITH c AS (SELECT *, lower({_CPU}) AS t FROM part)
SELECT p_partkey, {_RE_CPU} AS cpu, CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE (7000 + p_size) || CASE WHEN p_partkey % 3 = 1 THEN 'P' ELSE '' END END AS epyc,
  'E5-' || (2000 + p_size) || CASE WHEN p_partkey % 2 = 0 THEN 'V4' ELSE '' END AS intel, CASE WHEN p_partkey % 2 = 0 THEN (7000 + p_size) || 'X' ELSE 'A70' || p_size || 'Z' END AS bare FROM c""")
def model_extractors(spark, sf):
    epyc = F.expr("concat('AMD ', CASE p_partkey % 3 WHEN 0 THEN 'A6-' ELSE 'EPYC ' END, 7000 + p_size, CASE WHEN p_partkey % 3 = 1 THEN 'P' ELSE '' END, ' chip')")
    intel = F.expr("concat(' e5-', 2000 + p_size, CASE WHEN p_partkey % 2 = 0 THEN '  v4' ELSE ' ' END, '+=')")
    bare = F.expr("CASE WHEN p_partkey % 2 = 0 THEN concat(' A', 7000 + p_size, 'X') ELSE concat('A70', p_size, 'Z') END")
    return read_table(spark, sf, "part").select("p_partkey", extract.cpu_model(F.expr(_CPU)).alias("cpu"), extract.epyc_model(epyc).alias("epyc"), extract.intel_model(intel).alias("intel"), extract.bare_epyc(bare).alias("bare"))


_UNITS = [*text.ONES]
_TENS = [*text.TENS]
_WORDS = "[" + ", ".join(f"'{w}'" for w in ["zero", *_UNITS, *[f"{t}{'' if not u else '-' + _UNITS[u - 1]}" for t in _TENS[:5] for u in range(10)]]) + "]"


@register("slot_texts", f"""
WITH c AS (SELECT p_partkey, 1 + p_size AS n, {_WORDS}[2 + p_size] AS w FROM part)
SELECT p_partkey, n AS slots, n AS words, n::VARCHAR AS first, NULL::INT AS sum_of_words, 'memory ' || n || ' gb ' AS section FROM c""")
def slot_texts(spark, sf):
    words = F.array(*(F.lit(w) for w in ["zero", *_UNITS, *[f"{t}{'' if not u else '-' + _UNITS[u - 1]}" for t in _TENS[:5] for u in range(10)]]))
    part = read_table(spark, sf, "part").select("p_partkey", (F.col("p_size") + 1).cast("int").alias("n"), F.element_at(words, F.col("p_size") + 2).alias("w"), F.element_at(words, F.col("p_size") % 9 + 2).alias("u"))
    cell = F.expr("CASE p_partkey % 5 WHEN 0 THEN concat('Supports ', n, ' DIMM slots') WHEN 1 THEN concat(w, ' DDR4 DIMM sockets') WHEN 2 THEN concat('In ', n, ' DIMMs') WHEN 3 THEN concat(n, 'x DDR5 DIMM sockets available') ELSE concat('up to ', w, ' DIMM slots') END")
    spec = F.expr("concat('memory ', n, ' gb ', CASE WHEN p_partkey % 2 = 0 THEN 'ports and connectors ' ELSE 'storage ' END, 'memory 1 tb')")
    return part.select("p_partkey", extract.slot_count(cell).cast("int").alias("slots"), text.number_words(F.col("w")).alias("words"), extract.first_integer(F.expr("CASE WHEN p_partkey % 2 = 0 THEN concat('max ', n, ' of 9') ELSE w END")).alias("first"), text.number_words(F.concat_ws(" ", "u", "u", "u")).alias("sum_of_words"), extract.section(spec, (r"\bmemory specifications\b", r"\bmemory\b"), (r"\bports and connectors\b", r"\bstorage\b")).alias("section"))


@register("attribute_maps", """
SELECT p_partkey, array_to_string(list_filter([CASE WHEN p_partkey % 2 = 0 THEN 'CAS Latency: CL' || (10 + p_size % 9) END, 'Capacity: ' || p_size || 'GB', 'ECC: ' || CASE WHEN p_partkey % 3 = 0 THEN 'ECC' ELSE 'Non-ECC' END, 'Memory Type: DDR4', CASE WHEN p_partkey % 5 = 0 THEN 'Module Type: SO-DIMM' END,
  CASE WHEN p_partkey % 3 = 1 THEN 'Pin Count: 288' END, CASE WHEN p_partkey % 3 = 2 THEN 'Registered/Unbuffered: Unbuffered' END, 'Speed: ' || (2000 + p_size) || 'MT/s'], lambda x: x IS NOT NULL), '; ') AS shown FROM part""")
def attribute_maps(spark, sf):
    cell = F.expr("concat('DDR4 ', 2000 + p_size, 'MT/s ', CASE WHEN p_partkey % 3 = 0 THEN 'ECC' ELSE 'Non-ECC' END, CASE p_partkey % 3 WHEN 1 THEN ' 288-pin' WHEN 2 THEN ' Unbuffered' ELSE '' END, CASE WHEN p_partkey % 2 = 0 THEN concat(' CL', 10 + p_size % 9) ELSE '' END, CASE WHEN p_partkey % 5 = 0 THEN ' SO-DIMM ' ELSE ' ' END, p_size, 'GB ', p_name)")
    shown = F.array_join(F.transform(F.array_sort(F.map_entries(extract.attributes(cell))), lambda e: F.concat(e["key"], F.lit(": "), e["value"])), "; ")
    return read_table(spark, sf, "part").select("p_partkey", shown.alias("shown"))


_KIND = "CASE p_partkey % 8 WHEN 0 THEN 'Intel Xeon Gold ' WHEN 1 THEN 'Intel Xeon E5-' WHEN 2 THEN 'AMD EPYC ' WHEN 3 THEN 'Opteron model ' WHEN 4 THEN 'Note: Xeon ' WHEN 5 THEN 'Alpha ' WHEN 6 THEN 'Ampere Altra Max core ' ELSE 'cable ' END"


@register("product_codes", r"""
WITH c AS (SELECT p_partkey, 2000 + p_size AS n FROM part)
SELECT p_partkey, CASE p_partkey % 8 WHEN 0 THEN n::VARCHAR WHEN 1 THEN 'E5-' || n || 'V2' WHEN 2 THEN 'EPYC-' || n WHEN 3 THEN 'OPTERON-' || n WHEN 4 THEN n::VARCHAR WHEN 5 THEN 'ALPHA-1' || n WHEN 6 THEN 'AMPERE-ALTRA-MAX' ELSE '' END AS codes,
  p_partkey % 8 = 4 AS noise, p_partkey % 8 NOT IN (4, 7) AS described, p_partkey % 8 IN (0, 1, 2, 4, 6) AS named FROM c""")
def product_codes(spark, sf):
    line = F.expr(f"concat({_KIND}, CASE WHEN p_partkey % 8 = 5 THEN '1' ELSE '' END, CASE WHEN p_partkey % 8 = 6 THEN '' ELSE concat('', 2000 + p_size) END, CASE WHEN p_partkey % 8 = 1 THEN ' v2' ELSE '' END, ' FIO Kit P49614-B21')")
    return read_table(spark, sf, "part").select("p_partkey", F.array_join(extract.codes(line), "|").alias("codes"), extract.is_noise(line).alias("noise"), extract.is_description(line).alias("described"), extract.processor_line(line).alias("named"))


_DESC = "CASE p_partkey % 8 WHEN 0 THEN p_brand WHEN 1 THEN concat('Power Edge 12 ', 1000 + p_size) WHEN 2 THEN concat('Rack ', 1000 + p_size, ' xd') WHEN 3 THEN concat('Tower ', p_size, ' Max 2') WHEN 4 THEN concat('Edge R', p_size, ' plus') WHEN 5 THEN concat('Vertex Vista V', p_size) WHEN 6 THEN concat('Power Station T', p_size, ' v2') ELSE concat('Blade (M', p_size, ')') END"
_DESC_FAMILY = "CASE p_partkey % 8 WHEN 0 THEN p_brand WHEN 1 THEN 'Power Edge 12' WHEN 2 THEN 'Rack' WHEN 3 THEN 'Tower ' || p_size WHEN 4 THEN 'Edge' WHEN 5 THEN 'Vertex' WHEN 6 THEN 'Power Station' ELSE 'Blade' END"
_DESC_MODEL = "CASE p_partkey % 8 WHEN 0 THEN '' WHEN 1 THEN '' || (1000 + p_size) WHEN 2 THEN (1000 + p_size) || ' xd' WHEN 3 THEN 'Max 2' WHEN 4 THEN 'R' || p_size || ' plus' WHEN 5 THEN 'Vista V' || p_size WHEN 6 THEN 'T' || p_size || ' v2' ELSE '(M' || p_size || ')' END"


@register("split_descriptions", rf"""
WITH c AS (SELECT p_partkey, p_size, p_brand, p_name, {_DESC_FAMILY} AS family, {_DESC_MODEL} AS model, CASE WHEN p_partkey % 7 = 0 THEN '' WHEN p_partkey % 5 = 0 THEN 'other' ELSE upper({_DESC_FAMILY}) END AS b, {_DESC_MODEL} AS m FROM part)
SELECT p_partkey, family, model, CASE WHEN b = '' OR m = '' THEN 'MISSING' WHEN lower(b) <> lower(family) THEN 'MISMATCH' ELSE 'MATCH' END AS status,
  split_part(p_name, ' ', 1) AS a, split_part(p_name, ' ', 2) AS second, p_brand || ' ' || p_size AS rest, 'Super Server' AS at_family, 'X' || (1000 + p_size) || '-T4' AS at_model FROM c""")
def split_descriptions(spark, sf):
    from tessera.operators import ladders

    part = spread(read_table(spark, sf, "part")).withColumns({"d": extract.split_description(F.expr(_DESC)), "f": extract.split_fixed(F.concat_ws("  ", "p_name", "p_brand", "p_size")), "s": extract.split_at_model(F.expr("concat('Super  Server X', 1000 + p_size, ' - T4 (old)')"))})
    b = F.expr(f"CASE WHEN p_partkey % 7 = 0 THEN '' WHEN p_partkey % 5 = 0 THEN 'other' ELSE upper({_DESC_FAMILY.replace('||', '||')}) END")
    return part.select("p_partkey", "d.family", "d.model", ladders.split_status((b, F.col("d.family")), (F.expr(_DESC_MODEL), F.col("d.model"))).alias("status"), F.col("f.a").alias("a"), F.col("f.b").alias("second"), F.col("f.c").alias("rest"), F.col("s.family").alias("at_family"), F.col("s.model").alias("at_model"))


_ROW = {"capacity": "concat(p_size, 'GB')", "memory_type": "CASE WHEN p_partkey % 3 = 0 THEN 'DDR5' ELSE 'SD' END", "ecc": "CASE WHEN p_partkey % 2 = 0 THEN 'Non-ECC' ELSE 'ECC' END", "dimm_type": "p_type", "ranks": "concat(1 + p_partkey % 4, '.0')", "rank_width": "4", "speed": "2000 + p_size", "voltage": "'1.2V'", "height": "p_name", "qty": "1 + p_partkey % 2"}
_SKU = "p_size || CASE WHEN p_partkey % 3 = 0 THEN 'D5' ELSE 'D4' END || CASE WHEN p_partkey % 2 = 0 THEN '{n}' ELSE 'E' END || left(p_type, 1) || (1 + p_partkey % 4) || '4' || (2000 + p_size) || '12' || left(p_name, 1) || (1 + p_partkey % 2)"


@register("sku_check", f"""
WITH c AS (SELECT p_partkey, {_SKU.format(n="N")} AS strict, {_SKU.format(n="E")} AS loose FROM part)
SELECT p_partkey, strict, loose, CASE WHEN p_partkey % 5 = 0 THEN 'Missing' WHEN p_partkey % 4 = 0 THEN 'Unmatch' ELSE 'Match' END AS status FROM c""")
def sku_check(spark, sf):
    from tessera.operators import ladders

    row = {k: F.expr(e) for k, e in _ROW.items()}
    part = read_table(spark, sf, "part").withColumns({"strict": extract.sku(row), "loose": extract.sku(row, "loose")})
    actual = F.when(F.col("p_partkey") % 5 != 0, F.when(F.col("p_partkey") % 4 == 0, "other").otherwise(F.col("strict")))
    return part.select("p_partkey", "strict", "loose", ladders.sku_status(F.col("strict"), actual).alias("status"))


@register("capacity_check", """
WITH c AS (SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN p_size * 1024 WHEN 1 THEN p_size * 1048576 ELSE NULL END AS want, CASE WHEN p_partkey % 4 = 0 THEN NULL WHEN p_partkey % 5 = 0 THEN 1 ELSE p_size * CASE p_partkey % 3 WHEN 1 THEN 1048576 ELSE 1024 END END AS got FROM part)
SELECT p_partkey, CASE WHEN want IS NULL OR got IS NULL THEN 'Issue' WHEN want <> got THEN 'Issue' ELSE 'Verified' END AS status, CASE WHEN want IS NULL OR got IS NULL THEN 'missing' WHEN want <> got THEN 'mismatch' ELSE '' END AS reason FROM c""")
def capacity_check(spark, sf):
    from tessera.operators import ladders

    part = read_table(spark, sf, "part")
    cell, got = F.expr("concat(p_size, CASE p_partkey % 3 WHEN 0 THEN 'GB' WHEN 1 THEN ' TB' ELSE ' pins' END)"), F.expr("CASE WHEN p_partkey % 4 = 0 THEN NULL WHEN p_partkey % 5 = 0 THEN 1 ELSE p_size * CASE p_partkey % 3 WHEN 1 THEN 1048576 ELSE 1024 END END")
    return part.select("p_partkey", *ladders.capacity_status(numbers.capacity_mb(cell), got))


@register("model_lists", """
SELECT p_partkey, array_to_string(list_sort([lower(p_brand[7:]) || 'x', 'a_1', lower(replace(p_type, ' ', ''))]), ' ') AS models, p_partkey % 3 = 0 AS repeats, CASE WHEN p_partkey % 4 = 0 THEN 'C' || p_size WHEN p_partkey % 4 = 1 THEN p_name END AS chipset FROM part""")
def model_lists(spark, sf):
    """Models of a cell, whether its items repeat, and the chipset of a document, a list's first item."""
    cell = F.expr("concat(' ', p_type, '/ , A_1!,', substring(p_brand, 7), '(X)')")
    items = F.expr("concat('Server ', p_name, ', ', CASE WHEN p_partkey % 3 = 0 THEN concat(upper(p_name), '  system') ELSE concat(p_name, ' 2') END)")
    spec = F.expr("""CASE p_partkey % 4 WHEN 0 THEN concat('{"a": [1, {" Chipset": ["C', p_size, '", "other"]}]}') WHEN 1 THEN concat('{"chipset": "', p_name, '"}') WHEN 2 THEN '{"chip": "x"}' ELSE concat('{"chipset": "', p_name) END""")
    return read_table(spark, sf, "part").select("p_partkey", F.array_join(extract.models_key(cell), " ").alias("models"), extract.has_repeats(items).alias("repeats"), specs.first_value(spec, "chipset").alias("chipset"))


@register("shown_values", """
SELECT p_partkey, p_name || chr(10) || 'ö — ' || p_brand AS shown, '[A]' || chr(10) || '  - ' || p_type || chr(10) || '[B]' || chr(10) || '  - ' || p_size || chr(10) || '  - z' AS specs, CASE WHEN p_partkey % 3 = 0 THEN 0 ELSE 2 END AS lines, p_partkey % 2 = 0 AS broken_only FROM part""")
def shown_values(spark, sf):
    """Values of a report as they are displayed: lines, maps of lists, and whether two differ in line breaks only."""
    value = F.array(F.expr("concat('  ', p_name, '  ')"), F.expr("concat('Ã¶   â€” ', p_brand)"))
    groups = F.create_map(F.lit("B"), F.array(F.col("p_size").cast("string"), F.lit("z")), F.lit("A"), F.array("p_type"))
    shown = F.expr("CASE WHEN p_partkey % 3 = 0 THEN '(not present in CSV)' ELSE concat(p_name, '\n \n', p_type) END")
    a, b = F.concat("p_name", F.lit("\n"), "p_type"), F.expr("CASE WHEN p_partkey % 2 = 0 THEN concat(p_name, ' ', p_type) ELSE concat(p_name, '\n', p_type) END")
    return read_table(spark, sf, "part").select("p_partkey", text.shown_lines(value).alias("shown"), text.shown_map(groups).alias("specs"), F.size(text.value_lines(shown)).alias("lines"), text.same_but_lines(a, b).alias("broken_only"))
