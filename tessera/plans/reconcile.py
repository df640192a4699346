"""Queries that reconcile catalogue rows with reference dimensions, and rank checks, with their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import text
from tessera.operators import compare, ladders, ranks, reconcile
from tessera.plans.catalogue import read_table, register, spread
from tessera.sources.shared import written

# A catalogue row is an order; its items are the parts of its lines. Two references share part: names of size 30 at most,
# and of more than 20, so some names are in both with other families.
_CELLS = """
c AS (SELECT l_orderkey AS row_id, l_linenumber AS pos, l_partkey AS part, CASE WHEN l_quantity > 45 THEN concat(p_name, ' x') ELSE concat('Intel® ', p_name, ' Processor') END AS item,
  CASE WHEN l_discount > 0.08 THEN 'Other' WHEN l_discount >= 0.02 THEN p_type END AS fam, CASE WHEN l_tax < 0.07 THEN p_type END AS line, l_quantity AS qty FROM lineitem JOIN part ON l_partkey = p_partkey)"""
_KEYED = "trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(lower({0}), '[™®©�]|\\(r\\)|\\(tm\\)', '', 'g'), '\\s+', ' ', 'g'), '\\bprocessor\\b', ' ', 'g'), '\\s+', ' ', 'g'))"
_REFS = f"""
ref AS (SELECT * FROM (SELECT 'first' AS source, 0 AS prio, p_partkey AS k, concat('INTEL ', p_name) AS name, p_type AS fam, p_brand AS line FROM part WHERE p_size <= 30
  UNION ALL SELECT 'second', 1, p_partkey, concat('Intel ', p_name), concat(p_type, '-B'), '' FROM part WHERE p_size > 20) QUALIFY row_number() OVER (PARTITION BY {_KEYED.format('name')} ORDER BY prio, k) = 1)"""


def cells(spark, sf):
    li, part = read_table(spark, sf, "lineitem"), read_table(spark, sf, "part")
    return li.join(part, F.col("l_partkey") == F.col("p_partkey")).selectExpr("l_orderkey AS row_id", "l_linenumber AS pos", "l_partkey AS part", "CASE WHEN l_quantity > 45 THEN concat(p_name, ' x') ELSE concat('Intel® ', p_name, ' Processor') END AS item", "CASE WHEN l_discount > 0.08 THEN 'Other' WHEN l_discount >= 0.02 THEN p_type END AS fam", "CASE WHEN l_tax < 0.07 THEN p_type END AS line", "l_quantity AS qty")


def catalogue_rows(spark, sf):
    """row_id and its ordered lists of items, families and lines."""
    ordered = lambda c: F.transform(F.sort_array(F.transform(F.filter("_all", lambda s: s[c].isNotNull()), lambda s: F.struct(s["pos"].alias("pos"), s["part"].alias("part"), s[c].alias(c)))), lambda s: s[c]).alias(c)
    got = cells(spark, sf).groupBy("row_id").agg(F.collect_list(F.struct("pos", "part", "item", "fam", "line")).alias("_all"))
    return got.select("row_id", *(ordered(c) for c in ("item", "fam", "line")))


def expected_rows(spark, sf):
    """Catalogue rows with what the references say of their items."""
    got = reconcile.expected_values(catalogue_rows(spark, sf), "row_id", "item", key_of, references(spark, sf), "key", ["ref_fam", "ref_line"], keep=("item", "fam", "line"))
    return got.filter("row_id IS NOT NULL")


def key_of(c):
    return text.chain(c, text.PROCESSOR_KEY)


def references(spark, sf):
    """One row of each key, written so that Spark knows how few they are: a few names of many parts."""
    part = spread(read_table(spark, sf, "part"))
    first = part.filter("p_size <= 30").selectExpr("p_partkey AS k", "concat('INTEL ', p_name) AS name", "p_type AS fam", "p_brand AS ref_line")
    second = part.filter("p_size > 20").selectExpr("p_partkey AS k", "concat('Intel ', p_name) AS name", "concat(p_type, '-B') AS fam", "'' AS ref_line")
    dims = [(n, d.withColumn("key", key_of(F.col("name"))).drop("name").withColumnRenamed("fam", "ref_fam")) for n, d in (("first", first), ("second", second))]
    return written(reconcile.prioritised(dims, "key", [F.col("k")]), "references")


_EXPECTED = f"""{_CELLS}, {_REFS},
x AS (SELECT row_id, list(item ORDER BY pos, part) AS items, coalesce(list(fam ORDER BY pos, part) FILTER (fam IS NOT NULL), []) AS fams, coalesce(list(line ORDER BY pos, part) FILTER (line IS NOT NULL), []) AS lines FROM c GROUP BY 1),
h AS (SELECT c.row_id, c.pos, c.part, c.item, ref.k IS NOT NULL AS hit, ref.fam AS rf, ref.line AS rl, ref.source AS src FROM c LEFT JOIN ref ON {_KEYED.format('c.item')} = {_KEYED.format('ref.name')}),
e AS (SELECT row_id, count(*) AS n_items, count(*) FILTER (hit) AS n_matched, coalesce(list(item ORDER BY pos, part) FILTER (NOT hit), []) AS unmatched, coalesce(list_sort(list(DISTINCT rf) FILTER (rf <> '')), []) AS ef, coalesce(list_sort(list(DISTINCT rl) FILTER (rl <> '')), []) AS el, coalesce(list_sort(list(DISTINCT src) FILTER (src IS NOT NULL)), []) AS sources FROM h GROUP BY 1),
j AS (SELECT * FROM x JOIN e USING (row_id))"""
_SECOND = "list_filter(list_transform(range(1, len({0}) + 1), lambda i: CASE WHEN len(list_filter({0}[1:i - 1], lambda o: lower(o) = lower({0}[i]))) = 1 THEN {0}[i] END), lambda v: v IS NOT NULL)"
_MISS = "list_sort(list_filter({0}, lambda v: NOT list_contains({1}, v)))"


def _compare_sql(e: str, a: str, n: str) -> str:
    miss, extra, dup = _MISS.format(e, a), f"list_sort(list_distinct(list_filter({a}, lambda v: NOT list_contains({e}, v))))", _SECOND.format(a)
    return f"""CASE WHEN len({miss}) = 0 AND len({extra}) = 0 THEN CASE WHEN len({dup}) > 0 THEN 'DUPLICATED' ELSE 'PASS' END WHEN len({extra}) > 0 THEN 'FAIL' ELSE 'MISSING' END AS {n}_status,
  concat_ws(' | ', CASE WHEN len({dup}) > 0 THEN 'Duplicated: ' || array_to_string({dup}, ', ') END, CASE WHEN len({miss}) > 0 THEN CASE WHEN len({a}) = 0 THEN 'Empty; expected: ' ELSE 'Missing: ' END || array_to_string({miss}, ', ') END,
    CASE WHEN len({extra}) > 0 THEN 'Not supported by any matched processor: ' || array_to_string({extra}, ', ') END) AS {n}_reason"""


@register("family_line_validation", f"""
WITH {_EXPECTED}, s AS (SELECT row_id, n_items, n_matched, array_to_string(unmatched, ' | ') AS unmatched, array_to_string(sources, ',') AS sources, items, {_compare_sql('ef', 'fams', 'fam')}, {_compare_sql('el', 'lines', 'line')}, {_SECOND.format('items')} AS dup FROM j)
SELECT row_id, n_items, n_matched, unmatched, sources, fam_status, fam_reason, line_status, line_reason, array_to_string(dup, ' | ') AS dup_items,
  CASE WHEN 'FAIL' IN (fam_status, line_status) THEN 'FAIL' WHEN 'MISSING' IN (fam_status, line_status) THEN 'MISSING' WHEN 'DUPLICATED' IN (fam_status, line_status) OR len(dup) > 0 THEN 'DUPLICATED' ELSE 'PASS' END AS overall FROM s""")
def family_line_validation(spark, sf):
    """Explode, look up by priority, put together again, compare both fields, and let the worst status win."""
    got = expected_rows(spark, sf)
    low = lambda x: text.chain(x, text.KEY)
    dups = lambda c: reconcile.second_spellings(F.col(c), low)
    got = got.withColumns({"f": reconcile.compare_sets(F.col("expected_ref_fam"), F.col("fam"), dups("fam")), "l": reconcile.compare_sets(F.col("expected_ref_line"), F.col("line"), dups("line")), "d": dups("item")})
    overall = reconcile.worst(F.col("f.status"), F.col("l.status"), F.when(F.size("d") > 0, "DUPLICATED").otherwise("PASS"))
    return got.select("row_id", "n_items", "n_matched", F.array_join("unmatched", " | ").alias("unmatched"), F.array_join("sources", ",").alias("sources"), F.col("f.status").alias("fam_status"), F.col("f.reason").alias("fam_reason"), F.col("l.status").alias("line_status"), F.col("l.reason").alias("line_reason"), F.array_join("d", " | ").alias("dup_items"), overall.alias("overall"))


_SETS = "len(list_distinct({0})) AS z"


@register("processor_ladders", f"""
WITH {_EXPECTED}, s AS (SELECT *, list_sort(list_distinct(fams)) AS af, list_sort(list_distinct(lines)) AS al FROM j),
m AS (SELECT *, len({_MISS.format('ef', 'af')}) AS mf, len({_MISS.format('el', 'al')}) AS ml, len({_MISS.format('af', 'ef')}) AS xf, len({_MISS.format('al', 'el')}) AS xl FROM s)
SELECT row_id, CASE WHEN n_items = 0 THEN 'missing' WHEN n_matched = 0 THEN 'Family is not found' WHEN n_matched < n_items THEN (n_items - n_matched) || ' of ' || n_items || ' processors missing' ELSE 'match' END AS plain,
  CASE WHEN n_items = 0 THEN 'missing' WHEN n_matched = 0 THEN 'Family is not found' WHEN len(ef) = 0 THEN 'mismatch' WHEN n_matched < n_items THEN (n_items - n_matched) || ' of ' || n_items || ' family missing' ELSE 'match' END AS with_family,
  CASE WHEN n_items = 0 THEN 'missing' WHEN len(af) = 0 AND len(ef) > 0 THEN 'No family is mapped' WHEN len(ef) = 0 THEN 'Family is not found' WHEN xf = len(af) THEN 'mismatch' WHEN xf > 0 THEN xf || ' family missing' ELSE 'match' END AS as_sets,
  CASE WHEN mf > 0 AND ml > 0 THEN 'family and line missing' WHEN mf > 0 THEN 'family missing' WHEN ml > 0 THEN 'line missing' ELSE 'none' END AS missing_status,
  CASE WHEN n_items = 0 THEN 'missing' WHEN len(af) = 0 AND len(ef) > 0 THEN 'No family is mapped in main CSV' WHEN len(ef) = 0 THEN 'Family is not found' WHEN mf > 0 THEN mf || ' family missing' WHEN ml > 0 THEN ml || ' line missing' ELSE 'match' END AS status,
  CASE WHEN len(ef) = 0 AND len(el) = 0 THEN 'no match' ELSE coalesce(nullif(concat_ws(' & ', CASE WHEN mf > 0 THEN mf || CASE WHEN mf = 1 THEN ' family ' ELSE ' familys ' END || 'missing' END, CASE WHEN xf > 0 THEN xf || CASE WHEN xf = 1 THEN ' family ' ELSE ' familys ' END || 'mismatch' END,
    CASE WHEN ml > 0 THEN ml || CASE WHEN ml = 1 THEN ' line ' ELSE ' lines ' END || 'missing' END, CASE WHEN xl > 0 THEN xl || CASE WHEN xl = 1 THEN ' line ' ELSE ' lines ' END || 'mismatch' END), ''), 'match') END AS four_way,
  CASE WHEN n_items = 0 THEN 'missing' WHEN n_matched = 0 THEN 'Family is not found' WHEN n_matched < n_items THEN 'partial_match' WHEN len(af) > 0 AND len(ef) > 0 AND NOT list_contains(ef, af[1]) THEN 'mismatch' ELSE 'match' END AS vendor,
  len(fams) - len(af) AS repeats, array_to_string(list_sort(list_distinct(list_concat(ef, af))), '; ') AS either FROM m""")
def processor_ladders(spark, sf):
    got = expected_rows(spark, sf)
    distinct = lambda c: F.array_sort(F.array_distinct(F.col(c)))
    n, m, ef, el, af, al = F.col("n_items"), F.col("n_matched"), F.col("expected_ref_fam"), F.col("expected_ref_line"), distinct("fam"), distinct("line")
    gone, gone_lines = F.array_except(ef, af), F.array_except(el, al)
    return got.select(
        "row_id", ladders.lookup_status(n, m).alias("plain"), ladders.lookup_status(n, m, ef, "family").alias("with_family"), ladders.family_status(n, ef, af).alias("as_sets"), ladders.missing_status(gone, gone_lines).alias("missing_status"),
        ladders.family_line_status(n, ef, af, gone, gone_lines).alias("status"), ladders.four_way_status(ef, af, el, al).alias("four_way"), ladders.vendor_status(n, m, F.get(af, F.lit(0)), ef).alias("vendor"),
        reconcile.excess(F.col("fam")).alias("repeats"), reconcile.unique_join(F.array_sort(F.concat(ef, af))).alias("either"),
    )


_COUNTS = {"match": "p_size % 3", "missing": "p_partkey % 2", "family_match": "p_partkey % 3", "family_mismatch": "p_partkey % 4 // 3", "line_match": "p_size % 2", "line_mismatch": "0", "no_family": "p_size % 5 // 4", "dup_processors": "p_partkey % 7 // 6", "dup_families": "p_partkey % 5 // 2", "dup_lines": "p_size % 4 // 3"}


@register("counter_reasons", f"""
WITH n AS (SELECT p_partkey, p_partkey % 11 AS total, {', '.join(f'{e} AS {k}' for k, e in _COUNTS.items())} FROM part)
SELECT p_partkey, concat_ws('; ', CASE WHEN missing > 0 THEN missing || ' missing from the references' END, CASE WHEN family_match > 0 THEN family_match || ' processor family matched' END, CASE WHEN family_mismatch > 0 THEN family_mismatch || ' processor family mismatches' END,
    CASE WHEN line_match > 0 THEN line_match || ' processor line matched' END, CASE WHEN line_mismatch > 0 THEN line_mismatch || ' processor line mismatches' END, CASE WHEN no_family > 0 THEN no_family || ' have no processor_family mapping' END, CASE WHEN dup_processors > 0 THEN dup_processors || ' duplicate processor values' END,
    CASE dup_families WHEN 0 THEN NULL WHEN 1 THEN 'one duplicate in processor family' ELSE dup_families || ' duplicates in processor family' END, CASE dup_lines WHEN 0 THEN NULL WHEN 1 THEN 'one duplicate in processor line' ELSE dup_lines || ' duplicates in processor line' END) || '.' AS reason,
  CASE WHEN total = 0 THEN 'No processors in main CSV' ELSE concat_ws(' | ', CASE WHEN match + family_match + line_match > 0 THEN 'match' END, CASE WHEN missing > 0 THEN 'missing' END, CASE WHEN family_mismatch + line_mismatch > 0 THEN 'mismatch' END, CASE WHEN no_family > 0 THEN 'No family is mapped in main CSV' END, CASE WHEN dup_processors + dup_families + dup_lines > 0 THEN 'duplicate' END) END AS status,
  missing + family_mismatch + no_family > 0 AS problem FROM n""")
def counter_reasons(spark, sf):
    part = read_table(spark, sf, "part").select("p_partkey", (F.col("p_partkey") % 11).alias("total"), *(F.expr(e.replace("//", "div")).alias(k) for k, e in _COUNTS.items()))
    n = {k: F.col(k) for k in _COUNTS}
    return part.select("p_partkey", ladders.counter_reason(n).alias("reason"), ladders.counter_status(n, F.col("total")).alias("status"), ladders.any_counter(n, ("missing", "family_mismatch", "no_family")).alias("problem"))


@register("speed_rows", """
WITH hits AS (SELECT p_name, count(*) AS n, coalesce(list_sort(list(DISTINCT p_size::VARCHAR) FILTER (p_size % 3 > 0)), []) AS known FROM part WHERE p_size > 5 GROUP BY 1),
p AS (SELECT l_orderkey AS row_id, p.p_name, p_brand, p.p_size, l_linenumber, l_quantity, coalesce(n, 0) AS n, coalesce(known, []) AS known, count(DISTINCT l_tax) OVER (PARTITION BY l_orderkey, p.p_name) > 1 AS dup FROM lineitem JOIN part p ON l_partkey = p_partkey LEFT JOIN hits h ON h.p_name = p.p_name),
a AS (SELECT *, CASE WHEN l_quantity < 5 THEN '' WHEN l_quantity < 30 THEN p_size::VARCHAR ELSE '99' END AS speed, CASE WHEN l_quantity % 7 = 0 THEN ' ' ELSE p_brand END AS family FROM p),
s AS (SELECT row_id, CASE WHEN dup THEN 'Duplicate' WHEN n = 0 THEN 'Missing' WHEN len(known) = 0 AND speed = '' THEN CASE WHEN trim(family) = '' THEN 'NoFamily' ELSE 'Match' END WHEN len(known) = 0 OR speed = '' THEN 'Missing' WHEN NOT list_contains(known, speed) THEN 'Mismatch' WHEN trim(family) = '' THEN 'NoFamily' ELSE 'Match' END AS status FROM a),
g AS (SELECT row_id, list(status) AS x FROM s GROUP BY 1)
SELECT row_id, array_to_string(list_filter(['Match', 'Missing', 'Mismatch', 'Duplicate', 'NoFamily'], lambda v: list_contains(x, v)), '|') AS statuses,
  concat_ws('; ', CASE WHEN list_contains(x, 'Match') THEN len(list_filter(x, lambda v: v = 'Match')) || ' match max memory speed' END, CASE WHEN list_contains(x, 'Missing') THEN len(list_filter(x, lambda v: v = 'Missing')) || ' missing max memory speed' END, CASE WHEN list_contains(x, 'Mismatch') THEN len(list_filter(x, lambda v: v = 'Mismatch')) || ' mismatch max memory speed' END,
    CASE WHEN list_contains(x, 'Duplicate') THEN len(list_filter(x, lambda v: v = 'Duplicate')) || ' duplicate processor max memory speed' END, CASE WHEN list_contains(x, 'NoFamily') THEN len(list_filter(x, lambda v: v = 'NoFamily')) || ' no family mapped in main CSV' END) AS reason FROM g""")
def speed_rows(spark, sf):
    """Items against a dimension with many rows for a name: the hits are put together before the join, so a common name does not multiply rows."""
    part, li = read_table(spark, sf, "part"), read_table(spark, sf, "lineitem")
    hits = part.filter("p_size > 5").groupBy("p_name").agg(F.count(F.lit(1)).alias("hits"), F.collect_set(F.when(F.col("p_size") % 3 > 0, F.col("p_size").cast("string"))).alias("known"))
    items = li.join(part, F.col("l_partkey") == F.col("p_partkey")).join(hits, "p_name", "left")
    repeated = items.groupBy("l_orderkey", "p_name").agg(F.count_distinct("l_tax").alias("taxes")).filter("taxes > 1").select("l_orderkey", "p_name", F.lit(True).alias("dup"))
    items = items.join(repeated, ["l_orderkey", "p_name"], "left")
    speed, family = F.expr("CASE WHEN l_quantity < 5 THEN '' WHEN l_quantity < 30 THEN cast(p_size AS string) ELSE '99' END"), F.expr("CASE WHEN l_quantity % 7 = 0 THEN ' ' ELSE p_brand END")
    status = ladders.speed_status(F.coalesce("dup", F.lit(False)), F.coalesce("hits", F.lit(0)), F.coalesce("known", F.array().cast("array<string>")), speed, family)
    got = items.withColumn("status", status).groupBy(F.col("l_orderkey").alias("row_id")).agg(F.collect_list("status").alias("x"))
    return got.select("row_id", ladders.row_of_statuses(F.col("x")).alias("statuses"), ladders.row_of_reasons(F.col("x")).alias("reason"))


@register("joined_status_summary", """
WITH s AS (SELECT o_orderkey, concat_ws('|', CASE WHEN o_orderstatus = 'F' THEN 'Match' END, CASE WHEN o_orderpriority < '3' THEN 'Missing' END, CASE WHEN o_totalprice > 250000 THEN 'Duplicate' END) AS st FROM orders),
t AS (SELECT CASE WHEN st = '' THEN 'None' ELSE st END AS status FROM s)
SELECT status, count(*) AS n, min(coalesce(list_position(['Match', 'Missing', 'Mismatch', 'Duplicate'], x) - 1, 4)) AS place, count(*) * 1.0 / (SELECT count(*) FROM t) > 0.2 AS frequent FROM (SELECT status, unnest(string_split(status, '|'))  AS x, row_number() OVER () AS r FROM t) GROUP BY status HAVING true""".replace("count(*) AS n, min", "count(*) // len(string_split(status, '|')) AS n, min").replace("count(*) * 1.0 /", "count(*) // len(string_split(status, '|')) * 1.0 /"))
def joined_status_summary(spark, sf):
    """Counts of joined statuses in a custom order: the best place of their parts; frequent: more than a fifth of all rows."""
    o = read_table(spark, sf, "orders")
    st = F.concat_ws("|", F.when(F.col("o_orderstatus") == "F", "Match"), F.when(F.col("o_orderpriority") < "3", "Missing"), F.when(F.col("o_totalprice") > 250000, "Duplicate"))
    n = o.groupBy(F.coalesce(F.nullif(st, F.lit("")), F.lit("None")).alias("status")).agg(F.count(F.lit(1)).alias("n"))
    order = F.array(*map(F.lit, ("Match", "Missing", "Mismatch", "Duplicate")))
    place = F.array_min(F.transform(F.split("status", r"\|"), lambda x: F.when(F.array_position(order, x) > 0, F.array_position(order, x) - 1).otherwise(4)))
    total = n.agg(F.sum("n").alias("total"))
    return n.crossJoin(F.broadcast(total)).select("status", "n", place.cast("long").alias("place"), (F.col("n") / F.col("total") > 0.2).alias("frequent")).orderBy(F.desc("n"), "status")


@register("vendor_routing", """
WITH i AS (SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN 'E5-' || (2000 + p_size) WHEN 1 THEN (7000 + p_size) || 'P' WHEN 2 THEN 'E5-' || (9000 + p_size) ELSE p_name END AS token FROM part),
a AS (SELECT 'E5-' || (2000 + s_suppkey) AS key, s_name AS family FROM supplier), b AS (SELECT (7000 + n_nationkey) || 'P' AS key, n_name AS family FROM nation)
SELECT p_partkey, CASE WHEN a.key IS NOT NULL OR regexp_matches(token, 'E[0-9]-[0-9]{4}') THEN 'first' WHEN regexp_full_match(token, '[0-9]{4,5}[A-Z]?') THEN 'second' END AS vendor, CASE WHEN a.key IS NOT NULL OR regexp_matches(token, 'E[0-9]-[0-9]{4}') THEN a.family WHEN regexp_full_match(token, '[0-9]{4,5}[A-Z]?') THEN b.family END AS family
FROM i LEFT JOIN a ON token = a.key LEFT JOIN b ON token = b.key""")
def vendor_routing(spark, sf):
    items = read_table(spark, sf, "part").selectExpr("p_partkey", "CASE p_partkey % 4 WHEN 0 THEN concat('E5-', 2000 + p_size) WHEN 1 THEN concat(7000 + p_size, 'P') WHEN 2 THEN concat('E5-', 9000 + p_size) ELSE p_name END AS token")
    a = read_table(spark, sf, "supplier").selectExpr("concat('E5-', 2000 + s_suppkey) AS key", "s_name AS family")
    b = read_table(spark, sf, "nation").selectExpr("concat(7000 + n_nationkey, 'P') AS key", "n_name AS family")
    return reconcile.routed_lookup(items, "token", a, b, "E[0-9]-[0-9]{4}", "^[0-9]{4,5}[A-Z]?$").select("p_partkey", "vendor", "family")


_TOKEN = "CASE l_suppkey % 4 WHEN 0 THEN concat('E5-', 2000 + l_suppkey % 500) WHEN 1 THEN concat(7000 + l_partkey % 30, 'P') WHEN 2 THEN concat('E5-', 9000 + l_suppkey % 500) ELSE 'board' END"


@register("vendor_sets", f"""
WITH i AS (SELECT l_orderkey, l_linenumber * 1000000 + l_partkey AS pos, {_TOKEN} AS token FROM lineitem), a AS (SELECT 'E5-' || (2000 + s_suppkey) AS key, s_name AS family FROM supplier), b AS (SELECT (7000 + n_nationkey) || 'P' AS key, n_name AS family FROM nation),
r AS (SELECT l_orderkey, pos, token, CASE WHEN starts_with(token, 'E5') THEN 'Intel' WHEN token <> 'board' THEN 'AMD' END AS vendor, coalesce(a.family, b.family) AS family FROM i LEFT JOIN a ON token = a.key LEFT JOIN b ON token = b.key),
g AS (SELECT l_orderkey, coalesce(string_agg(DISTINCT vendor, ', ' ORDER BY vendor), '') AS vendors, count(vendor) AS total, count(family) AS matched, coalesce(string_agg(token, ' ' ORDER BY pos, token) FILTER (vendor IS NOT NULL AND family IS NULL), '') AS missing FROM r GROUP BY l_orderkey)
SELECT l_orderkey, vendors, missing, CASE WHEN total = 0 THEN 'missing' WHEN matched = 0 THEN 'Family is not found' WHEN matched < total THEN 'partial_match' ELSE 'match' END AS status,
  CASE WHEN total = 0 THEN 'missing' WHEN matched = 0 THEN 'Family is not found' WHEN matched < total THEN (total - matched) || ' of ' || total || ' family missing' ELSE 'match' END AS counted FROM g""")
def vendor_sets(spark, sf):
    """The vendors of an order's models, the models that no catalogue knows, and two ladders over both."""
    items = read_table(spark, sf, "lineitem").select("l_orderkey", (F.col("l_linenumber") * 1000000 + F.col("l_partkey")).alias("pos"), F.expr(_TOKEN).alias("token"))
    a = read_table(spark, sf, "supplier").selectExpr("concat('E5-', 2000 + s_suppkey) AS key", "s_name AS family")
    b = read_table(spark, sf, "nation").selectExpr("concat(7000 + n_nationkey, 'P') AS key", "n_name AS family")
    got = reconcile.vendor_summary(reconcile.routed_lookup(items, "token", a, b, "E[0-9]-[0-9]{4}", "^[0-9]{4,5}[A-Z]?$"), "l_orderkey", {"first": "Intel", "second": "AMD"})
    status = ladders.vendor_status(F.col("total"), F.col("matched"), F.lit(None).cast("string"), F.col("families"))
    return got.select("l_orderkey", "vendors", F.array_join("missing", " ").alias("missing"), status.alias("status"), ladders.partly_missing_status(F.col("total"), F.col("matched"), F.col("families")).alias("counted"))


@register("duplicates_first", """
WITH n AS (SELECT *, row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_shipdate, l_discount, l_tax) + 1 AS row_no FROM lineitem), f AS (SELECT *, min(row_no) OVER (PARTITION BY l_partkey, l_returnflag) AS first_row FROM n)
SELECT l_orderkey, l_linenumber, row_no, CASE WHEN first_row < row_no THEN 'DUPLICATE (same as row ' || first_row || ')' WHEN l_suppkey % 5 = 0 THEN 'MISSING' WHEN l_suppkey % 3 = 0 THEN 'MISMATCH' ELSE 'MATCH' END AS status FROM f""")
def duplicates_first(spark, sf):
    """Rows compared as expected and found texts, unless an earlier row has the same part and flag."""
    rows = reconcile.numbered(read_table(spark, sf, "lineitem"), [F.col(c) for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_shipdate", "l_discount", "l_tax")])
    found = F.expr("CASE WHEN l_suppkey % 5 = 0 THEN NULL WHEN l_suppkey % 3 = 0 THEN 'other' ELSE concat(l_returnflag, ' ') END")
    rows = reconcile.same_rows(rows, ["l_partkey", "l_returnflag"], "row_no")
    return rows.select("l_orderkey", "l_linenumber", "row_no", ladders.duplicate_or(F.col("first_row"), F.col("row_no"), compare.compare_text(F.col("l_returnflag"), found)).alias("status"))


def _generation(require: bool):
    def f(spark, sf):
        part = read_table(spark, sf, "part")
        dim = part.selectExpr("p_name AS name", "p_size % 5 AS gen").distinct().withColumn("full", F.concat_ws(" ", "name", F.concat(F.lit("g"), "gen")))
        probes = part.selectExpr("p_partkey", "concat(p_brand, ' ', p_name, ' g', p_size % 5, ' g', p_size % 3) AS t", "p_size % 5 AS g")
        got = reconcile.generation_join(probes, "p_partkey", "t", F.col("g"), dim.select(F.col("full").alias("name"), ((F.col("gen") + F.length("name")) % 5).alias("gen")), "name", "gen", require)
        return got.select("p_partkey", "name", "same_generation")

    return f


for _n, _w in (("generation_preferred", ""), ("generation_required", " WHERE p.g = d.gen")):
    register(_n, f"""
WITH d AS (SELECT DISTINCT p_name || ' g' || (p_size % 5) AS name, (p_size % 5 + length(p_name)) % 5 AS gen FROM part), p AS (SELECT p_partkey, string_split(lower(p_brand || ' ' || p_name || ' g' || (p_size % 5) || ' g' || (p_size % 3)), ' ') AS w, p_size % 5 AS g FROM part)
SELECT p_partkey, name, p.g = d.gen AS same_generation FROM p JOIN d ON len(list_filter(string_split(lower(name), ' '), lambda x: NOT list_contains(w, x))) = 0{_w} QUALIFY row_number() OVER (PARTITION BY p_partkey ORDER BY (p.g = d.gen) DESC, name) = 1""")(_generation(bool(_w)))


@register("numbered_rows", """
WITH n AS (SELECT *, row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_shipdate, l_discount, l_tax) + 1 AS row_no FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, row_no, min(row_no) OVER (PARTITION BY l_partkey, l_returnflag, l_linestatus) AS first_row FROM n""")
def numbered_rows(spark, sf):
    """Line items as numbered rows of one sheet, each with the first row of the same part and flags."""
    rows = read_table(spark, sf, "lineitem")
    n = reconcile.numbered(rows, [F.col(c) for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_shipdate", "l_discount", "l_tax")])
    return reconcile.same_rows(n, ["l_partkey", "l_returnflag", "l_linestatus"], "row_no").select("l_orderkey", "l_linenumber", "l_partkey", "row_no", "first_row")


# memory rows: a server is an order, a row a line of it
_MEM = """m AS (SELECT l_orderkey AS server, l_linenumber AS pos, l_partkey AS part, CASE WHEN l_discount < 0.01 THEN NULL ELSE concat('', 1 + l_partkey % 2) END AS ranks, CASE WHEN l_tax > 0.07 THEN '' ELSE concat('x', 4 * (1 + l_suppkey % 2)) END AS width,
  CASE WHEN l_quantity > 48 THEN ' ' ELSE concat(1 + l_partkey % 2, 'r x ', 4 * (1 + l_suppkey % 2)) END AS dimm, concat('DIMM ', CASE WHEN l_quantity < 4 THEN '' ELSE concat(1 + l_partkey % 2, 'Rx', CASE WHEN l_discount > 0.09 THEN 16 ELSE 4 * (1 + l_suppkey % 2) END) END) AS descr, l_returnflag AS flag FROM lineitem)"""
_LISTED = "CASE {0} % 4 WHEN 0 THEN ['1Rx4', '2Rx4', '1Rx8', '2Rx8'] WHEN 1 THEN ['1Rx4', '2Rx4', '2Rx4'] WHEN 2 THEN [] ELSE ['2Rx8', '1Rx8', '9Rx9'] END"


def memory_rows(spark, sf):
    m = read_table(spark, sf, "lineitem").selectExpr(
        "l_orderkey AS server", "l_linenumber AS pos", "l_partkey AS part", "CASE WHEN l_discount < 0.01 THEN NULL ELSE concat('', 1 + l_partkey % 2) END AS ranks", "CASE WHEN l_tax > 0.07 THEN '' ELSE concat('x', 4 * (1 + l_suppkey % 2)) END AS width",
        "CASE WHEN l_quantity > 48 THEN ' ' ELSE concat(1 + l_partkey % 2, 'r x ', 4 * (1 + l_suppkey % 2)) END AS dimm", "concat('DIMM ', CASE WHEN l_quantity < 4 THEN '' ELSE concat(1 + l_partkey % 2, 'Rx', CASE WHEN l_discount > 0.09 THEN 16 ELSE 4 * (1 + l_suppkey % 2) END) END) AS descr", "l_returnflag AS flag",
    )
    lists = "CASE (server + if(flag = 'R', 1, 0)) % 4 WHEN 0 THEN array('1Rx4', '2Rx4', '1Rx8', '2Rx8') WHEN 1 THEN array('1Rx4', '2Rx4', '2Rx4') WHEN 2 THEN cast(array() AS array<string>) ELSE array('2Rx8', '1Rx8', '9Rx9') END"
    return m.withColumn("listed", F.expr(lists))


_RANKED = f"""{_MEM}, r AS (SELECT *, {_LISTED.format("(server + CASE WHEN flag = 'R' THEN 1 ELSE 0 END)")} AS listed, CASE WHEN ranks IS NOT NULL AND width <> '' THEN ranks || 'R' || width END AS combined, CASE WHEN trim(dimm) <> '' THEN replace(replace(dimm, 'r', 'R'), ' ', '') END AS canon, nullif(regexp_extract(descr, '[0-9]+Rx[0-9]+'), '') AS expected,
  min(part) OVER (PARTITION BY server, pos, descr) AS fp FROM m),
q AS (SELECT *, fp <> part AS dup, concat_ws(', ', CASE WHEN ranks IS NULL THEN 'Rank' END, CASE WHEN width = '' THEN 'Rank Width' END, CASE WHEN trim(dimm) = '' THEN 'DIMM Rank' END, CASE WHEN expected IS NULL THEN 'DIMM Rank in Part Description' END) AS miss,
  concat_ws('; ', CASE WHEN combined IS DISTINCT FROM canon THEN 'Rank/Rank Width (' || coalesce(combined, 'none') || ') does not match DIMM Rank (' || dimm || ')' END, CASE WHEN canon IS DISTINCT FROM expected THEN 'DIMM Rank (' || dimm || ') does not match Part Description (' || expected || ')' WHEN combined IS DISTINCT FROM expected THEN 'Rank/Rank Width (' || coalesce(combined, 'none') || ') does not match Part Description (' || expected || ')' END) AS wrong,
  CASE WHEN coalesce(canon, expected) IS NOT NULL AND NOT list_contains(listed, coalesce(canon, expected)) THEN coalesce(canon, expected) || ' not present in Server DIMM Ranks [' || CASE (server + CASE WHEN flag = 'R' THEN 1 ELSE 0 END) % 4 WHEN 0 THEN '1Rx4, 1Rx8, 2Rx4, 2Rx8' WHEN 1 THEN '1Rx4, 2Rx4' WHEN 2 THEN 'empty' ELSE '1Rx8, 2Rx8, 9Rx9' END || ']' END AS absent FROM r),
st AS (SELECT *, CASE WHEN dup THEN 'Duplicate' WHEN miss <> '' THEN 'Missing' WHEN wrong <> '' OR absent IS NOT NULL THEN 'Unmatched' ELSE 'Matched' END AS raw FROM q)"""


def _rank_rows(spark, sf):
    m = memory_rows(spark, sf)
    first = m.groupBy("server", "pos", "descr").agg(F.min("part").alias("first"))
    m = m.join(first, ["server", "pos", "descr"]).withColumn("first", F.when(F.col("first") != F.col("part"), F.col("first")))
    width = F.when(F.col("width") != "", F.col("width"))
    return m.withColumn("s", ranks.rank_row(F.col("first"), F.col("ranks"), width, F.col("dimm"), F.col("descr"), F.col("listed")))


@register("rank_rows", f"""WITH {_RANKED} SELECT server, pos, part, raw AS status_raw, CASE WHEN raw = 'Missing' THEN 'Matched' ELSE raw END AS status,
  CASE WHEN dup THEN 'Duplicate of CSV row ' || fp WHEN miss <> '' THEN concat_ws('; ', 'Missing value(s): ' || miss, absent) ELSE concat_ws('; ', nullif(wrong, ''), absent) END AS reason FROM st""")
def rank_rows(spark, sf):
    return _rank_rows(spark, sf).select("server", "pos", "part", "s.status_raw", "s.status", "s.reason")


_SORTED = "array_to_string(list_sort(list_distinct({0})), ', ')"


@register("rank_servers", f"""
WITH {_RANKED}, g AS (SELECT server, coalesce(list_sort(list(DISTINCT expected) FILTER (expected IS NOT NULL)), []) AS exp, count(*) AS n_rows, count(*) FILTER (raw = 'Unmatched') AS rows_failed, list(DISTINCT listed) AS ls FROM st GROUP BY 1),
v AS (SELECT *, list_sort(list_distinct(flatten(list_transform(ls, lambda l: list_filter(exp, lambda x: NOT list_contains(l, x)))))) AS miss, list_sort(list_distinct(flatten(list_transform(ls, lambda l: list_filter(l, lambda x: NOT list_contains(exp, x)))))) AS extra,
  list_sort(list_distinct(flatten(list_transform(ls, lambda l: list_filter(list_distinct(l), lambda x: len(list_filter(l, lambda y: y = x)) > 1))))) AS dups, len(flatten(ls)) = 0 AS bare FROM g),
w AS (SELECT *, concat_ws('; ', CASE WHEN len(miss) > 0 THEN 'Expected rank(s) missing from Server DIMM Ranks: ' || array_to_string(list_transform(list_sort(list_transform(miss, lambda x: {{'a': regexp_extract(x, '^([0-9]+)', 1)::INT, 'b': regexp_extract(x, 'x([0-9]+)', 1)::INT, 'x': x}})), lambda s: s.x), ', ') END,
    CASE WHEN len(extra) > 0 THEN 'Server DIMM Ranks lists rank(s) with no memory part: ' || {_SORTED.format('extra')} END, CASE WHEN len(dups) > 0 THEN 'Rank(s) repeated in Server DIMM Ranks: ' || {_SORTED.format('dups')} END,
    CASE WHEN len(ls) > 1 THEN 'Server DIMM Ranks differs between rows (' || len(ls) || ' variants)' END, CASE WHEN len(exp) = 0 THEN 'No memory parts with DIMM ranks found for this server' END) AS txt,
  array_to_string(list_transform(list_sort(list_transform(exp, lambda x: {{'a': regexp_extract(x, '^([0-9]+)', 1)::INT, 'b': regexp_extract(x, 'x([0-9]+)', 1)::INT, 'x': x}})), lambda s: s.x), ', ') AS want FROM v)
SELECT server, n_rows, rows_failed, len(ls) AS variants, CASE WHEN bare THEN 'Missing' WHEN len(dups) > 0 AND len(miss) = 0 AND len(extra) = 0 THEN 'Duplicate' WHEN txt <> '' THEN 'Unmatched' ELSE 'Matched' END AS status,
  CASE WHEN bare THEN CASE WHEN len(exp) = 0 THEN 'No DIMM rank data: no memory part ranks and Server DIMM Ranks is empty' ELSE 'Server DIMM Ranks is empty; expected ' || want END ELSE txt END AS reason FROM w""")
def rank_servers(spark, sf):
    from tessera.functions import models

    rows = _rank_rows(spark, sf).withColumns({"expected": models.last_rank(F.col("descr")), "status": F.col("s.status_raw")})
    return ranks.server_status(ranks.server_roll_up(rows, "server", "expected", "listed", "status")).select("server", "n_rows", "rows_failed", "variants", "status", "reason")


@register("rank_coverage", f"""
WITH {_RANKED}, n AS (SELECT server, upper(expected) AS r, count(*) AS n FROM r WHERE expected IS NOT NULL GROUP BY 1, 2), k AS (SELECT server, list(r ORDER BY r) AS rs, list(r || ' x' || n ORDER BY r) AS said FROM n GROUP BY 1),
v AS (SELECT r.server, pos, part, coalesce(rs, []) AS rs, coalesce(said, []) AS said, list_transform(listed, lambda x: upper(x)) AS own FROM r LEFT JOIN k USING (server)),
x AS (SELECT *, list_transform(list_filter(range(1, len(rs) + 1), lambda i: NOT list_contains(own, rs[i])), lambda i: said[i]) AS miss, list_sort(list_filter(own, lambda y: NOT list_contains(rs, y))) AS mis, list_sort(list_filter(list_distinct(own), lambda y: len(list_filter(own, lambda z: z = y)) > 1)) AS dup FROM v)
SELECT server, pos, part, array_to_string(miss, ', ') AS missing, array_to_string(mis, ', ') AS mismatch, array_to_string(dup, ', ') AS duplicates, coalesce(nullif(concat_ws(', ', CASE WHEN len(miss) > 0 THEN 'Missing DIMM Ranks' END, CASE WHEN len(mis) > 0 THEN 'Mismatch DIMM Ranks' END, CASE WHEN len(dup) > 0 THEN 'Duplicate DIMM Ranks' END), ''), 'Verified') AS issue FROM x""")
def rank_coverage(spark, sf):
    from tessera.functions import models

    rows = memory_rows(spark, sf).withColumn("expected", models.last_rank(F.col("descr")))
    return ranks.coverage(rows, "server", "expected", "listed").select("server", "pos", "part", *(F.array_join(c, ", ").alias(c) for c in ("missing", "mismatch", "duplicates")), "issue")


@register("rank_domain", f"""
WITH {_MEM}, r AS (SELECT server, pos, part, {_LISTED.format("(server + CASE WHEN flag = 'R' THEN 1 ELSE 0 END)")} AS listed, CASE WHEN part % 3 = 0 THEN ['1Rx4', '7Rx7'] WHEN part % 3 = 1 THEN ['2Rx8'] ELSE [] END AS own FROM m),
x AS (SELECT *, list_contains(own, '7Rx7') AS bad, list_contains(listed, '9Rx9') AS far, listed = ['1Rx4', '2Rx4', '2Rx4'] AS dup, len(list_filter(own, lambda v: v <> '7Rx7' AND NOT list_contains(listed, v))) > 0 AS lacks FROM r)
SELECT server, pos, part, CASE WHEN bad OR far OR dup OR lacks THEN 'FAIL' ELSE 'PASS' END AS status, CASE WHEN bad THEN 'Invalid dimm_ranks: 7Rx7' ELSE '' END AS dimm_issue, CASE WHEN far THEN 'Invalid server_dimm_ranks: 9Rx9' WHEN dup THEN 'Duplicates in server_dimm_ranks: 2Rx4' ELSE '' END AS server_issue FROM x""")
def rank_domain(spark, sf):
    own = F.expr("CASE WHEN part % 3 = 0 THEN array('1Rx4', '7Rx7') WHEN part % 3 = 1 THEN array('2Rx8') ELSE cast(array() AS array<string>) END")
    return memory_rows(spark, sf).withColumn("s", ranks.domain_check(own, F.col("listed"))).select("server", "pos", "part", "s.status", "s.dimm_issue", "s.server_issue")
