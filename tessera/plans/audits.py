"""Queries of catalogue audits, summaries, filters and windows, with their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tessera.functions import text
from tessera.operators import audit, compare, ladders, verdicts
from tessera.plans.catalogue import read_table, register

_OLD = "SELECT p_partkey, p_name AS model, p_type AS category, list_sort(list_distinct([p_brand, p_name])) AS features, p_size AS sz, p_brand AS brand FROM part WHERE p_partkey % 11 <> 3"
_NEW = "SELECT p_partkey, CASE WHEN p_partkey % 7 = 0 THEN upper(p_name) ELSE concat(' ', p_name) END AS model, CASE WHEN p_partkey % 9 = 0 THEN '' ELSE p_type END AS category, list_sort(list_distinct([CASE WHEN p_partkey % 5 = 0 THEN 'new' ELSE p_brand END, p_name])) AS features, p_size + CASE WHEN p_partkey % 6 = 0 THEN 1 ELSE 0 END AS sz, p_brand AS brand FROM part WHERE p_partkey % 13 <> 4"


@register("catalogue_audit", f"""
WITH a AS ({_OLD}), b AS ({_NEW}), j AS (SELECT coalesce(a.p_partkey, b.p_partkey) AS p_partkey, a.p_partkey AS ka, b.p_partkey AS kb, a.*, b.model AS m2, b.category AS c2, b.features AS f2, b.sz AS s2, a.p_partkey % 4 = 0 AS few FROM a FULL JOIN b ON a.p_partkey = b.p_partkey),
n AS (SELECT p_partkey, ka, kb, CASE WHEN trim(model) <> trim(m2) THEN 'value differs: ''' || trim(model) || ''' vs ''' || trim(m2) || '''' END AS n1, CASE WHEN category <> c2 THEN 'value differs: ''' || category || ''' vs ''' || c2 || '''' END AS n2,
  CASE WHEN features <> f2 THEN 'features differ (' || concat_ws('; ', CASE WHEN len(list_filter(features, lambda x: NOT list_contains(f2, x))) > 0 THEN 'only in CSV: [' || array_to_string(list_filter(features, lambda x: NOT list_contains(f2, x)), ', ') || ']' END, CASE WHEN len(list_filter(f2, lambda x: NOT list_contains(features, x))) > 0 THEN 'only on live site: [' || array_to_string(list_filter(f2, lambda x: NOT list_contains(features, x)), ', ') || ']' END) || ')' END AS n3,
  CASE WHEN few OR sz <> s2 OR ka % 3 = 0 THEN 'specs differ (' || concat_ws('; ', CASE WHEN few THEN 'keys only in CSV: [brand]' END, CASE WHEN ka % 3 = 0 THEN 'keys only on live site: [extra]' END, CASE WHEN sz <> s2 THEN 'changed keys: [size]' END) || ')' END AS n4 FROM j),
s AS (SELECT *, CASE WHEN kb IS NULL AND p_partkey % 2 = 0 THEN 'LIVE_FETCH_FAILED' WHEN kb IS NULL THEN 'MISSING_FROM_LIVE_SITE' WHEN ka IS NULL THEN 'MISSING_FROM_CSV' WHEN coalesce(n1, n2, n3, n4) IS NOT NULL THEN 'UNMATCHED' ELSE 'MATCHED' END AS status, ka IS NULL OR kb IS NULL AS one FROM n)
SELECT p_partkey, status, CASE WHEN status = 'MATCHED' THEN 'YES' ELSE 'NO' END AS row_match, CASE WHEN one THEN 'N/A' WHEN n1 IS NULL THEN 'YES' ELSE 'NO' END AS model_match, CASE WHEN one THEN 'N/A' WHEN n2 IS NULL THEN 'YES' ELSE 'NO' END AS category_match, CASE WHEN one THEN 'N/A' WHEN n3 IS NULL THEN 'YES' ELSE 'NO' END AS features_match, CASE WHEN one THEN 'N/A' WHEN n4 IS NULL THEN 'YES' ELSE 'NO' END AS specs_match,
  CASE status WHEN 'MISSING_FROM_CSV' THEN 'Product exists on live site but this row is absent from the CSV entirely' WHEN 'MISSING_FROM_LIVE_SITE' THEN 'Product is in the CSV but was not found on the live site (removed, renamed, or fetch error)' WHEN 'LIVE_FETCH_FAILED' THEN '' ELSE concat_ws('; ', n1, n2, n3, n4) END AS notes FROM s""")
def catalogue_audit(spark, sf):
    part = read_table(spark, sf, "part")
    size = lambda e: F.array(F.expr(e).cast("string"))
    old = part.filter("p_partkey % 11 != 3").select("p_partkey", F.col("p_name").alias("model"), F.col("p_type").alias("category"), F.array("p_brand", "p_name").alias("features"), F.when(F.col("p_partkey") % 4 == 0, F.create_map(F.lit("size"), size("p_size"), F.lit("brand"), F.array("p_brand"))).otherwise(F.create_map(F.lit("size"), size("p_size"))).alias("specs"))
    live_specs = F.create_map(F.lit(" size "), size("p_size + if(p_partkey % 6 = 0, 1, 0)"))
    new = part.filter("p_partkey % 13 != 4").select("p_partkey", F.expr("CASE WHEN p_partkey % 7 = 0 THEN upper(p_name) ELSE concat(' ', p_name) END").alias("model"), F.expr("CASE WHEN p_partkey % 9 = 0 THEN NULL ELSE p_type END").alias("category"), F.array(F.expr("CASE WHEN p_partkey % 5 = 0 THEN 'new' ELSE p_brand END"), "p_name").alias("features"), F.when(F.col("p_partkey") % 3 == 0, audit.merged(live_specs, F.create_map(F.lit("extra"), F.array("p_brand")))).otherwise(live_specs).alias("specs"))
    new = new.withColumn("specs", audit.normal_map(F.col("specs"), lambda x: F.trim(x)))
    return audit.audit(old, new, part.filter("p_partkey % 2 = 0").select("p_partkey"), "p_partkey", ["model", "category"], ["features"], ["specs"])


@register("field_verdicts", """
SELECT p_partkey, coalesce('FAIL(' || nullif(concat_ws(', ', CASE WHEN p_size % 2 = 0 THEN 'model' END, CASE WHEN p_partkey % 3 = 0 THEN 'image' END, CASE WHEN p_partkey % 5 = 0 THEN 'specs' END), '') || ')', 'PASS') AS verdict,
  CASE p_partkey % 7 WHEN 0 THEN 'fetch_error' WHEN 1 THEN 'recategorized' WHEN 2 THEN 'driver_table' WHEN 3 THEN 'multi_config_tab' WHEN 4 THEN 'line_split' WHEN 5 THEN 'trademark_format' END AS tag FROM part""")
def field_verdicts(spark, sf):
    part = read_table(spark, sf, "part")
    field = F.expr("CASE p_partkey % 7 WHEN 0 THEN '(fetch)' WHEN 1 THEN 'category' WHEN 2 THEN concat('specifications[', p_name, ' BIOS]') WHEN 5 THEN 'features_summary' WHEN 6 THEN 'model_name' ELSE concat('specifications[', p_name, ']') END")
    csv = F.expr("CASE p_partkey % 7 WHEN 3 THEN concat(p_name, '\n', p_brand) WHEN 4 THEN concat(p_name, '\n', p_brand) ELSE p_name END")
    live = F.expr("CASE p_partkey % 7 WHEN 1 THEN p_brand WHEN 2 THEN '(not found on live page)' WHEN 3 THEN p_brand WHEN 4 THEN concat(p_name, ' ', p_brand) WHEN 5 THEN concat(p_name, 'TM') ELSE p_brand END")
    checks = {"model": F.col("p_size") % 2 != 0, "image": F.when(F.col("p_partkey") % 3 != 0, F.lit(True)), "specs": F.col("p_partkey") % 5 != 0}
    return part.select("p_partkey", audit.verdict(checks).alias("verdict"), ladders.explanation(field, csv, live).alias("tag"))


@register("explanation_rollup", """
WITH d AS (SELECT DISTINCT l_orderkey, CASE WHEN l_returnflag = 'N' THEN 'needs review' ELSE l_returnflag END AS t, l_linestatus || l_suppkey % 5 AS f FROM lineitem),
t AS (SELECT l_orderkey, t, array_to_string(list(f ORDER BY f), ', ') AS fs FROM d GROUP BY 1, 2)
SELECT l_orderkey, array_to_string(list(t || ': ' || fs ORDER BY t || ': ' || fs), ' | ') AS explanation FROM t GROUP BY 1""")
def explanation_rollup(spark, sf):
    d = read_table(spark, sf, "lineitem").select("l_orderkey", F.when(F.col("l_returnflag") != "N", F.col("l_returnflag")).alias("tag"), F.concat("l_linestatus", (F.col("l_suppkey") % 5).cast("string")).alias("field"))
    return audit.explained(d, "l_orderkey", "tag", "field")


@register("ordered_distinct_rollup", """
WITH e AS (SELECT o_orderstatus, o_orderpriority, o_orderkey, x, i FROM (SELECT *, unnest([o_custkey % 9, o_orderkey % 4]) AS x, unnest([0, 1]) AS i FROM orders)), f AS (SELECT o_orderstatus, o_orderpriority, x, min(o_orderkey * 2 + i) AS pl, count(*) AS n FROM e GROUP BY ALL)
SELECT o_orderstatus, o_orderpriority, sum(n)::BIGINT AS n_items, array_to_string(list(x ORDER BY pl), ',') AS items FROM f GROUP BY 1, 2""")
def ordered_distinct_rollup(spark, sf):
    o = read_table(spark, sf, "orders").withColumn("cell", F.array(F.col("o_custkey") % 9, F.col("o_orderkey") % 4))
    got = audit.ordered_distinct(o, ["o_orderstatus", "o_orderpriority"], "cell", "o_orderkey")
    return got.select("o_orderstatus", "o_orderpriority", "n_items", F.array_join("distinct_items", ",").alias("items"))


@register("speed_flag_set", """
WITH c AS (SELECT p_partkey, p_partkey % 5 AS k, p_partkey % 3 AS q, 2000 + p_size AS s, p_name FROM part)
SELECT p_partkey, array_to_string(list_sort(list_filter([CASE WHEN k = 1 THEN 'duplicate' END, CASE WHEN k = 2 THEN 'empty_speed' END, CASE WHEN k = 2 OR k = 3 THEN 'invalid_format' END, CASE WHEN q = 1 OR k = 3 THEN 'processor_mismatch' END,
  CASE WHEN k IN (2, 3) THEN 'missing' WHEN k = 4 THEN 'missing' END, CASE WHEN k = 4 THEN 'mismatch' END, CASE WHEN k IN (0, 1) AND q <> 1 THEN 'match' END], lambda x: x IS NOT NULL)), ' & ') AS flags FROM c""")
def speed_flag_set(spark, sf):
    """Entries 'name processor (speed)' of one row against its processors and the speeds that the reference has for them."""
    cell = F.expr("""CASE p_partkey % 5 WHEN 0 THEN array(concat(p_name, ' processor (', 2000 + p_size, ' MT/s)')) WHEN 1 THEN array(concat(p_name, ' processor (', 2000 + p_size, ' MHz)'), concat(p_name, ' processor (', 2000 + p_size, ' MHz)'))
      WHEN 2 THEN array(concat(p_name, ' processor ()')) WHEN 3 THEN array(concat(p_name, ' processor at some speed')) ELSE array(concat(p_name, ' processor (', 3000 + p_size, ' MHz)')) END""")
    known = F.array(F.expr("concat(2000 + p_size, CASE WHEN p_partkey % 5 IN (1, 4) THEN ' MHz' ELSE 'MT/s' END)"))
    processors = F.array(F.expr("CASE WHEN p_partkey % 3 = 1 THEN 'other' ELSE p_name END"))
    return read_table(spark, sf, "part").select("p_partkey", verdicts.speed_flags(cell, processors, known, lambda x: text.chain(x, text.SPEED_NAME)).alias("flags"))


@register("document_checks", """
SELECT p_partkey, CASE WHEN p_partkey % 4 = 0 THEN 'MISSING' WHEN p_partkey % 3 = 0 THEN 'MISMATCH' ELSE 'MATCH' END AS slots, CASE WHEN p_partkey % 5 = 0 THEN 'MISSING' WHEN p_partkey % 2 = 0 THEN 'MISMATCH' ELSE 'MATCH' END AS memory,
  CASE p_partkey % 6 WHEN 0 THEN 'invalid_json' WHEN 1 THEN 'no_key' WHEN 2 THEN 'no_data' WHEN 3 THEN 'invalid_data' WHEN 4 THEN 'match' ELSE 'mismatch' END AS answer,
  CASE (p_partkey % 2) + (p_size % 2) + (p_partkey % 3 > 0)::INT WHEN 3 THEN 'VERIFIED' WHEN 2 THEN 'PARTIAL' WHEN 1 THEN 'INCOMPLETE' ELSE 'FAILED' END AS complete, CASE (p_partkey % 2) + (p_size % 2) + (p_partkey % 3 > 0)::INT WHEN 3 THEN '100.0%' WHEN 2 THEN '66.7%' WHEN 1 THEN '33.3%' ELSE '0.0%' END AS percent,
  CASE WHEN p_partkey % 2 = 0 OR p_size % 2 = 0 THEN 'HIGH' WHEN p_partkey % 3 = 0 THEN 'MEDIUM' ELSE 'LOW' END AS severity, coalesce(nullif(concat_ws(' | ', CASE WHEN p_partkey % 2 = 0 THEN 'no description' END, CASE WHEN p_size % 2 = 0 THEN 'no document' END, CASE WHEN p_partkey % 3 = 0 THEN 'no specs' END), ''), 'None') AS issues,
  CASE WHEN p_partkey % 3 = 0 THEN 'YES - parse' WHEN p_size % 2 = 0 THEN 'NO - source' WHEN p_partkey % 2 = 0 THEN 'NO - source' ELSE 'YES' END AS feasible,
  CASE WHEN p_partkey % 8 = 0 THEN 'NOT_FOUND' WHEN p_size % 3 = 0 THEN 'FALLBACK' WHEN p_size % 3 = 2 AND p_partkey % 2 = 0 THEN 'PARTIAL' ELSE 'FULL' END AS level,
  CASE WHEN p_partkey % 9 = 0 THEN 'DUPLICATE_IN_CELL' WHEN p_partkey % 4 = 0 THEN 'MISSING' WHEN p_size % 2 = 0 THEN 'MISMATCH' WHEN p_partkey % 5 = 0 THEN 'DUPLICATE' ELSE 'MATCH' END AS mask FROM part""")
def document_checks(spark, sf):
    part = read_table(spark, sf, "part")
    k = F.col("p_partkey")
    d = ladders.document_status(F.col("p_size"), F.expr("CASE WHEN p_partkey % 4 = 0 THEN NULL WHEN p_partkey % 3 = 0 THEN p_size + 1 ELSE p_size END"), F.expr("CASE WHEN p_partkey % 5 <> 0 THEN p_size * 2 END"), F.expr("p_size * 2 + if(p_partkey % 2 = 0, 1, 0)"))
    cell = F.expr("CASE p_partkey % 6 WHEN 0 THEN concat('{\"CPU\": ', p_name) ELSE '{}' END")
    want = F.when(k % 6 != 3, F.array("p_name", F.concat(F.upper("p_brand"), F.lit(" "))))
    answer = ladders.answer_status(cell, k % 6 != 1, want, F.when(k % 6 == 2, F.array().cast("array<string>")).when(k % 6 == 5, F.array("p_name")).otherwise(F.array("p_brand", F.upper("p_name"))))
    c = ladders.completeness([(k % 2 == 1, "no description", "NO - source"), (F.col("p_size") % 2 == 1, "no document", "NO - source"), (k % 3 > 0, "no specs", "YES - parse")])
    mask = ladders.mask_status(k % 4 == 0, k % 9 == 0, F.col("p_size") % 2 == 0, k % 5 == 0)
    level = ladders.component_level(k % 8 != 0, F.lit(False), F.col("p_size") % 3, F.col("p_size") % 3 - F.when(F.col("p_size") % 3 == 2, (k + 1) % 2).otherwise(0))
    got = part.select("p_partkey", d.alias("d"), answer.alias("answer"), c.alias("c"), level.alias("level"), mask.alias("mask"))
    return got.select("p_partkey", "d.slots", "d.memory", "answer", F.col("c.status").alias("complete"), "c.percent", "c.severity", "c.issues", "c.feasible", "level", "mask")


@register("executive_summary", """
WITH a AS (SELECT count(*) AS n, count(*) FILTER (o_orderstatus = 'F') AS f, count(*) FILTER (o_totalprice > 1000) AS p, count(DISTINCT o_custkey) AS c FROM orders)
SELECT i AS place, m AS metric, v AS value FROM (SELECT unnest([0, 1, 2, 3, 4]) AS i, unnest(['rows', 'finished', 'priced', 'customers', 'gate']) AS m, unnest([n::VARCHAR, f::VARCHAR, round(100.0 * p / n, 1)::DECIMAL(10,1)::VARCHAR || '%', c::VARCHAR, CASE WHEN p >= 0.99 * n THEN 'PASS' ELSE 'FAIL' END]) AS v FROM a)""")
def executive_summary(spark, sf):
    priced, n = F.count_if(F.col("o_totalprice") > 1000), F.count(F.lit(1))
    return audit.summary(read_table(spark, sf, "orders"), {"rows": n, "finished": F.count_if(F.col("o_orderstatus") == "F"), "priced": F.format_string("%.1f%%", 100.0 * priced / n), "customers": F.count_distinct("o_custkey"), "gate": F.when(priced >= 0.99 * n, "PASS").otherwise("FAIL")})


@register("audit_rollup", """
WITH g AS (SELECT l_orderkey, list(l_linenumber ORDER BY l_linenumber, l_partkey) AS lines, count(*) FILTER (l_returnflag = 'R') AS mismatches, count(*) FILTER (l_linestatus = 'O') AS drift FROM lineitem GROUP BY 1)
SELECT len(lines) AS n_lines, count(*) AS servers, sum(mismatches)::BIGINT AS mismatches, sum(drift)::BIGINT AS drift, sum(len(lines))::BIGINT AS parts FROM g GROUP BY 1""")
def audit_rollup(spark, sf):
    """Rows of a server as one list, then sums of list sizes by their length."""
    g = read_table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey"))).alias("lines"), F.count_if(F.col("l_returnflag") == "R").alias("mismatches"), F.count_if(F.col("l_linestatus") == "O").alias("drift"))
    return g.groupBy(F.size("lines").alias("n_lines")).agg(F.count(F.lit(1)).alias("servers"), F.sum("mismatches").alias("mismatches"), F.sum("drift").alias("drift"), F.sum(F.size("lines")).alias("parts"))


@register("phase_counters", """
SELECT CASE WHEN o_orderkey % 10 = 0 THEN 'retry' ELSE 'initial' END AS phase, coalesce(nullif(concat_ws('|', CASE WHEN o_orderstatus = 'F' THEN 'ok' END, CASE WHEN o_orderstatus = 'P' THEN 'failed' END), ''), 'open') AS status, count(*) AS n FROM orders GROUP BY 1, 2""")
def phase_counters(spark, sf):
    st = F.when(F.col("o_orderstatus") == "F", "ok").when(F.col("o_orderstatus") == "P", "failed").otherwise("open")
    return read_table(spark, sf, "orders").groupBy(F.when(F.col("o_orderkey") % 10 == 0, "retry").otherwise("initial").alias("phase"), st.alias("status")).agg(F.count(F.lit(1)).alias("n"))


@register("status_frequency", "SELECT o_orderstatus, count(*) AS n, rank() OVER (ORDER BY count(*) DESC, o_orderstatus) AS place FROM orders GROUP BY 1")
def status_frequency(spark, sf):
    n = read_table(spark, sf, "orders").groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))
    return n.withColumn("place", F.rank().over(Window.orderBy(F.desc("n"), "o_orderstatus")).cast("long")).orderBy("place")  # one row a status


@register("filters", """
SELECT o_orderkey, lower(trim(' ' || o_orderpriority)) IN ('1-urgent', '2-high') AS in_list, o_orderstatus = 'F' OR nullif(o_totalprice, 0) IS NULL AS category_or_any, o_orderstatus IS DISTINCT FROM 'F' AS differs, (o_orderstatus <> 'F' OR o_orderpriority <> '5-LOW') AS failure FROM orders""")
def filters(spark, sf):
    o = read_table(spark, sf, "orders")
    return o.select("o_orderkey", F.lower(F.trim(F.concat(F.lit(" "), "o_orderpriority"))).isin("1-urgent", "2-high").alias("in_list"), ((F.col("o_orderstatus") == "F") | F.nullif("o_totalprice", F.lit(0.0)).isNull()).alias("category_or_any"), (~F.col("o_orderstatus").eqNullSafe("F")).alias("differs"), ((F.col("o_orderstatus") != "F") | (F.col("o_orderpriority") != "5-LOW")).alias("failure"))


@register("line_context", """
SELECT l_orderkey, l_linenumber, l_partkey, lag(l_returnflag) OVER w AS before, lead(l_returnflag, 2) OVER w AS after2, concat_ws(' ', lag(l_returnflag) OVER w, l_returnflag, lead(l_returnflag) OVER w, lead(l_returnflag, 2) OVER w) AS joined FROM lineitem WINDOW w AS (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity)""")
def line_context(spark, sf):
    """Look back one line and ahead two within a record; a record is bounded, so its window is."""
    w = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    f = lambda n: F.lead("l_returnflag", n).over(w) if n > 0 else F.lag("l_returnflag", -n).over(w)
    return read_table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", f(-1).alias("before"), f(2).alias("after2"), F.concat_ws(" ", f(-1), F.col("l_returnflag"), f(1), f(2)).alias("joined"))


@register("merged_lines", """
WITH c AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, CASE WHEN l_returnflag = 'R' THEN 'P' || (10000 + l_partkey) || '-B21' ELSE 'line ' || l_partkey END AS line FROM lineitem),
f AS (SELECT *, lag(line) OVER w AS prev FROM c WINDOW w AS (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity)), g AS (SELECT *, sum(CASE WHEN regexp_matches(line, '-B21$') AND prev IS NOT NULL AND NOT regexp_matches(prev, '-B21$') THEN 0 ELSE 1 END) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity) AS island FROM f)
SELECT l_orderkey, island::BIGINT AS island, string_agg(line, ' ' ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity) AS line FROM g GROUP BY 1, 2""")
def merged_lines(spark, sf):
    """A line that is a part number alone goes to the line before it, unless that one ends in a part number itself."""
    order = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity"]
    c = read_table(spark, sf, "lineitem").withColumn("line", F.expr("CASE WHEN l_returnflag = 'R' THEN concat('P', 10000 + l_partkey, '-B21') ELSE concat('line ', l_partkey) END"))
    return compare.merge_continuations(c, "l_orderkey", order, "line", r"^[A-Z]{0,2}[0-9]{5,}-[A-Z][0-9]{2}(#\w+)?$", r"\b[A-Z]{0,2}[0-9]{5,}-[A-Z][0-9]{2}\b")


@register("breaker_trips", """
WITH s AS (SELECT user_id, event_id, event_type = 'error' AS bad, sum(CASE WHEN event_type = 'error' THEN 0 ELSE 1 END) OVER (PARTITION BY user_id ORDER BY event_id) AS island FROM events),
n AS (SELECT *, row_number() OVER (PARTITION BY user_id, island, bad ORDER BY event_id) AS k FROM s)
SELECT user_id, event_id, CASE WHEN bad THEN (k - 1) % 2 + 1 ELSE 0 END AS streak, bad AND k % 2 = 0 AS trips FROM n""")
def breaker_trips(spark, sf):
    """Failures in a row, counted anew after each pause: a pause at every second one."""
    got = compare.streaks(read_table(spark, sf, "events"), "user_id", ["event_id"], F.col("event_type") == "error")
    return got.select("user_id", "event_id", *compare.with_reset(F.col("streak"), 2))


@register("sorted_limit", "SELECT p_partkey, p_name, left(p_name, 8) AS shown FROM part ORDER BY lower(p_name), p_partkey LIMIT 20")
def sorted_limit(spark, sf):
    """The first rows in an order that ties cannot change: a report, the limit is its feature."""
    return read_table(spark, sf, "part").orderBy(F.lower("p_name"), "p_partkey").limit(20).select("p_partkey", "p_name", text.clipped(F.col("p_name"), 8).alias("shown"))


@register("list_checks", """
WITH c AS (SELECT p_partkey, [p_brand, NULL, p_name, p_brand] AS a, CASE WHEN p_size % 2 = 0 THEN [p_name, p_brand, p_brand] ELSE [p_name, p_brand] END AS b FROM part)
SELECT p_partkey, array_to_string(list_sort(list_distinct(a)), '|') AS clean, list_sort(list_filter(a, lambda x: x IS NOT NULL)) = list_sort(b) AS same_bag, array_to_string(list_sort(list_filter(list_filter(a, lambda x: x IS NOT NULL), lambda x: x <> p_name)), '|') AS bag_missing, p_size || 'G' AS capacity FROM c JOIN part USING (p_partkey)""")
def list_checks(spark, sf):
    from tessera.functions import arrays

    a, b = F.array("p_brand", F.lit(None), "p_name", "p_brand"), F.expr("CASE WHEN p_size % 2 = 0 THEN array(p_name, p_brand, p_brand) ELSE array(p_name, p_brand) END")
    return read_table(spark, sf, "part").select("p_partkey", F.array_join(arrays.clean(a), "|").alias("clean"), arrays.same_bag(F.array_compact(a), b).alias("same_bag"), F.array_join(arrays.bag_missing(F.array_compact(a), F.array("p_name")), "|").alias("bag_missing"), F.upper(text.no_space(F.concat(F.col("p_size").cast("string"), F.lit("  g")))).alias("capacity"))


@register("date_texts", "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS iso, strftime(o_orderdate, '%Y%m%d_%H%M%S') AS stamp FROM orders")
def date_texts(spark, sf):
    from tessera.functions.dates import file_stamp, utc_iso

    return read_table(spark, sf, "orders").select("o_orderkey", utc_iso(F.col("o_orderdate")).alias("iso"), file_stamp(F.col("o_orderdate")).alias("stamp"))


@register("rank_lists", """
SELECT o_custkey, array_to_string(list_transform(list_sort(list_distinct(list({'w': o_orderkey % 4, 'x': o_orderkey % 3}))), lambda s: s.w || 'Rx' || s.x), ', ') AS shown FROM orders GROUP BY 1""")
def rank_lists(spark, sf):
    from tessera.operators import ranks

    o = read_table(spark, sf, "orders").withColumn("r", F.expr("concat(o_orderkey % 4, 'Rx', o_orderkey % 3)"))
    return o.groupBy("o_custkey").agg(F.collect_set("r").alias("rs")).select("o_custkey", ranks.shown(F.col("rs")).alias("shown"))


