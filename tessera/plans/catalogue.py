"""Registered queries of the engine's own operators, with their DuckDB SQL."""

from __future__ import annotations

QUERIES: dict = {}
ORACLE: dict = {}


def register(name: str, sql: str | None = None):
    """Add a query (spark, sf_dir) -> DataFrame and, if it has one, its SQL."""

    def add(f):
        QUERIES[name] = f
        if sql:
            ORACLE[name] = sql
        return f

    return add


from pyspark.sql import DataFrame, SparkSession, Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from tessera.functions import arrays, models, numbers, text  # noqa: E402
from tessera.operators import compare, documents, html, lookup, specs, verdicts  # noqa: E402
from tessera.sources.tables import append_new, read_table  # noqa: E402
from tessera.streaming import state  # noqa: E402



def spread(df: DataFrame) -> DataFrame:
    """Rows that cost far more than their bytes, dealt evenly over all cores: a small file gives few splits, and their number does not grow with the work."""
    return df.repartition(4 * df.sparkSession.sparkContext.defaultParallelism)


PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
_WANT = "['1-URGENT','2-HIGH','3-MEDIUM','4-NOT SPECIFIED','5-LOW']"


@register("coverage_missing_extra_dup", f"""
WITH n AS (SELECT o_custkey, o_orderpriority AS p, count(*) AS n FROM orders GROUP BY ALL),
g AS (SELECT o_custkey, list(p ORDER BY p) AS got, coalesce(list(p ORDER BY p) FILTER (n > 1), []) AS dup FROM n GROUP BY 1),
m AS (SELECT *, list_filter({_WANT}, lambda x: NOT list_contains(got, x)) AS miss, list_filter(got, lambda x: NOT list_contains({_WANT}, x)) AS extra FROM g)
SELECT o_custkey, array_to_string(miss, ',') AS missing, array_to_string(extra, ',') AS extra, array_to_string(dup, ',') AS duplicates,
  CASE WHEN len(miss) > 0 THEN 'MISSING' WHEN len(extra) > 0 THEN 'EXTRA' WHEN len(dup) > 0 THEN 'DUPLICATED' ELSE 'PASS' END AS status FROM m""")
def coverage(spark: SparkSession, sf: str) -> DataFrame:
    return compare.coverage_check(read_table(spark, sf, "orders"), "o_custkey", "o_orderpriority", PRIORITIES)


@register("group_distinct_rollup", """
SELECT l_orderkey, array_to_string(list_sort(list(DISTINCT l_returnflag)), ',') AS flags, count(*) AS n_lines, count(DISTINCT l_suppkey) AS n_suppliers,
 count(*) FILTER (l_linestatus = 'F') AS n_final FROM lineitem GROUP BY l_orderkey""")
def group_rollup(spark, sf):
    li = read_table(spark, sf, "lineitem")
    return li.groupBy("l_orderkey").agg(F.array_join(F.array_sort(F.collect_set("l_returnflag")), ",").alias("flags"), F.count(F.lit(1)).alias("n_lines"), F.size(F.collect_set("l_suppkey")).cast("long").alias("n_suppliers"), F.count_if(F.col("l_linestatus") == "F").alias("n_final"))


def _part_lookup(order: str):
    def f(spark, sf):
        part = read_table(spark, sf, "part")
        dim = part.select("p_name", F.col("p_partkey").alias("ref_key"), F.col("p_brand").alias("ref_brand"))
        way = F.col("ref_key").desc() if order == "DESC" else F.col("ref_key").asc()
        return lookup.lookup(part.select("p_partkey", "p_name"), dim, "p_name", [way]).select("p_partkey", "ref_key", "ref_brand")

    return f


for _name, _o in (("lookup_last_wins", "DESC"), ("lookup_first_wins", "ASC")):
    register(_name, f"""
WITH d AS (SELECT p_name, p_partkey AS ref_key, p_brand AS ref_brand FROM part QUALIFY row_number() OVER (PARTITION BY p_name ORDER BY p_partkey {_o}) = 1)
SELECT p_partkey, ref_key, ref_brand FROM part LEFT JOIN d USING (p_name)""")(_part_lookup(_o))


@register("lookup_multimap_summary", """
SELECT p_brand, count(*) AS n_hits, count(DISTINCT p_type) AS n_types, array_to_string(list_sort(list(DISTINCT p_type)), ' | ') AS types FROM part GROUP BY p_brand""")
def multimap(spark, sf):
    return read_table(spark, sf, "part").groupBy("p_brand").agg(F.count(F.lit(1)).alias("n_hits"), F.count_distinct("p_type").alias("n_types"), F.array_join(F.array_sort(F.collect_set("p_type")), " | ").alias("types"))


@register("lookup_cascade", """
WITH a AS (SELECT p_name AS k, min(p_partkey) AS v FROM part WHERE p_size < 10 GROUP BY 1), b AS (SELECT p_type AS k, min(p_partkey) AS v FROM part WHERE p_size < 3 AND p_brand < 'Brand#2' GROUP BY 1),
c AS (SELECT p_brand AS k, min(p_partkey) AS v FROM part GROUP BY 1)
SELECT p_partkey, CASE WHEN a.k IS NOT NULL THEN a.v WHEN b.k IS NOT NULL THEN b.v ELSE c.v END AS ref, CASE WHEN a.k IS NOT NULL THEN 'name' WHEN b.k IS NOT NULL THEN 'type' WHEN c.k IS NOT NULL THEN 'brand' END AS match_source
FROM part LEFT JOIN a ON p_name = a.k LEFT JOIN b ON p_type = b.k LEFT JOIN c ON p_brand = c.k""")
def cascade(spark, sf):
    part = read_table(spark, sf, "part")
    dim = lambda k, where: part.filter(where).groupBy(F.col(k).alias("key")).agg(F.min("p_partkey").alias("v"))
    steps = [("name", dim("p_name", "p_size < 10"), "p_name", "v"), ("type", dim("p_type", "p_size < 3 AND p_brand < 'Brand#2'"), "p_type", "v"), ("brand", dim("p_brand", "true"), "p_brand", "v")]
    return lookup.cascade_lookup(part, steps, "ref").select("p_partkey", "ref", "match_source")


@register("best_of_hits", """
SELECT c_custkey, s_suppkey, (s_acctbal >= c_acctbal) AS richer FROM customer JOIN supplier ON c_nationkey = s_nationkey
QUALIFY row_number() OVER (PARTITION BY c_custkey ORDER BY (s_acctbal >= c_acctbal) DESC, s_suppkey) = 1""")
def best_hits(spark, sf):
    got = lookup.best_above(read_table(spark, sf, "customer"), "c_nationkey", "c_acctbal", read_table(spark, sf, "supplier"), "s_nationkey", "s_acctbal", "s_suppkey")
    return got.select("c_custkey", "s_suppkey", F.col("above").alias("richer"))


def _contains(both: bool):
    def f(spark, sf):
        part = read_table(spark, sf, "part")
        probes = part.select(F.explode(F.split("p_name", " ")).alias("probe")).distinct()
        return lookup.contains_join(part.select("p_name").distinct(), "p_name", probes, "probe", both).select("p_name", "probe")

    return f


for _name, _extra in (("contains_join", ""), ("bidi_contains_join", " OR contains(probe, p_name)")):
    register(_name, f"""
WITH n AS (SELECT DISTINCT p_name FROM part), t AS (SELECT DISTINCT unnest(string_split(p_name, ' ')) AS probe FROM part)
SELECT p_name, probe FROM n JOIN t ON probe <> '' AND (contains(p_name, probe){_extra})""")(_contains(bool(_extra)))


@register("token_join_first", """
WITH dim AS (SELECT word, min(p_partkey) AS ref FROM (SELECT unnest(string_split(p_name, ' ')) AS word, p_partkey FROM part WHERE p_size > 25) GROUP BY 1),
e AS (SELECT p_partkey, w[i] AS word, i FROM (SELECT p_partkey, string_split(p_name, ' ') AS w, unnest(range(1, len(string_split(p_name, ' ')) + 1)) AS i FROM part))
SELECT p_partkey, word, ref FROM e JOIN dim USING (word) QUALIFY row_number() OVER (PARTITION BY p_partkey ORDER BY i) = 1""")
def token_first(spark, sf):
    part = read_table(spark, sf, "part")
    dim = part.filter("p_size > 25").select(F.explode(F.split("p_name", " ")).alias("word"), "p_partkey").groupBy("word").agg(F.min("p_partkey").alias("ref"))
    return lookup.token_join(part.select("p_partkey", F.split("p_name", " ").alias("tokens")), "p_partkey", "tokens", dim, "word").select("p_partkey", "word", "ref")


@register("fuzzy_overlap_best", """
WITH d AS (SELECT p_partkey AS k, string_split(lower(p_brand || ' ' || p_name || ' ' || p_type), ' ') AS w FROM part),
b AS (SELECT DISTINCT k, unnest(w) AS x FROM d), a AS (SELECT DISTINCT o_orderkey, unnest(string_split(lower(p_name || ' brand#' || (o_custkey % 30)), ' ')) AS x FROM orders JOIN part ON o_orderkey = p_partkey)
SELECT o_orderkey, k, count(*) AS n_shared FROM a JOIN b USING (x) GROUP BY o_orderkey, k QUALIFY row_number() OVER (PARTITION BY o_orderkey ORDER BY count(*) DESC, k) = 1""")
def overlap(spark, sf):
    """Every part is an entry, so the dimension grows with the data and its words are common ones."""
    part = read_table(spark, sf, "part")
    facts = read_table(spark, sf, "orders").join(part, F.col("o_orderkey") == F.col("p_partkey")).select("o_orderkey", F.split(F.lower(F.concat("p_name", F.lit(" brand#"), F.col("o_custkey") % 30)), " ").alias("words"))
    d = part.select(F.col("p_partkey").alias("k"), F.split(F.lower(F.concat_ws(" ", "p_brand", "p_name", "p_type")), " ").alias("w"))
    return lookup.overlap_best(facts, "o_orderkey", "words", d, "k", "w")


_OLD = "SELECT p_partkey, p_name, p_size, p_retailprice FROM part WHERE p_partkey % 11 <> 3"
_NEW = "SELECT p_partkey, CASE WHEN p_partkey % 7 = 0 THEN upper(p_name) ELSE p_name END AS p_name, CASE WHEN p_partkey % 5 = 0 THEN p_size + 1 ELSE p_size END AS p_size, p_retailprice FROM part WHERE p_partkey % 13 <> 4"


def _two(spark, sf):
    part = read_table(spark, sf, "part")
    new = part.filter("p_partkey % 13 != 4").withColumns({"p_name": F.expr("CASE WHEN p_partkey % 7 = 0 THEN upper(p_name) ELSE p_name END"), "p_size": F.expr("CASE WHEN p_partkey % 5 = 0 THEN p_size + 1 ELSE p_size END")})
    return part.filter("p_partkey % 11 != 3"), new


@register("full_outer_diff_status", f"""
WITH a AS ({_OLD}), b AS ({_NEW}), j AS (SELECT coalesce(a.p_partkey, b.p_partkey) AS p_partkey, a.p_partkey AS ka, b.p_partkey AS kb,
 CASE WHEN a.p_partkey IS NULL OR b.p_partkey IS NULL THEN '' ELSE concat_ws(',', CASE WHEN a.p_name IS DISTINCT FROM b.p_name THEN 'p_name' END, CASE WHEN a.p_size IS DISTINCT FROM b.p_size THEN 'p_size' END) END AS changed
 FROM a FULL JOIN b ON a.p_partkey = b.p_partkey)
SELECT p_partkey, CASE WHEN kb IS NULL THEN 'REMOVED' WHEN ka IS NULL THEN 'ADDED' WHEN changed <> '' THEN 'CHANGED' ELSE 'SAME' END AS status, changed FROM j""")
def full_diff(spark, sf):
    return compare.table_diff(*_two(spark, sf), "p_partkey", ["p_name", "p_size"])


@register("stable_volatile_diff", f"""
WITH a AS ({_OLD}), b AS ({_NEW}) SELECT a.p_partkey, CASE WHEN a.p_name IS DISTINCT FROM b.p_name THEN 'MISMATCH' WHEN a.p_size IS DISTINCT FROM b.p_size THEN 'DRIFT' ELSE 'MATCH' END AS status FROM a JOIN b USING (p_partkey)""")
def stable_volatile(spark, sf):
    d = compare.table_diff(*_two(spark, sf), "p_partkey", ["p_name", "p_size"]).filter("status IN ('CHANGED', 'SAME')")
    return d.select("p_partkey", compare.ladder((F.contains("changed", F.lit("p_name")), "MISMATCH"), (F.col("changed") != "", "DRIFT"), default="MATCH").alias("status"))


@register("anti_both_ways", """
SELECT 'customer' AS side, c_custkey AS k FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_custkey IS NOT NULL)
UNION ALL SELECT DISTINCT 'orders', o_custkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer)""")
def anti(spark, sf):
    c, o = read_table(spark, sf, "customer").select(F.col("c_custkey").alias("k")), read_table(spark, sf, "orders").select(F.col("o_custkey").alias("k"))
    return c.join(o, "k", "left_anti").select(F.lit("customer").alias("side"), "k").union(o.join(c, "k", "left_anti").distinct().select(F.lit("orders"), "k"))


@register("set_compare", """
WITH g AS (SELECT l_orderkey, list(l_returnflag ORDER BY l_linenumber, l_partkey, l_suppkey) AS got FROM lineitem GROUP BY 1)
SELECT l_orderkey, array_to_string(list_sort(list_filter(['A','N','R'], lambda x: NOT list_contains(got, x))), ',') AS missing, (len(list_distinct(got)) = 3) AS same,
 (len(list_distinct(got)) < 3) AS subset, array_to_string(list_sort(list_filter(list_distinct(got), lambda x: len(list_filter(got, lambda y: y = x)) > 1)), ',') AS dups,
 round(100.0 * len(list_distinct(got)) / 3, 1) AS score FROM g""")
def set_compare(spark, sf):
    g = read_table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.collect_list("l_returnflag").alias("got"))
    want = F.array(F.lit("A"), F.lit("N"), F.lit("R"))
    return g.select("l_orderkey", F.array_join(arrays.missing(want, F.col("got")), ",").alias("missing"), arrays.same_set(F.col("got"), want).alias("same"), arrays.strict_subset(F.col("got"), want).alias("subset"), F.array_join(arrays.duplicates(F.col("got")), ",").alias("dups"), arrays.overlap_percent(want, F.col("got")).alias("score"))


@register("dup_flag_keep_first", "SELECT doc_id, row_number() OVER w > 1 AS is_dup, first(doc_id) OVER w AS first_row FROM documents WINDOW w AS (PARTITION BY text ORDER BY doc_id)")
def dup_flag(spark, sf):
    d = read_table(spark, sf, "documents").select("doc_id", F.sha2("text", 256).alias("h"))
    return compare.flag_duplicates(d, ["h"], "doc_id").select("doc_id", "is_dup", "first_row")


@register("streak_breaker", """
WITH i AS (SELECT *, sum(CASE WHEN event_type = 'error' THEN 0 ELSE 1 END) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS g FROM events)
SELECT event_id, (sum((event_type = 'error')::INT) OVER (PARTITION BY user_id, g ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING))::BIGINT AS streak FROM i""")
def streak(spark, sf):
    return compare.streaks(read_table(spark, sf, "events"), "user_id", ["ts", "event_id"], F.col("event_type") == "error").select("event_id", "streak")


@register("carry_forward", """
SELECT event_id, last_value(CASE WHEN event_type = 'purchase' THEN value END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS last_purchase FROM events""")
def carry(spark, sf):
    w = Window.partitionBy("user_id").orderBy("ts", "event_id").rowsBetween(Window.unboundedPreceding, 0)
    return read_table(spark, sf, "events").select("event_id", F.last(F.when(F.col("event_type") == "purchase", F.col("value")), ignorenulls=True).over(w).alias("last_purchase"))


@register("gap_islands_merge", """
WITH i AS (SELECT *, sum((role = 'user')::INT) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING) AS g FROM conversations)
SELECT conv_id, g::BIGINT AS block, count(*) AS n_turns, min(turn) AS first_turn, sum(length(text))::BIGINT AS chars FROM i GROUP BY conv_id, g""")
def islands(spark, sf):
    w = Window.partitionBy("conv_id").orderBy("turn").rowsBetween(Window.unboundedPreceding, 0)
    return read_table(spark, sf, "conversations").withColumn("block", F.sum((F.col("role") == "user").cast("int")).over(w)).groupBy("conv_id", "block").agg(F.count(F.lit(1)).alias("n_turns"), F.min("turn").alias("first_turn"), F.sum(F.length("text")).alias("chars"))


@register("stalest_topn", "SELECT user_id, max(ts) AS last_seen FROM events GROUP BY 1 ORDER BY last_seen, user_id LIMIT 15")
def stalest(spark, sf):
    return read_table(spark, sf, "events").groupBy("user_id").agg(F.max("ts").alias("last_seen")).orderBy(F.asc_nulls_first("last_seen"), "user_id").limit(15)


@register("status_priority_worst", """
SELECT o_custkey, min(CASE o_orderstatus WHEN 'P' THEN '1-P' WHEN 'O' THEN '2-O' ELSE '3-F' END) AS worst, count(*) AS n FROM orders GROUP BY 1""")
def worst(spark, sf):
    return read_table(spark, sf, "orders").groupBy("o_custkey").agg(F.min(F.when(F.col("o_orderstatus") == "P", "1-P").when(F.col("o_orderstatus") == "O", "2-O").otherwise("3-F")).alias("worst"), F.count(F.lit(1)).alias("n"))


@register("pass_rate_summary", """
SELECT o_orderpriority, count(*) AS total, count(*) FILTER (o_orderstatus = 'F') AS passed, round(100.0 * count(*) FILTER (o_orderstatus = 'F') / count(*), 1) AS rate FROM orders GROUP BY 1""")
def pass_rate(spark, sf):
    ok = F.count_if(F.col("o_orderstatus") == "F")
    return read_table(spark, sf, "orders").groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("total"), ok.alias("passed"), numbers.percent(ok, F.count(F.lit(1))).alias("rate"))


@register("metric_long_unpivot", """
SELECT metric, value FROM (SELECT count(*) AS n_rows, count(DISTINCT l_orderkey) AS n_orders, count(*) FILTER (l_returnflag = 'R') AS n_returned FROM lineitem) UNPIVOT (value FOR metric IN (n_rows, n_orders, n_returned))""")
def metrics(spark, sf):
    one = read_table(spark, sf, "lineitem").agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("l_orderkey").alias("n_orders"), F.count_if(F.col("l_returnflag") == "R").alias("n_returned"))
    return one.unpivot([], ["n_rows", "n_orders", "n_returned"], "metric", "value")


@register("completeness_bands", """
SELECT d.doc_id, round(100.0 * ((d.lang IS NOT NULL)::INT + (l.doc_id IS NOT NULL)::INT + (n_chars > 1000)::INT) / 3, 1) AS score,
 CASE WHEN (d.lang IS NOT NULL)::INT + (l.doc_id IS NOT NULL)::INT + (n_chars > 1000)::INT = 3 THEN 'HIGH' WHEN (d.lang IS NOT NULL)::INT + (l.doc_id IS NOT NULL)::INT + (n_chars > 1000)::INT = 2 THEN 'MEDIUM' ELSE 'LOW' END AS band
FROM documents d LEFT JOIN (SELECT DISTINCT doc_id FROM labels) l ON d.doc_id = l.doc_id""")
def completeness(spark, sf):
    d = read_table(spark, sf, "documents").select("doc_id", "lang", "n_chars")
    got = d.join(read_table(spark, sf, "labels").select("doc_id", F.lit(1).alias("has")).distinct(), "doc_id", "left")
    n = sum((c.cast("int") for c in (F.col("lang").isNotNull(), F.col("has").isNotNull(), F.col("n_chars") > 1000)), F.lit(0))
    score = numbers.percent(n, F.lit(3))
    return got.select("doc_id", score.alias("score"), numbers.band(score).alias("band"))


@register("rollup_summary", "SELECT r_name, n_name, count(*) AS n, round(sum(c_acctbal), 2) AS bal FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY ROLLUP (r_name, n_name)")
def rollup(spark, sf):
    c = read_table(spark, sf, "customer").join(read_table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).join(read_table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return c.rollup("r_name", "n_name").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("c_acctbal"), 2).alias("bal"))


@register("clean_name_chain", r"""
SELECT p_partkey, trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(lower(p_name || ' Processors (2nd Generation) ' || p_brand), '\bgeneration\b', 'gen', 'g'), '\bprocessors\b', 'processor', 'g'), '[^\p{L}\p{N}_\s-]', ' ', 'g'), '\s+', ' ', 'g')) AS clean,
  upper(regexp_replace(p_brand, '[^A-Za-z0-9 ]+', '', 'g')) AS brand FROM part""")
def clean_name(spark, sf):
    name = F.concat(F.col("p_name"), F.lit(" Processors (2nd Generation) "), F.col("p_brand"))
    return read_table(spark, sf, "part").select("p_partkey", text.chain(name, text.PRODUCT_NAME).alias("clean"), text.alnum_upper(F.col("p_brand")).alias("brand"))


@register("regex_first_last_all", r"""
SELECT event_id, nullif(regexp_extract(props || ' ' || event_id, '[0-9]+'), '') AS first_number, regexp_extract_all(props || ' ' || event_id, '[0-9]+')[-1] AS last_number, array_to_string(list_distinct(list_sort(regexp_extract_all(props || ' ' || event_id, '[0-9]'))).list_sort(), '') AS digits FROM events""")
def regexes(spark, sf):
    t = F.concat_ws(" ", "props", "event_id")
    return read_table(spark, sf, "events").select("event_id", text.first_match(t, "[0-9]+").alias("first_number"), text.last_match(t, "[0-9]+").alias("last_number"), F.array_join(F.array_sort(text.distinct_matches(t, "[0-9]")), "").alias("digits"))


@register("capacity_to_mb", "SELECT p_partkey, p_size * CASE p_partkey % 3 WHEN 0 THEN 1 WHEN 1 THEN 1024 ELSE 1048576 END::DOUBLE AS mb, p_partkey % 4 = 0 AS by_four FROM part")
def capacity(spark, sf):
    cell = F.concat(F.col("p_size").cast("string"), F.element_at(F.array(F.lit("MB"), F.lit(" gb"), F.lit(" TB")), (F.col("p_partkey") % 3 + 1).cast("int")))
    return read_table(spark, sf, "part").select("p_partkey", numbers.capacity_mb(cell).alias("mb"), numbers.divides(F.col("p_partkey"), F.lit(4)).alias("by_four"))


_SPOKEN = "['twenty-one', 'Seven', 'forty', ' nineteen', 'many', 'one two', 'twenty thirty', 'ten one', 'zero', 'ninety nine', 'forty-ten', 'twenty one two']"


@register("number_words", f"SELECT p_partkey, [21, 7, 40, 19, NULL, NULL, NULL, NULL, NULL, 99, NULL, NULL][p_partkey % 12 + 1] AS n, {_SPOKEN}[p_partkey % 12 + 1] AS words FROM part")
def words_to_numbers(spark, sf):
    cell = F.expr(f"element_at(array({_SPOKEN[1:-1]}), cast(p_partkey % 12 + 1 AS int))")
    return read_table(spark, sf, "part").select("p_partkey", text.number_words(cell).alias("n"), cell.alias("words"))


@register("literal_list_parse", "SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN p_name || '|' || p_type WHEN 1 THEN p_name WHEN 2 THEN p_brand || '|' || p_type ELSE '' END AS items FROM part")
def list_parse(spark, sf):
    q = "CASE p_partkey % 4 WHEN 0 THEN concat(\"['\", p_name, \"', '\", p_type, \"']\") WHEN 1 THEN p_name WHEN 2 THEN concat('[', p_brand, ', nan, ', p_type, ']') ELSE '  ' END"
    return read_table(spark, sf, "part").select("p_partkey", F.array_join(text.parse_list(F.expr(q)), "|").alias("items"))


@register("sku_synthesis", "SELECT p_partkey, upper(left(p_brand, 1)) || p_size || 'x' || left(p_type, 3) || '-' || right('0000' || p_partkey, 4) AS sku FROM part")
def sku(spark, sf):
    return read_table(spark, sf, "part").select("p_partkey", F.concat(F.upper(F.expr("left(p_brand, 1)")), F.col("p_size"), F.lit("x"), F.expr("left(p_type, 3)"), F.lit("-"), F.expr("right(concat('0000', p_partkey), 4)")).alias("sku"))


@register("json_prop_extract", "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, array_to_string(list_sort(json_keys(props)), ',') AS keys FROM events")
def json_props(spark, sf):
    return read_table(spark, sf, "events").select("event_id", F.get_json_object("props", "$.k").try_cast("long").alias("k"), F.array_join(F.array_sort(F.json_object_keys("props")), ",").alias("keys"))


@register("page_facts")
def page_facts(spark, sf):
    """Title, first heading and links of each page; tested against a plain parser."""
    got = read_table(spark, sf, "pages").select("page_id", "html", html.page_facts("html").alias("f"))
    return got.select("page_id", "f.title", "f.h1", F.size("f.links").alias("n_links"), html.looks_blocked(F.col("f.title"), F.col("html")).alias("blocked"))


@register("url_canonical", r"SELECT page_id, regexp_replace(regexp_replace(url, '[?#].*$', ''), '/+$', '') AS url FROM pages")
def urls(spark, sf):
    return read_table(spark, sf, "pages").select("page_id", text.strip_query(F.col("url")).alias("url"))


@register("map_diff", """
SELECT p_partkey, array_to_string(list_filter(['brand', 'size'], lambda k: (k = 'brand' AND p_partkey % 5 = 0) OR (k = 'size' AND p_partkey % 3 = 0)), ',') AS differ FROM part""")
def maps(spark, sf):
    a = F.create_map(F.lit("brand"), F.col("p_brand"), F.lit("size"), F.col("p_size").cast("string"))
    b = F.create_map(F.lit("brand"), F.expr("CASE WHEN p_partkey % 5 = 0 THEN 'other' ELSE p_brand END"), F.lit("size"), F.expr("CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE cast(p_size AS string) END"))
    return read_table(spark, sf, "part").select("p_partkey", F.array_join(arrays.map_diff(a, b), ",").alias("differ"))


@register("variant_intersection", """
WITH a AS (SELECT DISTINCT l_partkey AS k, l_suppkey AS pn FROM lineitem WHERE l_returnflag = 'A'), b AS (SELECT DISTINCT l_partkey AS k, l_suppkey AS pn FROM lineitem WHERE l_returnflag = 'N')
SELECT k, pn FROM a JOIN b USING (k, pn)""")
def variants(spark, sf):
    li = read_table(spark, sf, "lineitem")
    side = lambda f: li.filter(F.col("l_returnflag") == f).select(F.col("l_partkey").alias("k"), F.col("l_suppkey").alias("pn")).distinct()
    return side("A").join(side("N"), ["k", "pn"])


@register("union_by_name", "SELECT o_orderkey AS k, o_orderstatus AS status, NULL::VARCHAR AS flag FROM orders UNION ALL SELECT l_orderkey, NULL, l_returnflag FROM lineitem")
def union_named(spark, sf):
    o = read_table(spark, sf, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_orderstatus").alias("status"))
    return o.unionByName(read_table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("k"), F.col("l_returnflag").alias("flag")), allowMissingColumns=True)


@register("append_dedup", "SELECT p_name, min(p_partkey) AS p_partkey FROM part WHERE p_name NOT IN (SELECT p_name FROM part WHERE p_size = 1) GROUP BY 1")
def appended(spark, sf):
    part = read_table(spark, sf, "part").select("p_name", "p_partkey", "p_size")
    return append_new(part.filter("p_size = 1"), part, "p_name", "p_partkey").select("p_name", "p_partkey")


@register("state_upsert_pending", """
WITH done AS (SELECT c_custkey FROM customer WHERE c_acctbal > 5000) SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT c_custkey FROM done)""")
def pending(spark, sf):
    c = read_table(spark, sf, "customer")
    return state.pending(c, c.filter("c_acctbal > 5000"), "c_custkey").select("c_custkey", "c_name")


@register("tumbling_counts", "SELECT date_trunc('hour', ts) AS window_start, event_type, count(*) AS n FROM events GROUP BY ALL")
def tumbling(spark, sf):
    return state.windowed_counts(read_table(spark, sf, "events"), "ts", "event_type")


@register("session_counts", """
WITH g AS (SELECT user_id, ts, (ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 30 MINUTE) IS NOT TRUE AS fresh FROM events),
s AS (SELECT user_id, sum(fresh::INT) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM g)
SELECT user_id, count(DISTINCT k) AS sessions, count(*) AS n FROM s GROUP BY 1""")
def sessions(spark, sf):
    s = read_table(spark, sf, "events").groupBy("user_id", F.session_window("ts", "30 minutes")).agg(F.count(F.lit(1)).alias("c"))
    return s.groupBy("user_id").agg(F.count(F.lit(1)).alias("sessions"), F.sum("c").alias("n"))


@register("compare_ladder", """
SELECT o_orderkey, CASE WHEN o_orderkey % 10 = 0 AND o_orderkey % 4 = 0 THEN 'EMPTY' WHEN o_orderkey % 10 = 0 OR o_orderkey % 4 = 0 THEN 'MISSING' WHEN o_orderkey % 3 = 0 THEN 'MISMATCH' ELSE 'MATCH' END AS status FROM orders""")
def ladder(spark, sf):
    e = F.expr("CASE WHEN o_orderkey % 10 = 0 THEN ' ' ELSE o_orderstatus END")
    a = F.expr("CASE WHEN o_orderkey % 4 = 0 THEN NULL WHEN o_orderkey % 3 = 0 THEN 'other' ELSE concat(o_orderstatus, ' ') END")
    return read_table(spark, sf, "orders").select("o_orderkey", compare.compare_text(e, a).alias("status"))


@register("key_coverage_score", """
WITH g AS (SELECT o_custkey, round(100.0 * count(DISTINCT o_orderpriority) / 5, 1) AS score FROM orders GROUP BY 1)
SELECT o_custkey, score, CASE WHEN score >= 75 THEN 'HIGH' WHEN score >= 50 THEN 'MEDIUM' ELSE 'LOW' END AS band FROM g""")
def coverage_score(spark, sf):
    g = read_table(spark, sf, "orders").groupBy("o_custkey").agg(F.collect_set("o_orderpriority").alias("got"))
    score = arrays.overlap_percent(F.array(*map(F.lit, PRIORITIES)), F.col("got"))
    return g.select("o_custkey", score.alias("score"), numbers.band(score).alias("band"))


@register("sliding_counts", """
SELECT w AS window_start, event_type, count(*) AS n FROM (SELECT event_type, unnest([time_bucket(INTERVAL 30 MINUTE, ts), time_bucket(INTERVAL 30 MINUTE, ts) - INTERVAL 30 MINUTE]) AS w FROM events) GROUP BY ALL""")
def sliding(spark, sf):
    e = read_table(spark, sf, "events").groupBy(F.window("ts", "1 hour", "30 minutes").alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n"))
    return e.select(F.col("w.start").alias("window_start"), "event_type", "n")


@register("rank_canonical", """
SELECT p_partkey, (p_size % 4 + 1) || 'Rx' || (p_size % 2 * 4 + 4) AS of_text, (p_size % 4 + 1) || 'Rx8' AS of_columns, (p_size % 4 + 1) || 'Rx16' AS of_description FROM part""")
def rank_canonical(spark, sf):
    n, w = F.col("p_size") % 4 + 1, F.col("p_size") % 2 * 4 + 4
    note = F.concat(F.lit("kit of 1Rx8, "), F.col("p_name"), F.lit(" "), n, F.lit("r X16 module"))
    return read_table(spark, sf, "part").select("p_partkey", models.rank(F.concat(F.lit(" "), n, F.lit(" r x "), w)).alias("of_text"), models.rank_of_columns(F.concat(n, F.lit(".0")), F.lit("x8")).alias("of_columns"), models.last_rank(note).alias("of_description"))


@register("rank_sort", """
WITH d AS (SELECT DISTINCT p_brand, CASE WHEN p_partkey % 7 = 0 THEN 'none' ELSE p_size || 'Rx' || (p_partkey % 3 * 4) END AS x, CASE WHEN p_partkey % 7 = 0 THEN 999 ELSE p_size END AS r, CASE WHEN p_partkey % 7 = 0 THEN 999 ELSE p_partkey % 3 * 4 END AS w FROM part)
SELECT p_brand, string_agg(x, ',' ORDER BY r, w, x) AS ranks FROM d GROUP BY 1""")
def rank_sort(spark, sf):
    x = F.expr("CASE WHEN p_partkey % 7 = 0 THEN 'none' ELSE concat(p_size, 'Rx', p_partkey % 3 * 4) END")
    return read_table(spark, sf, "part").groupBy("p_brand").agg(F.array_join(models.sort_ranks(F.collect_set(x)), ",").alias("ranks"))


@register("model_token_extract", r"""
WITH t AS (SELECT p_partkey, lower(p_name || ' E' || (p_partkey + 100) || 'v 3647 and ' || (p_partkey % 900 + 100) || 'X') AS t FROM part)
SELECT p_partkey, array_to_string(list_filter(regexp_extract_all(t, '\b[a-z]?[0-9]{3,5}[a-z]?\b'), lambda x: NOT regexp_full_match(x, '[0-9]{4}')), ',') AS models FROM t""")
def model_tokens(spark, sf):
    t = F.expr("concat(p_name, ' E', p_partkey + 100, 'v 3647 and ', p_partkey % 900 + 100, 'X')")
    return read_table(spark, sf, "part").select("p_partkey", F.array_join(models.model_tokens(t), ",").alias("models"))


@register("generation_extract", "SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE (p_size % 9 + 1)::VARCHAR END AS gen FROM part")
def generation(spark, sf):
    t = F.expr("CASE WHEN p_partkey % 3 = 0 THEN p_name WHEN p_partkey % 3 = 1 THEN concat(p_name, ' ', p_size % 9 + 1, 'th Gen') ELSE concat(p_size % 9 + 1, 'rd generation ', p_name) END")
    return read_table(spark, sf, "part").select("p_partkey", models.generation(t).alias("gen"))


@register("speed_entry_parse", "SELECT p_partkey, p_name AS name, (p_size + 2000) || 'MT/S,' || (p_size + 10000) || 'MHZ' AS speeds FROM part")
def speed_entries(spark, sf):
    t = F.expr("concat(p_name, ' (', p_size + 2000, ' MT/s) (', p_size + 10000, 'MHz) (', p_size + 2000, 'mt/s)')")
    return read_table(spark, sf, "part").select("p_partkey", models.before_paren(t).alias("name"), F.array_join(models.speeds(t), ",").alias("speeds"))


@register("slash_versions", "SELECT p_partkey, unnest(CASE WHEN p_partkey % 2 = 0 THEN [p_name || ' v' || p_size || ' kit', p_name || ' v3 kit'] ELSE [p_name || '/x'] END) AS name FROM part")
def slash_versions(spark, sf):
    t = F.expr("CASE WHEN p_partkey % 2 = 0 THEN concat(p_name, ' v', p_size, '/v3 kit') ELSE concat(p_name, '/x') END")
    return read_table(spark, sf, "part").select("p_partkey", F.explode(models.slash_versions(t)).alias("name"))


@register("phrase_assembly", "SELECT p_partkey, p_name || ' ' || p_type || ' processor|' || p_brand AS phrases FROM part")
def phrase_assembly(spark, sf):
    tokens = F.split(F.concat_ws(" ", "p_name", "p_type", F.lit("processor"), "p_brand"), " ")
    return read_table(spark, sf, "part").select("p_partkey", F.array_join(models.phrases(tokens), "|").alias("phrases"))


@register("unit_max", """
WITH t AS (SELECT p_brand, p_size || CASE p_partkey % 3 WHEN 0 THEN 'MB' WHEN 1 THEN 'GB' ELSE 'TB' END AS label, p_size * CASE p_partkey % 3 WHEN 0 THEN 1 WHEN 1 THEN 1024 ELSE 1048576 END AS mb FROM part)
SELECT p_brand, label FROM t QUALIFY row_number() OVER (PARTITION BY p_brand ORDER BY mb DESC, label) = 1""")
def unit_max(spark, sf):
    t = read_table(spark, sf, "part").select("p_brand", F.expr("concat(p_size, CASE p_partkey % 3 WHEN 0 THEN 'MB' WHEN 1 THEN 'GB' ELSE 'TB' END)").alias("label"))
    return verdicts.largest(t, "p_brand", "label", numbers.capacity_mb(F.col("label")))


@register("status_summary_order", "SELECT o_orderstatus, count(*) AS n, CASE o_orderstatus WHEN 'P' THEN 0 WHEN 'O' THEN 1 ELSE 2 END AS place FROM orders GROUP BY 1")
def status_order(spark, sf):
    return verdicts.status_summary(read_table(spark, sf, "orders"), "o_orderstatus", ["P", "O"])


@register("head_per_status", "SELECT o_orderstatus, o_orderkey FROM orders QUALIFY row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_orderkey) <= 2")
def head_status(spark, sf):
    return verdicts.head_per(read_table(spark, sf, "orders").select("o_orderstatus", "o_orderkey"), "o_orderstatus", [F.col("o_orderkey")], 2)


@register("nested_key_search", "SELECT p_partkey, CASE WHEN p_partkey % 4 = 3 THEN NULL ELSE p_brand END AS chipset FROM part")
def nested_search(spark, sf):
    t = F.expr(r"""CASE p_partkey % 4 WHEN 0 THEN concat('{"board": [{"size": 1}, {"io": {"ChipSet": "', p_brand, '"}}]}') WHEN 1 THEN concat("{'a': {'chipset': '', 'b': {'chipset': 'no'}}, 'c': {'chipset': '", p_brand, "'}}")
      WHEN 2 THEN concat('it''s not JSON: "Chipset" : "', p_brand, '"') ELSE '{"board": {}}' END""")
    return read_table(spark, sf, "part").select("p_partkey", specs.nested_value(t, "Chipset").alias("chipset"))


@register("range_scoped_expand", """
SELECT p_partkey, unnest(['256GB', '512GB', '1TB', '2TB']) AS capacity, unnest(CASE WHEN p_partkey % 2 = 0 THEN ['Rated | ' || p_size, 'Rated | ' || p_brand, 'Rated | ' || p_brand, 'Rated | ' || p_type]
  ELSE [p_name || ' | 4TB — none', p_name || ' | 4TB — none', p_name || ' | 4TB — none', p_name || ' | 4TB — none'] END) AS value FROM part""")
def range_scoped(spark, sf):
    caps = F.array(*map(F.lit, ("256GB", "512GB", "1TB", "2TB")))
    lines = F.expr("CASE WHEN p_partkey % 2 = 0 THEN array('Rated', concat('256 GB — ', p_size), concat('2TB–512GB — ', p_brand), concat('2TB — ', p_type)) ELSE array(p_name, '4TB — none') END")
    return read_table(spark, sf, "part").select("p_partkey", F.explode(specs.scoped_values(lines, caps)).alias("capacity", "value"))


@register("speed_flags", """
SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 AND p_size < 10 THEN 'duplicate & missing' WHEN p_partkey % 2 = 0 THEN 'duplicate' WHEN p_size < 10 THEN 'missing' ELSE 'match' END AS flags,
  CASE WHEN p_size % 3 = 0 AND p_size % 2 = 0 THEN 'match' ELSE concat_ws(' & ', CASE p_size % 3 WHEN 1 THEN '1 family missing' WHEN 2 THEN '2 families missing' END, CASE p_size % 2 WHEN 1 THEN '1 line mismatch' END) END AS counted,
  CASE WHEN p_size < 10 THEN 'FAIL' WHEN p_partkey % 2 = 0 THEN 'DUPLICATED' ELSE 'PASS' END AS overall FROM part""")
def speed_flags(spark, sf):
    even, small = F.col("p_partkey") % 2 == 0, F.col("p_size") < 10
    overall = verdicts.worst(["FAIL", "MISSING", "DUPLICATED", "PASS"], F.when(even, "DUPLICATED").otherwise("PASS"), F.when(small, "FAIL").otherwise("PASS"))
    return read_table(spark, sf, "part").select("p_partkey", verdicts.flags((small, "missing"), (even, "duplicate")).alias("flags"), verdicts.counted((F.col("p_size") % 3, "family", "families", "missing"), (F.col("p_size") % 2, "line", "lines", "mismatch")).alias("counted"), overall.alias("overall"))


@register("text_similarity")
def text_similarity(spark, sf):
    """Folded names and the matching-blocks ratio of name and type; tested against the standard library."""
    p = read_table(spark, sf, "part")
    return p.select("p_partkey", specs.nfkc(F.concat("p_name", F.lit("  \uff21\ufb01"))).alias("folded"), F.round(specs.similarity(F.col("p_name"), F.lower("p_type")), 6).alias("ratio"))


@register("path_cascade", """
SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN p_size || ' slots,up to 1.5TB,2TB' WHEN 1 THEN p_name || ',768 GB' ELSE '' END AS lines,
  CASE p_partkey % 4 WHEN 0 THEN '2TB' WHEN 1 THEN '768GB' END AS largest FROM part""")
def path_cascade(spark, sf):
    t = F.expr(r"""CASE p_partkey % 4 WHEN 0 THEN concat('{"System Memory": {"Memory": {"Slot Count": "', p_size, ' slots", "Items": ["up to 1.5TB", null, "2TB"]}}}')
      WHEN 1 THEN concat('{"Memory Capacity": ["768 GB"], "System Memory": {"Memory": ["', p_name, '"]}}') WHEN 2 THEN '{"System Memory": 5}' ELSE 'not JSON' END""")
    lines = documents.lines_at(t, '$["System Memory"]["Memory"]["Slot Count"]', '$["System Memory"]["Memory"]["Items"]', '$["System Memory"]["Memory"]', '$["Memory Capacity"]')
    got = read_table(spark, sf, "part").select("p_partkey", lines.alias("l"))
    return got.select("p_partkey", F.array_join("l", ",").alias("lines"), documents.largest_capacity(F.col("l")).alias("largest"))


@register("cell_merge", """
SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN '["' || p_brand || '", "x", "y"]' WHEN 1 THEN p_brand || '; ["y"]' WHEN 2 THEN p_name ELSE p_name || '; ' || p_brand END AS merged FROM part""")
def cell_merge(spark, sf):
    old = F.expr("""CASE p_partkey % 4 WHEN 0 THEN concat('["', p_brand, '", "x"]') WHEN 1 THEN p_brand WHEN 2 THEN '' ELSE p_name END""")
    new = F.expr("""CASE p_partkey % 4 WHEN 0 THEN '["x", "y"]' WHEN 1 THEN '["y"]' WHEN 2 THEN p_name ELSE p_brand END""")
    return read_table(spark, sf, "part").select("p_partkey", documents.merge_values(old, new).alias("merged"))


@register("sections_flat", """
SELECT p_partkey, unnest(['Name', 'Compatible Server', 'Status Name', 'Extra']) AS field, unnest([p_name, p_brand, p_type, p_size::VARCHAR]) AS value FROM part""")
def sections_flat(spark, sf):
    m = F.expr("map('More', map('Extra', string(p_size)), 'Status', map('Name', p_type), 'Compatibility', map('Server', p_brand), 'General', map('Name', p_name))")
    flat = documents.flat_sections(m, ["General", "Compatibility", "Status"], {"Compatibility": {"Server": "Compatible Server"}})
    return read_table(spark, sf, "part").select("p_partkey", F.explode(flat).alias("field", "value"))


@register("embedded_catalog", "SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN p_brand END AS brand FROM part")
def embedded_catalog(spark, sf):
    t = F.expr(r"""CASE p_partkey % 3 WHEN 0 THEN concat('<script>start("#id", {"t": "a } \\" {", "p": {"brand": "', p_brand, '"}}); go({})</script>') WHEN 1 THEN '<p>{"p": 1}</p>' ELSE 'start({"p": {"brand": "x"}' END""")
    found = documents.embedded_object(t, "start(")
    return read_table(spark, sf, "part").select("p_partkey", F.get_json_object(found, "$.p.brand").alias("brand"))


@register("spec_cards", """
SELECT p_partkey, unnest(['Memory', 'Notes']) AS heading, unnest(['Standard: ' || p_size || ' GB; Slots: ["' || p_brand || '", "' || p_name || ' / x"]', '["' || p_type || '", "two"]']) AS attrs FROM part""")
def spec_cards(spark, sf):
    page = F.expr(r"""concat('<div class="card a"><h3> Memory </h3><ul class="plain"><li><h4>Standard</h4><p>', p_size, '  GB</p></li><li><h4>Slots</h4><p>', p_brand, '</p><li><h4>Slots</h4><p>', p_name, '</p><p>x</p><li><h4>Slots</h4><p>', p_brand,
      '</p></ul></div><div class="card"><h3>Notes</h3><div class="row"><ul><li>', p_type, '<li>Show<li>two<li>two</ul></div></div><div class="card"><h3>Empty</h3></div>')""")
    got = spread(read_table(spark, sf, "part")).select("p_partkey", F.explode(html.spec_cards(page, "card", "plain", "row", ("Show",))).alias("s"))
    return got.select("p_partkey", "s.heading", html.attrs_text(F.col("s.attrs")).alias("attrs"))


@register("spec_table_pairs", """
SELECT p_partkey, p_name AS name, 'Boards' AS category, 'https://x/i.png' AS image, CASE WHEN p_partkey % 2 = 0 THEN 'https://x/copy' ELSE 'https://x/' || p_partkey END AS address, unnest(['CPU', 'Size']) AS label, unnest([p_brand || ' | ' || p_type, p_size::VARCHAR]) AS value FROM part""")
def spec_table_pairs(spark, sf):
    page = F.expr(r"""concat('<meta property="og:image" content="/i.png">', if(p_partkey % 2 = 0, '<input id=copyLink value="https://x/copy/">', ''), '<div class="bread"><a href="/products">All</a><a href="/products/b/">Boards</a><a href="/products/b/c">It</a></div><h1>', p_name, '</h1><table><tr><th>CPU<td>', p_brand,
      '<tr><td><td>', p_type, '</tr><tr><td>Size</td><td> ', p_size, '</td></tr><tr><td>None</td></tr></table>')""")
    got = spread(read_table(spark, sf, "part")).select("p_partkey", html.product_head(page, F.concat(F.lit("https://x/"), F.col("p_partkey").cast("string"), F.lit("/"))).alias("h"), F.explode(html.row_pairs(html.table_rows(page))).alias("r"))
    return got.select("p_partkey", "h.*", "r.label", "r.value")


@register("extraction_outcomes", """
SELECT p_partkey, CASE WHEN p_partkey % 5 = 0 THEN 'EXTRACTION_ERROR' WHEN p_size < 10 AND p_partkey % 2 = 0 THEN 'NOT_A_COMPUTE_PRODUCT' WHEN p_size < 10 THEN 'REVIEW_NO_STRUCTURED_MATCH' WHEN p_size < 20 THEN 'REVIEW_DESCRIPTION_ONLY' ELSE 'OK' END AS triage,
  CASE WHEN p_partkey % 7 = 0 THEN 'FAILED' WHEN p_size % 3 > 0 OR p_size > 13 THEN 'SUCCESS' ELSE 'PARTIAL' END AS outcome,
  CASE WHEN p_partkey % 3 = 0 THEN 'Datas are not available' WHEN p_partkey % 3 = 1 AND p_size < 5 THEN 'missing' WHEN p_size % 2 = 0 THEN 'match' ELSE 'mismatch' END AS slots FROM part""")
def extraction_outcomes(spark, sf):
    key, size = F.col("p_partkey"), F.col("p_size")
    doc = F.when(key % 3 == 0, " {} ").otherwise("{}x")
    slots = verdicts.compare_numbers(doc, F.when(~((key % 3 == 1) & (size < 5)), F.concat(size.cast("string"), F.lit(".0 slots"))), size + size % 2)
    return read_table(spark, sf, "part").select("p_partkey", verdicts.triage(F.when(key % 5 == 0, "bad"), size >= 10, size >= 20, key % 2 == 1).alias("triage"), verdicts.outcome(key % 7 == 0, size % 3, size - 10).alias("outcome"), slots.alias("slots"))
