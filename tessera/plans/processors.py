"""Queries of processor lists in pieces. A cell has the lines that the line items of an order say, in their order."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import processors
from tessera.plans.catalogue import read_table, register


#: The order of an order's lines; rows that tie in all of it say the same.
ORDER = ("l_linenumber", "l_partkey", "l_suppkey", "l_linestatus", "l_returnflag")


def cells(spark, sf, lines: str, lead: str = "array()"):
    """One row for each order: l_orderkey and the specification document of its lines. lines, lead: SQL of string arrays."""
    rows = read_table(spark, sf, "lineitem").select("l_orderkey", *ORDER, F.expr(lines).alias("lines"), F.expr(f"cast({lead} AS array<string>)").alias("lead"))
    got = rows.groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct(*ORDER, "lines"))).alias("found"), F.first("lead").alias("lead"))
    every = F.concat("lead", F.flatten(F.transform("found", lambda x: x["lines"])))
    return got.select("l_orderkey", F.to_json(F.struct(every.alias("CPU"))).alias("spec"))


def listed(cells_):
    names = processors.processor_list(F.col("spec"))
    return cells_.select("l_orderkey", F.array_join(names, "|").alias("processors"))


_PIECES = """concat(array(concat(4 + l_suppkey % 60, 'th Generation Intel'), '®', 'Xeon', '®', CASE WHEN l_linestatus = 'O' THEN 'Scalable Processors' ELSE 'CPU Max Series' END),
  CASE WHEN l_returnflag = 'R' THEN array(concat('TDP up to ', l_linenumber, 'W')) ELSE array() END)"""


@register("fragmented_generations", """
WITH n AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_linestatus, l_returnflag, (4 + l_suppkey % 60) || 'th Generation Intel' AS head, l_linestatus = 'O' AS scalable, count(*) OVER (PARTITION BY l_orderkey) AS runs FROM lineitem)
SELECT l_orderkey, string_agg(CASE WHEN runs > 1 THEN head || '  Xeon  ' || CASE WHEN scalable THEN 'Scalable processor' ELSE 'CPU Max Series' END
  ELSE head || ' Xeon ' || CASE WHEN scalable THEN 'Scalable Processors' ELSE 'CPU Max Series' END END, '|' ORDER BY l_linenumber, l_partkey, l_suppkey, l_linestatus, l_returnflag) AS processors FROM n GROUP BY l_orderkey""")
def fragmented_generations(spark, sf):
    """Names whose generation, maker, brand and tier lie on lines of their own, technical lines between them."""
    return listed(cells(spark, sf, _PIECES))


_DESKTOP = """CASE WHEN l_orderkey % 2 = 0 THEN array('Intel®', 'Xeon®', concat('Processor E-', 2000 + l_orderkey % 700, '/E-', 3000 + l_orderkey % 700, ' series'), concat(4 + l_orderkey % 9, 'th Gen. Intel Core™ i', 3 + l_orderkey % 7, '/ Pentium®'), '/ Celeron®')
  ELSE array('Intel Xeon', concat('E-', 2000 + l_orderkey % 700, ' Processors'), concat('E-', 3000 + l_orderkey % 700, ' Processors'), concat(4 + l_orderkey % 9, 'th Gen. Intel Core i', 3 + l_orderkey % 7, '/ Pentium'), '/ Celeron') END"""


@register("mixed_token_runs", """
WITH o AS (SELECT l_orderkey, count(*) AS n, 'E-' || (2000 + l_orderkey % 700) AS a, 'E-' || (3000 + l_orderkey % 700) AS b, (4 + l_orderkey % 9) || 'th' AS g, 'Core i' || (3 + l_orderkey % 7) AS c FROM lineitem GROUP BY l_orderkey)
SELECT l_orderkey, CASE WHEN n >= 3 AND l_orderkey % 2 = 0 THEN concat_ws('|', 'Intel Xeon Processor ' || b || ' series', g || ' Generation  Intel ' || c || ' processors', g || ' Generation Intel Pentium  processors', g || ' Generation Intel Celeron  processors', 'Intel  Xeon  Processor ' || a || ' series')
  WHEN n >= 3 THEN concat_ws('|', 'Intel Xeon ' || a || ' Processors', 'Intel Xeon ' || b || ' Processors', g || ' Generation Intel ' || c || ' Processors', g || ' Generation Intel Pentium Processors', g || ' Generation Intel Celeron Processors')
  WHEN l_orderkey % 2 = 0 THEN 'Intel Xeon Processor ' || a || '/' || b || ' series ' || g || ' Gen. Intel ' || c || '/ Pentium|/ Celeron'
  ELSE 'Intel Xeon ' || a || ' Processors ' || b || ' Processors ' || g || ' Gen. Intel ' || c || '/ Pentium|/ Celeron' END AS processors FROM o""")
def mixed_token_runs(spark, sf):
    """E-series crossed out of one line and a generation crossed with desktop brands, in cells of eight lines or more; shorter cells are assembled from their tokens."""
    return listed(cells(spark, sf, "array(concat('Memory slot ', l_linenumber))", _DESKTOP))


_SOCKET = "array(CASE WHEN l_suppkey % 2 = 0 THEN concat('- ', 4 + l_suppkey % 60, 'th generation intel Core processors / Intel Pentium processor') WHEN l_suppkey % 3 = 0 THEN 'note' ELSE 'Intel Celeron processors*' END)"


@register("socket_generations", """
WITH n AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_linestatus, l_returnflag, CASE WHEN l_suppkey % 2 = 0 THEN (4 + l_suppkey % 60) || 'th' END AS own, l_suppkey % 2 <> 0 AND l_suppkey % 3 = 0 AS aside FROM lineitem),
c AS (SELECT *, coalesce(last_value(own IGNORE NULLS) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_linestatus, l_returnflag ROWS UNBOUNDED PRECEDING), last_value(own IGNORE NULLS) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_linestatus, l_returnflag ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)) AS g FROM n)
SELECT l_orderkey, coalesce(string_agg(CASE WHEN aside THEN NULL WHEN own IS NOT NULL THEN own || ' Generation Intel Core processors|' || own || ' Generation Intel Pentium processors' ELSE coalesce(g || ' Generation ', '') || 'Intel Celeron processors' END, '|' ORDER BY l_linenumber, l_partkey, l_suppkey, l_linestatus, l_returnflag), '') AS processors FROM c GROUP BY l_orderkey""")
def socket_generations(spark, sf):
    """Rows of one item under a socket's name: a row without a generation takes the last one said, or the last of all if none came before."""
    got = cells(spark, sf, _SOCKET)
    item = F.concat(F.lit("LGA1700 package:\n"), F.array_join(F.from_json(F.get_json_object("spec", "$.CPU"), "array<string>"), "\n"))
    got = listed(got.withColumn("spec", F.to_json(F.struct(F.array(item).alias("CPU")))))
    return got.withColumn("processors", F.coalesce("processors", F.lit("")))


_SUPPORTED = "array(CASE l_suppkey % 3 WHEN 0 THEN concat('Core i', l_partkey % 9, ' Processors') WHEN 1 THEN 'Pentium processor' ELSE 'Intel Celeron processors' END)"


@register("supported_generations", """
WITH n AS (SELECT *, CASE l_suppkey % 3 WHEN 0 THEN 'Intel Core i' || (l_partkey % 9) || ' processors' WHEN 1 THEN 'Intel Pentium processor' ELSE 'Intel Celeron processors' END AS x FROM lineitem),
g AS (SELECT l_orderkey, CASE l_orderkey % 3 WHEN 0 THEN [(4 + l_orderkey % 9) || 'th Generation '] WHEN 1 THEN [''] ELSE [(5 + l_orderkey % 9) || 'th Generation ', (4 + l_orderkey % 9) || 'th Generation '] END AS gs FROM (SELECT DISTINCT l_orderkey FROM lineitem)),
e AS (SELECT l_orderkey, unnest(gs) AS g, generate_subscripts(gs, 1) AS i FROM g)
SELECT l_orderkey, string_agg(g || x, '|' ORDER BY i, l_linenumber, l_partkey, l_suppkey, l_linestatus, l_returnflag) AS processors FROM e JOIN n USING (l_orderkey) GROUP BY l_orderkey""")
def supported_generations(spark, sf):
    """'Support for' one generation, none, or two between slashes, and the names between slashes behind it."""
    got = cells(spark, sf, _SUPPORTED)
    kinds = F.from_json(F.get_json_object("spec", "$.CPU"), "array<string>")
    two = F.transform(kinds, lambda x: F.when(x.startswith("Intel"), x).otherwise(F.concat(F.lit("Intel "), x)))
    n = F.col("l_orderkey") % 9 + 4
    head = F.when(F.col("l_orderkey") % 3 == 0, F.concat(F.lit("Support for "), n.cast("string"), F.lit("th Generation Intel "), F.array_join(kinds, " / "))).when(F.col("l_orderkey") % 3 == 1, F.concat(F.lit("Support for Intel "), F.array_join(kinds, "/")))
    item = head.otherwise(F.concat(F.lit("Support for "), (n + 1).cast("string"), F.lit("th/"), n.cast("string"), F.lit("th Generation "), F.array_join(two, "/"), F.lit(" in the LGA1151 package")))
    return listed(got.withColumn("spec", F.to_json(F.struct(F.array(item).alias("CPU")))))


@register("text_rows", """
WITH n AS (SELECT l_orderkey, CASE WHEN l_suppkey % 2 = 0 THEN 'AMD Ryzen Threadripper PRO ' || (1000 + l_suppkey) || ' series Processors' ELSE 'Intel Celeron N' || l_partkey || ' CPU' END AS x, l_linenumber, l_partkey, l_suppkey, l_linestatus, l_returnflag FROM lineitem),
f AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey, x ORDER BY l_linenumber, l_partkey, l_suppkey, l_linestatus, l_returnflag) AS again FROM n)
SELECT l_orderkey, string_agg(x, '|' ORDER BY l_linenumber, l_partkey, l_suppkey, l_linestatus, l_returnflag) AS processors FROM f WHERE again = 1 GROUP BY l_orderkey""")
def text_rows(spark, sf):
    """Cells of one text of several lines: what is built in and Threadripper series, each name once, between lines that name nothing."""
    row = """array(CASE WHEN l_suppkey % 2 = 0 THEN concat('amd Ryzen™ threadripper™ pro ', 1000 + l_suppkey, ' Series processors /')
      ELSE concat('- Built in with an intel® Celeron N', l_partkey, ' cpu (', l_linenumber, ' GHz)') END, concat('TDP up to ', l_linenumber, 'W'))"""
    got = cells(spark, sf, row)
    text = F.array_join(F.from_json(F.get_json_object("spec", "$.CPU"), "array<string>"), "\n")
    return listed(got.withColumn("spec", F.to_json(F.struct(text.alias("CPU")))))
