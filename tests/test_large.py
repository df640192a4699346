"""Faults that showed on large tables: work done again and again, sides that must not be broadcast, large keys."""

import os
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from tessera.functions import text
from tessera.operators import html, parts, processors, reconcile
from tessera.plans import catalogue
from tests.test_catalogue import SF, TABLES, plain, rows


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def against_sql(spark, name: str, folder: str) -> None:
    """A query on other tables in a folder, the rest at the smallest size, against its SQL."""
    con = duckdb.connect()
    for t in TABLES:
        path = f"{folder}/{t}.parquet"
        if not os.path.exists(path):
            os.symlink(f"{SF}/{t}.parquet", path)
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{path}'")
    got = catalogue.QUERIES[name](spark, folder)
    cols = sorted(got.columns)
    want = con.execute(f"SELECT {', '.join(cols)} FROM ({catalogue.ORACLE[name]})").fetchall()
    assert want and rows(cols, got.select(*cols).collect()) == rows(cols, want)


def test_variant_specs_name_each_step_once(spark):
    table = "array<struct<form_factor:string,rows:array<struct<label:string,lines:array<string>>>>>"
    df = spark.range(1).select(F.lit(None).cast(table).alias("t"), F.lit("M.2").alias("f"), F.lit("1TB").alias("c"))
    said = df.select(parts.specs_of(F.col("t"), F.col("f"), F.col("c")))._jdf.queryExecution().analyzed().toString()
    assert said.count("regexp_extract") < 10


def test_variants_with_many_rows(spark):
    lines = [("Capacities", ["256GB, 512 GB, 1TB"])] + [(f"Row {i}", [f"256GB — {i}", "about", f"512GB–1TB — {i} TB"]) for i in range(12)]
    table = "f string, c string, t array<struct<form_factor:string,rows:array<struct<label:string,lines:array<string>>>>>"
    df = spark.createDataFrame([("M.2", "1 tb", [("M.2", lines)]), ("M.2", "256GB", None)], table).coalesce(1)
    got = [r[0] for r in df.select(parts.specs_of(F.col("t"), F.col("f"), F.col("c"))).collect()]
    assert got == [{"Capacities": "256GB, 512 GB, 1TB"} | {f"Row {i}": f"about | {i} TB" for i in range(12)}, {}]


def test_storage_parts_deals_pages_over_cores(spark):
    said = plan(catalogue.QUERIES["storage_parts"](spark, SF))
    assert said.count("RoundRobinPartitioning") >= 2


def test_storage_parts_broadcasts_no_products(spark):
    assert "Broadcast" not in plan(catalogue.QUERIES["storage_parts"](spark, SF))


def test_cards_without_a_link_are_dealt_over_tasks(spark):
    cards = spark.range(400).select(F.concat(F.lit("S"), "id").alias("part_number"), F.lit("").alias("url"), F.create_map().cast("map<string,string>").alias("attrs"))
    products = spark.createDataFrame([], "url string, variants array<struct<capacity:string,form_factor:string,part_number:string>>, tables array<struct<form_factor:string,rows:array<struct<label:string,lines:array<string>>>>>")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sizes = [r["n"] for r in parts.storage_parts(cards, products).groupBy(F.spark_partition_id()).agg(F.count("*").alias("n"), F.max("extraction").alias("x")).collect() if r["x"] == "COMPONENT_URL_FAILED"]
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert sum(sizes) == 400 and max(sizes) < 200


def large_keys(folder) -> str:
    """Line items whose part keys lie on both sides of a million."""
    duckdb.sql(f"COPY (SELECT * REPLACE (l_partkey * 6000 AS l_partkey) FROM '{SF}/lineitem.parquet') TO '{folder}/lineitem.parquet'")
    return str(folder)


def test_merged_lines_with_large_part_keys(spark, tmp_path):
    against_sql(spark, "merged_lines", large_keys(tmp_path))


def test_section_documents_with_large_part_keys(spark, tmp_path):
    against_sql(spark, "section_documents", large_keys(tmp_path))


@pytest.mark.parametrize("name", ["generation_preferred", "generation_required"])
def test_generation_join_broadcasts_no_side(spark, name):
    assert "Broadcast" not in plan(catalogue.QUERIES[name](spark, SF))


def test_generation_join_with_repeated_probes_and_no_generation(spark):
    probes = spark.createDataFrame([(1, "b a g1", 1), (2, "a g1 B", 1), (3, "a b g1", None), (4, None, 1), (1, "a", 2)], "id int, t string, g int")
    dim = spark.createDataFrame([("a", 2), ("A b", 1), ("b g1", None), ("c", 1)], "name string, gen int")
    got = {r["id"]: (r["name"], r["same_generation"]) for r in reconcile.generation_join(probes, "id", "t", F.col("g"), dim, "name", "gen").collect()}
    assert got == {1: ("A b", True), 2: ("A b", True), 3: ("b g1", True)}


def test_rules_after_the_first_that_fits_are_not_worked_out(spark):
    fit = lambda lines: lines
    fail = lambda lines: F.when(F.size(lines) > 0, F.array(F.raise_error(F.lit("worked out")).cast("string")))
    df = spark.createDataFrame([('{"CPU": ["a", "b"]}',)], "t string").coalesce(1)
    assert [r[0] for r in df.select(processors.processor_list(F.col("t"), (fit, fail))).collect()] == [["a", "b"]]


def test_plain_pages_have_the_trees_of_the_parser():
    def shown(n):
        return n if isinstance(n, str) else (n.tag, n.attrs, [shown(k) for k in n.kids])

    pieces = ["<ul>", "</ul>", "<li class=\"a b\">", "</LI>", "<P>", "</p>", "<br>", "<br/>", "<div ID=\"x\"\n data-y hidden=\"\">", "</div>", "<p />", "text ", " \n", "<table><tr><td>", "</td >", "<th>", "</table>", "a > b", "&amp;", "< b", "<!-- c -->", "<a href=x>", "</a>", "<a b=\"<\">", "<script>1 < 2</script>", "<title>a<b></title>", "<img alt=\"\" alt=\"z\"/>", "<", "</", "<x:y>", "\"", "<a b = \"c\">"]
    rng, plainly = random.Random(3), 0
    for i in range(3000):
        page = "".join(rng.choices(pieces[:18] if i % 2 else pieces, k=rng.randrange(12)))
        t = html._Tree()
        t.feed(page)
        t.close()
        assert shown(html.tree(page)) == shown(t.open[0]), page
        plainly += html._plain_tree(page) is not None
    assert plainly > 1000


def test_w_series_respells_a_line_once(spark):
    df = spark.createDataFrame([(["INTEL® \t xeon™ w-3500/W-3400/w-1", "x Intel Xeon w-22/w-33/b", "Intel Xeon W-5", "intel xeon W-3400/w-9"],), ([],), (None,)], "l array<string>").coalesce(1)
    got = [r[0] for r in df.select(parts.w_series(F.col("l"))).collect()]
    spelled = lambda brand, *ws: [f"{brand} W-{w} series processor" for w in ws]
    assert got == [spelled("Intel \t Xeon", 3500, 3400, 1) + spelled("Intel Xeon", 22, 33, 3400, 9), [], None]
    said = df.select(parts.w_series(F.col("l")).alias("w"))._jdf.queryExecution().optimizedPlan().toString()
    assert said.count("Threadripper") == 2 and "Series Processors" not in said


def test_chipset_lines_are_worked_out_once(spark):
    said = spark.createDataFrame([("{}",)], "t string").select(parts.chipsets(F.col("t")).alias("c"))._jdf.queryExecution().analyzed().toString()
    assert said.count("from_json") == 1


def said_once(df, column, word: str) -> int:
    return df.select(column.alias("c"))._jdf.queryExecution().analyzed().toString().count(word)


def test_second_spellings_and_compared_sets_work_each_part_out_once(spark):
    df = spark.createDataFrame([(["a", "B", "b", "A ", "a"], ["x"]), ([], None)], "l array<string>, e array<string>").coalesce(1)
    key = lambda x: F.regexp_replace(F.lower(x), "[ ]", "")
    dup = reconcile.second_spellings(F.col("l"), key)
    assert [r[0] for r in df.select(dup).collect()] == [["b", "A "], []]
    assert said_once(df, dup, "regexp_replace") == 1
    compared = reconcile.compare_sets(F.col("e"), F.col("l"), dup)
    assert said_once(df, compared, "regexp_replace") == 1 and said_once(df, compared, "array_except") == 2
    assert df.select(compared["reason"]).first()[0] == "Duplicated: b, A  | Missing: x | Not supported by any matched processor: A , B, a, b"


def test_expected_values_keep_columns_of_rows(spark):
    rows_ = spark.createDataFrame([(1, ["b", "z", None, "a"], "k"), (2, [], "m"), (3, None, None), (4, ["y", "b"], "o")], "id int, l array<string>, kept string")
    dim = spark.createDataFrame([("a", "2", "s"), ("b", "", "t")], "key string, v string, source string")
    got = {r["id"]: tuple(r)[1:] for r in reconcile.expected_values(rows_, "id", "l", lambda c: c, dim, "key", ["v"], keep=("l", "kept")).collect()}
    assert got == {1: (["b", "z", None, "a"], "k", 3, 2, ["z"], ["s", "t"], ["2"]), 2: ([], "m", 0, 0, [], [], []), 3: (None, None, 0, 0, [], [], []), 4: (["y", "b"], "o", 2, 1, ["y"], ["t"], [])}


@pytest.mark.parametrize("name", ["family_line_validation", "processor_ladders"])
def test_catalogue_rows_are_worked_out_once(spark, name):
    assert plan(catalogue.QUERIES[name](spark, SF)).count("lineitem.parquet") == 1


def test_keys_of_odd_texts(spark):
    plainly = ((r"[™®©�]|\(r\)|\(tm\)", ""), (r"\s+", " "))
    for_processors = (*plainly, (r"\bprocessor\b", " "), (r"\s+", " "))
    rng = random.Random(5)
    pieces = ["(", "r", "tm", ")", "(R)", "(TM)", "®", "™", "�", " ", "  ", "\t", "\n", "\x0b", " ", "processor", "Processor", "processors", "_", "x", "-"]
    df = spark.createDataFrame([("".join(rng.choices(pieces, k=rng.randrange(14))),) for _ in range(3000)], "t string")
    odd = df.filter((text.chain(F.col("t"), text.KEY) != text.chain(F.col("t"), plainly)) | (text.chain(F.col("t"), text.PROCESSOR_KEY) != text.chain(F.col("t"), for_processors)))
    assert odd.count() == 0
