"""Reconciliation of catalogue rows with reference dimensions: expected families and lines against those the rows state."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions import arrays
from tessera.operators.lookup import best_hit, dedup_dim
from tessera.sources.shared import written

#: The worst status of a row wins.
PRIORITY = ("FAIL", "MISSING", "DUPLICATED", "PASS")


def prioritised(dims: list[tuple[str, DataFrame]], key: str, order: list[Column]) -> DataFrame:
    """One row of each key from several dimensions of the same columns: the first dimension that has it wins, in it the first by order. Adds source."""
    every = None
    for i, (label, dim) in enumerate(dims):
        one = dim.withColumns({"source": F.lit(label), "_prio": F.lit(i)})
        every = one if every is None else every.unionByName(one)
    return dedup_dim(every.filter(F.col(key) != ""), key, [F.col("_prio"), *order]).drop("_prio")


def expected_values(rows: DataFrame, row: str, items: str, key, dim: DataFrame, dim_key: str, values: list[str], keep: tuple[str, ...] = ()) -> DataFrame:
    """For each row: n_items, n_matched, unmatched (items without a hit, in order), expected_<value> (sorted distinct values of the hits), sources.

    key: from an item to its lookup key. Items are looked up one by one, in a join that Spark broadcasts or sorts by the
    dimension's size, and put together again by row. Rows without items stay. keep: other columns of a row, which ride with
    its first item, so that rows need not be worked out again and joined back.
    """
    kept = F.when(F.coalesce(F.col("_pos"), F.lit(0)) == 0, F.struct(*keep)) if keep else F.lit(None)
    each = rows.select(row, *keep, F.posexplode_outer(items).alias("_pos", "_item")).select(row, kept.alias("_kept"), "_pos", "_item", key(F.col("_item")).alias(dim_key))
    hit = each.join(dim.withColumn("_hit", F.lit(True)), dim_key, "left")
    of = lambda name: F.array_sort(F.array_distinct(F.filter(F.col("_all")[name], lambda x: x.isNotNull())))
    missed = F.transform(F.array_sort(F.transform(F.filter("_all", lambda s: s["_hit"].isNull() & s["_item"].isNotNull()), lambda s: F.struct(s["_pos"].alias("_pos"), s["_item"].alias("_item")))), lambda s: s["_item"])
    count = lambda name: F.size(F.array_compact(F.col("_all")[name])).cast("long")
    # One list of a row's hits, from which all else is read: an aggregate for each figure would be stored and sorted on its own.
    got = hit.groupBy(row).agg(F.collect_list(F.struct("_pos", "_item", "_hit", "source", *values, "_kept")).alias("_all"))
    got = got.withColumn("_kept", F.array_compact(F.col("_all")["_kept"])[0]) if keep else got
    sets = [F.filter(of(v), lambda x: x != "").alias(f"expected_{v}") for v in values]
    return got.select(row, *(F.col("_kept")[c].alias(c) for c in keep), count("_item").alias("n_items"), count("_hit").alias("n_matched"), missed.alias("unmatched"), of("source").alias("sources"), *sets)


def second_spellings(items: Column, key) -> Column:
    """Items whose key stands twice or more in the list: of each such key the second spelling, once."""
    def of(marked: Column) -> Column:
        nth = lambda m: F.size(F.filter(marked, lambda o: (o["k"] == m["k"]) & (o["i"] < m["i"])))
        return F.transform(F.filter(marked, lambda m: nth(m) == 1), lambda m: m["x"])

    # Bound once: lambdas would work out every key anew for each item.
    return arrays.let(F.transform(items, lambda x, i: F.struct(i.alias("i"), x.alias("x"), key(x).alias("k"))), of)


def first_spellings(items: Column, key) -> Column:
    """Items whose key stands twice or more: the first spelling with its count, such as 'a (2)'."""
    keys = F.transform(items, lambda x: key(x))
    marked = F.transform(items, lambda x, i: F.struct(i.alias("i"), x.alias("x"), F.size(F.filter(keys, lambda k: k == key(x))).alias("n")))
    first = F.filter(marked, lambda m: (m["n"] > 1) & (F.array_position(keys, key(m["x"])) == m["i"] + 1))
    return F.transform(first, lambda m: F.concat(m["x"], F.lit(" ("), m["n"].cast("string"), F.lit(")")))


def excess(items: Column) -> Column:
    """How many items repeat an earlier one."""
    return F.size(items) - F.size(F.array_distinct(items))


def unique_join(items: Column, sign: str = "; ") -> Column:
    """Distinct items that are not blank, in the order of their first place."""
    return F.array_join(F.array_distinct(F.filter(F.transform(items, lambda x: F.trim(x)), lambda x: x != "")), sign)


def compare_sets(expected: Column, actual: Column, duplicates: Column) -> Column:
    """struct(status, missing, extra, reason). Agreeing values are PASS, or DUPLICATED if one is written twice; only missing ones are MISSING; any wrong one is FAIL."""
    some = lambda words, items: F.concat(F.lit(words), F.array_join(items, ", "))

    def of(missing: Column, extra: Column, duplicates: Column) -> Column:
        dup = F.size(duplicates) > 0
        agree = (F.size(missing) == 0) & (F.size(extra) == 0)
        status = F.when(agree & dup, "DUPLICATED").when(agree, "PASS").when(F.size(extra) > 0, "FAIL").otherwise("MISSING")
        parts = [
            F.when(dup, some("Duplicated: ", duplicates)),
            F.when(F.size(missing) > 0, F.when(F.size(actual) == 0, some("Empty; expected: ", missing)).otherwise(some("Missing: ", missing))),
            F.when(F.size(extra) > 0, some("Not supported by any matched processor: ", extra)),
        ]
        return F.struct(status.alias("status"), missing.alias("missing"), extra.alias("extra"), F.concat_ws(" | ", *parts).alias("reason"))

    three = F.struct(arrays.missing(expected, actual).alias("m"), arrays.missing(actual, expected).alias("x"), duplicates.alias("d"))
    return arrays.let(three, lambda t: of(t["m"], t["x"], t["d"]))


def worst(*statuses: Column) -> Column:
    held = F.array(*statuses)
    return F.filter(F.array(*map(F.lit, PRIORITY)), lambda p: F.array_contains(held, p))[0]


def numbered(df: DataFrame, order: list[Column], name: str = "row_no", shards: int = 64) -> DataFrame:
    """Rows numbered as in a spreadsheet (the first is 2), in two steps: positions inside ranges of the order, then the rows before each range.

    The ranges are written once and both steps read that table: two range exchanges of unlike columns draw bounds of their
    own. No task gets the whole table. Rows that tie in the order are numbered in any order; an empty table stays empty.
    """
    parted = df.repartitionByRange(shards, *order).sortWithinPartitions(*order).withColumn("_part", F.spark_partition_id())
    inside = written(parted.withColumn("_at", F.monotonically_increasing_id() - F.shiftleft(F.col("_part").cast("long"), 33)), "numbered")
    sizes = inside.groupBy("_part").count()
    before = sizes.withColumn("_before", F.coalesce(F.sum("count").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("count")
    # `shards` rows at most, whatever the table's size
    return inside.join(F.broadcast(before), "_part").withColumn(name, F.col("_before") + F.col("_at") + 2).drop("_part", "_at", "_before")


def same_rows(df: DataFrame, columns: list[str], row_no: str) -> DataFrame:
    """first_row: the least row number with the same content, by one aggregation and a join back; a common content does not go to one task's window."""
    content = F.sha2(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}), 256)
    keyed = df.withColumn("_content", content)
    first = keyed.groupBy("_content").agg(F.min(row_no).alias("first_row"), F.count(F.lit(1)).alias("_n")).filter("_n > 1").drop("_n")
    return keyed.join(first, "_content", "left").withColumn("first_row", F.coalesce("first_row", row_no)).drop("_content")


def routed_lookup(items: DataFrame, token: str, first: DataFrame, second: DataFrame, first_shape: str, second_shape: str) -> DataFrame:
    """Vendor routing: a token that the first dimension knows, or of its shape, is the first vendor's; else one of the second's shape is the second's.

    Adds vendor (null: neither) and family (null: not found). Dimensions: (key, family), one row of each key.
    """
    a, b = first.select(F.col("key").alias("_ka"), F.col("family").alias("_fa")), second.select(F.col("key").alias("_kb"), F.col("family").alias("_fb"))
    got = items.join(a, F.col(token) == F.col("_ka"), "left").join(b, F.col(token) == F.col("_kb"), "left")
    vendor = F.when(F.col("_ka").isNotNull() | F.col(token).rlike(first_shape), "first").when(F.col(token).rlike(second_shape), "second")
    return got.withColumn("vendor", vendor).withColumn("family", F.when(F.col("vendor") == "first", F.col("_fa")).when(F.col("vendor") == "second", F.col("_fb"))).drop("_ka", "_fa", "_kb", "_fb")


def vendor_summary(routed: DataFrame, row: str, names: dict[str, str]) -> DataFrame:
    """(row, vendors, families, missing, total, matched) of items routed by routed_lookup(): names of vendors, sorted and joined by ', ',
    sorted distinct families, and the items of a vendor that no dimension knows, in order of `pos`; items of no vendor do not count."""
    named = F.create_map(*[F.lit(x) for kv in names.items() for x in kv])
    of = F.col("vendor").isNotNull()
    missed = F.array_sort(F.collect_list(F.when(of & F.col("family").isNull(), F.struct("pos", "token"))))
    return routed.groupBy(row).agg(
        F.array_join(F.array_sort(F.collect_set(F.try_element_at(named, F.col("vendor")))), ", ").alias("vendors"), F.array_sort(F.collect_set(F.when(of, F.col("family")))).alias("families"),
        F.transform(missed, lambda x: x["token"]).alias("missing"), F.count("vendor").alias("total"), F.count(F.when(of, F.col("family"))).alias("matched"),
    )


def generation_join(probes: DataFrame, probe_id: str, text: str, generation: Column, dim: DataFrame, name: str, dim_generation: str, require: bool = False) -> DataFrame:
    """The dimension name whose words are all in the probe: of the same generation if there is one (or only such, if required), least name on ties.

    Candidates meet by words, never all with all: a name's rarest word is looked up among the probes' words, once for
    all probes of the same words and generation. Spark judges a side by the bytes of its files, of which the words of its
    rows are many times more, so the joins say that neither side is to be broadcast.
    """
    words = lambda c: F.array_distinct(F.filter(F.split(F.lower(c), r"\s+"), lambda x: x != ""))
    p = probes.select(probe_id, generation.alias("_gen"), F.array_sort(words(F.col(text))).alias("_words"))
    d = dim.select(name, dim_generation, words(F.col(name)).alias("_need"))
    rare = d.select(F.explode("_need").alias("_w")).groupBy("_w").agg(F.count(F.lit(1)).alias("_c"))
    key = d.select(name, F.explode("_need").alias("_w")).join(rare.hint("merge"), "_w").groupBy(name).agg(F.min(F.struct("_c", "_w")).alias("_m")).select(name, F.col("_m._w").alias("_w"))
    kinds = p.select("_words", "_gen").distinct()
    hits = kinds.withColumn("_w", F.explode("_words")).join(d.join(key.hint("merge"), name).hint("merge"), "_w").filter(F.size(F.array_except("_need", "_words")) == 0)
    same = F.col(dim_generation).eqNullSafe(F.col("_gen"))
    hits = hits.filter(same) if require else hits
    best = hits.groupBy(F.col("_words").alias("_of"), F.col("_gen").alias("_at")).agg(F.min(F.struct((~same).alias("other"), F.col(name).alias("n"))).alias("_m"))
    got = p.join(best.hint("merge"), (F.col("_words") == F.col("_of")) & F.col("_gen").eqNullSafe(F.col("_at"))).select(probe_id, F.col("_m.n").alias(name), (~F.col("_m.other")).alias("same_generation"))
    return best_hit(got, [probe_id], [F.desc("same_generation"), F.col(name)])
