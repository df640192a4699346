"""Audits of a catalogue against live rows: presence, fields, maps, sets, explanations, summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions import arrays


def normal_map(m: Column, clean) -> Column:
    """A map of text to lists with keys and items cleaned; keys that become equal keep the last one's list."""
    entries = F.transform(F.map_entries(m), lambda e: F.struct(clean(e["key"]).alias("key"), F.transform(e["value"], lambda x: clean(x)).alias("value")))
    keys = F.transform(entries, lambda e: e["key"])
    last = F.filter(entries, lambda e, i: ~F.array_contains(F.slice(keys, i + 2, F.greatest(F.size(keys), F.lit(1))), e["key"]))
    return F.map_from_entries(last)


def merged(base: Column, over: Column) -> Column:
    """Both maps' entries; the second one's value wins."""
    return F.map_concat(F.map_filter(base, lambda k, v: ~F.map_contains_key(over, k)), over)


def map_sides(a: Column, b: Column) -> Column:
    """struct(only_a, only_b, changed): sorted keys of one side, of the other, and of both with other values."""
    ka, kb = F.map_keys(a), F.map_keys(b)
    changed = F.filter(F.array_intersect(ka, kb), lambda k: ~F.element_at(a, k).eqNullSafe(F.element_at(b, k)))
    return F.struct(arrays.missing(ka, kb).alias("only_a"), arrays.missing(kb, ka).alias("only_b"), F.array_sort(changed).alias("changed"))


def said(words: str, items: Column) -> Column:
    return F.when(F.size(items) > 0, F.concat(F.lit(f"{words}: ["), F.array_join(items, ", "), F.lit("]")))


def text_note(a: Column, b: Column) -> Column:
    """Null where the trimmed texts agree, null and blank alike, else what differs."""
    x, y = (F.coalesce(F.trim(c), F.lit("")) for c in (a, b))
    return F.when(x != y, F.concat(F.lit("value differs: '"), x, F.lit("' vs '"), y, F.lit("'")))


def set_note(name: str, a: Column, b: Column) -> Column:
    inside = F.concat_ws("; ", said("only in CSV", arrays.missing(a, b)), said("only on live site", arrays.missing(b, a)))
    return F.when(inside != "", F.concat(F.lit(f"{name} differ ("), inside, F.lit(")")))


def map_note(name: str, a: Column, b: Column) -> Column:
    d = map_sides(a, b)
    inside = F.concat_ws("; ", said("keys only in CSV", d["only_a"]), said("keys only on live site", d["only_b"]), said("changed keys", d["changed"]))
    return F.when(inside != "", F.concat(F.lit(f"{name} differ ("), inside, F.lit(")")))


def audit(catalogue: DataFrame, live: DataFrame, failed: DataFrame, key: str, texts: list[str], sets: list[str], maps: list[str]) -> DataFrame:
    """One row of each key of either side: status, row_match, <field>_match (YES, NO, N/A), notes.

    failed: keys whose live fetch failed. One full outer join on the key and one left join; both tables are partitioned
    by the key, so a large audit is two exchanges.
    """
    fields = [*texts, *sets, *maps]
    a = catalogue.select(F.col(key).alias("_ka"), *(F.col(f).alias(f"_a_{f}") for f in fields))
    b = live.select(F.col(key).alias("_kb"), *(F.col(f).alias(f"_b_{f}") for f in fields))
    got = a.join(b, F.col("_ka") == F.col("_kb"), "full").withColumn(key, F.coalesce("_ka", "_kb")).join(failed.select(key, F.lit(True).alias("_failed")).distinct(), key, "left")
    notes = {f: text_note(F.col(f"_a_{f}"), F.col(f"_b_{f}")) for f in texts} | {f: set_note(f, F.col(f"_a_{f}"), F.col(f"_b_{f}")) for f in sets} | {f: map_note(f, F.col(f"_a_{f}"), F.col(f"_b_{f}")) for f in maps}
    one_side = F.col("_ka").isNull() | F.col("_kb").isNull()
    differs = F.lit(False)
    for n in notes.values():
        differs = differs | n.isNotNull()
    status = F.when(F.col("_kb").isNull() & F.col("_failed"), "LIVE_FETCH_FAILED").when(F.col("_kb").isNull(), "MISSING_FROM_LIVE_SITE").when(F.col("_ka").isNull(), "MISSING_FROM_CSV").when(differs, "UNMATCHED").otherwise("MATCHED")
    got = got.withColumn("status", status)
    told = F.when(F.col("status") == "MISSING_FROM_CSV", "Product exists on live site but this row is absent from the CSV entirely").when(F.col("status") == "MISSING_FROM_LIVE_SITE", "Product is in the CSV but was not found on the live site (removed, renamed, or fetch error)").when(one_side, "").otherwise(F.concat_ws("; ", *notes.values()))
    matches = [F.when(one_side, "N/A").when(n.isNotNull(), "NO").otherwise("YES").alias(f"{f}_match") for f, n in notes.items()]
    return got.select(key, "status", F.when(F.col("status") == "MATCHED", "YES").otherwise("NO").alias("row_match"), *matches, told.alias("notes"))


def verdict(checks: dict[str, Column]) -> Column:
    """'PASS', or 'FAIL(a, b)' with the names of the checks that do not hold; null counts as not held."""
    bad = F.concat_ws(", ", *[F.when(~F.coalesce(c, F.lit(False)), F.lit(n)) for n, c in checks.items()])
    return F.when(bad == "", "PASS").otherwise(F.concat(F.lit("FAIL("), bad, F.lit(")")))


def explained(differences: DataFrame, row: str, tag: str, field: str) -> DataFrame:
    """Roll-up of explanations: of each row 'tag: a, b | tag: c', tags and fields in order. Fields are distinct before they are gathered, and there are few."""
    one = differences.select(row, F.coalesce(tag, F.lit("needs review")).alias("_t"), field).distinct()
    tagged = one.groupBy(row, "_t").agg(F.array_join(F.array_sort(F.collect_list(field)), ", ").alias("_f"))
    return tagged.groupBy(row).agg(F.array_join(F.array_sort(F.collect_list(F.concat("_t", F.lit(": "), "_f"))), " | ").alias("explanation"))


def ordered_distinct(df: DataFrame, by: list[str], items: str, pos: str) -> DataFrame:
    """Of each group the items of its list cells and the distinct ones, both in order of row and place. Repeats go before anything is gathered."""
    each = df.select(*by, F.col(pos).alias("_p"), F.posexplode(items).alias("_i", "_x"))
    first = each.groupBy(*by, "_x").agg(F.min(F.struct("_p", "_i")).alias("_at"), F.count(F.lit(1)).alias("_n"))
    return first.groupBy(*by).agg(F.sum("_n").alias("n_items"), F.transform(F.array_sort(F.collect_list(F.struct("_at", "_x"))), lambda s: s["_x"]).alias("distinct_items"))


def summary(df: DataFrame, metrics: dict[str, Column]) -> DataFrame:
    """(metric, value as text) of one aggregation, in the order given."""
    one = df.agg(*(m.cast("string").alias(k) for k, m in metrics.items()))
    pairs = F.array(*[F.struct(F.lit(i).alias("place"), F.lit(k).alias("metric"), F.col(k).alias("value")) for i, k in enumerate(metrics)])
    return one.select(F.explode(pairs).alias("r")).select("r.*")


def gate(df: DataFrame, status: str, fail_on: set[str], sign: str = r"\|") -> int:
    """How many rows hold a status to fail on; the caller's exit code is 1 if any does."""
    return df.filter(F.arrays_overlap(F.split(status, sign), F.array(*map(F.lit, sorted(fail_on))))).count()
