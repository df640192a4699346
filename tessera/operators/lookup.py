"""Lookups into dimension tables: first or last wins, cascades, containment, tokens, best overlap.

A dimension is broadcast only by Spark's own size check; no hints are given, so large dimensions are sort-merged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def dedup_dim(dim: DataFrame, key: str, order: list[Column]) -> DataFrame:
    """One row of each key, the first by order; null keys go."""
    w = Window.partitionBy(key).orderBy(*order)
    return dim.filter(F.col(key).isNotNull()).withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def lookup(facts: DataFrame, dim: DataFrame, key: str, order: list[Column]) -> DataFrame:
    """Left join with one dimension row for each key."""
    return facts.join(dedup_dim(dim, key, order), key, "left")


def cascade_lookup(facts: DataFrame, steps: list[tuple[str, DataFrame, str, str]], value: str, source: str = "match_source") -> DataFrame:
    """First step that hits wins. step: (label, dimension, key column of facts, value column); dimensions have unique column `key`."""
    got = facts
    for i, (_, dim, key, val) in enumerate(steps):
        got = got.join(dim.select(F.col("key").alias(f"_k{i}"), F.col(val).alias(f"_v{i}")), F.col(key) == F.col(f"_k{i}"), "left")
    which = F.coalesce(*[F.when(F.col(f"_k{i}").isNotNull(), F.lit(label)) for i, (label, *_) in enumerate(steps)])
    hit = F.lit(None)
    for i in reversed(range(len(steps))):
        hit = F.when(F.col(f"_k{i}").isNotNull(), F.col(f"_v{i}")).otherwise(hit)
    return got.withColumns({value: hit, source: which}).drop(*[f"_{x}{i}" for i in range(len(steps)) for x in "kv"])


def best_hit(hits: DataFrame, by: list[str], order: list[Column]) -> DataFrame:
    """The best of several hits of each probe."""
    return hits.withColumn("_rn", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).filter("_rn = 1").drop("_rn")


def token_join(facts: DataFrame, fact_id: str, tokens: str, dim: DataFrame, dim_token: str) -> DataFrame:
    """First token, in order, that the dimension knows; one row for each fact that hits."""
    e = facts.select(fact_id, F.posexplode(tokens).alias("_pos", dim_token))
    return best_hit(e.join(dim, dim_token), [fact_id], [F.col("_pos")]).drop("_pos")


def overlap_best(facts: DataFrame, fact_id: str, words: str, dim: DataFrame, dim_id: str, dim_words: str) -> DataFrame:
    """Dimension entry that shares most distinct words with each fact, least id on ties; entries that share none are never paired.

    Facts of the same words are one, and so are entries (their least id stands for them), so equal names never multiply.
    """
    of = lambda c: F.array_sort(F.array_distinct(c))
    sets = facts.select(fact_id, of(words).alias("_set"))
    kinds = dim.select(dim_id, of(dim_words).alias("_words")).groupBy("_words").agg(F.min(dim_id).alias(dim_id))
    a = sets.select("_set").distinct().withColumn("_w", F.explode("_set"))
    shared = a.join(kinds.select(dim_id, F.explode("_words").alias("_w")), "_w").groupBy("_set", dim_id).agg(F.count(F.lit(1)).alias("n_shared"))
    best = shared.groupBy("_set").agg(F.min(F.struct((-F.col("n_shared")).alias("n"), F.col(dim_id).alias("k"))).alias("m"))
    return sets.join(best, "_set").select(fact_id, F.col("m.k").alias(dim_id), (-F.col("m.n")).alias("n_shared"))


def _grams(c: Column, sizes) -> Column:
    part = lambda n: F.when(F.length(c) >= n, F.transform(F.sequence(F.lit(1), F.length(c) - (n - 1)), lambda i: F.substr(c, i, F.lit(n)))).otherwise(F.array().cast("array<string>"))
    return F.array_distinct(F.flatten(F.array(*[part(n) for n in sizes])))


def _parts_of(names: DataFrame, name: str, probes: DataFrame, probe: str) -> DataFrame:
    in_names = names.select(name, F.explode(_grams(F.col(name), (1, 2, 3))).alias("_g"))
    size = F.least(F.length(probe), F.lit(3))
    own = F.filter(_grams(F.col(probe), (1, 2, 3)), lambda g: F.length(g) == size)
    counts = in_names.groupBy("_g").agg(F.count(F.lit(1)).alias("_n"))
    rare = probes.select(probe, F.explode(own).alias("_g")).join(counts, "_g").groupBy(probe).agg(F.min(F.struct("_n", "_g")).alias("_m")).select(probe, F.col("_m._g").alias("_g"))
    return in_names.join(rare, "_g").filter(F.contains(F.col(name), F.col(probe))).select(name, probe)


def contains_join(names: DataFrame, name: str, probes: DataFrame, probe: str, both_ways: bool = False) -> DataFrame:
    """Distinct pairs in which the probe is part of the name, or either of the other; blank probes match nothing, blank names only the other way.

    Candidates meet by the probe's rarest three letters (all letters of shorter ones); contains() then decides, so no
    name is compared with a probe that shares no such letters with it.
    """
    n, p = names.select(name).filter(F.col(name).isNotNull()).distinct(), probes.select(probe).filter(F.col(probe) != "").distinct()
    got = _parts_of(n, name, p, probe)
    return got.union(_parts_of(p, probe, n.filter(F.col(name) != ""), name).select(name, probe)).distinct() if both_ways else got


def best_above(facts: DataFrame, group: str, bound: str, dim: DataFrame, dim_group: str, value: str, dim_id: str, salts: int = 64) -> DataFrame:
    """For each fact of a group with entries: the least entry id among those of value >= bound, else the least of all; adds dim_id and above.

    A group's entries are reduced to the steps at which the least id changes as the bound falls, a few in expectation, so
    facts and entries of a common group are never paired. Steps are found in salted parts of a group first, so that a
    common group is spread, and then among the few steps of its parts.
    """
    least = dim.groupBy(dim_group, value).agg(F.min(dim_id).alias(dim_id)).withColumn("_salt", F.abs(F.xxhash64(dim_id) % salts))
    w = Window.partitionBy(dim_group, "_salt").orderBy(F.desc(value), dim_id).rowsBetween(Window.unboundedPreceding, 0)
    parts = least.withColumn("_least", F.min(dim_id).over(w)).filter(F.col("_least") == F.col(dim_id))
    entry = F.struct((-F.col(value)).alias("n"), F.col(dim_id).alias("k"), F.col(value).alias("v"))
    sorted_ = parts.groupBy(F.col(dim_group).alias("_g")).agg(F.array_sort(F.collect_list(entry)).alias("_e"), F.min(dim_id).alias("_any"))
    none = F.filter("_e", lambda e: F.lit(False))
    fall = lambda done, e: F.when(F.coalesce(e["k"] < F.try_element_at(done, F.lit(-1))["k"], F.lit(True)), F.array_append(done, e)).otherwise(done)
    steps = sorted_.select("_g", "_any", F.aggregate("_e", none, fall).alias("_steps"))
    got = facts.join(steps, F.col(group) == F.col("_g"))
    found = F.array_min(F.transform(F.filter("_steps", lambda s: s["v"] >= F.col(bound)), lambda s: s["k"]))
    return got.withColumns({dim_id: F.coalesce(found, "_any"), "above": found.isNotNull()}).drop("_g", "_steps", "_any")
