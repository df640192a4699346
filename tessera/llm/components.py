"""Connected components by alternating large-star and small-star steps.

Every step is an aggregation and a join over the links; a hub's links are never gathered in one task's memory. After
each round the links are written to the shared folder, so lineage stays short and a lost executor costs one round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import discard, materialise


def _both(e: DataFrame) -> DataFrame:
    return e.select("u", "v").union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _star(e: DataFrame, large: bool) -> DataFrame:
    if large:
        e = _both(e)
        m = e.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        got = e.join(m, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        e = e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        m = e.groupBy("u").agg(F.min("v").alias("m"))
        got = e.join(m, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(m.select("u", F.col("m").alias("v")))
    return got.filter("u != v").distinct()


def components(links: DataFrame, u: str, v: str) -> DataFrame:
    """(id, component) of every id in links but each component's smallest; component is the smallest id reachable.

    Links of an id with itself and repeated links do no harm; no links give no rows. Ids must not be null. The result
    is a written table, which its user may discard.
    """
    e = materialise(links.select(F.col(u).cast("long").alias("u"), F.col(v).cast("long").alias("v")).filter("u != v").distinct(), "links")
    seen = None
    while True:
        got = e.agg(F.count(F.lit(1)).alias("n"), F.expr("bit_xor(xxhash64(u, v))").alias("x")).first()
        if (got.n, got.x) == seen or not got.n:
            out = e.select(F.col("u").alias("id"), F.col("v").alias("component"))
            out.written_at = e.written_at
            return out
        seen, before = (got.n, got.x), e
        e = materialise(_star(_star(e, True), False), "links")
        discard(before)
