"""Expected against actual: coverage of groups, table diffs, status ladders, roll-ups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions import arrays


def ladder(*steps: tuple[Column, str], default: str) -> Column:
    """The first status whose condition holds."""
    out = None
    for cond, status in steps:
        out = F.when(cond, status) if out is None else out.when(cond, status)
    return out.otherwise(default)


def compare_text(expected: Column, actual: Column) -> Column:
    """EMPTY, MISSING, MATCH or MISMATCH; nulls and blanks count as empty."""
    e, a = F.nullif(F.trim(expected), F.lit("")), F.nullif(F.trim(actual), F.lit(""))
    return ladder((e.isNull() & a.isNull(), "EMPTY"), (e.isNull() | a.isNull(), "MISSING"), (e == a, "MATCH"), default="MISMATCH")


def coverage_check(df: DataFrame, group: str, item: str, expected: list[str]) -> DataFrame:
    """For each group: missing, extra and duplicate items against a fixed list, and a status. Repeats are counted before anything is gathered."""
    n = df.filter(F.col(group).isNotNull() & F.col(item).isNotNull()).groupBy(group, item).count()
    want = F.array(*[F.lit(x) for x in sorted(expected)])
    got = n.groupBy(group).agg(F.array_sort(F.collect_list(item)).alias("got"), F.array_sort(F.collect_list(F.when(F.col("count") > 1, F.col(item)))).alias("dup"))
    got = got.withColumns({"miss": arrays.missing(want, F.col("got")), "extra": arrays.missing(F.col("got"), want)})
    status = ladder((F.size("miss") > 0, "MISSING"), (F.size("extra") > 0, "EXTRA"), (F.size("dup") > 0, "DUPLICATED"), default="PASS")
    return got.select(group, *(F.array_join(c, ",").alias(a) for c, a in (("miss", "missing"), ("extra", "extra"), ("dup", "duplicates"))), status.alias("status"))


def table_diff(old: DataFrame, new: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """Full outer diff: REMOVED, ADDED, CHANGED or SAME, and the changed fields in order."""
    a = old.select(F.col(key).alias("_a"), *(F.col(f).alias(f"_a_{f}") for f in fields))
    b = new.select(F.col(key).alias("_b"), *(F.col(f).alias(f"_b_{f}") for f in fields))
    got = a.join(b, F.col("_a") == F.col("_b"), "full")
    both = F.col("_a").isNotNull() & F.col("_b").isNotNull()
    changed = F.when(both, F.concat_ws(",", *[F.when(~F.col(f"_a_{f}").eqNullSafe(F.col(f"_b_{f}")), F.lit(f)) for f in fields])).otherwise("")
    status = ladder((F.col("_b").isNull(), "REMOVED"), (F.col("_a").isNull(), "ADDED"), (changed != "", "CHANGED"), default="SAME")
    return got.select(F.coalesce("_a", "_b").alias(key), status.alias("status"), changed.alias("changed"))


def flag_duplicates(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """first_row: the least order value among rows of the same keys (nulls are alike); is_dup: not that row. order tells rows apart.

    The least value comes from one aggregation, combined before its exchange, and only of keys that repeat is it joined
    back: a common content is not sorted in one task.
    """
    first = df.groupBy(*keys).agg(F.min(order).alias("first_row"), F.count(F.lit(1)).alias("_n")).filter("_n > 1").drop("_n")
    other = first.select(*(F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)), "first_row")
    same = None
    for i, k in enumerate(keys):
        one = F.col(k).eqNullSafe(F.col(f"_k{i}"))
        same = one if same is None else same & one
    got = df.join(other, same, "left").drop(*(f"_k{i}" for i in range(len(keys))))
    return got.withColumn("first_row", F.coalesce("first_row", order)).withColumn("is_dup", F.col(order) != F.col("first_row"))


def streaks(df: DataFrame, by: str, order: list[str], bad: Column) -> DataFrame:
    """streak: consecutive bad rows up to this one, 0 after a good one."""
    w = Window.partitionBy(by).orderBy(*order)
    island = F.sum(F.when(bad, 0).otherwise(1)).over(w.rowsBetween(Window.unboundedPreceding, 0))
    df = df.withColumn("_bad", bad).withColumn("_i", island)
    inside = Window.partitionBy(by, "_i").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn("streak", F.sum(F.col("_bad").cast("int")).over(inside)).drop("_bad", "_i")


def with_reset(streak: Column, most: int) -> list[Column]:
    """streak counted anew after every `most` bad rows, and whether this row trips the breaker."""
    return [F.when(streak > 0, (streak - 1) % most + 1).otherwise(0).alias("streak"), ((streak > 0) & (streak % most == 0)).alias("trips")]


def merge_continuations(df: DataFrame, by: str, order: list[str], line: str, alone: str, ends: str) -> DataFrame:
    """(by, island, line): lines that match `alone` joined to the line before, unless that one matches `ends` already. A record's lines are bounded."""
    w = Window.partitionBy(by).orderBy(*order)
    previous = F.lag(line).over(w)
    joins = F.col(line).rlike(alone) & previous.isNotNull() & ~F.coalesce(previous.rlike(ends), F.lit(False))
    got = df.withColumn("_starts", F.when(joins, 0).otherwise(1)).withColumn("island", F.sum("_starts").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    parts = F.transform(F.array_sort(F.collect_list(F.struct(*order, line))), lambda s: s[line])
    return got.groupBy(by, "island").agg(F.array_join(parts, " ").alias("line"))
