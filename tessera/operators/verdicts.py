"""Verdicts from several findings: flag sets, counted phrases, worst status, summaries in a status order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def flags(*steps: tuple[Column, str], default: str = "match") -> Column:
    """All labels whose condition holds, sorted, joined by ' & '; default if none does."""
    found = F.array_compact(F.array(*[F.when(c, F.lit(label)) for c, label in steps]))
    return F.when(F.size(found) == 0, default).otherwise(F.array_join(F.array_sort(found), " & "))


def counted(*steps: tuple[Column, str, str, str], default: str = "match") -> Column:
    """Phrases such as '2 lines missing' of (count, singular, plural, verb), joined by ' & '; counts of 0 and null say nothing."""
    parts = [F.when(n > 0, F.concat(n.cast("string"), F.when(n == 1, f" {one} ").otherwise(f" {many} "), F.lit(verb))) for n, one, many, verb in steps]
    return F.coalesce(F.nullif(F.concat_ws(" & ", *parts), F.lit("")), F.lit(default))


def position(status: Column, order: list[str]) -> Column:
    """Place of a status in an order from 0, the order's length for any other and for null."""
    at = F.array_position(F.array(*map(F.lit, order)), status)
    return F.when(at > 0, at - 1).otherwise(len(order)).cast("int")


def worst(order: list[str], *statuses: Column) -> Column:
    """The status that comes first in the order."""
    return F.least(*[F.struct(position(s, order).alias("at"), s.alias("s")) for s in statuses])["s"]


def status_summary(df: DataFrame, status: str, order: list[str]) -> DataFrame:
    """(status, n, place) in the given order, unknown ones last."""
    got = df.groupBy(status).agg(F.count(F.lit(1)).alias("n")).withColumn("place", position(F.col(status), order))
    return got.orderBy("place", status)


def head_per(df: DataFrame, by: str, order: list[Column], n: int) -> DataFrame:
    """The first n rows of each group: a report, n is its feature."""
    return df.withColumn("_rn", F.row_number().over(Window.partitionBy(by).orderBy(*order))).filter(F.col("_rn") <= n).drop("_rn")


def largest(df: DataFrame, by: str, label: str, size: Column) -> DataFrame:
    """(by, label) of the largest size in each group, least label on ties; null sizes never win."""
    first = F.min(F.when(size.isNotNull(), F.struct((-size).alias("s"), F.col(label).alias("l"))))
    return df.groupBy(by).agg(first.alias("m")).filter("m IS NOT NULL").select(by, F.col("m.l").alias(label))


def compare_numbers(document: Column, expected: Column, actual: Column) -> Column:
    """First numbers of two cells: 'Datas are not available' for an empty document, missing, match or mismatch."""
    number = lambda c: F.nullif(F.regexp_extract(c.cast("string"), "([0-9]+(?:\\.[0-9]+)?)", 1), F.lit("")).cast("double")
    empty = F.trim(document) == "{}"
    return F.when(empty, "Datas are not available").when(expected.isNull() | actual.isNull(), "missing").when(number(expected) == number(actual), "match").otherwise("mismatch")


def triage(error: Column, described: Column, coded: Column, mentioned: Column) -> Column:
    """What an extraction is good for, from its error and whether it holds descriptions, codes and keywords."""
    t = F.when(F.coalesce(error, F.lit("")) != "", "EXTRACTION_ERROR").when(~described & ~mentioned, "NOT_A_COMPUTE_PRODUCT")
    return t.when(~described, "REVIEW_NO_STRUCTURED_MATCH").when(~coded, "REVIEW_DESCRIPTION_ONLY").otherwise("OK")


def outcome(failed: Column, parts: Column, filled: Column, enough: int = 3) -> Column:
    """FAILED, SUCCESS with any parts or more than `enough` filled fields, else PARTIAL."""
    return F.when(failed, "FAILED").when((parts > 0) | (filled > enough), "SUCCESS").otherwise("PARTIAL")


def speed_flags(entries: Column, processors: Column, known: Column, clean) -> Column:
    """All flags that hold for a row's entries 'name processor (speed)', sorted, joined by ' & ': duplicate, empty_speed, invalid_format, match, mismatch, missing, processor_mismatch.

    processors: cleaned names of the row; known: the speeds that the reference has for them. match: some entry names a
    processor of the row, and speeds agree both ways without an empty one.
    """
    from tessera.functions import models

    entries = F.coalesce(entries, F.array().cast("array<string>"))
    own = F.array_distinct(F.flatten(F.transform(entries, lambda x: models.speeds(x))))
    wanted = F.array_distinct(F.flatten(F.transform(known, lambda x: models.speeds(x))))
    named = lambda x: F.array_contains(processors, clean(models.before_paren(x)))
    missing, extra = F.size(F.array_except(wanted, own)) > 0, F.size(F.array_except(own, wanted)) > 0
    empty = F.exists(entries, lambda x: x.rlike(r"(?i)processor\s*\(\s*\)"))
    invalid = (F.size(entries) == 0) | F.exists(entries, lambda x: ~x.rlike(r"(?i)processor\s*\(\s*[0-9]{4,5}\s*(?:MT/s|MHz)\s*\)$"))
    repeated = F.size(entries) != F.size(F.array_distinct(entries))
    steps = [(repeated, "duplicate"), (empty, "empty_speed"), (invalid, "invalid_format"), (F.exists(entries, lambda x: ~F.coalesce(named(x), F.lit(False))), "processor_mismatch"), (missing, "missing"), (extra, "mismatch"), (F.exists(entries, lambda x: F.coalesce(named(x), F.lit(False))) & ~missing & ~extra & ~empty, "match")]
    return flags(*steps, default="")
