"""Model numbers, generations, speeds and memory ranks in free text, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.functions.text import first_match, last_match

MODEL = "\\b[a-z]?[0-9]{3,5}[a-z]?\\b"
SPEED = "(?i)[0-9]{4,5} *(?:MT/s|MHz)"
RANK = "(?i)([0-9]+) *R *x *([0-9]+)"


def model_tokens(col: Column) -> Column:
    """Distinct model numbers in order; four plain digits name a socket and do not count."""
    found = F.array_distinct(F.regexp_extract_all(F.lower(col), F.lit(MODEL), F.lit(0)))
    return F.filter(found, lambda x: ~x.rlike("^[0-9]{4}$"))


def generation(col: Column) -> Column:
    """The digit of '3rd gen' or '3rd generation'; null without one."""
    return first_match(F.lower(col), "\\b([0-9])(?:st|nd|rd|th)\\s+gen(?:eration)?\\b", 1)


def speeds(col: Column) -> Column:
    """Distinct speeds in order, without spaces and in upper case."""
    found = F.regexp_extract_all(col, F.lit(SPEED), F.lit(0))
    return F.array_distinct(F.transform(found, lambda x: F.upper(F.regexp_replace(x, " +", ""))))


def before_paren(col: Column) -> Column:
    return F.nullif(F.trim(F.regexp_extract(col, "^([^(]*)", 1)), F.lit(""))


def slash_versions(col: Column) -> Column:
    """'E5 v4/v3' as 'E5 v4' and 'E5 v3'; any other text as itself alone."""
    shape = "(?i)^(.*?)\\b(v[0-9]+)((?:/v[0-9]+)+)(.*)$"
    head, tail = F.regexp_extract(col, shape, 1), F.regexp_extract(col, shape, 4)
    versions = F.split(F.concat(F.regexp_extract(col, shape, 2), F.regexp_extract(col, shape, 3)), "/")
    return F.when(col.rlike(shape), F.transform(versions, lambda v: F.concat(head, v, tail))).otherwise(F.array(col))


def rank(col: Column) -> Column:
    """'2 r x 4' as '2Rx4'; null without a rank."""
    ranks, width = F.regexp_extract(col, RANK, 1), F.regexp_extract(col, RANK, 2)
    return F.when(ranks != "", F.concat(ranks.cast("int").cast("string"), F.lit("Rx"), width.cast("int").cast("string")))


def rank_of_columns(ranks: Column, width: Column) -> Column:
    """A rank from two cells such as '2.0' and 'x4'; null if either holds no number."""
    n = ranks.cast("string").try_cast("double").try_cast("int")
    w = F.regexp_replace(width.cast("string"), "(?i)^ *x", "").try_cast("double").try_cast("int")
    return F.concat(n.cast("string"), F.lit("Rx"), w.cast("string"))


def last_rank(description: Column) -> Column:
    return rank(last_match(description, RANK))


def sort_ranks(items: Column) -> Column:
    """By number of ranks, then width; what is no rank comes last, by text."""
    keyed = F.transform(items, lambda x: F.struct(F.coalesce(F.regexp_extract(x, RANK, 1).try_cast("int"), F.lit(999)).alias("r"), F.coalesce(F.regexp_extract(x, RANK, 2).try_cast("int"), F.lit(999)).alias("w"), x.alias("x")))
    return F.transform(F.array_sort(keyed), lambda s: s["x"])


def phrases(tokens: Column, end: str = "processor", most: int = 4) -> Column:
    """Tokens put together; a phrase closes at a token that ends with `end` or at `most` tokens."""
    zero = F.struct(F.array().cast("array<string>").alias("done"), F.array().cast("array<string>").alias("open"))

    def step(a: Column, t: Column) -> Column:
        grown = F.concat(a["open"], F.array(t))
        closes = F.endswith(F.lower(t), F.lit(end)) | (F.size(grown) >= most)
        return F.struct(F.when(closes, F.concat(a["done"], F.array(F.array_join(grown, " ")))).otherwise(a["done"]).alias("done"), F.when(closes, F.array().cast("array<string>")).otherwise(grown).alias("open"))

    return F.aggregate(tokens, zero, step, lambda a: F.when(F.size(a["open"]) > 0, F.concat(a["done"], F.array(F.array_join(a["open"], " ")))).otherwise(a["done"]))
