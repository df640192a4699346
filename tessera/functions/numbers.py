"""Units and safe numbers as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_int(col: Column) -> Column:
    """An integer from text such as '12' or '12.0'; null otherwise."""
    return col.cast("string").try_cast("double").try_cast("int")


def capacity_mb(col: Column) -> Column:
    """Megabytes of '1.5 TB', '16GB' or '512 MB'; null otherwise."""
    n = F.regexp_extract(F.upper(F.trim(col)), "^([0-9]+(?:\\.[0-9]+)?) *(MB|GB|TB)$", 1).try_cast("double")
    unit = F.regexp_extract(F.upper(F.trim(col)), "(MB|GB|TB)$", 1)
    return n * F.when(unit == "MB", 1).when(unit == "GB", 1024).when(unit == "TB", 1048576)


def divides(a: Column, b: Column) -> Column:
    """Whether a is a multiple of b; null where b is 0 or null."""
    return F.try_mod(a, b) == 0


def percent(part: Column, whole: Column, digits: int = 1) -> Column:
    return F.round(100.0 * part / F.nullif(whole, F.lit(0)), digits)


def band(col: Column, high: float = 75, middle: float = 50) -> Column:
    return F.when(col >= high, "HIGH").when(col >= middle, "MEDIUM").otherwise("LOW")
