"""Set, bag and map comparison as column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of a value that is worked out once, however often body names it."""
    return F.try_element_at(F.transform(F.array(value), body), F.lit(1))


def missing(expected: Column, actual: Column) -> Column:
    """Sorted distinct expected items that are not in actual."""
    return F.array_sort(F.array_except(expected, actual))


def bag_missing(expected: Column, actual: Column) -> Column:
    """Sorted expected items that are not in actual, repeats kept."""
    return F.array_sort(F.filter(expected, lambda x: ~F.array_contains(actual, x)))


def duplicates(items: Column) -> Column:
    """Sorted items that occur more than once."""
    return F.array_sort(F.filter(F.array_distinct(items), lambda x: F.size(F.filter(items, lambda y: y == x)) > 1))


def same_set(a: Column, b: Column) -> Column:
    return F.array_sort(F.array_distinct(a)).eqNullSafe(F.array_sort(F.array_distinct(b)))


def strict_subset(a: Column, b: Column) -> Column:
    return (F.size(F.array_except(a, b)) == 0) & (F.size(F.array_except(b, a)) > 0)


def overlap_percent(expected: Column, actual: Column) -> Column:
    return F.round(100.0 * F.size(F.array_intersect(expected, actual)) / F.nullif(F.size(F.array_distinct(expected)), F.lit(0)), 1)


def map_diff(a: Column, b: Column) -> Column:
    """Sorted keys whose values differ or that one side lacks."""
    keys = F.array_union(F.map_keys(a), F.map_keys(b))
    return F.array_sort(F.filter(keys, lambda k: ~F.try_element_at(a, k).eqNullSafe(F.try_element_at(b, k))))


def clean(items: Column) -> Column:
    """Sorted distinct items that are not null."""
    return F.array_sort(F.array_distinct(F.array_compact(items)))


def same_bag(a: Column, b: Column) -> Column:
    """Whether both hold the same items as often."""
    return F.array_sort(a).eqNullSafe(F.array_sort(b))
