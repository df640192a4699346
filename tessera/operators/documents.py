"""Semi-structured documents: path cascades, capacities, merged values, flat rows of sections, objects inside pages."""

from __future__ import annotations

import json
import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

CAPACITY = "(?i)([0-9]+(?:\\.[0-9]+)?)\\s*(TB|GB)"


def lines_at(doc: Column, *paths: str) -> Column:
    """Lines at each of the paths of a JSON text, in the paths' order: lists by item, a text as one line.

    Absent paths, nulls in lists, objects and texts that are no JSON give no lines; a null text gives an empty array.
    """
    v = F.try_parse_json(doc)
    none = F.array().cast("array<string>")

    def at(path: str) -> Column:
        text = F.when(F.schema_of_variant(F.try_variant_get(v, path, "variant")) == "STRING", F.try_variant_get(v, path, "string"))
        return F.coalesce(F.array_compact(F.try_variant_get(v, path, "array<string>")), F.when(text.isNotNull(), F.array(text)), none)

    return F.concat(*[at(p) for p in paths])


def largest_capacity(lines: Column) -> Column:
    """The greatest capacity named in the lines, such as '2TB' or '1.5TB'; the first one on ties, null without one."""
    found = F.flatten(F.transform(lines, lambda x: F.regexp_extract_all(x, F.lit(CAPACITY), F.lit(0))))

    def sized(x: Column, i: Column) -> Column:
        n, unit = F.regexp_extract(x, CAPACITY, 1).cast("double"), F.upper(F.regexp_extract(x, CAPACITY, 2))
        label = F.concat(F.when(n == F.floor(n), F.floor(n).cast("string")).otherwise(n.cast("string")), unit)
        return F.struct((n * F.when(unit == "TB", 1024).otherwise(1)).alias("gb"), (-i).alias("i"), label.alias("label"))

    return F.array_max(F.transform(found, sized))["label"]


def merge_values(old: Column, new: Column) -> Column:
    """Two cells as one: two JSON arrays as one array of distinct items, other texts joined by '; '. An empty or null old cell gives the new one."""
    listed = lambda c: F.when(c.startswith("[") & c.endswith("]"), F.from_json(c, "array<string>"))
    items = F.array_distinct(F.concat(listed(old), listed(new)))
    quoted = F.transform(items, lambda x: F.when(x.isNull(), "null").otherwise(_quoted(x)))
    return (
        F.when(F.coalesce(old, F.lit("")) == "", new).when(items.isNotNull(), F.concat(F.lit("["), F.array_join(quoted, ", "), F.lit("]")))
        .otherwise(F.btrim(F.concat(old, F.lit("; "), F.coalesce(new, F.lit(""))), F.lit("; ")))
    )


def _quoted(x: Column) -> Column:
    """A text as JSON."""
    return F.regexp_extract(F.to_json(F.array(x)), "(?s)^\\[(.*)\\]$", 1)


def flat_sections(sections: Column, order: list[str], renames: dict[str, dict[str, str]] | None = None) -> Column:
    """One map of a map of sections: known sections first in the given order, then the others in theirs.

    A key that is taken already gets its section's name before it; a name taken even so is set again. renames: for a
    section, its keys' names in the result. Null sections are empty.
    """
    known = F.array(*map(F.lit, order))
    rest = F.filter(F.map_keys(sections), lambda k: ~F.array_contains(known, k))
    names = F.concat(F.filter(known, lambda k: F.map_contains_key(sections, k)), rest)
    pairs = F.flatten(F.transform(names, lambda s: F.transform(F.map_entries(F.coalesce(sections[s], F.create_map().cast("map<string,string>"))), lambda e: F.struct(s.alias("s"), e["key"].alias("k"), e["value"].alias("v")))))
    zero = F.array().cast("array<struct<k:string,v:string>>")

    def named(p: Column) -> Column:
        out = p["k"]
        for section, keys in (renames or {}).items():
            for old, new in keys.items():
                out = F.when((p["s"] == section) & (p["k"] == old), new).otherwise(out)
        return out

    def step(done: Column, p: Column) -> Column:
        taken = F.exists(done, lambda d: d["k"] == named(p))
        k = F.when(taken, F.concat_ws(" ", p["s"], p["k"])).otherwise(named(p))
        return F.concat(F.filter(done, lambda d: d["k"] != k), F.array(F.struct(k.alias("k"), p["v"].alias("v"))))

    return F.map_from_entries(F.aggregate(pairs, zero, step))


#: What matters for nesting: whole strings, quotes that never close, braces.
_TOKENS = re.compile(r'"(?:\\.|[^"\\])*"|\'(?:\\.|[^\'\\])*\'|["\'{}]', re.DOTALL)


def _object_after(text: str, marker: str) -> str | None:
    at = text.find(marker)
    start = text.find("{", at) if at >= 0 else -1
    if start < 0:
        return None
    depth = 0
    for m in _TOKENS.finditer(text, start):
        token = m.group()
        if token in "\"'":
            return None
        depth += (token == "{") - (token == "}")
        if not depth:
            try:
                json.loads(found := text[start : m.end()])
                return found
            except (ValueError, RecursionError):
                return None
    return None


def embedded_object(col: Column, marker: str) -> Column:
    """The JSON object that begins at the first brace after a marker in a page; null without one or if it does not parse."""

    @F.pandas_udf("string")
    def find(texts: pd.Series) -> pd.Series:
        return pd.Series([None if t is None else _object_after(t, marker) for t in texts], dtype=object)

    return find(col)
