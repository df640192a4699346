"""Specification documents: keys at any depth, values scoped by capacity, normalised and compared text."""

from __future__ import annotations

import difflib
import json
import re
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.arrays import let


def _first(node, key: str):
    """The first value that is not empty under `key` in any case, depth first; an empty one ends the search of its object."""
    frames, end = [iter([(None, node)])], object()
    while frames:
        k, at = next(frames[-1], (None, end))
        if at is end:
            frames.pop()
        elif k is not None and k.strip().lower() == key:
            if at:
                return at
            frames.pop()
        elif isinstance(at, dict):
            frames.append(iter(at.items()))
        elif isinstance(at, list):
            frames.append(iter([(None, v) for v in at]))
    return None


def first_value(col: Column, key: str) -> Column:
    """The value under a key at any depth of a JSON text, of a list its first element; null for broken JSON, other types and no hit."""
    value = nested_value(col, key, loose=False)
    listed = F.from_json(F.when(value.startswith("["), value), "array<string>")
    return F.when(listed.isNotNull(), F.get(listed, F.lit(0))).when(~value.startswith("{"), value)


def nested_value(col: Column, key: str, loose: bool = True) -> Column:
    """The first value that is not empty under a key at any depth of a JSON text; other types than text as JSON.

    loose: single quotes are tried as double ones where the text does not parse, and a text without a hit is searched for
    "key": "value" as it stands, in this case. Null and no hit give null.
    """
    plain = re.compile(rf'"{re.escape(key)}"\s*:\s*"([^"]+)"')

    @F.pandas_udf("string")
    def search(texts: pd.Series) -> pd.Series:
        out = []
        for t in texts:
            found = None
            if t is not None:
                for attempt in (t, t.replace("'", '"')) if loose else (t,):
                    try:
                        found = _first(json.loads(attempt), key.lower())
                        break
                    except (ValueError, RecursionError):
                        continue
                if loose and found is None and (m := plain.search(t)):
                    found = m.group(1)
            out.append(found if found is None or isinstance(found, str) else json.dumps(found))
        return pd.Series(out, dtype=object)

    return search(col)


_CAP = "[0-9]+(?:\\.[0-9]+)? *[MGT]B"
#: A line such as '256GB — 150 TBW' or '512GB–2TB — 300 TBW'.
SCOPED = f"(?i)^({_CAP})(?: *[-–] *({_CAP}))? *[—:] *(.+)$"


def scoped_values(lines: Column, capacities: Column) -> Column:
    """Map of capacity to value from lines of a specification cell.

    A line that names a capacity, or a range of them in the given order, holds for these; lines before it that name
    none are put before its value; the last line for a capacity counts. Where no line names a known capacity the whole
    cell holds for every one.
    """
    plain = lambda c: F.upper(F.regexp_replace(c, "\\s", ""))
    zero = F.struct(F.array().cast("array<string>").alias("before"), F.array().cast("array<struct<cap:string,value:string>>").alias("got"))

    def stepped(a: Column, line: Column, capacities: Column, low: Column, high: Column) -> Column:
        hit = (low > 0) & (high > 0)
        value = F.array_join(F.concat(a["before"], F.array(F.regexp_extract(line, SCOPED, 3))), " | ")
        at = F.slice(capacities, F.greatest(F.least(low, high), F.lit(1)).cast("int"), (F.abs(high - low) + 1).cast("int"))
        new = let(value, lambda v: F.transform(at, lambda c: F.struct(c.alias("cap"), v.alias("value"))))
        return F.struct(F.when(hit, a["before"]).otherwise(F.concat(a["before"], F.array(line))).alias("before"), F.when(hit, F.concat(a["got"], new)).otherwise(a["got"]).alias("got"))

    def step(capacities: Column, known: Column):
        def one(a: Column, line: Column) -> Column:
            place = lambda c: F.array_position(known, plain(c))
            second = lambda low: let(F.regexp_extract(line, SCOPED, 2), lambda s: F.when(s == "", low).otherwise(place(s)))
            return let(place(F.regexp_extract(line, SCOPED, 1)), lambda low: let(second(low), lambda high: stepped(a, line, capacities, low, high)))

        return one

    def finish(a: Column, lines: Column, capacities: Column) -> Column:
        last = lambda c: F.try_element_at(F.filter(a["got"], lambda g: g["cap"] == c), F.lit(-1))["value"]
        scoped = F.filter(F.transform(F.array_distinct(capacities), lambda c: F.struct(c.alias("cap"), last(c).alias("value"))), lambda s: s["value"].isNotNull())
        whole = let(F.array_join(lines, " | "), lambda v: F.transform(F.array_distinct(capacities), lambda c: F.struct(c.alias("cap"), v.alias("value"))))
        return F.map_from_entries(F.when(F.size(a["got"]) > 0, scoped).otherwise(whole))

    got = lambda ls, caps: let(F.transform(caps, plain), lambda known: F.aggregate(ls, zero, step(caps, known), lambda a: finish(a, ls, caps)))
    return let(lines, lambda ls: let(capacities, lambda caps: got(ls, caps)))


@F.pandas_udf(T.StringType())
def nfkc(texts: pd.Series) -> pd.Series:
    """Compatibility composition, case folded, white space squeezed; null stays null."""
    return texts.map(lambda t: None if t is None else " ".join(unicodedata.normalize("NFKC", t).casefold().split()))


@F.pandas_udf(T.DoubleType())
def similarity(a: pd.Series, b: pd.Series) -> pd.Series:
    """Matching-blocks ratio of two texts, 0 to 1; null if either is null."""
    return pd.Series([None if x is None or y is None else difflib.SequenceMatcher(None, x, y).ratio() for x, y in zip(a, b)], dtype="float64")
