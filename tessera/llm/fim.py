"""Fill-in-the-middle transformation of documents.

A unit is a longest run of ASCII letters or any other single character. One Aho-Corasick automaton finds the places where
ASCII letters and other characters meet, and the sentinels. Between two places lies one run of letters (one unit) or a
run of others (one unit a character), so the places alone give the number of units and the character at which any unit
ends. Only these figures come out of Python; texts are cut, put together and restored by column expressions.
"""

from __future__ import annotations

import itertools
import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import bounded_batches, column_udf, free_name

#: The marks before prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = SENTINELS = ("<P>", "<S>", "<M>")
_MEET, _SENTINEL = 0, 1


def automaton():
    """Every pair of an ASCII letter and an ASCII other character, both ways, and the sentinels."""
    import ahocorasick

    a = ahocorasick.Automaton()
    others = [c for c in map(chr, range(128)) if c not in string.ascii_letters]
    for x, y in itertools.product(string.ascii_letters, others):
        a.add_word(x + y, _MEET)
        a.add_word(y + x, _MEET)
    for s in SENTINELS:
        a.add_word(s, _SENTINEL)
    a.make_automaton()
    return a


class Units:
    """The runs of one text: where each begins, and the units up to its end."""

    def __init__(self, text: str, events):
        # Any character outside ASCII is a unit like "?", which keeps the number of characters.
        plain = text if text.isascii() else text.encode("ascii", "replace").decode()
        found = np.fromiter(itertools.chain.from_iterable(events.iter(plain)), np.int64).reshape(-1, 2)
        self.has_sentinel = bool((found[:, 1] == _SENTINEL).any())
        self.begins = np.concatenate([[0], found[found[:, 1] == _MEET, 0], [len(text)]])
        sizes = np.diff(self.begins)
        self.letters = np.arange(len(sizes)) % 2 == (plain[:1] not in string.ascii_letters or not plain)
        self.ends = np.cumsum(np.where(self.letters, np.minimum(sizes, 1), sizes))
        self.n = int(self.ends[-1])

    def place(self, units: int) -> int:
        """The number of characters of the first `units` units."""
        if not units:
            return 0
        k = int(np.searchsorted(self.ends, units))
        if self.letters[k]:
            return int(self.begins[k + 1])
        return int(self.begins[k] + units - (self.ends[k - 1] if k else 0))


def transform(df: DataFrame, key: str = "doc_id", text: str = "text", seed: str = "1", plain_percent: int = 10, spm_percent: int = 20, name: str = "fim") -> DataFrame:
    """df with a struct (n, form, prefix_chars, middle_chars, output) for each row.

    The first four 8-digit groups of the sha256 of `seed:key` draw two cuts in units, then plain or not, then spm or psm;
    a null key counts as an empty one. Null texts are empty. A text that is empty or holds a sentinel stays plain, with
    null counts. Rows are independent: repeated rows come out alike, rows that share a key and differ in text share their
    draws, an empty table gives no rows; other columns stay, a column `name` is replaced. Nothing is shuffled.
    """
    bounded_batches(df.sparkSession)

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        events = automaton()
        for b in batches:
            out = []
            for t, h, i in zip(b.field(0), b.field(1).to_pylist(), b.field(2).to_pylist()):
                u = Units(t.as_py(), events)
                a, z = sorted((h % (u.n + 1), i % (u.n + 1)))
                out.append((u.n, u.has_sentinel, u.place(a), u.place(z)))
            n, marked, a, z = map(list, zip(*out)) if out else ([], [], [], [])
            yield pa.StructArray.from_arrays([pa.array(n, pa.int64()), pa.array(marked, pa.bool_()), pa.array(a, pa.int64()), pa.array(z, pa.int64())], names=["n", "marked", "a", "z"])

    whole, cuts, drawn = F.coalesce(F.col(f"`{text}`"), F.lit("")), free_name(df, "_cuts"), free_name(df, "_drawn")
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(f"`{key}`").cast("string"), F.lit(""))).cast("binary"), 256)
    got = df.withColumn(drawn, digest)
    h = [F.conv(F.substring(drawn, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]
    kind = "struct<n: bigint, marked: boolean, a: bigint, z: bigint>"
    got = got.withColumn(cuts, column_udf(run, kind)(F.struct(whole.alias("t"), h[0].alias("h"), h[1].alias("i"))))
    n, a, z = (F.col(f"{cuts}.{x}") for x in ("n", "a", "z"))
    plain = (n == 0) | F.col(f"{cuts}.marked") | (h[2] % 100 >= 100 - plain_percent)
    form = F.when(plain, "plain").when(h[3] % 100 < spm_percent, "spm").otherwise("psm")
    at = lambda start, size: F.substring(whole, start.cast("int"), size.cast("int"))
    prefix, middle, suffix = at(F.lit(1), a), at(a + 1, z - a), at(z + 1, F.length(whole) - z)
    output = F.when(form == "plain", whole).when(form == "psm", F.concat(F.lit(PREFIX), prefix, F.lit(SUFFIX), suffix, F.lit(MIDDLE), middle))
    output = output.otherwise(F.concat(F.lit(SUFFIX), suffix, F.lit(PREFIX), prefix, F.lit(MIDDLE), middle))
    cut = lambda c: F.when(form != "plain", c)
    fields = F.struct(n.alias("n"), form.alias("form"), cut(a).alias("prefix_chars"), cut(z - a).alias("middle_chars"), output.alias("output"))
    return got.withColumn(name, fields).drop(cuts, drawn)


def restore(output: Column, form: Column) -> Column:
    """The text that transform() made an output of: the parts between the marks in their first order."""
    second = F.when(form == "psm", SUFFIX).otherwise(PREFIX)
    head = F.length(F.lit(PREFIX)) + 1
    i, j = F.instr(output, second), F.instr(output, F.lit(MIDDLE))
    first, then, last = F.substr(output, head, i - head), F.substr(output, i + 3, j - i - 3), F.substr(output, j + 3)
    return F.when(form == "plain", output).when(form == "psm", F.concat(first, last, then)).otherwise(F.concat(then, last, first))
