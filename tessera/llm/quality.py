"""Quality rules as a short-circuit cascade.

Each rule is a cheap or costly test of one document: counting signs costs little, counting repeated windows of words a
hundred times as much. On a bounded random sample its cost and its rejections are measured, on the executors; rules then
run in order of rejection per cost, and a document leaves at the first rule that rejects it, before the figures of later
rules are computed. The verdict does not depend on the order.
"""

from __future__ import annotations

import re
import time
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cached_property

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import WORDS, bounded_batches

SYMBOLS = "#*$%&|<>"
_UPPER = re.compile(r"[A-ZÀ-ÖØ-Þ]+")
_LETTER = re.compile(r"[A-Za-zÀ-ÖØ-öø-ÿ]+")


class Stats:
    """Figures of one text, each computed when first asked for. A null text has no words and no lines."""

    def __init__(self, text: str | None):
        self.text = text or ""

    @cached_property
    def words(self) -> list[str]:
        return WORDS.findall(self.text)

    @cached_property
    def n_words(self) -> int:
        return len(self.words)

    @cached_property
    def word_chars(self) -> int:
        return sum(map(len, self.words))

    @cached_property
    def n_symbols(self) -> int:
        return sum(map(self.text.count, SYMBOLS))

    @cached_property
    def lines(self) -> list[str]:
        return [x for x in self.text.split("\n") if WORDS.search(x)]

    @cached_property
    def n_dup_lines(self) -> int:
        return len(self.lines) - len(set(self.lines))

    def covered(self, k: int) -> int:
        """Words in windows of k words that occur twice or more."""
        w = self.words
        grams = list(zip(*(w[i:] for i in range(k))))
        if len(set(grams)) == len(grams):
            return 0
        count = Counter(grams)
        covered = bytearray(len(w))
        for i, g in enumerate(grams):
            if count[g] > 1:
                covered[i : i + k] = b"\1" * k
        return sum(covered)

    @cached_property
    def n_repeat_words(self) -> int:
        return self.covered(3)

    @cached_property
    def n_long_repeats(self) -> int:
        return self.covered(8)

    @cached_property
    def n_top_pair(self) -> int:
        return max(Counter(zip(self.words, self.words[1:])).values(), default=0)

    @cached_property
    def n_upper(self) -> int:
        return sum(map(len, _UPPER.findall(self.text)))

    @cached_property
    def n_letters(self) -> int:
        return sum(map(len, _LETTER.findall(self.text)))


@dataclass(frozen=True)
class Rule:
    name: str
    rejects: Callable[[Stats], bool]


TOO_SHORT = Rule("too_short", lambda s: s.n_words < 50)
REPETITIVE = Rule("repetitive", lambda s: 100 * s.n_repeat_words > 50 * s.n_words)
RULES = (
    Rule("symbols", lambda s: 100 * s.n_symbols > 30 * s.n_words),
    Rule("shouting", lambda s: 100 * s.n_upper > 60 * s.n_letters),
    Rule("exclaiming", lambda s: 100 * s.text.count("!") > 50 * s.n_words),
    Rule("dup_lines", lambda s: 2 * s.n_dup_lines > len(s.lines)),
    Rule("word_length", lambda s: s.word_chars < 2 * s.n_words or s.word_chars > 15 * s.n_words),
    Rule("one_pair", lambda s: 100 * s.n_top_pair > 10 * s.n_words and s.n_top_pair > 1),
    Rule("long_repeats", lambda s: 100 * s.n_long_repeats > 40 * s.n_words),
)


def measure(texts: list[str | None], rules: tuple[Rule, ...], first: tuple[Rule, ...] = ()) -> dict[str, tuple[float, int]]:
    """Seconds and rejections of each rule over the texts that no rule of `first` rejects; each rule pays for its own figures beyond those of `first`."""
    out = {r.name: (0.0, 0) for r in rules}
    for t in texts:
        base = Stats(t)
        if any([r.rejects(base) for r in first]):
            continue
        for r in rules:
            s = Stats(t)
            s.__dict__.update(base.__dict__)
            began = time.perf_counter()
            rejected = bool(r.rejects(s))
            out[r.name] = (out[r.name][0] + time.perf_counter() - began, out[r.name][1] + rejected)
    return out


def order_rules(measured: dict[str, tuple[float, int]], rules: tuple[Rule, ...]) -> tuple[Rule, ...]:
    """Rules by rejection per cost, highest first; rules that rejected nothing go by cost, the cheapest first."""
    return tuple(sorted(rules, key=lambda r: (-measured[r.name][1] / max(measured[r.name][0], 1e-9), measured[r.name][0])))


def sampled_order(df: DataFrame, rules: tuple[Rule, ...], first: tuple[Rule, ...], text: str, key: str, sample_rows: int) -> tuple[Rule, ...]:
    """The order that a sample gives: the rows of the sample_rows ids of least hash. Ids are picked without reading texts, and texts stay on the executors."""
    ids = [r[0] for r in df.select(key).filter(F.col(key).isNotNull()).distinct().orderBy(F.xxhash64(key), key).limit(sample_rows).collect()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left, total = sample_rows, Counter()
        for b in batches:
            got = measure(b.column(0).slice(0, left).to_pylist(), rules, first)
            left -= min(left, b.num_rows)  # an id that repeats may stand in more rows
            for name, (cost, rejected) in got.items():
                total[name, "cost"] += cost
                total[name, "rejected"] += rejected
        names = [r.name for r in rules]
        yield pa.RecordBatch.from_arrays([pa.array(names), pa.array([float(total[x, "cost"]) for x in names]), pa.array([total[x, "rejected"] for x in names], pa.int64())], names=["rule", "cost", "rejected"])

    got = df.filter(F.col(key).isin(ids)).select(text).mapInArrow(run, "rule string, cost double, rejected long")
    sums = {r.rule: (r.cost, r.rejected) for r in got.groupBy("rule").agg(F.sum("cost").alias("cost"), F.sum("rejected").alias("rejected")).collect()}
    return order_rules({r.name: sums.get(r.name, (0.0, 0)) for r in rules}, rules)


def cascade(df: DataFrame, rules: tuple[Rule, ...] = (TOO_SHORT, REPETITIVE, *RULES), text: str = "text", key: str = "doc_id", figures: tuple[str, ...] = (), first: tuple[Rule, ...] = (), sample_rows: int = 256) -> DataFrame:
    """One row for each input row: key, the figures asked for (long), first_failed (of `first`), kept.

    first: rules that are tested before the cascade, in their order. sample_rows bounds the ids on whose rows costs and
    rejections are estimated. Null and empty texts have no words: every figure is 0. Repeated rows are judged alike,
    whole texts of any length are read; an empty table gives no rows; other columns are not read.
    """
    bounded_batches(df.sparkSession)
    ordered = sampled_order(df, rules, first, text, key, sample_rows)
    kind = df.schema[key].dataType.simpleString()

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cols: list[list] = [[] for _ in range(len(figures) + 2)]
            for t in b.column(1):
                s = Stats(t.as_py())
                failed = any(r.rejects(s) for r in first)
                cols[-2].append(failed)
                cols[-1].append(not failed and not any(r.rejects(s) for r in ordered))
                for c, f in zip(cols, figures):
                    c.append(getattr(s, f))
            types = [pa.int64()] * len(figures) + [pa.bool_()] * 2
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, t) for c, t in zip(cols, types))], names=[key, *figures, "first_failed", "kept"])

    schema = f"{key} {kind}, " + "".join(f"{f} long, " for f in figures) + "first_failed boolean, kept boolean"
    return df.select(key, text).mapInArrow(judge, schema)
