"""Toxicity by a weighted lexicon.

Texts are folded (case, accents, homoglyphs, digits put for letters) and matched with one Aho-Corasick automaton that
holds lexicon stems and exception phrases. The sum of the weights of what matched, divided by a slowly growing function
of the length, goes through a logistic curve. Stems, weights and the curve are learned from a bounded labelled sample.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import bounded_batches, column_udf, discard, materialise, trimmed

#: Letters that look like Latin ones, and digits and signs put for letters.
LOOKALIKES = str.maketrans("асеорхуіјѕԁһԛԝαβεικνορτυχмткнв0134578@$€", "aceopxyijsdhqwabeiknoptuxmtkhboieastbase")
_ALIKE = re.compile("[" + "".join(map(chr, LOOKALIKES)) + "]")
_DIGITS = bytes(LOOKALIKES.get(c, c) for c in range(256))
_MARKS = re.compile(r"[\u0300-\u036f]+")
_BREAKS = re.compile(r"[^a-z0-9]+")
#: Rows handed back at a time.
SLICE = 1024
#: No stem counts below this log-likelihood ratio (chance 0.0025 a stem), however few the labelled rows are.
LEAST_EVIDENCE = 12.0
#: Phrases in which a stem is not an insult.
EXCEPTIONS = ("trash can", "trash bin", "clown fish", "clownfish", "trash collection")


def fold(text: str | None) -> str:
    """Folded words, each with one space before and after; '' as words for null and empty texts."""
    t = (text or "").lower()
    if not t.isascii():
        t = _MARKS.sub("", unicodedata.normalize("NFKD", t))
    if t.isascii():
        t = t.encode().translate(_DIGITS).decode()
    elif _ALIKE.search(t):
        t = t.translate(LOOKALIKES)
    return f" {_BREAKS.sub(' ', t)} "


def stems(text: str | None) -> set[str]:
    """Whole folded words and their first 4 to 9 letters, each after a space; whole words end with a space too."""
    out = set()
    for w in set(fold(text).split()):
        out.add(f" {w} ")
        out.update(f" {w[:k]}" for k in range(4, min(9, len(w)) + 1))
    return out


@dataclass(frozen=True)
class Lexicon:
    weights: dict[str, float]
    exceptions: tuple[str, ...]
    slope: float
    middle: float

    def automaton(self):
        import ahocorasick

        a = ahocorasick.Automaton()
        for stem, w in self.weights.items():
            a.add_word(stem, w)
        for phrase in self.exceptions:  # what the phrase's own stems add is taken off again
            key = f" {phrase}"
            inside = sum(w for s, w in self.weights.items() if s in f"{key} ")
            if inside:
                a.add_word(key, self.weights.get(key, 0.0) - inside)
        if len(a):
            a.make_automaton()
        return a

    def raw(self, automaton, text: str | None) -> float:
        folded = fold(text)
        total = sum(w for _, w in automaton.iter(folded)) if len(automaton) else 0.0
        return max(0.0, total) / (1 + math.log1p(len(folded) / 1000))

    def score(self, raw: float) -> float:
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, self.slope * (raw - self.middle)))))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, sample_rows: int, text: str, key: str) -> DataFrame:
    """(text, y) of at most sample_rows labelled rows, a quarter of them of label 1 as far as there are so many.

    Ids come first: those with the least hash of each label; then one scan of the documents against these few ids.
    Ids with several labels count as 1 if any is; null ids and labels are left out.
    """
    y = labels.filter(F.col(key).isNotNull() & F.col(label).isNotNull()).groupBy(key).agg(F.max((F.col(label) > 0).cast("int")).alias("y"))
    ids = [y.filter(F.col("y") == v).orderBy(F.xxhash64(key), key).limit(n) for v, n in ((0, sample_rows - sample_rows // 4), (1, sample_rows // 4))]
    return docs.select(key, text).join(F.broadcast(ids[0].union(ids[1])), key).select(text, "y")  # sample_rows rows at most


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", text: str = "text", key: str = "doc_id", sample_rows: int = 8000, max_stems: int = 3000, evidence: float = 30.0, exceptions: tuple[str, ...] = EXCEPTIONS) -> Lexicon:
    """Learn a lexicon from the labelled rows given (hold out rows before the call).

    Stems are whole words, and beginnings of four letters or more that two words or more share; a beginning that says no
    more than a longer stem gives way to it, so that ordinary words that begin alike do not match. Exception phrases are
    learned beside those given. A stem counts if the log-likelihood ratio of its label counts against chance is above evidence, or, where the rows
    of label 1 are few, above a third of what a stem in all of them and in no other row has. The sample has
    sample_rows rows at most. Counts are gathered on the executors; the driver gets the max_stems stems of
    highest weight and one raw figure for each row of the sample.
    """
    bounded_batches(docs.sparkSession)
    sample = materialise(labelled_sample(docs, labels, label, sample_rows, text, key), "toxic-sample")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pos, neg, n = Counter(), Counter(), [0, 0]
        for b in batches:
            for t, y in zip(b.column(0), b.column(1)):
                y = int(y.as_py() > 0)
                n[y] += 1
                (pos if y else neg).update(stems(t.as_py()))
        keys = list(pos.keys() | neg.keys())
        yield pa.RecordBatch.from_arrays([pa.array([*keys, ""]), pa.array([*(pos[k] for k in keys), n[1]], pa.int64()), pa.array([*(neg[k] for k in keys), n[0]], pa.int64())], names=["stem", "pos", "neg"])

    counts = sample.mapInArrow(trimmed(count), "stem string, pos long, neg long").groupBy("stem").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    weight = F.log((F.col("pos") + 0.5) / (F.col("np") + 1)) - F.log((F.col("neg") + 0.5) / (F.col("nn") + 1))
    counts = materialise(counts, "toxic-stems")
    total = counts.filter("stem = ''").first()
    n_pos, n_neg = (total.pos, total.neg) if total else (0, 0)
    share = max(n_pos, 0.5) / max(n_pos + n_neg, 1)  # of label 1
    least = min(evidence, max(LEAST_EVIDENCE, -2 * n_pos * math.log(share) / 3))

    def side(n: str, expected: float):
        of = F.col(n) / (F.col("pos") + F.col("neg"))
        return F.when(F.col(n) > 0, F.col(n) * F.log(of / expected)).otherwise(0.0)

    weighed = counts.filter("stem != ''").withColumns({"np": F.lit(n_pos), "nn": F.lit(n_neg)}).withColumns({"w": weight, "g": 2 * (side("pos", share) + side("neg", 1 - share))})
    # A beginning counts only where two words or more end differently behind it, each with a quarter of the evidence.
    heads = F.transform(F.sequence(F.lit(5), F.least(F.lit(10), F.length("stem") - 1)), lambda n: F.substr("stem", F.lit(1), n))
    words = weighed.filter(F.endswith("stem", F.lit(" ")) & (F.length("stem") >= 6) & (F.col("w") > 1) & (F.col("g") > least / 4)).select(F.explode(heads).alias("stem"))
    shared = words.groupBy("stem").count().filter("count > 1").select("stem")
    got = weighed.filter((F.col("w") > 2) & (F.col("g") > least))
    got = got.filter(F.endswith("stem", F.lit(" "))).unionByName(got.filter(~F.endswith("stem", F.lit(" "))).join(shared, "stem", "left_semi"))
    weights = chosen([(r.stem, r.w, r.pos) for r in got.orderBy(F.desc("w"), F.length("stem"), "stem").limit(max_stems).collect()])
    exceptions = (*exceptions, *learned_exceptions(sample, Lexicon(weights, (), 1.0, 0.0), n_pos, n_neg))
    lexicon = Lexicon(weights, exceptions, 1.0, 0.0)

    def figures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a = lexicon.automaton()
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([lexicon.raw(a, t.as_py()) for t in b.column(0)], pa.float64()), pa.array([float(y.as_py() > 0) for y in b.column(1)], pa.float64())], names=["x", "y"])

    xy = np.array([(r.x, r.y) for r in sample.mapInArrow(trimmed(figures), "x double, y double").collect()]).reshape(-1, 2)
    slope, middle = logistic(xy[:, 0], xy[:, 1])
    discard(sample, counts)
    return Lexicon(weights, exceptions, slope, middle)


def chosen(stems_: list[tuple[str, float, int]]) -> dict[str, float]:
    """Weights of the stems that stay, of (stem, weight, rows of label 1): of stems in the same rows the longest, the whole word
    last of all; of the others those of which no shorter one that stays says as much."""
    rows: dict[str, int] = {}
    for stem, _, pos in stems_:
        for k in range(5, len(stem)):
            rows[stem[:k]] = max(rows.get(stem[:k], 0), pos)
    weights: dict[str, float] = {}
    for stem, w, _ in sorted((x for x in stems_ if rows.get(x[0], 0) < x[2]), key=lambda x: (len(x[0]), x[0])):
        if not any(weights.get(stem[:k], 0) >= w - 1 for k in range(4, len(stem))):
            weights[stem] = w
    return weights


def learned_exceptions(sample: DataFrame, lexicon: Lexicon, n_pos: int, n_neg: int, rows: int = 3) -> tuple[str, ...]:
    """Phrases of a matched word and a neighbour that speak for label 0: in `rows` rows of label 0 or more and, by its share of
    rows, rarer in those of label 1. Of a word's phrases only those on one side count, so that none is taken off twice."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, found = lexicon.automaton(), Counter()
        for b in batches:
            for t, y in zip(b.column(0), b.column(1)):
                seen, words = set(), fold(t.as_py()).split()
                hit = [len(a) > 0 and any(True for _ in a.iter(f" {w} ")) for w in words]
                for i, h in enumerate(hit):
                    if h:
                        seen.update([(words[i], "next", f"{words[i]} {x}") for x in words[i + 1 : i + 2]] + [(words[i], "before", f"{x} {words[i]}") for x in words[max(i - 1, 0) : i]])
                found.update((*s, int(y.as_py() > 0)) for s in seen)
        keys = list(found)
        cols = [[k[i] for k in keys] for i in range(4)]
        yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.string()) for c in cols[:3]), pa.array(cols[3], pa.int32()), pa.array([found[k] for k in keys], pa.int64())], names=["word", "side", "phrase", "y", "n"])

    counts = sample.mapInArrow(trimmed(count), "word string, side string, phrase string, y int, n long")
    both = counts.groupBy("word", "side", "phrase").agg(F.sum(F.when(F.col("y") == 0, F.col("n")).otherwise(0)).alias("neg"), F.sum(F.when(F.col("y") == 1, F.col("n")).otherwise(0)).alias("pos"))
    kept = both.filter((F.col("neg") >= rows) & (F.col("neg") / max(n_neg, 1) > F.col("pos") / max(n_pos, 1)))
    side = kept.groupBy("word", "side").agg(F.sum("neg").alias("n")).groupBy("word").agg(F.max(F.struct("n", "side"))["side"].alias("side"))
    return tuple(sorted(f"{r.phrase} " for r in kept.join(side, ["word", "side"]).collect()))


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3, steps: int = 50) -> tuple[float, float]:
    """Slope (not negative) and middle of a logistic curve by Newton steps; labels weigh alike. With one label only, no row scores 0.5.

    Figures that do not tell the labels apart give a curve on which every text scores below 0.5.
    """
    if not len(x) or y.min() == y.max():
        return 1.0, 30.0 if not len(x) or y.max() == 0 else -30.0
    if x.min() == x.max():
        return 1.0, math.inf
    w = np.where(y > 0, 0.5 / (y > 0).sum(), 0.5 / (y == 0).sum()) * len(x)
    scale = max(x.std(), 1e-9)
    a = np.stack([x / scale, np.ones_like(x)], 1)
    beta = np.zeros(2)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a @ beta, -30, 30)))
        grad = a.T @ (w * (p - y)) + ridge * len(x) * beta
        hess = (a * (w * p * (1 - p))[:, None]).T @ a + ridge * len(x) * np.eye(2)
        beta -= np.linalg.solve(hess, grad)
    slope = beta[0] / scale
    if slope <= 1e-6:
        return 1.0, math.inf
    return float(slope), float(-beta[1] / slope)


def score(df: DataFrame, lexicon: Lexicon, text: str = "text", name: str = "toxicity") -> DataFrame:
    """All columns of df and the score, a double from 0 to 1 (higher: toxic likelier). Null and empty texts score as no match.

    A column of df with that name is replaced; no other is touched, and only the text goes to Python. Repeated rows score
    alike, whole texts of any length are read, an empty table gives no rows.
    """

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        a = lexicon.automaton()
        for b in (whole.slice(i, SLICE) for whole in batches for i in range(0, len(whole), SLICE)):
            yield pa.array([lexicon.score(lexicon.raw(a, t.as_py())) for t in b], pa.float64())

    bounded_batches(df.sparkSession)
    return df.withColumn(name, column_udf(run, "double")(F.col(f"`{text}`")))
