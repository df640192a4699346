"""Token counts of texts under a sentencepiece BPE vocabulary, by merging ragged arrays.

A text, led by the space mark, is cut into pre-tokens at borders that no piece of the vocabulary crosses. The distinct
pre-tokens of a block that the worker has not met lie one after another in flat numpy arrays (symbol, weight, sequence).
In each round every sequence merges its pair of the lowest rank, all sequences at once; a sequence without a mergeable
pair leaves with the number of its symbols. Characters outside the vocabulary count as their UTF-8 bytes.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import CACHES, bounded_batches, column_udf
from tessera.llm.tokens import CACHE_ENTRIES

#: The sign that sentencepiece writes for a space.
MARK = "▁"
#: The rank of a pair that no piece spells.
NEVER = np.iinfo(np.int32).max
#: Texts are cut into pre-tokens in blocks of about this many characters.
BLOCK = 1 << 20
#: Pre-tokens longer than this are counted but not remembered.
REMEMBERED = 64
_BORDER = re.compile("[^ ] ")


class PieceCounter:
    """counts(texts) gives each text's number of tokens; null and empty texts have none."""

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        rules = model.normalizer_spec
        kinds = type(model.pieces[0])
        found = {p.piece: p.score for p in model.pieces if p.type == kinds.NORMAL}
        plain = rules.add_dummy_prefix and rules.escape_whitespaces and not rules.remove_extra_whitespaces and not rules.precompiled_charsmap
        odd = any(p.type in (kinds.USER_DEFINED, kinds.UNUSED) for p in model.pieces)
        crossed = any(re.search(f"[^{MARK}]{MARK}", p) for p in found)
        if model.trainer_spec.model_type != model.trainer_spec.BPE or not model.trainer_spec.byte_fallback or not plain or odd or crossed:
            raise ValueError(f"{path}: only BPE models with byte fallback, marked spaces and no other normalisation are counted")
        self._tables(found)
        self.known: dict[str, int] = {}
        self._cutter(found)

    def _tables(self, found: dict[str, float]) -> None:
        ids = {p: i for i, p in enumerate(found)}
        for c in sorted(set("".join(found))):
            ids.setdefault(c, len(ids))
        self.unknown = len(ids)
        self.width = np.int64(len(ids) + 1)
        self.char = np.full(0x110000, self.unknown, np.int32)
        self.is_piece = np.zeros(0x110000, bool)
        for c, i in ids.items():
            if len(c) == 1:
                self.char[ord(c)], self.is_piece[ord(c)] = i, c in found
        ranks = dict(zip(found, np.unique([-s for s in found.values()], return_inverse=True)[1].tolist()))
        pairs = {ids[p[:k]] * int(self.width) + ids[p[k:]]: (ranks[p], ids[p]) for p in found for k in range(1, len(p)) if p[:k] in ids and p[k:] in ids}
        self.keys = np.array(sorted(pairs), np.int64)
        self.ranks, self.merged = np.array([pairs[k] for k in self.keys.tolist()], np.int32).T.copy()
        self.inner = np.array(sorted({(ord(a) << 21) | ord(b) for p in found for a, b in zip(p, p[1:])}), np.int64)

    def _cutter(self, found: dict[str, float]) -> None:
        """Pre-tokens: signs that no longer piece holds stand alone; else marks and what follows up to the next mark."""
        longer = set("".join(p for p in found if len(p) > 1))
        alone = "".join(c for c in map(chr, range(128)) if c not in longer)
        inside = f"[^{MARK}{re.escape(alone)}]" if alone else f"[^{MARK}]"
        # The lowest rank of all belongs to runs of marks: they grow from the left to the longest run that is a piece,
        # so a run is cut there, before its last mark, which a word may take.
        blank = [p for p in found if not p.strip(MARK) and len(p) > 1]
        most = max(map(len, blank), default=1)
        words = f"{MARK}*{inside}+|{MARK}+"
        self.cut = re.compile(words)
        if len({found[p] for p in blank}) == 1 and found[blank[0]] == min(found.values()) and self._merge([MARK * most])[0] == 1:
            words = f"{MARK}{{{most}}}(?={MARK})|{words.replace(f'{MARK}*', f'{MARK}{{0,{most}}}')}"
        self.cut = re.compile(f"{words}|[{re.escape(alone)}]" if alone else words)

    def _pairs(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        key = left * self.width + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        there = self.keys[at] == key
        return np.where(there, self.ranks[at], NEVER), self.merged[at]

    def _merge(self, tokens: list[str]) -> np.ndarray:
        """The number of symbols left of each of the pre-tokens, which are not empty."""
        points = np.frombuffer("".join(tokens).encode("utf-32-le"), "<u4").astype(np.int64)
        owner = np.repeat(np.arange(len(tokens)), [len(t) for t in tokens])
        sym = self.char[points]
        weight = np.where(self.is_piece[points], 1, 1 + (points > 0x7F) + (points > 0x7FF) + (points > 0xFFFF))
        # A border that no piece crosses starts a sequence of its own.
        inner = (points[:-1] << 21) | points[1:]
        at = np.minimum(np.searchsorted(self.inner, inner), len(self.inner) - 1)
        starts = np.ones(len(points), bool)
        starts[1:] = (owner[1:] != owner[:-1]) | (self.inner[at] != inner)
        seq = np.cumsum(starts) - 1
        owner = owner[starts]
        rank, to = self._pairs(sym[:-1].astype(np.int64), sym[1:])
        rank, to = np.append(rank, NEVER), np.append(to, 0)
        rank[:-1][starts[1:]] = NEVER
        total = np.zeros(len(tokens), np.int64)
        while len(sym):
            first = np.flatnonzero(np.append(True, seq[1:] != seq[:-1]))
            low = np.minimum.reduceat(rank, first)
            low = np.repeat(low, np.diff(np.append(first, len(sym))))
            if (low == NEVER).any():
                over = low == NEVER
                np.add.at(total, owner[seq[over]], weight[over])
                sym, weight, seq, rank, to, low = (x[~over] for x in (sym, weight, seq, rank, to, low))
                if not len(sym):
                    break
            take = self._chosen(sym, seq, rank, to, np.flatnonzero(rank == low))
            sym[take], weight[take] = to[take], 1
            stays = np.ones(len(sym), bool)
            stays[take + 1] = False
            now = np.cumsum(stays)[take] - 1
            sym, weight, seq, rank, to = (x[stays] for x in (sym, weight, seq, rank, to))
            changed = np.zeros(len(sym) + 1, bool)
            changed[now] = changed[now - 1] = True  # the last place stands for the one before the first
            self._renew(sym, seq, rank, to, np.flatnonzero(changed[:-1]))
        return total

    def _chosen(self, sym: np.ndarray, seq: np.ndarray, rank: np.ndarray, to: np.ndarray, hits: np.ndarray) -> np.ndarray:
        """The places that merge in this round, from left to right in each sequence: none overlaps the one before, and
        none comes after one that makes a pair of the same or a lower rank, which goes first."""
        n = np.arange(len(hits))
        begins = np.append(True, hits[1:] != hits[:-1] + 1)
        take = hits[(n - np.maximum.accumulate(np.where(begins, n, 0))) % 2 == 0]
        new, r, s = to[take].astype(np.int64), rank[take], seq[take]
        before = sym[np.maximum(take - 1, 0)].astype(np.int64)
        near = np.append(False, take[1:] == take[:-1] + 2)
        before[near] = new[:-1][near[1:]]
        soon = np.zeros(len(take), bool)
        with_left = (take > 0) & (seq[np.maximum(take - 1, 0)] == s)
        soon[with_left] = self._pairs(before[with_left], new[with_left])[0] <= r[with_left]
        after = np.minimum(take + 2, len(sym) - 1)
        with_right = (take + 2 < len(sym)) & (seq[after] == s)
        soon[with_right] |= self._pairs(new[with_right], sym[after[with_right]])[0] <= r[with_right]
        earlier = np.cumsum(soon) - soon
        starts = np.append(True, s[1:] != s[:-1])
        return take[earlier == np.maximum.accumulate(np.where(starts, earlier, 0))]

    def _renew(self, sym: np.ndarray, seq: np.ndarray, rank: np.ndarray, to: np.ndarray, at: np.ndarray) -> None:
        rank[at] = NEVER
        at = at[at + 1 < len(sym)]
        at = at[seq[at] == seq[at + 1]]
        rank[at], to[at] = self._pairs(sym[at].astype(np.int64), sym[at + 1])

    def _block(self, texts: list[str]) -> list[int]:
        """The tokens of some marked texts, whose new pre-tokens are merged together."""
        known, cut = self.known, [self.cut.findall(t) for t in texts]
        if new := set().union(*cut).difference(known):
            if len(known) + len(new) > CACHE_ENTRIES:
                known.clear()
                new = set().union(*cut)
            ordered = list(new)
            known.update(zip(ordered, self._merge(ordered).tolist()))
        out = [sum(map(known.__getitem__, tokens)) for tokens in cut]
        for t in new:
            if len(t) > REMEMBERED:
                del known[t]
        return out

    def counts(self, texts: list[str | None]) -> list[int]:
        """The tokens of each text, in blocks of about BLOCK characters; a longer text is cut before spaces."""
        out, at, block, size = [0] * len(texts), [], [], 0
        for i, text in enumerate(texts):
            start, lead = 0, MARK
            while text and start < len(text):
                border = _BORDER.search(text, start + BLOCK) if len(text) - start > BLOCK else None
                end = border.end() - 1 if border else len(text)
                at.append(i)
                block.append(lead + text[start:end].replace(" ", MARK))
                start, lead, size = end, "", size + end - start
                if size > BLOCK:
                    for k, n in zip(at, self._block(block)):
                        out[k] += n
                    at, block, size = [], [], 0
        for k, n in zip(at, self._block(block)):
            out[k] += n
        return out


_COUNTERS: dict[str, PieceCounter] = {}
CACHES["counters"] = _COUNTERS


def counter(path: str) -> PieceCounter:
    """The worker's counter of a vocabulary file."""
    if path not in _COUNTERS:
        _COUNTERS[path] = PieceCounter(path)
    return _COUNTERS[path]


def count_tokens(df: DataFrame, path: str, text: str = "text", name: str = "n_tokens") -> DataFrame:
    """df with the number of tokens of each whole text (long), without begin and end tokens.

    Null and empty texts have none; strings of special tokens are ordinary text. Each row is counted on its own: ties and
    repeated rows alike, an empty table gives no rows, all other columns stay; a column `name` is replaced. Nothing is
    shuffled; a worker holds one Arrow batch (about 4 MB, or one row) and at most CACHE_ENTRIES pre-tokens.
    """
    bounded_batches(df.sparkSession)

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        c = counter(path)
        for b in batches:
            yield pa.array(c.counts(b.to_pylist()), pa.int64())

    return df.withColumn(name, column_udf(run, "bigint", "counters")(F.col(f"`{text}`")))
