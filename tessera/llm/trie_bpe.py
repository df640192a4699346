"""BPE encoding by a walk over the prefixes that distinct words share.

Greedy-merge BPE has this property: the encoding of a prefix ends with the one token t for which the prefix before t
is encoded with a last token u such that u and t, put side by side, stay as they are. So one state, the last token,
describes the encoding of a prefix. Distinct words, sorted, are the leaves of a trie in depth-first order; the stack of
last tokens along the current path is kept, and only the letters below the branching point are worked out for each word.

Every piece of every text takes this way, white-space runs and other scripts too; the library only splits what is not
plain into pieces. A worker keeps the pieces it has met, so the trie of a block of texts holds the block's new pieces.
"""

from __future__ import annotations

import json
from array import array

import numpy as np

from tessera.llm.tokens import Encoder


class TrieEncoder(Encoder):
    """An Encoder whose new pieces are all encoded by the trie; for byte-level vocabularies without word ends."""

    def _plain(self, path: str):
        return None

    def __init__(self, path: str):
        super().__init__(path)
        model = json.load(open(path, encoding="utf-8"))["model"]
        of, added = self.byte_of, self.library.get_added_tokens_decoder()
        special = {t.content for t in added.values()}
        bytes_of = {t: bytes(of[c] for c in t) for t in model["vocab"] if t not in special}
        self.id_of = {b: model["vocab"][t] for t, b in bytes_of.items()}
        self.longest = max(map(len, self.id_of))
        size = max([*self.id_of.values(), *added]) + 1
        self.table = [b""] * size
        for b, i in self.id_of.items():
            self.table[i] = b
        self.made = [-1] * size  # the rank of the merge that makes a token; -1: none does
        self.left, self.right = [-1] * size, [-1] * size
        self.pair: dict[int, int] = {}  # rank of a merge by its two tokens
        for r, m in enumerate(model["merges"]):
            a, b = (model["vocab"][x] for x in (m if isinstance(m, list) else m.split(" ")))
            t = self.id_of[self.table[a] + self.table[b]]
            self.pair.setdefault(a << 20 | b, r)
            if self.made[t] < 0:
                self.made[t], self.left[t], self.right[t] = r, a, b
        for i, t in added.items():
            self.table[i] = t.content.encode()
        self.stays: dict[int, bool] = {}
        self.guess: dict[int, int] = {}  # length of the last token by the one before and the next byte

    def merge(self, text: bytes) -> list[bytes]:
        """The definition: merge the adjacent pair of least rank, leftmost first, until none is left."""
        ids = [self.id_of[text[i : i + 1]] for i in range(len(text))]
        while len(ids) > 1:
            r, i = min((self.pair.get(a << 20 | b, 1 << 60), i) for i, (a, b) in enumerate(zip(ids, ids[1:])))
            if r == 1 << 60:
                break
            ids[i : i + 2] = [self.id_of[self.table[ids[i]] + self.table[ids[i + 1]]]]
        return [self.table[i] for i in ids]

    def _stays(self, u: int, t: int) -> bool:
        """Whether token t stays whole after token u (-1: at the start).

        Merges are undone from the latest on, on both sides of the border; the border falls if a pair across it has a
        merge that comes before the merge that took one of its sides away (leftmost first at equal ranks).
        """
        if u < 0:
            got = self.merge(self.table[t]) == [self.table[t]]
        else:
            pair, made, left, right = self.pair, self.made, self.left, self.right
            x, y, until, got = u, t, 1 << 60, True
            while True:
                if pair.get(x << 20 | y, 1 << 60) < until:
                    got = False
                    break
                if made[x] > made[y]:
                    until, x = made[x], right[x]
                elif made[y] >= 0:
                    until, y = made[y] + 1, left[y]
                else:
                    break
        if len(self.stays) > 300_000:
            self.stays.clear()
        self.stays[u + 1 << 20 | t] = got
        return got

    def encode_pieces(self, pieces: list[str]) -> list[bytes]:
        id_of, table, stays, guess, longest = self.id_of, self.table, self.stays, self.guess, self.longest
        words = [p.encode() for p in pieces]
        done: dict[bytes, bytes] = {}
        last = [-1]  # last[d]: the last token of the current path's prefix of d bytes
        before = b""
        for w in sorted(words):
            shared, most = 0, min(len(before), len(w))
            if w[:most] == before[:most]:
                shared = most
            else:
                while w[shared] == before[shared]:
                    shared += 1
            del last[shared + 1 :]
            for d in range(shared + 1, len(w) + 1):
                # just one length fits; the one that did after the same token and byte is tried first
                g = last[d - 1] + 1 << 8 | w[d - 1]
                n = guess.get(g, 1)
                if n <= d and (t := id_of.get(w[d - n : d])) is not None:
                    ok = stays.get(last[d - n] + 1 << 20 | t)
                    if ok or ok is None and self._stays(last[d - n], t):
                        last.append(t)
                        continue
                for n in range(min(d, longest), 0, -1):
                    t = id_of.get(w[d - n : d])
                    if t is not None:
                        u = last[d - n]
                        ok = stays.get(u + 1 << 20 | t)
                        if ok or ok is None and self._stays(u, t):
                            last.append(t)
                            if len(guess) > 300_000:
                                guess.clear()
                            guess[g] = n
                            break
                else:
                    raise ValueError(f"no token ends the prefix {w[:d]!r}")
            ids, d = [], len(w)
            while d:
                ids.append(last[d])
                d -= len(table[last[d]])
            done[w] = array("I", ids[::-1]).tobytes()
            before = w
        return [done[w] for w in words]

    def decode(self, ids: bytes) -> str:
        """The text of ids; bytes that are not UTF-8 become U+FFFD."""
        return b"".join(map(self.table.__getitem__, np.frombuffer(ids, "<u4").tolist())).decode("utf-8", "replace")
