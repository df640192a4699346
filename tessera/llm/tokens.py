"""Encoding with the ids of the tokenizers library, each text at the cheapest way that gives the same ids.

Texts of plain Latin letters, digits, ASCII signs and ASCII white space go whole through the vocabulary's merges in
tiktoken, whose ranks are built from the vocabulary file. Any other text is cut before white space, where the
vocabulary's own rule always cuts, so its ids are those of its chunks in turn: chunks and pieces already met in this
Python worker are looked up, new pieces go to the library's model or, where white space is dropped, odd chunks to the
library's full pipeline.
"""

from __future__ import annotations

import json
import os
import re
from array import array

import numpy as np

from tessera.llm.common import CACHES

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

#: The characters with the Unicode property White_Space.
_WS = "\t-\r \x85\xa0  -     　"
_CHUNK = re.compile(f"[{_WS}]*[^{_WS}]+|[{_WS}]+")
#: White space other than single spaces and line feeds: such texts are cut by _CHUNK where white space makes tokens.
_ODD = re.compile(f"[ \n]{{2}}|[\t\x0b-\r\x1c-\x1f{_WS[5:]}]")
_L = "A-Za-zÀ-ÖØ-öø-ÿ"
_PLAIN = re.compile(f"[{_L}]+")
_SAFE = re.compile(f"[ \n]?[!-~{_L}]+")
_PLAIN_TEXT = re.compile(f"[\t-\r -~{_L}]*")
#: Runs this long without white space are left to the library, whose merging of long pieces is not quadratic.
_LONG = re.compile(r"[^\x20\x09-\x0D]{300}")
#: The split rules of the two public vocabularies, for such chunks.
_WORD_PIECES = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\\sa-zß-öø-ÿ0-9]+")
_BYTE_PIECES = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d| ?[{_L}]+| ?[0-9]+| ?[^\\s{_L}0-9]+|\\s+")
#: The split rule of the byte-level vocabulary for plain texts, as tiktoken reads it.
_BYTE_RULE = f"'(?:[stmd]|re|ve|ll)| ?[{_L}]+| ?[0-9]+| ?[^\\s{_L}0-9]+|\\s+(?!\\S)|\\s+"
_END = "\x01"  # no plain text has it
#: A cache is emptied at this many entries, which bounds a worker's memory.
CACHE_ENTRIES = 300_000


def byte_letters() -> list[str]:
    """The printable character that byte-level vocabularies write for each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


class Encoder:
    """ids(texts) gives each text's ids as little-endian unsigned 32-bit integers in bytes."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.spaced = self.library.normalizer is None  # white space makes tokens
        self.letters = byte_letters()
        self.byte_of = {c: b for b, c in enumerate(self.letters)}
        self.pieces: dict[str, bytes] = {}
        self.head: dict[str, bytes] = {"": b""}
        self.body: dict[str, bytes] = {} if self.spaced else self.head
        self.specials = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.special_ids = {t.content: array("I", [i]).tobytes() for i, t in self.library.get_added_tokens_decoder().items()}
        self.at_special = re.compile("(" + "|".join(map(re.escape, self.specials)) + ")") if self.specials else None
        self.plain = self._plain(path)

    def _plain(self, path: str):
        """The merges as (tiktoken encoding, ids of its ranks), or None if its ranks cannot say them."""
        import tiktoken

        model = json.load(open(path, encoding="utf-8"))["model"]
        suffix, vocab = model["end_of_word_suffix"] or "", model["vocab"]
        raw = lambda t: bytes(self.byte_of[c] for c in t)
        end = lambda t: raw(t.removesuffix(suffix)) + _END.encode() if suffix and t.endswith(suffix) else raw(t)
        tokens = list(self.letters) + ([c + suffix for c in self.letters] if suffix else [])
        tokens += ["".join(m if isinstance(m, list) else m.split(" ")) for m in model["merges"]]
        ranks = {end(t): i for i, t in enumerate(tokens)}  # an end mark is joined to the sign before it first of all
        if len(ranks) != len(tokens):
            return None
        ids = np.array([vocab.get(t, 0) for t in tokens], "<u4")
        rule = f"[^{_END}]*{_END}" if suffix else _BYTE_RULE
        return tiktoken.Encoding("plain", pat_str=rule, mergeable_ranks=ranks, special_tokens={}), ids

    def _plain_ids(self, text: str) -> bytes:
        encoding, ids = self.plain
        if not self.spaced:
            found = _WORD_PIECES.findall(text.lower())
            text = _END.join(found) + _END if found else ""
        return ids[encoding.encode_to_numpy(text, disallowed_special=())].tobytes() if text else b""

    def _whole(self, text: str) -> bytes:
        return array("I", self.library.encode(text, add_special_tokens=False).ids).tobytes()

    def encode_pieces(self, pieces: list[str]) -> list[bytes]:
        """The ids of new pieces, which are words or runs of signs after normalisation."""
        tokenize, letters, space = self.library.model.tokenize, self.letters, self.letters[32]
        out = []
        for p in pieces:
            if p.isascii() and p.isprintable():
                m = p.replace(" ", space)
            else:
                m = "".join([letters[b] for b in p.encode()])
            out.append(array("I", [t.id for t in tokenize(m)]).tobytes())
        return out

    def _split(self, chunk: str) -> list[str | bytes]:
        """The pieces of any chunk by the library's own pre-tokenizer; ids of special tokens as bytes."""
        out: list[str | bytes] = []
        for part in self.at_special.split(chunk) if self.at_special else [chunk]:
            if part in self.special_ids:
                out.append(self.special_ids[part])
            elif part:
                out += [bytes(map(self.byte_of.__getitem__, p)).decode() for p, _ in self.library.pre_tokenizer.pre_tokenize_str(part)]
        return out

    def _learn(self, chunks: dict[str, None], lead: str, into: dict[str, bytes]) -> None:
        split: list[tuple[str, list]] = []
        for c in chunks:
            chunk = lead + c if c[:1] != "\n" else c
            if _PLAIN.fullmatch(c):
                split.append((c, [chunk if self.spaced else c.lower()]))
            elif chunk == " " or _SAFE.fullmatch(chunk) and not any(s in chunk for s in self.specials):
                split.append((c, _BYTE_PIECES.findall(chunk) if self.spaced else _WORD_PIECES.findall(chunk.lower())))
            elif self.spaced:
                split.append((c, self._split(chunk)))
            else:
                into[c] = self._whole(chunk)
        known = self.pieces
        new = list(dict.fromkeys(p for _, ps in split for p in ps if isinstance(p, str) and p not in known))
        if len(known) + len(new) > CACHE_ENTRIES:
            known.clear()
            new = list(dict.fromkeys(p for _, ps in split for p in ps if isinstance(p, str)))
        known.update(zip(new, self.encode_pieces(new)))
        for c, ps in split:
            into[c] = b"".join([known[p] if isinstance(p, str) else p for p in ps])

    def ids(self, texts: list[str | None]) -> list[bytes]:
        out: list[bytes | None] = [None] * len(texts)
        todo: list[tuple[int, list[str], dict[str, bytes]]] = []
        if len(self.body) + len(self.head) > CACHE_ENTRIES:
            self.body.clear()
            self.head.clear()
            self.head[""] = b""
        head, body = self.head, self.body
        first: dict[str, None] = {}
        later: dict[str, None] = {}
        for i, t in enumerate(texts):
            if not t:
                out[i] = b""
            elif self.plain and _PLAIN_TEXT.fullmatch(t) and not any(s in t for s in self.specials) and not _LONG.search(t):
                out[i] = self._plain_ids(t)
            elif not self.spaced:
                cs = t.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ")
                later.update(dict.fromkeys(c for c in cs if c not in body))
                todo.append((i, cs, body))
            elif _ODD.search(t):
                cs = _CHUNK.findall(t)
                first.update(dict.fromkeys([c for c in cs if c not in head]))
                todo.append((i, cs, head))
            else:
                cs = t.replace("\n", " \n").split(" ")
                if cs[0] not in head:
                    first[cs[0]] = None
                later.update(dict.fromkeys([c for c in cs[1:] if c not in body]))
                todo.append((i, cs, body))
        if first:
            self._learn(first, "", head)
        if later:
            self._learn(later, " " if self.spaced else "", body)
        for i, cs, known in todo:
            out[i] = b"".join([head[cs[0]], *[known[c] for c in cs[1:]]])
        return out


_ENCODERS: dict[tuple, Encoder] = {}
CACHES["encoders"] = _ENCODERS


def encoder(path: str, kind: type[Encoder] = Encoder) -> Encoder:
    """The worker's encoder of a vocabulary file; its caches serve all tasks of the worker."""
    if (path, kind) not in _ENCODERS:
        _ENCODERS[path, kind] = kind(path)
    return _ENCODERS[path, kind]


def slices(n: int, sizes: list[int], most: int = 8_000_000):
    """Consecutive row ranges of n rows with about `most` bytes of text each."""
    start, total = 0, 0
    for i in range(n):
        total += sizes[i]
        if total >= most:
            yield start, i + 1
            start, total = i + 1, 0
    if start < n:
        yield start, n
