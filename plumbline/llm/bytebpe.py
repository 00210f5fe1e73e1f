"""Byte-level BPE ids of many texts, each distinct stretch of text encoded once.

The tokenizer cuts a text into stretches before it merges bytes, so a text may be cut where
such a stretch surely ends: before the last white space ahead of a visible character, after
it unless it is a space, and between an ASCII letter and punctuation. Each distinct piece is
given to the tokenizers library once for a worker; a text's ids are those of its pieces in
order. A piece is known by a 64-bit hash of its bytes and by its length; texts of a slice in
which that fails, or in which the tokenizer sees a stretch beyond a cut, are encoded whole.
Texts are first cut at the literals of added tokens, which the tokenizer takes out before it
does anything else.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
from tokenizers import Tokenizer

from plumbline.llm.words import mix, span_hashes

_MOST_KNOWN = 1_000_000
_GROUP = 1 << 17
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: First bytes of characters that are surely no white space, in any Unicode sense.
_SEEN = np.zeros(256, bool)
_SEEN[0x21:0x7F] = True
_SEEN[[0xC3, *range(0xC4, 0xE0)]] = True
_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True
_POINT = np.zeros(256, bool)
_POINT[[c for c in range(0x21, 0x7F) if not chr(c).isalnum() and chr(c) != "'"]] = True


class Unsure(Exception):
    """Pieces don't surely give the ids of their texts."""


class Encoder:
    """Ids of texts by a byte-level BPE file of the tokenizers library."""

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.added = {t.content.encode(): i for i, t in self.tokenizer.get_added_tokens_decoder().items()}
        #: None where added tokens do more than stand for themselves: such texts are encoded whole.
        plain = not any(t.lstrip or t.rstrip or t.single_word or t.normalized and not t.special for t in self.tokenizer.get_added_tokens_decoder().values())
        literals = b"|".join(re.escape(t) for t in sorted(self.added, key=len, reverse=True))
        self.at_added = re.compile(b"(" + literals + b")") if literals and plain else None
        vocab = self.tokenizer.get_vocab()
        self.bytes_of = np.zeros(max(vocab.values()) + 1, np.int64)
        for token, i in vocab.items():
            self.bytes_of[i] = len(token)  # one character stands for each byte
        self.line = self.tokenizer.encode("\n", add_special_tokens=False).ids[0]
        self._forget()

    def _forget(self) -> None:
        self.keys, self.at = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.size, self.ids = np.zeros(0, np.int64), np.zeros(0, np.uint32)
        self.width = np.zeros(0, np.int64)

    def _encode(self, pieces: list[str]) -> list[np.ndarray]:
        """Ids of each piece. Pieces without inner white space go together, a line break between them."""
        out: list[np.ndarray | None] = [None] * len(pieces)
        plain, odd, held, groups = [], [], 0, []
        for i, p in enumerate(pieces):
            if len((p[1:] if p[0] == " " else p).split()) == 1 and not p[-1].isspace() and not (p[0] != " " and p[0].isspace()) and p != " ":
                plain.append(i)
                held += len(p)
                if held > _GROUP:
                    groups.append(plain)
                    plain, held = [], 0
            else:
                odd.append(i)
        if plain:
            groups.append(plain)
        done = self.tokenizer.encode_batch(["\n".join(pieces[i] for i in g) for g in groups], add_special_tokens=False)
        for g, e in zip(groups, done, strict=True):
            ids = np.array(e.ids, np.uint32)
            ends = np.cumsum(self.bytes_of[ids])
            size = np.array([len(pieces[i].encode()) for i in g]) + 1
            stop = np.cumsum(size) - 1
            cut = np.searchsorted(ends, stop)
            if not (ends[cut] == stop).all():
                raise Unsure("a stretch of text ran over a cut")
            begin = np.concatenate(([0], cut[:-1] + 2))
            for i, a, b in zip(g, begin.tolist(), (cut + 1).tolist(), strict=True):
                out[i] = ids[a:b]
        for i, e in zip(odd, self.tokenizer.encode_batch([pieces[i] for i in odd], add_special_tokens=False), strict=True):
            out[i] = np.array(e.ids, np.uint32)
        return out

    def __call__(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, how many each has)."""
        if not any(t in x for t in self.added for x in texts):
            return self._sure(texts)
        if self.at_added is None:
            return self._whole(texts)
        cut = [self.at_added.split(x) for x in texts]  # texts and added tokens by turns
        ids, counts = self._sure([part for row in cut for part in row[::2]])
        ends, out, at = np.cumsum(counts), [], 0
        for row in cut:
            for k, part in enumerate(row):
                if k % 2:
                    out.append(np.array([self.added[part]], np.uint32))
                else:
                    out.append(ids[ends[at] - counts[at] : ends[at]])
                    at += 1
        size = np.fromiter(map(len, out), np.int64, len(out))
        first = np.concatenate(([0], np.cumsum([len(row) for row in cut])[:-1])).astype(np.int64)
        return np.concatenate(out), np.add.reduceat(size, first)

    def _whole(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        rows = [np.array(self.tokenizer.encode(t.decode(), add_special_tokens=False).ids, np.uint32) for t in texts]
        return np.concatenate([np.zeros(0, np.uint32), *rows]), np.fromiter(map(len, rows), np.int64, len(rows))

    def _sure(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        try:
            return self._pieces(texts)
        except Unsure:
            self._forget()
            return self._whole(texts)

    def _pieces(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        data = b"".join(texts)
        n = len(data)
        begin = np.concatenate(([0], np.cumsum([len(t) for t in texts], dtype=np.int64)))
        if not n:
            return np.zeros(0, np.uint32), np.zeros(len(texts), np.int64)
        buf = np.frombuffer(data + bytes(16), np.uint8)
        b = buf[:n]
        last = np.append(_SPACE[b[:-1]] & _SEEN[b[1:]], False)
        last[begin[1:][begin[1:] > 0] - 1] = False  # what follows is another text
        cut = last.copy()
        cut[1:] |= (last & (b != 0x20))[:-1] | (_LETTER[b[:-1]] & _POINT[b[1:]])
        cut[begin[:-1][begin[:-1] < n]] = True
        start = np.flatnonzero(cut)
        end = np.append(start[1:], n)
        keys = mix(span_hashes(buf, start, end) + (end - start).astype(np.uint64))
        which, distinct = pd.factorize(keys)
        if len(self.keys) > _MOST_KNOWN:
            self._forget()
        place = np.searchsorted(self.keys, distinct)
        known = np.zeros(len(distinct), bool)
        inside = place < len(self.keys)
        known[inside] = self.keys[place[inside]] == distinct[inside]
        fresh = np.flatnonzero(~known)
        if len(fresh):
            one = np.zeros(len(distinct), np.int64)
            one[which[::-1]] = np.arange(len(which))[::-1]
            at = one[fresh]
            # A cut stands before the first byte of a character, so each piece is whole UTF-8.
            got = self._encode([data[x:y].decode() for x, y in zip(start[at].tolist(), end[at].tolist(), strict=True)])
            size = np.fromiter(map(len, got), np.int64, len(got))
            where = len(self.ids) + np.cumsum(size) - size
            self.ids = np.concatenate((self.ids, *got))
            keys_now = np.concatenate((self.keys, distinct[fresh]))
            order = np.argsort(keys_now)
            self.keys = keys_now[order]
            self.at, self.size = np.concatenate((self.at, where))[order], np.concatenate((self.size, size))[order]
            self.width = np.concatenate((self.width, end[at] - start[at]))[order]
            place = np.searchsorted(self.keys, distinct)
        if not (self.width[place][which] == end - start).all():
            raise Unsure("two stretches of text share a hash")
        size = self.size[place][which]
        first = np.cumsum(size) - size
        ids = self.ids[np.arange(size.sum()) + np.repeat(self.at[place][which] - first, size)]
        total = np.concatenate(([0], np.cumsum(size)))[np.searchsorted(start, begin)]
        total[-1] = len(ids)
        return ids, np.diff(total)


_ready: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's own encoder of a file."""
    if path not in _ready:
        _ready[path] = Encoder(path)
    return _ready[path]
