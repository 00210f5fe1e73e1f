"""Many phrases in one pass over a text: an Aho-Corasick automaton as arrays, run over many texts at once in numpy.

Time goes by the bytes of the texts, not by the number of phrases. Texts are cut into windows
that overlap by the longest phrase, so a long text is as many short ones, and all windows take
each step together. A state's phrases are bits, gathered along the way.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from plumbline.functions.slices import in_slices

#: Bytes of a window, without its overlap, and of the windows that are worked on at once.
WINDOW, AT_ONCE = 512, 1 << 22


class Automaton:
    """Transitions of all states by class of byte, and the phrases that end in each state, those of its suffixes included."""

    def __init__(self, phrases: Sequence[str]):
        found = [p.encode() for p in phrases]
        self.longest = max(map(len, found), default=0)
        self.always = [i for i, p in enumerate(found) if not p]  # an empty phrase is in every text
        used = sorted({b for p in found for b in p})
        self.class_of = np.zeros(256, np.uint8 if len(used) < 256 else np.uint16)
        self.class_of[used] = np.arange(1, len(used) + 1)
        kids: list[dict[int, int]] = [{}]
        ends: list[int] = [0]
        for i, p in enumerate(found):
            at = 0
            for c in self.class_of[list(p)].tolist() if p else ():
                if c not in kids[at]:
                    kids[at][c] = len(kids)
                    kids.append({})
                    ends.append(0)
                at = kids[at][c]
            if p:
                ends[at] |= 1 << i
        step = np.zeros((len(kids), len(used) + 1), np.int32)
        fall = [0] * len(kids)
        for c, to in kids[0].items():
            step[0, c] = to
        todo = deque(kids[0].values())
        while todo:  # in order of depth: where a state falls back to is done already
            at = todo.popleft()
            ends[at] |= ends[fall[at]]
            step[at] = step[fall[at]]
            for c, to in kids[at].items():
                fall[to] = int(step[fall[at], c])
                step[at, c] = to
                todo.append(to)
        self.step = step.ravel()
        self.width = step.shape[1]
        words = max(1, -(-len(found) // 64))
        self.ends = np.array([[e >> (64 * k) & (1 << 64) - 1 for k in range(words)] for e in ends], np.uint64)
        self.final = self.ends.any(1)

    def found(self, texts: list[bytes]) -> np.ndarray:
        """(text, word of 64 phrases): which phrases each text has."""
        out = np.zeros((len(texts), self.ends.shape[1]), np.uint64)
        for i in self.always:
            out[:, i // 64] |= np.uint64(1 << i % 64)
        if not self.longest:
            return out
        size = np.array([len(t) for t in texts], np.int64)
        data = np.frombuffer(b"".join(texts) + b"\0", np.uint8)
        begin = np.cumsum(size) - size
        count = -(-size // WINDOW)
        text = np.repeat(np.arange(len(texts)), count)
        nth = np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)
        start = begin[text] + nth * WINDOW
        stop = np.minimum(start + WINDOW + self.longest - 1, begin[text] + size[text])
        order = np.argsort(start - stop, kind="stable")  # long ones first, so that those still running are a head
        text, start, length = text[order], start[order], (stop - start)[order]
        classes = self.class_of[data]
        most = max(1, AT_ONCE // WINDOW)
        for a in range(0, len(text), most):
            self._run(classes, text[a : a + most], start[a : a + most], length[a : a + most], out)
        return out

    def _run(self, classes: np.ndarray, text: np.ndarray, start: np.ndarray, length: np.ndarray, out: np.ndarray) -> None:
        state = np.zeros(len(text), np.int32)
        live = np.searchsorted(-length, -np.arange(1, length[0] + 1), "right") if len(length) else ()
        for i, n in enumerate(live):
            now = self.step[state[:n] * self.width + classes[start[:n] + i]]
            state[:n] = now
            hit = np.flatnonzero(self.final[now])
            if len(hit):
                np.bitwise_or.at(out, text[hit], self.ends[now[hit]])


def hits_of(batches: Iterator[pa.Array], phrases: Sequence[str]) -> Iterator[pa.Array]:
    """A list of phrases for each text of each batch, in the order given."""
    automaton, names = Automaton(phrases), pa.array(phrases, pa.string())
    for batch in batches:
        bits = np.zeros((len(batch), automaton.ends.shape[1]), np.uint64)
        for at, some in in_slices(batch, AT_ONCE):
            bits[at : at + len(some)] = automaton.found([t or b"" for t in some.cast(pa.binary()).to_pylist()])
        bits[np.array(batch.is_null())] = 0
        row, phrase = np.nonzero(np.unpackbits(bits.astype("<u8").view(np.uint8), axis=1, bitorder="little")[:, : len(phrases)])
        offset = np.concatenate(([0], np.cumsum(np.bincount(row, minlength=len(batch)))))
        yield pa.ListArray.from_arrays(pa.array(offset.astype(np.int32)), names.take(pa.array(phrase)))


def phrase_hits(text: Column, phrases: Sequence[str]) -> Column:
    """The phrases that are in the text, in the order given; a null text has none."""
    listed = list(phrases)

    @F.arrow_udf("array<string>")
    def hits(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        yield from hits_of(batches, listed)

    return hits(text)
