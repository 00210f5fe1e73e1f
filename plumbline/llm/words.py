"""Words and word n-grams of many texts at once, in numpy.

A word is a maximal run of bytes other than 0x20 and 0x09-0x0D; in UTF-8 that is
``[^\\x20\\x09-\\x0D]+`` over characters. Word hashes are 64 bits of the word's bytes.
"""

from __future__ import annotations

import numpy as np
import xxhash

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_MASK = np.array([(1 << (8 * k)) - 1 for k in range(9)], np.uint64)
_A, _B, _P = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), 0x9E3779B97F4A7C15
_LONG = 64


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * _A
    x = (x ^ (x >> np.uint64(27))) * _B
    return x ^ (x >> np.uint64(31))


class Words:
    """The words of a list of texts: ``start``/``end`` in ``data``; text d has words ``first[d]:first[d+1]``.

    ``between`` says which bytes lie between words; the line break must be one of them.
    """

    def __init__(self, texts: list[bytes], between: np.ndarray = _SPACE):
        self.data = b"\n".join(texts) + b"\n"
        n = len(self.data)
        self.buf = np.frombuffer(self.data + bytes(16), np.uint8)
        self.begin = np.concatenate(([0], np.cumsum([len(t) + 1 for t in texts], dtype=np.int64)))
        space = between[self.buf[:n]]
        edge = np.flatnonzero(space[1:] != space[:-1]) + 1
        if n and not space[0]:
            edge = np.concatenate(([0], edge))
        self.start, self.end = edge[0::2], edge[1::2]
        self.first = np.searchsorted(self.start, self.begin)
        self.count = np.diff(self.first)
        self.doc = np.repeat(np.arange(len(texts)), self.count)

    def hashes(self) -> np.ndarray:
        return span_hashes(self.buf, self.start, self.end)

    def rest(self) -> np.ndarray:
        """For each word, how many words its text has from there on."""
        return self.first[self.doc + 1] - np.arange(len(self.start))


def span_hashes(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of each span of bytes; ``buf`` ends in 8 spare bytes at least."""
    lane = np.ndarray((len(buf) - 7,), "<u8", buf, 0, (1,))
    size = end - start
    h = mix(size.astype(np.uint64) * np.uint64(_P) ^ (lane[start] & _MASK[np.minimum(size, 8)]))
    at, k = np.flatnonzero((size > 8) & (size <= _LONG)), 8
    while len(at):
        h[at] = mix(h[at] * np.uint64(_P) + (lane[start[at] + k] & _MASK[np.minimum(size[at] - k, 8)]))
        k += 8
        at = at[size[at] > k]
    data = memoryview(buf)
    for i in np.flatnonzero(size > _LONG):
        h[i] = xxhash.xxh64_intdigest(data[start[i] : end[i]], 7)
    return h


def grams(h: np.ndarray, n: int, start: np.uint64 = np.uint64(0)) -> np.ndarray:
    """Hash of each n consecutive values (rolled together in log n steps); entry i covers ``h[i:i+n]``."""
    if len(h) < n:
        return np.zeros(0, np.uint64)
    acc, size = h, 1
    for bit in bin(n)[3:]:
        acc = acc[: len(h) - 2 * size + 1] * np.uint64(pow(_P, size, 1 << 64)) + acc[size : len(h) - size + 1]
        size *= 2
        if bit == "1":
            acc = acc[: len(h) - size] * np.uint64(_P) + h[size:]
            size += 1
    return mix(acc ^ np.uint64(n) ^ start)


def window_min(x: np.ndarray, n: int) -> np.ndarray:
    """Minimum of each n consecutive values."""
    if len(x) < n:
        return x[:0]
    size = 1
    while 2 * size <= n:
        x = np.minimum(x[:-size], x[size:])
        size *= 2
    return np.minimum(x[: len(x) - (n - size)], x[n - size :])


def covered(n: int, start: np.ndarray, size: np.ndarray | int) -> np.ndarray:
    """Which of n places lie in one of the spans ``start:start+size``."""
    step = np.bincount(start, minlength=n + 1) - np.bincount(np.minimum(start + size, n), minlength=n + 1)
    return np.cumsum(step[:n]) > 0


def runs(change: np.ndarray) -> np.ndarray:
    """Starts of the runs, where ``change`` says that a place differs from the one before it."""
    at = np.flatnonzero(change)
    return at if len(at) and at[0] == 0 else np.concatenate(([0], at)) if len(change) else at
