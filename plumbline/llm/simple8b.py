"""Simple-8b words in numpy.

A 64-bit word holds a selector in its top four bits and as many ids as the selector says in
the other 60. Ids of more than 60 bits are escaped: selector 15, then the id as a word of
its own. Ids are packed in blocks of ``BLOCK``; each block starts a new word, and the first
word of each block is listed, so that blocks decode on their own and all at once.
"""

from __future__ import annotations

import numpy as np

#: Fixed values of the format: ids in a word and bits of each, by selector.
COUNTS = np.array([60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1])
BITS = np.array([1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60])
ESCAPE, BLOCK = 15, 256
_PER_WORD = np.concatenate((COUNTS, [0, 1]))


def _widest(width: np.ndarray, n: int) -> np.ndarray:
    """Maximum of each n consecutive widths; past the end nothing is wide."""
    size, x = 1, width
    while 2 * size <= n:
        y = x.copy()
        np.maximum(x[:-size], x[size:], out=y[:-size]) if len(x) > size else None
        x, size = y, 2 * size
    if n > size:
        y = x.copy()
        np.maximum(x[: -(n - size)], x[n - size :], out=y[: -(n - size)]) if len(x) > n - size else None
        x = y
    return x


def encode(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """ids -> (words, first word of each block)."""
    ids = np.asarray(ids, np.uint64)
    n = len(ids)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint32)
    width = np.ones(n, np.uint8)
    for step in (32, 16, 8, 4, 2, 1):  # bits needed, by halving
        wide = (ids >> (width.astype(np.uint64) + np.uint64(step - 1))) > 0
        width += wide.astype(np.uint8) * np.uint8(step)
    best = np.full(n, ESCAPE, np.uint8)
    for s in range(len(COUNTS) - 1, -1, -1):
        best[_widest(width, int(COUNTS[s])) <= BITS[s]] = s
    room = np.array([0, *(int(np.argmax(COUNTS <= k)) for k in range(1, BLOCK + 1))], np.uint8)
    at = np.arange(0, n, BLOCK)
    stop = np.minimum(at + BLOCK, n)
    starts, kinds = [], []
    while len(at):  # all blocks go on by a word at a time
        kind = best[at]
        kind = np.where(kind == ESCAPE, kind, np.maximum(kind, room[stop - at]))
        starts.append(at)
        kinds.append(kind)
        at = at + _PER_WORD[kind]
        going = at < stop
        at, stop = at[going], stop[going]
    start, kind = np.concatenate(starts), np.concatenate(kinds)
    order = np.argsort(start, kind="stable")
    start, kind = start[order], kind[order]
    place = np.concatenate(([0], np.cumsum(1 + (kind == ESCAPE))))
    words = np.zeros(place[-1], np.uint64)
    for s in range(len(COUNTS)):
        of = np.flatnonzero(kind == s)
        word = np.full(len(of), np.uint64(s) << np.uint64(60))
        for j in range(int(COUNTS[s]) if len(of) else 0):
            word |= ids[start[of] + j] << np.uint64(BITS[s] * j)
        words[place[of]] = word
    of = np.flatnonzero(kind == ESCAPE)
    words[place[of]] = np.uint64(ESCAPE) << np.uint64(60)
    words[place[of] + 1] = ids[start[of]]
    return words, place[np.searchsorted(start, np.arange(0, n, BLOCK))].astype(np.uint32)


def decode(words: np.ndarray, first: np.ndarray) -> np.ndarray:
    """All ids of the blocks that begin at ``first``."""
    words = np.asarray(words, np.uint64)
    kind = (words >> np.uint64(60)).astype(np.int64)
    top = kind == ESCAPE
    if top.any():  # of neighbours that look like escapes, each second one is an escaped id
        begins = top.copy()
        begins[1:] &= ~top[:-1]
        begins[np.asarray(first, np.int64)] |= top[np.asarray(first, np.int64)]
        since = np.arange(len(words)) - np.maximum.accumulate(np.where(begins, np.arange(len(words)), 0))
        escape = top & (since % 2 == 0)
        raw = np.flatnonzero(escape) + 1
        kind[raw] = 14
    place = np.concatenate(([0], np.cumsum(_PER_WORD[kind])))
    out = np.zeros(place[-1], np.uint64)
    for s in range(len(COUNTS)):
        of = np.flatnonzero(kind == s)
        mask = np.uint64((1 << int(BITS[s])) - 1)
        for j in range(int(COUNTS[s]) if len(of) else 0):
            out[place[of] + j] = (words[of] >> np.uint64(BITS[s] * j)) & mask
    if top.any():
        out[place[raw - 1]] = words[raw]
    return out
