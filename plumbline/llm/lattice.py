"""Sampled SentencePiece segmentation by forward filtering, backward sampling (operator 5).

The pieces of a SentencePiece model span a lattice over each text: a path through it is a
segmentation, with the product of its pieces' weights as its probability. The forward pass
sums the weight of all paths to each place; the backward pass draws pieces from the end of
the text, each with its share of that sum. Draws come from a counter-based generator keyed by
seed, row key and place, so a row's segmentation is the same on any cluster and any run.

The model's merge ranks give the weights: a piece of rank r weighs 1 / (r + 1), to the power
``alpha``. No piece joins a space to something before it, and a character that no longer
piece has stands alone, so the lattice falls into stretches that are sampled on their own
with the same result. Stretches that repeat share one forward pass.

Decoding is lossless: a space is written as the model's space mark, after one mark put ahead
of the text; characters outside the vocabulary, and marks in the text itself, are written as
byte pieces.

Null and empty texts have no pieces. A null key counts as key 0. Rows that repeat a key and
its text have the same segmentation. Texts of any length are sampled whole; of a stretch over
``LONG`` bytes only the sums are kept, 12 bytes a character, and its pieces are found again on
the way back.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import sentencepiece

from plumbline.llm.words import mix, span_hashes

MARK = "▁"
_MARK_BYTES = MARK.encode()
#: Forward passes kept, by their edges (16 bytes each); texts are sampled in slices of ``SLICE`` bytes.
_MOST_EDGES, SLICE = 2_500_000, 1_000_000
#: Longer stretches are summed one by one, with their sums rescaled on the way.
_IN_STEP = 150
LONG = 1 << 14
_SMALL, _LARGE = 1e-120, 1e120
_GOLDEN, _SILVER = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1B54A32D192ED03)


class Lattice:
    """Samples segmentations by the pieces of a SentencePiece model file."""

    def __init__(self, path: str, alpha: float = 1.0):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.pieces: dict[str, tuple[int, float]] = {}
        self.bytes_of: list[bytes] = []
        self.byte_id = [0] * 256
        rank = 0
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.byte_id[int(piece[3:5], 16)] = i
                self.bytes_of.append(bytes([int(piece[3:5], 16)]))
            elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
                self.bytes_of.append(b"")
            else:
                rank += 1
                text = piece.replace(MARK, " ")
                self.bytes_of.append(text.encode())
                # The constant per character cancels between paths and keeps the sums near one.
                self.pieces[text] = (i, (1.0 / (rank + 1)) ** alpha * 40.0 ** len(text))
        self.longest = max(map(len, self.pieces), default=1)
        self.prefixes = {p[:k] for p in self.pieces for k in range(1, len(p) + 1)}
        # The pieces as a trie: a state for each prefix; a move is found under state and code point.
        state = {p: i + 1 for i, p in enumerate(sorted(self.prefixes))} | {"": 0}
        moves = sorted((state[p[:-1]] << 21 | ord(p[-1]), state[p]) for p in self.prefixes)
        self.moves = np.array([a for a, _ in moves] or [-1], np.int64)
        self.moved = np.array([b for _, b in moves] or [0], np.int64)
        self.piece_at, self.weight_at = np.full(len(state), -1, np.int64), np.zeros(len(state))
        for p, (i, w) in self.pieces.items():
            self.piece_at[state[p]], self.weight_at[state[p]] = i, w
        # Two ASCII characters that no piece has side by side: the lattice falls apart between them.
        self.apart = np.ones((256, 256), bool)
        self.apart[128:] = self.apart[:, 128:] = False
        for p in self.pieces:
            for a, b in zip(p, p[1:], strict=False):
                if a < "\x80" and b < "\x80":
                    self.apart[ord(a), ord(b)] = False
        self._forget()

    def _forget(self) -> None:
        self.keys, self.last_node, self.width = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.cum, self.piece, self.back = np.zeros(0), np.zeros(0, np.int32), np.zeros(0, np.int32)
        self.nodes = 0

    def _append(self, cum, piece, back) -> None:
        self.cum = np.concatenate((self.cum, cum))
        self.piece = np.concatenate((self.piece, np.array(piece, np.int32)))
        self.back = np.concatenate((self.back, np.array(back, np.int32)))

    def _forward(self, text: str, cum: list[float], piece: list[int], back: list[int]) -> int:
        """Add the stretch's nodes and edges; the node of its end. Each node is where some path ends."""
        n, pieces, prefixes, longest = len(text), self.pieces, self.prefixes, self.longest
        into: list[list[tuple[int, int, float]]] = [[] for _ in range(n + 1)]
        total = [0.0] * (n + 1)
        total[0] = 1.0
        base = self.nodes
        self.nodes += n + 1
        cum.append(base + 1.0)  # the stretch's start: walks stop here
        piece.append(-1)
        back.append(-1)
        for i in range(n):
            if i:
                edges, sum_ = into[i], 0.0
                for _, _, x in edges:
                    sum_ += x
                total[i] = sum_
                if edges and not _SMALL < sum_ < _LARGE:  # only the ratios among the latest sums count
                    for k in range(max(0, i - longest), i):
                        total[k] /= sum_
                    for k in range(i, min(n, i + longest) + 1):
                        into[k] = [(a, b, x / sum_) for a, b, x in into[k]]
                    total[i] = sum_ = 1.0
                self._close(base + i, into[i], sum_, cum, piece, back)
                into[i] = []
            here = total[i]
            if here == 0.0:
                continue
            found = False
            for j in range(i + 1, min(n, i + longest) + 1):
                part = text[i:j]
                if part not in prefixes:
                    break
                got = pieces.get(part)
                if got is not None:
                    into[j].append((got[0], base + i, here * got[1]))
                    found = found or j == i + 1
            if not found:  # byte pieces, one edge for the character; spelled out when sampled
                into[i + 1].append((-2 - ord(text[i]), base + i, here * 1e-6))
        self._close(base + n, into[n], sum(x for _, _, x in into[n]), cum, piece, back)
        return base + n

    @staticmethod
    def _close(node: int, edges: list[tuple[int, int, float]], total: float, cum: list[float], piece: list[int], back: list[int]) -> None:
        sum_ = 0.0
        for p, b, x in edges:
            sum_ += x
            cum.append(node + sum_ / total)
            piece.append(p)
            back.append(b)
        if edges:
            cum[-1] = node + 1.0
        else:  # no path ends here: a stop that no walk reaches
            cum.append(node + 1.0)
            piece.append(-1)
            back.append(-1)

    def _walk(self, text: str, key: np.uint64) -> list[int]:
        """The pieces of one stretch, sampled with sums alone in memory; the same draws as in ``sample``."""
        n, pieces, prefixes, longest = len(text), self.pieces, self.prefixes, self.longest
        total, power = np.zeros(n + 1), np.zeros(n + 1, np.int32)  # a sum is total * 2**power
        room = longest + 1
        coming, shift = [0.0] * room, 0  # sums of the next places, by place modulo room
        coming[0] = 1.0
        for i in range(n + 1):
            here, coming[i % room] = coming[i % room], 0.0
            if here and not _SMALL < here < _LARGE:
                k = math.frexp(here)[1]
                here, coming, shift = math.ldexp(here, -k), [math.ldexp(x, -k) for x in coming], shift + k
            total[i], power[i] = here, shift
            if not here or i == n:
                continue
            alone = False
            for j in range(i + 1, min(n, i + longest) + 1):
                part = text[i:j]
                if part not in prefixes:
                    break
                got = pieces.get(part)
                if got is not None:
                    coming[j % room] += here * got[1]
                    alone = alone or j == i + 1
            if not alone:
                coming[(i + 1) % room] += here * 1e-6
        out, at = [], n
        while at:
            if len(out) % 4096 == 0:
                u = (mix(key + (np.arange(len(out), len(out) + 4096, dtype=np.uint64) * _SILVER)) >> np.uint64(12)) * 2.0**-52
            draw, sum_, chosen = float(u[len(out) % 4096]), 0.0, None
            for i in range(at - 1, max(0, at - longest) - 1, -1):
                got = pieces.get(text[i:at])
                weight = got[1] if got is not None else 1e-6 if i + 1 == at else 0.0
                if not weight or not total[i]:
                    continue
                sum_ += math.ldexp(float(total[i]) * weight, int(power[i] - power[at])) / float(total[at])
                chosen = (i, got[0] if got is not None else -2 - ord(text[i]))
                if sum_ > draw:
                    break
            at = chosen[0]
            out.append(chosen[1])
        return out[::-1]

    def _forward_all(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """What ``_forward`` adds, for many short stretches in step: (cum, piece, back, end nodes)."""
        size = np.fromiter(map(len, texts), np.int64, len(texts))
        code = np.frombuffer("".join(texts).encode("utf-32-le"), "<u4").astype(np.int64)
        n = len(code)
        owner = np.repeat(np.arange(len(texts)), size)
        first = np.cumsum(size) - size
        stop = (first + size)[owner]
        node = self.nodes + np.arange(n) + owner  # the node ahead of each character
        self.nodes += n + len(texts)
        at, state, found = np.arange(n), np.zeros(n, np.int64), []
        single = np.zeros(n, bool)
        for k in range(self.longest):
            near = at + k < stop[at]
            at, state = at[near], state[near]
            if not len(at):
                break
            key = state << 21 | code[at + k]
            where = np.minimum(np.searchsorted(self.moves, key), len(self.moves) - 1)
            on = self.moves[where] == key
            at, state = at[on], self.moved[where[on]]
            whole = self.piece_at[state] >= 0
            found.append((at[whole], np.full(int(whole.sum()), k + 1), self.piece_at[state[whole]], self.weight_at[state[whole]]))
            if k == 0:
                single[at[whole]] = True
        odd = np.flatnonzero(~single)
        found.append((odd, np.ones(len(odd), np.int64), -2 - code[odd], np.full(len(odd), 1e-6)))
        start, long, piece, weight = map(np.concatenate, zip(*found, strict=True))
        place = start - first[owner[start]] + long  # of the edge's end in its stretch
        order = np.lexsort((long, start + long + owner[start], place))
        start, long, piece, weight, place = start[order], long[order], piece[order], weight[order], place[order]
        back, end = node[start], node[start] + long
        total = np.zeros(n + len(texts))
        base = self.nodes - n - len(texts)
        heads = node[first[size > 0]]
        total[heads - base] = 1.0
        share = np.zeros(len(start))
        bounds = np.flatnonzero(np.append(True, place[1:] != place[:-1])) if len(place) else np.zeros(0, np.int64)
        for a, b in zip(bounds.tolist(), [*bounds[1:].tolist(), len(place)], strict=True):
            x, to = total[back[a:b] - base] * weight[a:b], end[a:b]
            begin = np.flatnonzero(np.append(True, to[1:] != to[:-1]))
            sums = np.add.reduceat(x, begin)
            total[to[begin] - base] = sums
            share[a:b] = x / np.repeat(np.where(sums > 0, sums, 1.0), np.diff(np.append(begin, b - a)))
        order = np.argsort(end, kind="stable")
        share, end, back, piece = share[order], end[order], back[order], piece[order]
        acc = np.cumsum(share)
        begin = np.flatnonzero(np.append(True, end[1:] != end[:-1])) if len(end) else np.zeros(0, np.int64)
        before = np.concatenate(([0.0], acc))[begin]
        cum = end + np.minimum(acc - np.repeat(before, np.diff(np.append(begin, len(end)))), 1.0)
        cum[np.append(begin[1:], len(end)) - 1 if len(end) else begin] = end[np.append(begin[1:], len(end)) - 1 if len(end) else begin] + 1.0
        # The start of each stretch: walks stop there.
        cum, piece, back = np.concatenate((cum, heads + 1.0)), np.concatenate((piece, np.full(len(heads), -1))), np.concatenate((back, np.full(len(heads), -1)))
        order = np.argsort(cum, kind="stable")
        return cum[order], piece[order], back[order], base + first + size + np.arange(len(texts))

    def _stretches(self, texts: list[bytes]) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
        """(all bytes with a space ahead of each text, start and end of each stretch, stretches of each text)."""
        data = b"".join(b" " + t if t else b"" for t in texts)
        begin = np.concatenate(([0], np.cumsum([len(t) + bool(t) for t in texts], dtype=np.int64)))
        b = np.frombuffer(data, np.uint8)
        n = len(b)
        cut = np.zeros(n, bool)
        space, line = b == 0x20, b == 0x0A
        cut[1:] = (space[1:] & ~space[:-1]) | line[1:] | line[:-1] | self.apart[b[:-1], b[1:]]
        cut[begin[:-1][begin[:-1] < n]] = True
        start = np.flatnonzero(cut)
        return data, start, np.append(start[1:], n), np.diff(np.searchsorted(start, begin))

    def sample(self, texts: list[bytes], keys: np.ndarray, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """(piece ids of all texts, how many each has)."""
        data, start, end, per_text = self._stretches(texts)
        if not len(data):
            return np.zeros(0, np.int32), np.zeros(len(texts), np.int64)
        buf = np.frombuffer(data + bytes(16), np.uint8)
        alone = end - start > LONG  # sampled one by one
        short = np.flatnonzero(~alone)
        begins, ends = start[short], end[short]
        which, distinct = pd.factorize(span_hashes(buf, begins, ends))
        one = np.zeros(len(distinct), np.int64)
        one[which[::-1]] = np.arange(len(which))[::-1]
        width = (ends - begins)[one]
        if len(self.cum) > _MOST_EDGES:
            self._forget()
        place = np.searchsorted(self.keys, distinct)
        known = np.zeros(len(distinct), bool)
        inside = place < len(self.keys)
        known[inside] = self.keys[place[inside]] == distinct[inside]
        fresh = np.flatnonzero(~known)
        if len(fresh):
            parts = [data[a:b].decode() for a, b in zip(begins[one[fresh]].tolist(), ends[one[fresh]].tolist(), strict=True)]
            last = np.zeros(len(parts), np.int64)
            small = np.array([len(x) <= _IN_STEP for x in parts])
            if small.any():
                cum, piece, back, last[small] = self._forward_all([x for x in parts if len(x) <= _IN_STEP])
                self._append(cum, piece, back)
            for i in np.flatnonzero(~small).tolist():
                cum, piece, back = [], [], []
                last[i] = self._forward(parts[i], cum, piece, back)
                self._append(cum, piece, back)
            keys_now = np.concatenate((self.keys, distinct[fresh]))
            order = np.argsort(keys_now)
            self.keys = keys_now[order]
            self.last_node = np.concatenate((self.last_node, last))[order]
            self.width = np.concatenate((self.width, width[fresh]))[order]
            place = np.searchsorted(self.keys, distinct)
        clash = self.width[place][which] != ends - begins  # stretches that share a hash
        alone[short[clash]] = True
        # Backward: all stretches step together, from their ends.
        text = np.repeat(np.arange(len(texts)), per_text)
        nth = np.arange(len(text)) - np.repeat(np.cumsum(per_text) - per_text, per_text)
        key = mix(np.asarray(keys).astype(np.int64).view(np.uint64) + np.uint64(seed * int(_SILVER) % (1 << 64)))[text]
        key = mix(key + nth.astype(np.uint64) * _GOLDEN)
        node, active, steps = self.last_node[place][which][~clash], short[~clash], []
        count, k = np.zeros(len(text), np.int64), 0
        while len(active):
            u = (mix(key[active] + np.uint64(k * int(_SILVER) % (1 << 64))) >> np.uint64(12)) * 2.0**-52
            edge = np.searchsorted(self.cum, node + u, "right")
            drawn = self.piece[edge]
            going = drawn != -1
            steps.append((active[going], drawn[going]))
            active, node = active[going], self.back[edge[going]]
            count[active] += 1
            k += 1
        walked = {i: self._walk(data[start[i] : end[i]].decode(), key[i]) for i in np.flatnonzero(alone).tolist()}
        for i, ids in walked.items():
            count[i] = len(ids)
        first = np.cumsum(count) - count
        out = np.zeros(count.sum(), np.int64)
        for k, (at, drawn) in enumerate(steps):
            out[first[at] + count[at] - 1 - k] = drawn
        for i, ids in walked.items():
            out[first[i] : first[i] + count[i]] = ids
        stops = np.concatenate(([0], np.cumsum(count)))
        bounds = stops[np.concatenate(([0], np.cumsum(per_text)))]
        return self._spell(out, bounds)

    def _spell(self, ids: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Characters outside the vocabulary become the pieces of their bytes."""
        odd = np.flatnonzero(ids < -1)
        if not len(odd):
            return ids.astype(np.int32), np.diff(bounds)
        spelled = {c: [self.byte_id[x] for x in chr(-2 - c).encode()] for c in np.unique(ids[odd]).tolist()}
        size = np.ones(len(ids), np.int64)
        size[odd] = [len(spelled[c]) for c in ids[odd].tolist()]
        at = np.concatenate(([0], np.cumsum(size)))
        out = np.repeat(ids, size)
        for k in range(4):
            of = odd[size[odd] > k]
            out[at[of] + k] = [spelled[c][k] for c in ids[of].tolist()]
        return out.astype(np.int32), np.diff(at[bounds])

    def decode(self, ids: np.ndarray) -> bytes:
        """The text of a segmentation."""
        return b"".join(map(self.bytes_of.__getitem__, ids.tolist()))[1:]


_ready: dict[tuple[str, float], Lattice] = {}


def lattice(path: str, alpha: float = 1.0) -> Lattice:
    """The worker's own lattice of a file."""
    if (path, alpha) not in _ready:
        _ready[path, alpha] = Lattice(path, alpha)
    return _ready[path, alpha]
