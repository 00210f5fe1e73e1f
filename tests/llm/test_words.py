import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from plumbline.llm.words import Words, covered, grams, runs, window_min

TEXT = st.text(alphabet="ab \n\t\x0b\x1f\x85\xa0é漢🙂,.", max_size=60)


@settings(max_examples=150, deadline=None)
@given(st.lists(TEXT, max_size=6))
def test_words_are_those_of_the_pattern(texts):
    w = Words([t.encode() for t in texts])
    got = [[w.data[a:b].decode() for a, b in zip(w.start[w.first[d] : w.first[d + 1]], w.end[w.first[d] : w.first[d + 1]], strict=True)] for d in range(len(texts))]
    assert got == [re.findall(r"[^\x20\x09-\x0D]+", t) for t in texts]


def test_hash_tells_words_apart_and_equal_words_together():
    words = [b"a" * n + bytes([98 + n % 3]) for n in range(1, 300)] + [b"x%d" % i for i in range(2000)]
    w = Words([b" ".join(words), b" ".join(reversed(words))])
    h = w.hashes()
    n = len(words)
    assert len(set(h[:n].tolist())) == n
    assert h[:n].tolist() == h[n:][::-1].tolist()


def test_grams_and_window_minimum():
    h = np.random.default_rng(1).integers(0, 1 << 63, 500).astype(np.uint64)
    h[300:340] = h[100:140]
    for n in (1, 2, 3, 5, 7, 10, 16, 50):
        g = grams(h, n)
        assert len(g) == len(h) - n + 1
        if n <= 40:
            assert (g[100 : 140 - n + 1] == g[300 : 340 - n + 1]).all()
        assert len(set(g.tolist())) == len({h[i : i + n].tobytes() for i in range(len(g))})
        assert window_min(h, n).tolist() == [h[i : i + n].min() for i in range(len(h) - n + 1)]
    assert len(grams(h[:3], 5)) == 0


def test_cover_and_runs():
    assert covered(6, np.array([1, 2]), 2).tolist() == [False, True, True, True, False, False]
    assert runs(np.array([True, False, True, False])).tolist() == [0, 2]
