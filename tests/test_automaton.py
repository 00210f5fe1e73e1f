import random
import time

import numpy as np
import pyarrow as pa
import pytest

from plumbline.functions import automaton as A
from plumbline.functions.lexicon import phrases


def brute(texts, words):
    return [[i for i, p in enumerate(words) if p in t] for t in texts]


def found(texts, words):
    bits = A.Automaton(words).found([t.encode() for t in texts])
    return [[i for i in range(len(words)) if int(row[i // 64]) >> i % 64 & 1] for row in bits]


@pytest.mark.parametrize("alphabet, n", [("ab", 150), ("abcé漢 ", 90), ("abcdefghij", 3)])
def test_against_substring_search(alphabet, n, monkeypatch):
    rng = random.Random(n)
    monkeypatch.setattr(A, "WINDOW", 16)
    word = lambda most: "".join(rng.choice(alphabet) for _ in range(rng.randrange(1, most)))
    words = list(dict.fromkeys(word(9) for _ in range(n)))
    texts = ["", alphabet[0], *(word(200) for _ in range(150)), word(5000)]
    assert found(texts, words) == brute(texts, words)


def test_edges():
    assert found(["x", ""], []) == [[], []]
    assert found(["abc", ""], ["", "abc", "bc", "c", "abcd"]) == [[0, 1, 2, 3], [0]]
    long = "p" * 3000
    assert found([long + "q" + long, "q" + long], [long + "q", "q" + long]) == [[0, 1], [1]]


def test_across_windows():
    """A phrase at every place around the ends of windows."""
    texts = [" " * k + "needle in" + "." * 2000 for k in range(A.WINDOW - 12, A.WINDOW + 3)]
    assert found(texts, ["needle in", "in."]) == [[0, 1]] * len(texts)


def test_time_doesnt_go_by_the_number_of_phrases():
    rng = random.Random(3)
    texts = ["".join(rng.choice("abcdefghijklmnop ") for _ in range(4000)).encode() for _ in range(300)]
    few = [f"{rng.choice('abcd')}{i}x" for i in range(5)]
    many = few + [f"{rng.choice('abcdefgh')}{i}yz{i}" for i in range(2000)]
    took = []
    for words in (few, many):
        automaton = A.Automaton(words)
        automaton.found(texts[:5])
        took.append(min(_timed(lambda a=automaton: a.found(texts)) for _ in range(3)))
    assert took[1] < 4 * took[0] + 0.05


def _timed(f):
    begin = time.perf_counter()
    f()
    return time.perf_counter() - begin


def test_column(spark):
    words = phrases()
    texts = ["I hate that it is TEDIOUS and clunky", None, "", "nothing", "by hand, manually; copy paste " * 400]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").repartition(2)
    got = {r.i: r.h for r in df.select("i", A.phrase_hits(df["t"], words).alias("h")).collect()}
    assert got == {i: [w for w in words if t and w in t] for i, t in enumerate(texts)}
    assert np.array(A.Automaton(words).ends).shape[1] == 2


def test_a_batch_is_searched_in_slices(monkeypatch):
    """Bytes at once are bounded however many rows a batch has."""
    sizes, found = [], A.Automaton.found
    monkeypatch.setattr(A, "AT_ONCE", 2048)
    monkeypatch.setattr(A.Automaton, "found", lambda self, texts: sizes.append(sum(map(len, texts))) or found(self, texts))
    batch = pa.array(["x" * 700 + "ab"] * 9 + [None, "", "b" * 5000, "ba"])
    got = next(A.hits_of(iter([batch]), ["ab", "ba", "b"])).to_pylist()
    assert max(sizes) <= 5000 and len(sizes) > 3
    assert got == [["ab", "b"]] * 9 + [[], [], ["b"], ["ba", "b"]]
