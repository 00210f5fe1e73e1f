from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from plumbline.llm import lattice as L

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def model():
    return L.Lattice(PATH)


def split(ids, counts):
    end = np.cumsum(counts)
    return [ids[b - n : b] for n, b in zip(counts, end, strict=True)]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(alphabet="the an\n▁é漢🙂.,\x00\t", max_size=80), max_size=5), st.integers(0, 2**40))
def test_decoding_is_lossless(texts, seed):
    m = L.lattice(PATH)
    raw = [t.encode() for t in texts]
    rows = split(*m.sample(raw, np.arange(len(raw)), seed))
    assert [m.decode(x) for x in rows] == raw


def test_same_key_same_segmentation_whatever_the_batch(model):
    raw = [b"thing of the thonan, ingeat", b"", b"and the rest of it"] * 3
    keys = np.arange(9)
    one = split(*model.sample(raw, keys, 7))
    other = split(*L.Lattice(PATH).sample(raw[::-1], keys[::-1], 7))[::-1]
    assert [x.tolist() for x in one] == [x.tolist() for x in other]
    assert any(x.tolist() != y.tolist() for x, y in zip(one, split(*model.sample(raw, keys, 8)), strict=True))


def paths(m, s):
    if not s:
        return [((), 1.0)]
    return [((m.pieces[s[:j]][0], *r), m.pieces[s[:j]][1] * w) for j in range(1, len(s) + 1) if s[:j] in m.pieces for r, w in paths(m, s[j:])]


@pytest.mark.parametrize("word", ["than", "onst", "eaer"])
def test_samples_follow_the_weights(model, word):
    n = 20000
    found = Counter(tuple(x.tolist()) for x in split(*model.sample([word.encode()] * n, np.arange(n), 1)))
    every = paths(model, " " + word)
    total = sum(w for _, w in every)
    for p, w in every:
        assert abs(found[p] / n - w / total) < 0.02


def test_long_stretches_one_by_one_and_in_step_agree(model, monkeypatch):
    raw = [b"thonaningheat" * 9]
    want = model.sample(raw, np.array([3]), 2)[0].tolist()
    monkeypatch.setattr(L, "_IN_STEP", 0)
    fresh = L.Lattice(PATH)
    slow = fresh.sample(raw, np.array([3]), 2)[0]
    assert fresh.decode(slow) == raw[0] and model.decode(np.array(want)) == raw[0]
    long_ = b"x9" * 40000
    assert fresh.decode(fresh.sample([long_], np.array([1]), 2)[0]) == long_


def test_walks_without_edges_give_the_same_pieces(model, monkeypatch):
    raw = ["thonaningheat, and 漢字 🙂 of the\nrest▁x".encode() * 4, b"", b"x9" * 300, "ëëß".encode() * 500]
    keys = np.arange(len(raw))
    monkeypatch.setattr(L, "_IN_STEP", 10**6)
    want = [x.tolist() for x in split(*L.Lattice(PATH).sample(raw, keys, 5))]
    monkeypatch.setattr(L, "LONG", 0)
    assert [x.tolist() for x in split(*L.Lattice(PATH).sample(raw, keys, 5))] == want


def test_stretches_that_share_a_hash_are_sampled_alone(monkeypatch):
    raw = [b"a aa aaa b", b"aaaa a bbb"]
    monkeypatch.setattr(L, "span_hashes", lambda buf, start, end: buf[end - 1].astype(np.uint64))  # unlike lengths clash
    m = L.Lattice(PATH)
    got = split(*m.sample(raw, np.arange(2), 5))
    assert [m.decode(x) for x in got] == raw
