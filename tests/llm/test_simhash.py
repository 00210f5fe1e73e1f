import random

import numpy as np
import pytest
import xxhash

from plumbline.llm import simhash as S


def brute_fp(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    h = [xxhash.xxh64_intdigest(x, 42) for x in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components(fps):
    ids = sorted(fps)
    label = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for i in ids:
            for j in ids:
                if label[j] < label[i] and (fps[i] ^ fps[j]).bit_count() <= S.DISTANCE:
                    label[i], changed = label[j], True
    return label


def test_fingerprints_and_components(docs):
    rows = [r for r in docs.collect() if r.doc_id is not None]
    fps = {r.doc_id: brute_fp(r.text) for r in rows}
    got = S.near_duplicates(docs).filter("doc_id is not null").collect()
    assert sorted((r.doc_id, r.fp & (2**64 - 1), r.component_id) for r in got) == sorted((r.doc_id, fps[r.doc_id], components(fps)[r.doc_id]) for r in rows)
    kept = {r.doc_id for r in S.keep_first(docs).collect()}
    assert kept == {i for i, c in components(fps).items() if i == c} | {None}


@pytest.mark.parametrize("most", [2, 20_000])
def test_links_of_random_and_near_fingerprints(spark, monkeypatch, most):
    monkeypatch.setattr(S, "MOST", most)
    rng = random.Random(5)
    fps = {}
    for i in range(0, 600, 3):  # chains: each at most four bits from the one before
        fps[i] = rng.getrandbits(64)
        fps[i + 1] = fps[i] ^ sum(1 << b for b in rng.sample(range(64), 4))
        fps[i + 2] = fps[i + 1] ^ sum(1 << b for b in rng.sample(range(64), rng.choice([3, 4, 5])))
    for i in range(600, 800):  # a full bucket of unlike ones, as short texts make
        fps[i] = rng.getrandbits(40)
    links = S.near_links(spark.createDataFrame([(S._signed(f),) for f in fps.values()], "fp long"))
    root = {S._signed(f): S._signed(f) for f in fps.values()}
    root.update({r.u: r.v for r in S.stars(links).collect()})
    least = {}
    for i in sorted(fps):
        least.setdefault(root[S._signed(fps[i])], i)
    assert {i: least[root[S._signed(f)]] for i, f in fps.items()} == components(fps)


def test_rows_without_id_link_and_bridge(spark):
    """Near texts, some without an id, ids past 2^53, and texts that only rows without an id have."""
    base = [f"w{i}" for i in range(400)]
    near = lambda k: " ".join([*base[:k], f"new{k}", *base[k + 1 :]])
    rows = [(None, near(0)), (2**60 + 3, near(100)), (2**60 + 1, near(200)), (None, near(300)), (None, "only without an id, and far from all others"), (None, ""), (None, None), (7, "far " * 9 + "away")]
    rows += [(None, f"text {i} of its own " * 5) for i in range(30)]
    fps = [brute_fp(t) for _, t in rows]
    part = components(dict(enumerate(fps)))
    least = {}
    for k, (i, _) in enumerate(rows):
        least[part[k]] = min((x for x in (least.get(part[k]), i) if x is not None), default=None)
    assert least[part[0]] == 2**60 + 1 and (fps[0] ^ fps[1]).bit_count() <= S.DISTANCE
    got = S.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(((r.doc_id, r.fp & (2**64 - 1), r.component_id) for r in got), key=str) == sorted(((i, fps[k], least[part[k]]) for k, (i, _) in enumerate(rows)), key=str)


def test_every_choice_of_blocks_meets_each_close_pair():
    rng = random.Random(1)
    for m in (6, 7, 8):
        masks = S.block_masks(m)
        for _ in range(200):
            d = sum(1 << b for b in rng.sample(range(64), 4))
            assert any(d & x == 0 for x in masks)
            given = next(x for x in masks if d & x == 0)
            assert any(d & x == 0 and x & given == given and x != given for x in S.block_masks(6, given))


def test_forest_spans_dense_groups():
    base = 0x123456789ABCDEF0
    fp = np.array([base ^ (1 << i) for i in range(64)] + [base ^ 0xFFFF00], np.uint64)
    a, b = S.forest(fp)
    assert len(a) == 63 and (np.bitwise_count(fp[a] ^ fp[b]) <= 4).all()


def test_empty_table(empty):
    assert S.near_duplicates(empty).count() == 0
