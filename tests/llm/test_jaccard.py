import random
import re

import numpy as np
import pytest

from plumbline.llm import jaccard as J


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    return frozenset(tuple(words[i : i + 4]) for i in range(max(1, len(words) - 3))) if words else frozenset()


def linked(a, b):
    return bool(a) and bool(b) and 100 * len(a & b) >= 85 * len(a | b)


def brute(rows):
    """(doc_id, size, smallest id reachable) row by row."""
    sets = [shingles(t) for _, t in rows]
    part = list(range(len(rows)))

    def top(i):
        while part[i] != i:
            i = part[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if linked(sets[i], sets[j]):
                part[top(i)] = top(j)
    groups = {}
    for i in range(len(rows)):
        groups.setdefault(top(i), []).append(rows[i][0])
    least = lambda i: min((d for d in groups[top(i)] if d is not None), default=None)
    return sorted(((d, len(s), least(i) if s else d) for i, ((d, _), s) in enumerate(zip(rows, sets, strict=True))), key=str)


def corpus(seed):
    """Short and long texts, chains at the threshold, groups of near copies, a passage that many share, equal sets of other texts."""
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(3000)}"
    texts = []
    for n in (1, 3, 4, 8, 9, 10, 11, 12, 16, 23, 40, 120, 400):
        base = [word() for _ in range(n)]
        for _ in range(6):
            x = list(base)
            for _ in range(rng.choice([0, 1, 1, 2, max(1, n // 50)])):
                x[rng.choice([0, -1, rng.randrange(len(x))])] = word()
            texts.append(" ".join(x[: rng.choice([n, n, max(1, n - 1)])]))
            base = rng.choice([base, x])
    hot = [word() for _ in range(60)]
    texts += [" ".join([*hot[:-1], f"end{i}"]) for i in range(40)]
    passage = [word() for _ in range(50)]
    texts += [" ".join([*(word() for _ in range(rng.randrange(4, 60))), *passage, *(word() for _ in range(rng.randrange(30)))]) for _ in range(60)]
    texts += ["a b c d a b c d a b c d", "d a b c d a b c d a b c d", "A B c D\ta b c d"]
    rng.shuffle(texts)
    return [(i * 3, t) for i, t in enumerate(texts)]


@pytest.mark.parametrize("small, most", [(None, 256), (10**9, 256), (20, 3), (0, 5)])
def test_components_against_all_pairs(spark, docs, monkeypatch, small, most):
    """Whatever the boundary, and with lists in blocks: workers get the constants with the code."""
    monkeypatch.setattr(J, "MOST", most)
    given = [(r.doc_id, r.text) for r in docs.collect()]
    rows = [*given, *((i + 1000, t) for i, t in corpus(small or most)), (None, "first of a link that only rows without id have " * 3)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'mine' as key", "1 as n", "2 as node", "'x' as prefix").repartition(5)
    got = J.similar(df, small)
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(rows)


def test_null_ids_link_and_bridge(spark):
    base = [f"t{i}" for i in range(60)]
    change = lambda *at: " ".join(f"x{i}" if i in at else w for i, w in enumerate(base))
    rows = [(5, change()), (None, change(0)), (2**60 + 1, change(0, 59)), (None, "alone and without any id here"), (9, change(30, 20, 10))]
    assert sorted((tuple(r) for r in J.similar(spark.createDataFrame(rows, "doc_id long, text string")).collect()), key=str) == brute(rows)


def test_prefix_lemma():
    """Sets that just link share as many first elements as the keys need, in any order of elements."""
    rng = random.Random(2)
    for _ in range(3000):
        n = rng.randrange(6, rng.choice([20, 90, 900]))
        m = rng.randrange(-(-85 * n // 100), 100 * n // 85 + 1)
        both = int(J.shared_least(np.array(n), np.array(m)))
        if both > min(n, m):
            continue
        pool = rng.sample(range(10**6), n + m - both)
        a, b = sorted(pool[:n]), sorted(pool[n - both :])
        for k in (1, 2):
            cut = lambda x: set(x[: int(J.prefix_size(np.array(len(x)))) + k - 1])
            assert len(cut(a) & cut(b)) >= k
        lists = [set(x[: int(J.prefix_size(len(x)) + J.wanted(len(x))) - 1]) for x in (a, b)]
        assert len(lists[0] & lists[1]) >= max(int(J.needed(n)), int(J.needed(m)))
        assert all(len(x) <= J.listed_size(k) for x, k in zip(lists, (n, m), strict=True))


def test_prefixes_shrink_by_one_at_most():
    sizes = J.prefix_size(np.arange(6, 100_000))
    assert (np.maximum.accumulate(sizes) - sizes <= 1).all()


def test_forest_spans_groups():
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 60, 200).astype(np.uint64)
    sets = [np.unique(np.concatenate((base[k % 7 :], rng.integers(0, 1 << 60, k % 5).astype(np.uint64)))) for k in range(40)]
    sets += [np.unique(rng.integers(0, 1 << 60, 190).astype(np.uint64)) for _ in range(10)]
    links = J.forest(sets, np.arange(50))
    assert len(links) == 39 and all(linked(set(sets[a].tolist()), set(sets[b].tolist())) for a, b in links)
    assert J.forest(sets, np.array([0] * 40 + list(range(1, 11)))) == []


def test_sketches_differ_in_no_more_cells_than_sets_in_elements():
    rng = np.random.default_rng(5)
    for n in (1, 50, 5000):
        base = rng.integers(0, 1 << 63, n).astype(np.uint64)
        for k in (0, 1, n // 2, n):
            x, y = np.unique(base), np.unique(np.concatenate((base[k:], rng.integers(0, 1 << 63, k // 2 + 1).astype(np.uint64))))
            one, two = sorted((np.frombuffer(J.sketch(s), np.uint64) for s in (x, y)), key=len)
            while len(two) > len(one):
                two = two[: len(two) // 2] ^ two[len(two) // 2 :]
            apart = np.bitwise_count(one ^ two).sum(dtype=np.int64)
            assert apart <= len(np.setxor1d(x, y)) and (apart - len(np.setxor1d(x, y))) % 2 == 0


def test_suspects_have_every_pair_that_links():
    """Sets of sizes around a change of width, linked and not, in one block."""
    import pyarrow as pa

    rng = np.random.default_rng(6)
    base = rng.integers(0, 1 << 62, 2300).astype(np.uint64)
    sets = [np.unique(np.concatenate((base[: 2300 - k], rng.integers(0, 1 << 62, k // 3).astype(np.uint64)))) for k in range(0, 900, 60)]
    sets += [np.unique(rng.integers(0, 1 << 62, 2000 + 20 * k).astype(np.uint64)) for k in range(8)]
    n = len(sets)
    batch = pa.RecordBatch.from_pydict({"key": [1] * n, "block": [""] * n, "node": list(range(n)), "root": list(range(n)), "n": [len(x) for x in sets], "sketch": [J.sketch(x) for x in sets]})
    assert len({len(J.sketch(x)) for x in sets}) == 2
    got = {i for out in J._suspects(iter([batch])) for i in out.column("node").to_pylist()}
    want = {i for i in range(n) for j in range(n) if i != j and linked(set(sets[i].tolist()), set(sets[j].tolist()))}
    assert want <= got and want and not got & set(range(n - 8, n))


def test_boundary_follows_cost():
    sets = {J.size_class(np.array([n]))[0].item(): (1000, float(n)) for n in (10, 20, 40, 300, 2000)}
    assert J.boundary(sets, {}) < 10  # nothing to scan: lists
    small = J.boundary(sets, {c: 1e9 for c in sets})
    assert small >= 40
    assert J.boundary({}, {}) == 0


def test_empty_table(empty):
    assert J.similar(empty).count() == 0
