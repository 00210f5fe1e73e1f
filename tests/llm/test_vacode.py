import hashlib
import math
import random

import numpy as np
import pytest

from plumbline.llm import vacode as V

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, rounds=V.ROUNDS):
    """Plain loops over whole numbers."""
    fine = [(i, v, k) for i, v, k in rows if v and all(x is not None and math.isfinite(x) and abs(x) < V.LIMIT for x in v)]
    fine.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    if not fine:
        return []
    dims = len(fine[0][1])
    fine = [(i, [math.floor(4096 * float(np.float32(x))) for x in v] + [0] * (-dims % 8), k) for i, v, k in fine if len(v) == dims]
    w = len(fine[0][1]) // 8
    part = lambda v, j: v[j * w : (j + 1) * w]
    books = [[part(v, j) for _, v, _ in fine[:16]] for j in range(8)]
    near = lambda x, book: min((sum((a - b) ** 2 for a, b in zip(x, e, strict=True)), n) for n, e in enumerate(book))
    for _ in range(rounds):
        for j in range(8):
            held = {}
            for _, v, _ in fine:
                held.setdefault(near(part(v, j), books[j])[1], []).append(part(v, j))
            books[j] = [[sum(c) // len(c) for c in zip(*held[n], strict=True)] if n in held else e for n, e in enumerate(books[j])]
    sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    out = []
    for i, v, k in fine:
        best = [near(part(v, j), books[j]) for j in range(8)]
        out.append((i, "".join(f"{n:02x}" for _, n in best), sum(d for d, _ in best), k))
    return [(i, c, e, sum(x[2] for x in out if x[3] == k), sha) for i, c, e, k in out]


def rows_of(n, dims, seed, spread=0.3):
    rng = random.Random(seed)
    grid = lambda: float(np.float32(rng.choice([rng.gauss(0, spread), rng.randrange(-3, 4) / 4096, 0.0])))
    return [(i * 3, [grid() for _ in range(dims)], rng.choice([1, 2, None])) for i in range(n)]


def odd(dims):
    v = [0.5] * dims
    nan, inf = float("nan"), float("inf")
    rows = [(-9, None, 1), (-8, [], 1), (-7, [None, *v[1:]], 1), (-6, [nan, *v[1:]], 2), (-5, [*v[1:], -inf], 2), (-4, [3.4e38, *v[1:]], 2)]
    return [*rows, (1, v, None), (1, v, None), (1, [0.25] * dims, 7), (None, v, 7), (2, v * 2, 7), (4, [-30000.0, *v[1:]], 7), (5, [-0.00001] * dims, 7)]


def order(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, *r[1:]))


@pytest.mark.parametrize("rows", [rows_of(300, 16, 1) + odd(16), rows_of(90, 11, 2) + odd(11), odd(8), rows_of(3, 8, 3), [(2, [1.0] * 8, 1)] * 40], ids=["16", "11", "odd", "few", "copies"])
def test_codes_against_plain_loops(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).repartition(5).selectExpr("*", "'mine' as code", "1 as error", "2 as id", "3 as vector", "4 as of")
    got = V.compress(df).collect()
    assert order(tuple(r) for r in got) == order(brute(rows))


def test_bounds_hold_and_filter():
    rng = np.random.default_rng(4)
    for top in (40, 5000, 1 << 26):
        book = V.Codebook(rng.integers(-top, top, (16, 8)))
        x = rng.integers(-2 * top, 2 * top, (500, 8))
        low, high = book.bounds(x)
        exact = ((x[:, None] - book.entries[None]) ** 2).sum(2)
        assert (low <= exact).all() and (exact <= high).all()
        assert (low <= high.min(1)[:, None]).mean() < 0.6  # of the entries, those that are refined
        at, distance = book.nearest(x)
        assert (at == exact.argmin(1)).all() and (distance == exact.min(1)).all()


def test_ties_go_to_the_lower_index():
    book = V.Codebook(np.array([[5, 0], [3, 4], [3, 4], [-5, 0]]))
    at, distance = book.nearest(np.array([[0, 0], [3, 4], [0, 1]]))
    assert at.tolist() == [0, 1, 1] and distance.tolist() == [25, 0, 18]


def test_error_falls_and_decoding_is_near(spark):
    rows = rows_of(400, 32, 9)
    df = spark.createDataFrame(rows, SCHEMA)
    errors = [V.compress(df, rounds=k).agg({"error": "sum"}).first()[0] for k in (0, 1, 6)]
    assert errors[0] > errors[1] > errors[2]
    books = V.train(df)
    codes = {r.id: [int(r.code[2 * j : 2 * j + 2], 16) for j in range(8)] for r in V.encode(df, books).collect()}
    back = books.decode(np.array([codes[i] for i, _, _ in rows]))
    x = np.array([v for _, v, _ in rows])
    assert back.shape == x.shape and ((back - x) ** 2).sum() < 0.8 * ((x - x.mean(0)) ** 2).sum()


def test_empty_table(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert V.compress(none).columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"] and V.compress(none).count() == 0
    assert V.compress(spark.createDataFrame([(1, None, 1)], SCHEMA)).count() == 0
