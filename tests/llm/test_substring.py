import random

import pytest

from plumbline.llm import substring as S


def brute(rows):
    first = {}
    for d, t in rows:
        w = (t or "").encode().split()
        for i in range(len(w) - S.WINDOW + 1) if d is not None else ():
            k = tuple(w[i : i + S.WINDOW])
            first[k] = min(first.get(k, d), d)
    out = []
    for d, t in rows:
        w = (t or "").encode().split()
        gone = set()
        for i in range(len(w) - S.WINDOW + 1) if d is not None else ():
            if first[tuple(w[i : i + S.WINDOW])] < d:
                gone.update(range(i, i + S.WINDOW))
        out.append((d, len(w), len(gone), b" ".join(x for i, x in enumerate(w) if i not in gone).decode()))
    return sorted(out, key=str)


def result(df):
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.kept) for r in S.remove_repeats(df).collect()), key=str)


def test_against_brute_force(docs):
    assert result(docs) == brute([(r.doc_id, r.text) for r in docs.collect()])


def mixed(seed, n):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(40)]
    passages = [[rng.choice(words) for _ in range(rng.randint(30, 130))] for _ in range(6)]
    rows = []
    for i in range(n):
        parts = []
        for _ in range(rng.randint(1, 4)):
            p = rng.choice(passages)
            cut = rng.randint(0, 20)
            parts += p[cut:] if rng.random() < 0.8 else [rng.choice(words) for _ in range(70)]
        rows.append((i, " ".join(parts)))
    return rows


def test_shared_passages(spark):
    rows = mixed(3, 60)
    assert result(spark.createDataFrame(rows, "doc_id long, text string")) == brute(rows)


@pytest.mark.parametrize("hot", [2, 12])
def test_anchors_of_many_contexts_are_folded_and_go_by_their_windows(spark, monkeypatch, hot):
    monkeypatch.setattr(S, "HOT", hot)
    rows = mixed(4, 50)
    assert result(spark.createDataFrame(rows, "doc_id long, text string")) == brute(rows)


@pytest.mark.parametrize("hot", [2, 500])
def test_rows_that_repeat_a_doc_id_with_other_texts(spark, monkeypatch, hot):
    monkeypatch.setattr(S, "HOT", hot)
    rows = [(i % 12, t) for i, t in mixed(5, 40)]
    rows += rows[:3]
    assert result(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)) == brute(rows)


def test_one_word_over_and_over(spark):
    rows = [(1, "a " * 900), (2, "b " * 60 + "a " * 700), (3, "a b " * 300), (4, "b " * 55 + "a b " * 90)]
    assert result(spark.createDataFrame(rows, "doc_id long, text string")) == brute(rows)


def test_automaton_matches_like_search():
    rng = random.Random(2)
    for _ in range(200):
        old = [[rng.randint(0, 2) for _ in range(rng.randint(1, 15))] for _ in range(4)]
        a = S.Automaton()
        for x in old:
            a.add(x)
        q = [rng.randint(0, 2) for _ in range(20)]
        for n in (1, 3, 5):
            want = [i for i in range(len(q) - n + 1) if any(x[j : j + n] == q[i : i + n] for x in old for j in range(len(x) - n + 1))]
            assert a.matches(q, n) == want


def test_empty_table(empty):
    assert S.remove_repeats(empty).count() == 0
