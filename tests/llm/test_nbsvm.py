import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from plumbline.llm import nbsvm


def corpus(n, seed):
    rng = np.random.default_rng(seed)
    words = ["tion", "ander", "the", "ofin", "reble", "hath", "on"]
    texts, labels = [], []
    for i in range(n):
        ws = [str(w) for w in rng.choice(words, 40)]
        good = i % 4 != 0
        texts.append((" ".join(ws) if good else " | ".join(w.upper() + "!!" for w in ws)).encode())
        labels.append(int(good))
    return texts, np.array(labels)


def test_learns_and_is_calibrated():
    model = nbsvm.fit(*corpus(400, 1))
    texts, labels = corpus(200, 2)
    p = model.score(texts)
    assert ((p >= nbsvm.THRESHOLD) == (labels == 1)).mean() > 0.98
    assert ((p >= 0) & (p <= 1)).all()


def test_descent_reaches_the_optimum():
    rng = np.random.default_rng(0)
    x = rng.standard_normal((60, 5))
    y = np.where(x @ np.array([1, -2, 0.5, 0, 1]) + 0.3 * rng.standard_normal(60) > 0, 1.0, -1.0)
    rows = [np.arange(5)] * 60
    w, b = nbsvm._descend(rows, list(x), y, 1.0, 400, 0)
    loss = lambda v, c: 0.5 * (v @ v + c * c) + np.maximum(0, 1 - y * (x @ v + c)).sum()
    best = loss(w[:5], b)
    for _ in range(300):
        assert loss(w[:5] + 0.05 * rng.standard_normal(5), b + 0.05 * rng.standard_normal()) > best - 0.05


def test_features_are_indicators_of_the_whole_text():
    long_ = b"a b " * (nbsvm._STRETCH // 2) + b"ZQ!"
    (at,) = nbsvm.features([long_])
    (again,) = nbsvm.features([long_ + b" " + long_])
    assert len(at) == len(set(at.tolist()))
    assert set(at.tolist()) <= set(again.tolist())
    assert [len(x) for x in nbsvm.features([b"", b"a"])][0] == 0


@pytest.mark.parametrize("labels", [[], [1, 1], [0, 0]])
def test_one_class_or_none(labels):
    model = nbsvm.fit([b"some text"] * len(labels), np.array(labels))
    p = model.score([b"", b"any"])
    assert p[0] == p[1] and (abs(p[0] - (0.5 if not labels else labels[0])) < 1e-3)


def test_train_and_score(spark, docs, empty):
    texts, labels = corpus(300, 3)
    rows = [(i + 100, t.decode(), int(y)) for i, (t, y) in enumerate(zip(texts, labels, strict=True))]
    df = spark.createDataFrame(rows, "doc_id long, text string, quality int")
    marks = df.select("doc_id", "quality").union(spark.createDataFrame([(None, 1), (5, None), (99999, 0)], "doc_id long, quality int"))
    model = nbsvm.train(df.select("doc_id", "text"), marks)
    got = {r.doc_id: r for r in nbsvm.with_score(df, model).select("doc_id", "score", nbsvm.held_out(df.doc_id).alias("h")).collect()}
    held = [i for i, _, _ in rows if zlib.crc32(str(i).encode()) % 5 == 0]
    assert sorted(i for i, r in got.items() if r.h) == held
    assert np.mean([(got[i].score >= nbsvm.THRESHOLD) == (y == 1) for i, _, y in rows if i in set(held)]) > 0.95
    scored = nbsvm.with_score(docs.drop("score"), model)
    assert scored.count() == docs.count() and scored.filter("score is null or score < 0 or score > 1").count() == 0
    assert nbsvm.with_score(empty.drop("score"), model).count() == 0
    assert nbsvm.train(empty, marks.limit(0)).score([b"x"])[0] == pytest.approx(0.5)


def _mixed(x):
    m = 2**64 - 1
    x = ((x ^ x >> 30) * 0xBF58476D1CE4E5B9) & m
    x = ((x ^ x >> 27) * 0x94D049BB133111EB) & m
    return x ^ x >> 31


def brute_places(text):
    out = set()
    for k in range(4):
        for i in range(len(text) - k):
            gram = int.from_bytes(text[i : i + k + 1], "little")
            out.add(((gram * nbsvm._ODD[k] + k) * 0x9E3779B1) % 2**32 >> 14)
    kind = lambda c: 5 if c > 127 else 1 if chr(c).islower() else 2 if chr(c).isupper() else 3 if chr(c).isdigit() else 4
    words = text.split()
    shape = [_mixed((min(len(w), 15) // 4 | kind(w[0]) << 4 | kind(w[-1]) << 8 | (i > 0 and words[i - 1] == w) << 12) + 1) for i, w in enumerate(words)]
    for n in (1, 2, 3):
        for i in range(len(shape) - n + 1):
            acc = 0
            for h in shape[i : i + n]:
                acc = (acc * 0x9E3779B97F4A7C15 + h) % 2**64
            out.add(_mixed(acc ^ n) >> 46)
    return sorted(out)


def test_features_and_scores_against_brute_force():
    texts = [b"", b"a", "Some words, some Words ß 漢字 12 !!".encode(), b"the the the end. The END\nand more of it 3x"]
    found = [x.tolist() for x in nbsvm.features(texts)]
    assert found == [brute_places(t) for t in texts]
    model = nbsvm.fit(*corpus(80, 4))
    for t, p in zip(texts, model.score(texts), strict=True):
        at = brute_places(t)
        margin = sum(float(model.weight[i]) for i in at) / max(len(at), 1) ** 0.5 + model.bias
        assert p == pytest.approx(1 / (1 + np.exp(-(model.slope * margin + model.offset))))


def test_repeated_and_missing_ids(spark):
    texts, labels = corpus(60, 5)
    rows = [(i, t.decode(), int(y)) for i, (t, y) in enumerate(zip(texts, labels, strict=True))]
    one = spark.createDataFrame(rows, "doc_id long, text string, quality int")
    many = one.union(one).union(one)
    a, b = (nbsvm.train(x.select("doc_id", "text"), one.select("doc_id", "quality")) for x in (one, many))
    assert (a.weight == b.weight).all() and a.bias == b.bias
    assert spark.sql("select cast(null as long) as i").select(nbsvm.held_out(F.col("i"))).first()[0] is False
