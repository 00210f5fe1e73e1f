"""The stored word index against a scan of the texts."""

import math
import random
import re

import pytest

from plumbline.functions import fts
from plumbline.operators import searchindex as S


def corpus(n, seed):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(200)] + ["running", "runs", "Stations", "é漢"]
    pick = lambda: words[min(int(rng.expovariate(0.03)), len(words) - 1)]
    return [(i, " ".join(pick() + rng.choice(["", ",", "."]) for _ in range(rng.choice([3, 20, 60, 400])))) for i in range(n)]


ROWS = [*corpus(700, 1), (9000, None), (9001, ""), (None, "w1 w2 w3"), (9002, "w150 " * 900)]


def tokens(text, stemmed):
    text = (text or "").lower()
    return fts.lexemes(text) if stemmed else [(m.group(), i) for i, m in enumerate(re.finditer(r"[^\W_]+", text), 1)]


def by_scan(rows, words, stemmed, k):
    docs = {d: [w for w, _ in tokens(t, stemmed)] for d, t in rows if d is not None}
    mean = sum(map(len, docs.values())) / len(docs)
    out = {}
    for w in words:
        df = sum(w in x for x in docs.values())
        for d, x in docs.items():
            if w in x:
                tf, idf = x.count(w), math.log(1 + (len(docs) - df + 0.5) / (df + 0.5))
                out[d] = out.get(d, 0) + idf * tf * (S.K1 + 1) / (tf + S.K1 * (1 - S.B + S.B * len(x) / mean))
    return sorted(out.items(), key=lambda r: (-r[1], r[0]))[:k]


@pytest.mark.parametrize("stemmed", [True, False])
def test_ranking_and_phrases_against_a_scan(spark, tmp_path, monkeypatch, stemmed):
    monkeypatch.setattr(S, "BLOCK", 8)
    monkeypatch.setattr(S, "FIRST", 3)
    df = spark.createDataFrame(ROWS, "doc_id long, text string")
    index = S.SearchIndex.build(df.filter("doc_id is null or doc_id % 3 <> 0"), f"file://{tmp_path}/i", stemmed=stemmed, buckets=8).append(df.filter("doc_id % 3 = 0"))
    index = S.SearchIndex(spark, f"file://{tmp_path}/i")  # as a later session would
    assert index.docs == len(ROWS) - 1
    for q, k in (("w120 w0 w3", 7), ("runs running", 5), ("é漢 w199", 10_000), ("w150", 1)):
        want = by_scan(ROWS, index.lexemes(q), stemmed, k)
        got = [(r["key"], r.score) for r in index.search(q, k).collect()]
        assert [d for d, _ in got] == [d for d, _ in want] and all(math.isclose(a, b) for (_, a), (_, b) in zip(got, want, strict=True))
    assert index.search("not there at all zzz", 5).count() == 0 and index.search("", 5).count() == 0
    few, all_ = index.scored_blocks("w120 w0 w3", 3)
    assert few < all_
    asked = ["w0 w1", "w3 w0 w2", "runs", "w5 w5", "zzz w0", "é漢"]
    want = set()
    for p in asked:
        steps = tokens(p, stemmed)
        for d, t in ROWS:
            found = set(tokens(t, stemmed))
            if d is not None and any(all((w, i + at - steps[0][1]) in found for w, at in steps) for _, i in found):
                want.add((d, p))
    assert {tuple(r) for r in index.phrases(asked).collect()} == want and len({p for _, p in want}) >= 4
    assert index.phrases([]).count() == 0


def test_only_the_buckets_of_the_lexemes_are_read(spark, tmp_path):
    df = spark.createDataFrame(corpus(200, 2), "doc_id long, text string")
    index = S.SearchIndex.build(df, f"file://{tmp_path}/i", stemmed=False)
    rows = index.postings(["w1"])
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"DataFilters: \[[^\]]*lexeme", plan) and not re.search(r"DataFilters: \[[^\]]*bucket", plan)  # the bucket is a filter of files
    files = lambda f: f.select("postings", S.F.input_file_name().alias("f")).select("f").distinct().count()
    assert files(rows) < files(spark.read.parquet(f"file://{tmp_path}/i/postings")) / 10


def test_stems_of_the_published_vocabulary():
    """Pairs of the stemmer's published sample vocabulary."""
    pairs = """consign consign consigned consign consigning consign consignment consign consist consist consisted consist
    consistency consist consistent consist consistently consist consisting consist consists consist consolation consol consolations consol
    consolatory consolatori console consol consoled consol consoles consol consolidate consolid consolidated consolid consolidating consolid
    consoling consol consolingly consol consols consol consonant conson consort consort consorted consort consorting consort
    conspicuous conspicu conspicuously conspicu conspiracy conspiraci conspirator conspir conspirators conspir conspire conspir
    conspired conspir conspiring conspir constable constabl constables constabl constance constanc constancy constanc constant constant
    knack knack knackeries knackeri knacks knack knag knag knave knave knaves knave knavish knavish kneaded knead kneading knead
    knee knee kneel kneel kneeled kneel kneeling kneel kneels kneel knees knee knell knell knelt knelt knew knew knick knick
    knif knif knife knife knight knight knightly knight knights knight knit knit knits knit knitted knit knitting knit
    knives knive knob knob knobs knob knock knock knocked knock knocker knocker knockers knocker knocking knock knocks knock
    knopp knopp knot knot knots knot""".split()
    assert {w: fts.stem(w) for w in pairs[::2]} == dict(zip(pairs[::2], pairs[1::2], strict=True))


def test_texts_are_shuffled_once(spark, tmp_path, monkeypatch):
    """A batch is one shuffle of its texts by block: no rows by word are made and shuffled."""
    df = spark.createDataFrame([(i, "one two three four five " * 200) for i in range(300)], "doc_id long, text string")
    rows, explode = [], S.F.explode
    monkeypatch.setattr(S.F, "explode", lambda c: rows.append(c) or explode(c))
    index = S.SearchIndex.build(df, f"file://{tmp_path}/i", stemmed=False, buckets=4)
    assert not rows and (index.docs, index.mean) == (300, 1000.0)
    assert index.search("three", 1).collect()[0]["key"] == 0
