from collections import Counter

from plumbline.llm.repetition import COVERAGE, LINES, measure, repetition_quality


def brute(text):
    words = (text or "").encode().split()
    n = len(words)
    size = [len(w.decode()) for w in words]
    total = sum(size)

    def inside(k):
        g = [tuple(words[i : i + k]) for i in range(n - k + 1)]
        c = Counter(g)
        return {i + j for i, x in enumerate(g) if c[x] > 1 for j in range(k)}

    seen, dup, dup_chars = set(), 0, 0
    for line in (text or "").split("\n"):
        if line.encode().split():
            if line in seen:
                dup += 1
                dup_chars += sum(len(w.decode()) for w in line.encode().split())
            seen.add(line)
    rep = len(inside(3))
    failed = n < 50 or 100 * rep > 50 * n
    bad = dup_chars / max(total, 1) > LINES or any(sum(size[i] for i in inside(k)) / max(total, 1) > most for k, most in COVERAGE.items())
    return n, total, sum(c in "#*$%&|<>" for c in text or ""), dup, rep, failed, not failed and not bad


def test_against_brute_force(docs):
    got = repetition_quality(docs).collect()
    want = Counter((r.doc_id, *brute(r.text)) for r in docs.collect())
    assert Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed, r.kept) for r in got) == want


def test_method_rejects_what_the_base_rule_keeps(spark):
    words = [f"w{i}" for i in range(300)]
    passage = " ".join(f"p{i}" for i in range(60))
    texts = [" ".join(words), " ".join([*words, passage, *words[:1], passage]), " ".join(words) + f"\n{passage}\n{passage}\n{passage}"]
    got = repetition_quality(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).orderBy("doc_id").collect()
    assert [r.base_failed for r in got] == [False] * 3 and [r.kept for r in got] == [True, False, False]
    assert [brute(t)[-1] for t in texts] == [True, False, False]


def test_empty_table_and_no_texts(empty):
    assert repetition_quality(empty).count() == 0
    assert measure([])["kept"].tolist() == []
