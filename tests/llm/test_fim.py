import hashlib
import re

import pytest

from plumbline.llm import fim

ODD = [
    (20, "a\nb\nc"),
    (21, "\n\n\n"),
    (22, "no break"),
    (23, "has <S> inside\nand more\n"),
    (24, "<P"),
    (25, "one <\n<\nS>\n>P\n"),
    (26, "漢字 🙂\né\r\nß x\n"),
    (None, "no id\nbut lines\n"),
    (28, "$1 \\ line\n" * 3000),
    (29, "y" * 200_000),
    (29, "z\n" * 50_000),
    (30, "tail\n"),
]


def by_hand(doc, text, seed=7, rate=100, spm=50):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    h = hashlib.sha256(f"{seed}:{'' if doc is None else doc}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * i : 8 * i + 8], 16) for i in range(4))
    n = len(units)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = ("".join(units[x:y]) for x, y in ((0, a), (a, b), (b, n)))
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= rate:
        return n, "plain", None, None, None, text
    if h4 % 100 < spm:
        return n, "spm", p, m, s, f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", p, m, s, f"<P>{p}<S>{s}<M>{m}"


@pytest.mark.parametrize("rate, spm", [(100, 50), (40, 0), (0, 50), (100, 100)])
def test_arrangement_and_round_trip(spark, docs, rate, spm):
    rows = docs.select("doc_id", "text").unionByName(spark.createDataFrame(ODD, "doc_id long, text string"))
    made = fim.arranged(rows.selectExpr("doc_id", "text", "'mine' as prefix", "1 as n", "'x' as form"), 7, rate, spm, keep=["text"])
    got = made.withColumn("back", fim.restored(made["output"], made["form"])).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[1] or "")
    want = sorted(((r.doc_id, r.text) for r in rows.collect()), key=key)
    got = sorted(((r.doc_id, r.text, r.n, r.form, r.prefix, r.middle, r.suffix, r.output, r.back) for r in got), key=key)
    assert got == [(d, t, *by_hand(d, t, 7, rate, spm), t or "") for d, t in want]
    if (rate, spm) == (100, 50):
        assert {r[3] for r in got} == {"plain", "psm", "spm"}


def test_a_stranger_id_and_text_column(spark):
    df = spark.createDataFrame([("k1", "a\nb\n", 5)], "key string, body string, keep int")
    r = fim.arranged(df, 3, id_col="key", text_col="body", keep=["keep"]).first()
    assert (r.key, r.keep, r.n) == ("k1", 5, 2) and r.output == by_hand("k1", "a\nb\n", 3)[-1]


def test_empty_table(empty):
    assert fim.arranged(empty, 7).count() == 0


def test_no_python_and_no_shuffle(docs):
    made = fim.arranged(docs, 7)
    plan = made.select(fim.restored(made["output"], made["form"]))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan
