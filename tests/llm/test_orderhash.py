import hashlib

from pyspark.sql import functions as F

from plumbline.llm import orderhash as O


def signatures(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    return [r.s for r in df.select("i", O.signature(F.col("text")).alias("s")).orderBy("i").collect()]


def brute(spark, text):
    """The same selection in Python over Spark's hashes."""
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", text or "") if w]
    if not words:
        return []
    grams = [words[i : i + O.K] for i in range(max(1, len(words) - O.K + 1))]
    rows = spark.createDataFrame([(i, *(g + [None] * (O.K - len(g)))) for i, g in enumerate(grams)], "i int, " + ", ".join(f"w{j} string" for j in range(O.K)))
    base = {r.i: r.h for r in rows.select("i", F.xxhash64(*(f"w{j}" for j in range(O.K))).alias("h")).collect()}
    seen, picked = {}, []
    for i in sorted(base):
        seen[base[i]] = seen.get(base[i], 0) + 1
        picked.append((i, base[i], seen[base[i]]))
    again = [(i, s, n) for i, s, n in picked if n > 1]
    named = {}
    if again:
        df = spark.createDataFrame(again, "i int, s long, n int").select("i", F.xxhash64("s", "n").alias("h"))
        named = {r.i: r.h for r in df.collect()}
    bins = {}
    for k, i in sorted((named.get(i, s), i) for i, s, _ in picked):
        bins.setdefault((k % 2**64) >> 59, []).append((i, k))
    tuples = []
    for b, found in sorted(bins.items(), key=lambda x: x[0] - 32 if x[0] > 15 else x[0]):
        tuples.append((b, [k for _, k in sorted(found[: O.PICKS])]))
    df = spark.createDataFrame([(n, *(t + [None] * (O.PICKS - len(t)))) for n, (_, t) in enumerate(tuples)], "n int, a long, b long")
    h = {r.n: r.h & 0xFFFFFFFF for r in df.select("n", F.xxhash64("a", "b").alias("h")).collect()}
    return [(b << 32) | h[n] for n, (b, _) in enumerate(tuples)]


def test_selection_against_brute_force(spark):
    texts = ["a b c d e f g h i j k l m n o p", "one", "x y " * 60, " ".join(f"w{i % 37}" for i in range(400)), "", "  \n", "é 漢 " * 9]
    assert signatures(spark, texts) == [brute(spark, t) for t in texts]


def test_order_matters_and_equal_texts_agree(spark):
    words = [f"w{i}" for i in range(600)]
    moved = words[300:] + words[:300]
    a, b, c = signatures(spark, [" ".join(words), " ".join(words), " ".join(moved)])
    assert a == b
    same = len(set(a) & set(c)) / len(a)
    assert 0 < same < 1  # most k-mers are shared, but pairs that swapped places differ


def test_neighbours_and_edited_text(docs, empty):
    ordered = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("t")).orderBy(F.col("doc_id").asc_nulls_first(), F.xxhash64("t"))
    rows = [(r.doc_id, r.t) for r in ordered.collect()]
    got = O.with_next(docs).withColumn("edited", O.edited(F.col("text"), F.col("next_text"))).collect()
    want = []
    for i, (d, t) in enumerate(rows):
        n, h = len(t), len(t) // 2
        following = rows[(i + 1) % len(rows)][1]
        want.append((d, hashlib.md5(t.encode()).hexdigest(), hashlib.md5((t[: n - h] + following[:h]).encode()).hexdigest()))
    assert sorted(((r.doc_id, hashlib.md5(r.text.encode()).hexdigest(), hashlib.md5(r.edited.encode()).hexdigest()) for r in got), key=str) == sorted(want, key=str)
    assert O.with_next(empty).count() == 0


def test_ranges_of_neighbours(spark, monkeypatch):
    """Ids far apart, repeated and missing: ranges hold about as many rows, and each row meets the next."""
    for n in (1, 2, 7, 40):
        monkeypatch.setattr(O, "range_count", lambda df: n)  # noqa: B023
        rows = [(i * i, f"text {i}") for i in range(300)] + [(1 << 62, "far"), (-(1 << 62), "farther")] + [(None, f"none {i}") for i in range(150)] + [(9, f"nine {i}") for i in range(150)]
        df = spark.createDataFrame(rows, "doc_id long, text string")
        order = [(r.doc_id, r.text) for r in df.orderBy(F.col("doc_id").asc_nulls_first(), F.xxhash64("text")).collect()]
        got = {(r.doc_id, r.text): r.next_text for r in O.with_next(df).collect()}
        assert got == {a: b[1] for a, b in zip(order, order[1:] + order[:1], strict=True)}
        dealt = O._dealt(df.select("doc_id", "text", F.xxhash64("text").alias("row"), F.lit(0).alias("signature"))).filter("late = 0").groupBy("bucket").count().collect()
        assert sum(r["count"] for r in dealt) == len(rows) and max(r["count"] for r in dealt) <= 3 * len(rows) / n + 3
    one = spark.createDataFrame([(5, "alone")], "doc_id long, text string")
    assert [r.next_text for r in O.with_next(one).collect()] == ["alone"]


def test_likeness(spark):
    df = spark.createDataFrame([([1, (1 << 32) + 5], [1, (1 << 32) + 6]), ([], []), ([1], [])], "a array<long>, b array<long>")
    assert [r[0] for r in df.select(O.likeness(F.col("a"), F.col("b"))).collect()] == [0.5, 1.0, 0.0]
