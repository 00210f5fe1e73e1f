"""Gaps and the ranges to read again, and packing, against plain loops."""

import random

import pytest
from pyspark.sql import functions as F

from plumbline.operators import gaps, packing
from plumbline.sources.paged import PagedSource

ITEMS = [{"id": f"i{t}", "created_utc": t} for t in (3, 5, 40, 41, 90, 91, 140)]


def fetch(after, before, size):
    """A service; it says what it was asked for by what it gives."""
    return [x for x in ITEMS if after < x["created_utc"] < before][:size]


def test_gaps_against_loops(spark):
    rng = random.Random(3)
    items = [(rng.choice("ab"), int(rng.expovariate(0.002))) for _ in range(300)] + [(None, 5), ("a", None), ("c", 7)]
    asked = [("a", 100, 400), ("a", 300, 900), ("a", 900, 950), ("b", 0, 100_000), ("c", 0, 20), ("d", 5, 90), ("a", 50, 50), (None, 1, 99), ("b", 10, 20)]
    df, wanted = spark.createDataFrame(items, "s string, t long").repartition(4), spark.createDataFrame(asked, "shard string, after long, before long")
    for most in (1, 13, 60):
        want = set()
        for s, ranges in {"a": [(100, 950)], "b": [(0, 100_000)], "c": [(0, 20)], "d": [(5, 90)]}.items():
            for lo, hi in ranges:
                points = sorted({lo, hi} | {t for x, t in items if x == s and t is not None and lo < t < hi})
                want |= {(s, a, b) for a, b in zip(points, points[1:], strict=False) if b - a > most}
        assert {tuple(r) for r in gaps.to_read(df, wanted, "s", "t", most).collect()} == want


def test_the_source_reads_just_the_gaps(spark):
    """An earlier run had lost what came between 5 and 90, and after 91."""
    spark.dataSource.register(PagedSource)
    had = spark.createDataFrame([("x", t) for t in (3, 5, 90, 91)], "s string, t long")
    asked = spark.createDataFrame([("x", 0, 150)], "shard string, after long, before long")
    option = gaps.as_option(gaps.to_read(had, asked, "s", "t", 10))
    assert option == "[[5, 90], [91, 150]]"
    read = spark.read.format("paged").options(transport="tests.test_repair:fetch", ranges=option).load()
    assert read.rdd.getNumPartitions() == 2
    assert sorted(r.id for r in read.collect()) == ["i140", "i40", "i41"]


@pytest.mark.parametrize("ranges", [1, 6])
def test_prompts_have_whole_items_in_order_under_the_budget(spark, ranges):
    rng = random.Random(8)
    items = [(i, rng.randrange(4), "é" * rng.randrange(90) + f"end{i}") for i in range(500)] + [(1000, 2, None)]
    df = spark.createDataFrame(items, "id long, score long, text string").repartition(7)
    order = [F.col("score").desc(), F.col("id")]
    rows = packing.packed(df, F.col("text"), order, 400, ["t1", "t2", "t1"], ranges)
    made = sorted(packing.prompts(rows, [-F.col("score"), F.col("id")], ["t1", "t2", "t1"]).collect())
    assert [r.prompt for r in made] == list(range(len(made))) and all(len(r.text) <= 400 and r.text.startswith("t1\nt2\n") for r in made)
    told = [x for r in made for x in r.text[6:].split("\n")[:-1]]
    assert told == [t or "" for _, _, t in sorted(items, key=lambda r: (-r[1], r[0]))]
    assert min(len(r.text) for r in made[:-1]) > 400 - 2 * 97  # a step is filled
    with pytest.raises(ValueError):
        packing.packed(df, F.col("text"), order, 90)
    assert packing.prompts(packing.packed(df.limit(0), F.col("text"), order, 90), [F.col("id")]).count() == 0


def test_running_total_over_ranges_with_ties_in_the_first_key(spark):
    df = spark.range(1000).withColumn("k", F.lit(1)).withColumn("n", F.col("id") % 7)
    got = packing.running_total(df, [F.col("k"), F.col("id")], "n", "s", 9)
    want, s = {}, 0
    for i in range(1000):
        s += i % 7
        want[i] = s
    assert {r.id: r.s for r in got.collect()} == want
