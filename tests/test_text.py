import datetime as dt

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from plumbline.functions import fts, htmlx, jsonx, lexicon, numbers
from plumbline.functions import text as T


def one(spark, value, expr, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(expr(F.col("x")).alias("y")).first().y


def test_lexicon_has_its_phrases_once():
    listed = lexicon.phrases()
    assert len(listed) == len(set(listed)) == 111


def test_hits_of_the_lexicon_come_longest_first(spark):
    text = "tedious manual work by hand, takes hours and hours every week, over and over"
    hits = one(spark, text, T.lexicon_hits)
    assert hits == sorted((p for p in lexicon.phrases() if p in text), key=lambda p: (-len(p), p)) and len(hits) == 6
    assert one(spark, text, lambda c: T.lexicon_hits(c, ["tedious", "by hand", "over and over", "none"])) == ["tedious", "by hand", "over and over"]


def test_hits_of_a_known_sentence(spark):
    text = "I would pay for this, doing it manually takes me hours every week."
    hits = one(spark, text, lambda c: T.lexicon_hits(c, squeeze=True))
    assert {"i would pay for", "manually", "takes me hours"} <= set(hits) and hits == sorted(hits)
    assert one(spark, text, T.has_phrase)
    assert not one(spark, "nothing here", T.has_phrase) and not one(spark, None, T.has_phrase)
    assert one(spark, "It costs us $ 5", T.has_phrase)


@pytest.mark.parametrize("text,sql,shape", [("How do I export this", True, True), ("So. Does anyone know", True, True), ("so how do i", False, False), ("x\n  need help now", True, False), ("is it? what now", False, True), ("helpful", False, False), (None, None, False)])
def test_question_paths(spark, text, sql, shape):
    assert one(spark, text, T.starts_question) == sql
    assert one(spark, text, T.question_shape) == shape


@pytest.mark.parametrize("text,want", [("my client pays the agency", "agency"), ("shopify store inventory", "ecom"), ("churn and mrr of our saas", "saas_operator"), ("client shopify", "agency"), ("array", "saas_operator"), ("none of it", None)])
def test_audience_vote(spark, text, want):
    assert one(spark, text, T.audience) == want


@pytest.mark.parametrize("rating,want", [("4.35", 4), ("-3", None), ("", None), (None, None), ("5", 5), ("95/100", 95)])
def test_rating(spark, rating, want):
    assert one(spark, rating, T.rating_score) == want


@pytest.mark.parametrize("text,want", [("1.1K", 1100), ("800,000+", 800000), ("2M", 2000000), ("3b", 3000000000), ("", None), ("many", None), (None, None), ("2.5", 2)])
def test_human_int(spark, text, want):
    assert one(spark, text, numbers.human_int) == want


def test_other_numbers(spark):
    assert one(spark, " $1,234.50 ", numbers.money) == 1234.5 and one(spark, "n/a", numbers.money) is None
    assert one(spark, "1,234 likes", numbers.likes) == 1234
    assert one(spark, "report-2024-05-06.csv", numbers.date_in_name) == dt.date(2024, 5, 6)
    assert one(spark, "20240203", numbers.compact_date) == dt.datetime(2024, 2, 3)
    assert one(spark, "soon", numbers.compact_date) is None


def test_time_and_topic(spark):
    late = F.lit("2020-01-01").cast("timestamp")
    assert one(spark, "2024-01-02 03:04:05", lambda c: T.guarded_time(c, late)) == dt.datetime(2024, 1, 2, 3, 4, 5)
    assert one(spark, "2024-99-99", lambda c: T.guarded_time(c, late)) == dt.datetime(2020, 1, 1)
    assert one(spark, None, lambda c: T.guarded_time(c, late)) == dt.datetime(2020, 1, 1)
    assert one(spark, "Slow-Sync now!", T.topic_slug) == "slow_sync_now"
    assert one(spark, "Slow -Sync now!", T.rollup_topic) == "slow_sync_now_"


def test_diagnose_and_snippet(spark):
    assert one(spark, "nothing", T.diagnose) == ["NO-PATH"]
    assert one(spark, "how do i fix this manually " + "x" * 300, T.diagnose)[0] == "lexicon:manually"
    assert one(spark, "one  two three four", lambda c: T.snippet(c, 12)) == "one two …"


def test_json_in_prose(spark):
    assert one(spark, 'So: {"a": 1} ok', jsonx.json_in_prose) == '{"a": 1}'
    assert one(spark, 'List [{"a": 1}, {"a": 2}] ok', jsonx.json_in_prose) == '[{"a": 1}, {"a": 2}]'
    assert one(spark, "none", jsonx.json_in_prose) is None


@pytest.mark.parametrize("old,new,want", [('{"a":1,"b":2}', '{"b":3}', '{"a":"1","b":"3"}'), (None, '{"b":3}', '{"b":"3"}'), ('{"a":1}', None, '{"a":"1"}'), (None, None, None)])
def test_shallow_merge(spark, old, new, want):
    df = spark.createDataFrame([(old, new)], "a string, b string")
    assert df.select(jsonx.shallow_merge(F.col("a"), F.col("b")).alias("y")).first().y == want


def test_html_values(spark):
    html = '<title> A &amp; B</title><meta property="og:title" content="Name"><a class=x href="/y">l</a><script type="application/ld+json">{"@type":"Other"}</script><script type="application/ld+json">{"@type":"SoftwareApplication","name":"N"}</script><p>seen<style>p{}</style>'
    assert one(spark, html, htmlx.title) == " A & B" and one(spark, html, lambda c: htmlx.meta(c, "og:title")) == "Name"
    assert one(spark, html, htmlx.links) == ["/y"]
    assert one(spark, html, lambda c: F.get_json_object(htmlx.json_ld_of(c, "SoftwareApplication"), "$.name")) == "N"
    assert one(spark, html, htmlx.visible_text) == "A & B l seen"
    assert one(spark, "https://x.test/a/b/", htmlx.last_part) == "b"


@pytest.mark.parametrize("word,want", [("running", "run"), ("frustrating", "frustrat"), ("tired", "tire"), ("switches", "switch"), ("expensive", "expens"), ("cries", "cri"), ("ties", "tie"), ("hopping", "hop"), ("hoping", "hope"), ("generally", "general"), ("national", "nation"), ("relational", "relat"), ("conditional", "condit"), ("hopefulness", "hope"), ("knightly", "knight"), ("agreed", "agre"), ("skies", "sky"), ("controlling", "control"), ("happy", "happi"), ("by", "by")])
def test_stems(word, want):
    assert fts.stem(word) == want


def test_phrases_match_by_position():
    q = fts.compile_phrases(["tired of paying", "over and over", "by hand"])
    assert len(q) == 2  # a phrase of stop words alone vanishes
    assert fts.matches("I am TIRED of paying for it", q) and fts.matches("wash hands", q)
    assert not fts.matches("tired paying", q) and not fts.matches(None, q)
    assert fts.matches("so tired when pays", q)  # any one stop word may stand in between


@settings(max_examples=50, deadline=None)
@given(st.text(alphabet="abcdefgy'", max_size=12))
def test_stemmer_takes_any_word(word):
    assert isinstance(fts.stem(word), str)


def test_inverted_index(spark):
    df = spark.createDataFrame([(1, "pay and pay"), (2, "paying")], "id int, text string")
    assert sorted((r.lexeme, r.id, r.positions) for r in fts.inverted_index(df, "id", "text").collect()) == [("pay", 1, [1, 3]), ("pay", 2, [1])]


def test_texts_are_indexed_in_slices(spark):
    """Slices follow the bytes, and rows of one key are put together."""
    batch = pa.array(["ab", None, "c" * 10, "", "déf", "x"])
    assert [(at, s.to_pylist()) for at, s in fts.in_slices(batch, 5)] == [(0, ["ab", None]), (2, ["c" * 10]), (3, ["", "déf", "x"])]
    df = spark.createDataFrame([(1, "pays to pay"), (1, "pay"), (None, "pay"), (2, None), (3, "the")], "id int, text string")
    got = sorted((r.lexeme, r.id or 0, r.positions) for r in fts.inverted_index(df, "id", "text").collect())
    assert got == [("pay", 0, [1]), ("pay", 1, [1, 1, 3])]
