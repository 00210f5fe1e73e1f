"""The lexical funnel: source stages, keep predicate, union, insert of new signals, audit."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions import text as T
from plumbline.functions.lexicon import REVIEW_FEEDS
from plumbline.operators.upsert import first_wins, insert_ignore

SIGNAL = ("source", "source_id", "intent", "text", "score", "created_at_src", "lexicon_hits", "icp_guess", "dup_count", "is_duplicate")


def signals(rows: DataFrame, source: Column, source_id: Column, text: Column, score: Column, created: Column, words: Sequence[str] | None = None, starters: Sequence[str] | None = None, with_question: bool = True, low: int = T.MIN_LEN, high: int = T.MAX_LEN, long_min: int = T.LONG_MIN, matched: Column | None = None) -> DataFrame:
    """Rows that pass length gate and keep predicate, in the shape of a signal. Rows without id or text are dropped.

    ``matched`` replaces the substring test of the lexicon, e.g. by a full-text match.
    """
    base = rows.select(source.alias("source"), source_id.cast("string").alias("source_id"), text.alias("text"), score.cast("bigint").alias("score"), created.alias("created_at_src"), *([matched.alias("_matched")] if matched is not None else []))
    t = F.col("text")
    found = F.col("_matched") if matched is not None else T.has_phrase(t, words)
    kept = base.filter(F.col("source_id").isNotNull() & T.length_gate(t, low, high) & T.keep(t, found, T.starts_question(t, starters) if with_question else None, long_min, high))
    kept = kept.withColumn("intent", F.lit("pain")).withColumn("lexicon_hits", T.lexicon_hits(t, words)).withColumn("icp_guess", T.audience(t)).withColumn("dup_count", F.lit(1).cast("bigint")).withColumn("is_duplicate", F.lit(False))
    return kept.select(*SIGNAL)


def review_signals(documents: DataFrame, feeds: Mapping[str, str] | None = None, **options) -> DataFrame:
    """Stage of the review feeds: only listed feeds, no question path, rating as score, time from the metadata where it has one.

    Input: source_slug, ext_id, title, body, metadata (JSON text), fetched_at.
    """
    spark = documents.sparkSession
    listed = spark.createDataFrame(sorted((REVIEW_FEEDS if feeds is None else feeds).items()), "source_slug string, label string")
    rows = documents.join(F.broadcast(listed), "source_slug")  # a list given in code
    meta = F.col("metadata")
    rating = T.rating_score(F.coalesce(F.get_json_object(meta, "$.rating"), F.get_json_object(meta, "$.score")))
    created = T.guarded_time(F.get_json_object(meta, "$.at"), F.col("fetched_at"))
    return signals(rows, F.col("label"), F.col("ext_id"), T.title_body(F.col("title"), F.col("body")), rating, created, with_question=False, **options)


def post_signals(posts: DataFrame, **options) -> DataFrame:
    return signals(posts, F.lit("reddit_post"), F.col("reddit_id"), T.title_body(F.col("title"), F.col("selftext")), F.col("score"), F.col("created_utc"), **options)


def comment_signals(comments: DataFrame, posts: DataFrame, subreddit: str | None = None, **options) -> DataFrame:
    """Comments whose post is known (in one subreddit, where named)."""
    known = posts if subreddit is None else posts.filter(F.col("subreddit") == subreddit)
    rows = comments.join(known.select(F.col("reddit_id").alias("post_id")).distinct(), "post_id", "left_semi")
    return signals(rows, F.lit("reddit_comment"), F.col("reddit_id"), F.col("body"), F.col("score"), F.col("created_utc"), **options)


def video_comment_signals(comments: DataFrame, **options) -> DataFrame:
    return signals(comments, F.lit("youtube_comment"), F.col("comment_id"), F.col("text"), F.col("like_count"), F.col("published_at"), **options)


def transcript_signals(videos: DataFrame, **options) -> DataFrame:
    """Transcripts joined in the order of their segments; a longer upper bound."""
    text = F.array_join(F.transform("transcript", lambda s: s["text"]), " ")
    return signals(videos, F.lit("youtube_transcript"), F.col("video_id"), text, F.col("view_count"), F.col("published_at"), high=T.TRANSCRIPT_MAX, **options)


def insert_new(target: DataFrame, *stages: DataFrame) -> DataFrame:
    """New signals of all stages: the union, one row per (source, source_id), less what the target has."""
    rows = stages[0]
    for s in stages[1:]:
        rows = rows.unionByName(s)
    key = ["source", "source_id"]
    return insert_ignore(target, first_wins(rows, key, ["text"]).select(*rows.columns), key)


def audit(rows: DataFrame, kept: DataFrame, n: int = 20, min_score: int = 0, low: int = 40, words: Sequence[str] | None = None, starters: Sequence[str] | None = None) -> DataFrame:
    """The n highest scored rows that the funnel missed, with the paths that would have kept them."""
    floor = (F.coalesce(F.col("score"), F.lit(0)) >= min_score) & (F.char_length("text") >= low)
    missed = rows.filter(floor).join(kept.select("source", "source_id"), ["source", "source_id"], "left_anti")
    top = missed.orderBy(F.col("score").desc_nulls_last(), "source", "source_id").limit(n)
    return top.withColumn("flags", T.diagnose(F.col("text"), words, starters)).withColumn("snippet", T.snippet(F.col("text")))


def top_signals(rows: DataFrame, n: int = 20_000) -> DataFrame:
    """Signals by priority, ties by id."""
    ok = (F.col("intent") == "pain") & F.col("text").isNotNull() & (F.char_length("text") > 20)
    ranked = rows.filter(ok).withColumn("priority", T.priority(F.col("score"), F.col("dup_count")))
    return ranked.orderBy(F.col("priority").desc(), "source", "source_id").limit(n)


def fold_exact(rows: DataFrame, text: str = "text", key: str = "source_id") -> DataFrame:
    """One row per text: the smallest key, and how many rows had it."""
    folded = rows.groupBy(F.sha2(F.coalesce(F.col(text), F.lit("")), 256).alias("text_hash")).agg(F.min(key).alias(key), F.count("*").alias("dup_count"))
    return folded
