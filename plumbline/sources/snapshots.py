"""Snapshot payloads by job type, and the inputs of jobs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.sources.feeds import ITEM, either, metadata, text, value


def _reddit() -> tuple[Column, ...]:
    meta = metadata(subreddit=either("community_name", "subreddit"), community_url="community_url", user="user_posted", date_posted="date_posted", num_comments="num_comments", num_upvotes=F.coalesce(value("num_upvotes"), value("upvotes")), photos="photos", videos="videos", related_queries="related_queries", comments="comments")
    return either("post_id", "id", "url"), text("url"), text("title"), either("description", "markdown", "title", default=""), meta


def _reddit_comment() -> tuple[Column, ...]:
    meta = metadata(post_url=either("post_url", "url"), parent=either("parent_comment_id", "parent_id"), user=either("user_posted", "author"), upvotes=F.coalesce(value("num_upvotes"), value("score")), date=either("date_posted", "created_at"), subreddit=either("community_name", "subreddit"))
    return either("comment_id", "id", "url"), either("url", "comment_url"), F.substring(either("post_title", default="comment"), 1, 200), either("comment", "body", "text", default=""), meta


def _generic() -> tuple[Column, ...]:
    return F.coalesce(either("id", "url", "product_id"), F.substring(F.to_json(ITEM), 1, 120)), text("url"), either("title", "name"), either("description", "review", "text", "content", default=""), F.to_json(ITEM)


MAPS = {"reddit": _reddit, "reddit_comment": _reddit_comment, "generic": _generic}


def snapshot_rows(raw: DataFrame, kind: str, slug: str, payload: str = "payload") -> DataFrame:
    """A snapshot (a JSON array of records) into documents."""
    rows = raw.select(F.explode(F.from_json(payload, "array<variant>")).alias(ITEM))
    columns = ("ext_id", "url", "title", "body", "metadata")
    out = rows.select(F.lit(slug).alias("source_slug"), *(c.alias(n) for c, n in zip(MAPS.get(kind, _generic)(), columns, strict=True)))
    return out.filter("ext_id is not null")


def expand_inputs(subreddits: DataFrame, keywords: DataFrame, sort_by: str = "New", num_of_posts: int = 10) -> DataFrame:
    """Every subreddit with every keyword: two short lists of a job."""
    return subreddits.crossJoin(keywords).withColumn("sort_by", F.lit(sort_by)).withColumn("num_of_posts", F.lit(num_of_posts))


def daily_inputs(inputs: DataFrame, today: Column) -> DataFrame:
    """Inputs with the day before ``today`` where they name no dates."""
    day = F.date_format(F.date_sub(today, 1), "yyyy-MM-dd")
    out = inputs
    for c in ("date", "start_date", "end_date"):
        out = out.withColumn(c, F.coalesce(F.col(c), day) if c in out.columns else day)
    return out


def check_job(job: dict) -> dict:
    """A job without a limit is refused."""
    if not job.get("limit"):
        raise ValueError(f"job {job.get('name')!r} has no limit")
    return job
