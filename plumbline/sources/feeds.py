"""JSON feeds into documents. A feed says where its items are and how one becomes a row.

Input is a table of raw payloads (column ``payload``, JSON text), as files or a stream give
them; network clients are not part of this. Rows without a key are dropped, a batch is
collapsed by ``upsert.last_wins`` or ``first_wins``, and written by the feed's policy.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions.text import stripped

ITEM = "_item"


def text(path: str) -> Column:
    """A value of the item as text."""
    return F.try_variant_get(ITEM, f"$.{path}", "string")


def value(path: str) -> Column:
    """A value of the item as it is, to go into the metadata."""
    return F.try_variant_get(ITEM, f"$.{path}", "variant")


def either(*paths: str, default: str | None = None) -> Column:
    """The first of the values that is neither null nor empty."""
    found = [F.nullif(text(p), F.lit("")) for p in paths]
    return F.coalesce(*found, *([F.lit(default)] if default is not None else [])) if found else F.lit(default)


def metadata(**fields: str | Column) -> Column:
    return F.to_json(F.struct(*((value(v) if isinstance(v, str) else v).alias(k) for k, v in fields.items())), {"ignoreNullFields": "false"})


@dataclass(frozen=True)
class Feed:
    """Items of a payload and their mapping; ``items`` is a path to an array, '' for a payload that is an array itself."""

    slug: str
    items: str
    ext_id: Callable[[], Column]
    url: Callable[[], Column]
    title: Callable[[], Column]
    body: Callable[[], Column]
    meta: Callable[[], Column]
    ready: Callable[[], Column] = field(default=lambda: F.lit(True))

    def rows(self, raw: DataFrame, payload: str = "payload") -> DataFrame:
        """(source_slug, ext_id, url, title, body, metadata, content_hash) and the payload's other columns."""
        source = F.get_json_object(payload, f"$.{self.items}") if self.items else F.col(payload)
        one = F.when(F.startswith(stripped(source), F.lit("{")), F.concat(F.lit("["), source, F.lit("]"))).otherwise(source)
        rest = [c for c in raw.columns if c != payload]
        rows = raw.select(*rest, F.explode(F.from_json(one, "array<variant>")).alias(ITEM)).filter(self.ready())
        out = rows.select(F.lit(self.slug).alias("source_slug"), self.ext_id().alias("ext_id"), self.url().alias("url"), self.title().alias("title"), self.body().alias("body"), self.meta().alias("metadata"), *rest)
        return out.filter("ext_id is not null").withColumn("content_hash", F.sha2(F.coalesce("body", F.lit("")), 256))


def _entities(c: Column) -> Column:
    from plumbline.functions.htmlx import few_entities

    return stripped(few_entities(F.coalesce(c, F.lit(""))))


def _either_url(path: str, prefix: str, key: str, suffix: str = "") -> Column:
    return F.coalesce(either(path), F.concat(F.lit(prefix), text(key), F.lit(suffix)))


def _words(path: str) -> Column:
    return F.coalesce(text(path), F.lit("None"))


FEEDS: dict[str, Feed] = {
    f.slug: f
    for f in (
        Feed("reddit_feed", "data.children", lambda: text("data.id"), lambda: F.concat(F.lit("https://www.reddit.com"), F.coalesce(text("data.permalink"), F.lit(""))), lambda: text("data.title"), lambda: either("data.selftext", "data.title", default=""),
             lambda: metadata(sub=F.coalesce(value("data.subreddit"), value("sub")), score="data.score", num_comments="data.num_comments", author="data.author", created_utc="data.created_utc", flair="data.link_flair_text")),
        Feed("hackernews", "hits", lambda: text("objectID"), lambda: _either_url("url", "https://news.ycombinator.com/item?id=", "objectID"), lambda: text("title"), lambda: either("story_text", "title", default=""),
             lambda: metadata(points="points", num_comments="num_comments", author="author", created_at="created_at", query="query")),
        Feed("producthunt", "data.posts.edges", lambda: text("node.id"), lambda: text("node.url"), lambda: text("node.name"), lambda: stripped(F.concat(F.coalesce(text("node.tagline"), F.lit("")), F.lit("\n"), F.coalesce(text("node.description"), F.lit("")))),
             lambda: metadata(votes="node.votesCount", comments="node.commentsCount", created_at="node.createdAt", topics=F.transform(F.from_json(F.to_json(value("node.topics.edges")), "array<struct<node:struct<name:string>>>"), lambda t: t["node"]["name"]))),
        Feed("ycombinator", "", lambda: either("id", "slug"), lambda: _either_url("website", "https://www.ycombinator.com/companies/", "slug"), lambda: text("name"), lambda: either("long_description", "one_liner", default=""),
             lambda: metadata(one_liner="one_liner", batch="batch", industry="industry", subindustry="subindustry", tags="tags", team_size="team_size", locations="all_locations", top_company="top_company", is_hiring="isHiring", status="status", launched_at="launched_at")),
        Feed("stackexchange", "items", lambda: F.concat_ws("_", either("site", default="None"), text("question_id")), lambda: text("link"), lambda: text("title"), lambda: either("body", "title", default=""),
             lambda: metadata(site="site", score="score", answers="answer_count", tags="tags", is_answered="is_answered", query="query"), lambda: text("question_id").isNotNull()),
        Feed("wordpress_plugins", "plugins", lambda: either("slug"), lambda: _either_url("homepage", "https://wordpress.org/plugins/", "slug", "/"), lambda: _entities(text("name")),
             lambda: F.concat(_entities(text("short_description")), F.lit("\n\n[active_installs="), _words("active_installs"), F.lit(", rating="), _words("rating"), F.lit("/100 ("), _words("num_ratings"), F.lit(" ratings), support_threads="), _words("support_threads"), F.lit(", resolved="), _words("support_threads_resolved"), F.lit("]")),
             lambda: metadata(active_installs="active_installs", rating="rating", num_ratings="num_ratings", support_threads="support_threads", support_threads_resolved="support_threads_resolved", src="src")),
        Feed("devto", "", lambda: F.nullif(either("id"), F.lit("0")), lambda: text("url"), lambda: F.coalesce(text("title"), F.lit("")), lambda: stripped(F.concat(F.coalesce(text("title"), F.lit("")), F.lit("\n\n"), either("body_markdown", "description", default=""))),
             lambda: metadata(tags=F.coalesce(value("tag_list"), value("tags")), reactions=F.coalesce(value("public_reactions_count"), value("positive_reactions_count")), comments_count="comments_count", reading_time="reading_time_minutes", published_at="published_at", user=F.struct(value("user.username").alias("username"), value("user.name").alias("name")), tag_seed="tag_seed")),
        Feed("appstore_reviews", "feed.entry", lambda: either("id.label"), lambda: F.concat(F.lit("https://apps.apple.com/"), either("country", default="us"), F.lit("/app/id"), F.coalesce(text("app_id"), F.lit(""))), lambda: text("title.label"), lambda: text("content.label"),
             lambda: metadata(app="app", app_id="app_id", genre="genre", rating=F.try_variant_get(ITEM, "$['im:rating'].label", "string"), version=F.try_variant_get(ITEM, "$['im:version'].label", "string"), author="author.name.label"), lambda: F.try_variant_get(ITEM, "$['im:rating']", "variant").isNotNull()),
        Feed("google_play_reviews", "reviews", lambda: either("reviewId"), lambda: text("url"), lambda: F.coalesce(either("title"), F.concat(stripped(F.substring(text("content"), 1, 60)), F.when(F.char_length(text("content")) > 60, "...").otherwise(""))), lambda: text("content"),
             lambda: metadata(app="app", app_id="app_id", score="score", thumbs_up="thumbsUpCount", version=either("reviewCreatedVersion", "appVersion"), at=text("at"), keyword="keyword"), lambda: either("content").isNotNull()),
        Feed("atlassian_app", "_embedded.addons", lambda: either("key"), lambda: F.concat(F.lit("https://marketplace.atlassian.com/apps/"), text("key")), lambda: either("name", "key"),
             lambda: F.concat_ws("\n\n", either("name", "key"), either("tagLine", "summary"), F.when(F.coalesce(text("summary"), F.lit("")) != F.coalesce(either("tagLine", "summary"), F.lit("")), either("summary"))),
             lambda: metadata(rating="_embedded.reviews.averageStars", review_count="_embedded.reviews.count", downloads="_embedded.distribution.downloads", categories=F.transform(F.from_json(F.to_json(value("_embedded.categories")), "array<struct<name:string>>"), lambda c: c["name"]), tags="tags", vendor="_embedded.vendor.name", vendor_link=F.concat(F.lit("https://marketplace.atlassian.com"), text("_links.vendor.href")), tagline=either("tagLine", "summary", default=""), reviews_sample=F.slice(F.from_json(F.to_json(value("reviews_sample")), "array<variant>"), 1, 5))),
    )
}


_ITEMS = "array<struct<guid: struct<_VALUE: string>, link: string, title: string, description: string, pubDate: string>>"


def news_items(raw: DataFrame, feed: str, payload: str = "payload") -> DataFrame:
    """RSS payloads into documents: guid or link as key, description or title as body; a payload that is no XML has no items."""
    parsed = raw.select(F.from_xml(payload, f"struct<channel: struct<item: {_ITEMS}>, item: {_ITEMS}>", {"ignoreNamespace": "true"}).alias("f"))
    none = F.array().cast(_ITEMS)
    rows = parsed.select(F.explode(F.concat(F.coalesce("f.channel.item", none), F.coalesce("f.item", none))).alias("x"))  # some feeds have them beside the channel

    def tag(name: str) -> Column:
        return F.nullif(stripped(F.col(f"x.{name}")), F.lit(""))

    meta = F.to_json(F.struct(F.lit(feed).alias("feed"), F.coalesce(tag("pubDate"), F.lit("")).alias("published")))
    out = rows.select(F.lit("news_rss").alias("source_slug"), F.coalesce(tag("guid._VALUE"), tag("link")).alias("ext_id"), tag("link").alias("url"), tag("title").alias("title"), F.coalesce(tag("description"), tag("title"), F.lit("")).alias("body"), meta.alias("metadata"))
    return out.filter("ext_id is not null")


def reddit_posts(raw: DataFrame, payload: str = "payload") -> DataFrame:
    """Archive pages of posts; those without id or time are dropped, titles cut at 2000 characters."""
    rows = raw.select(F.explode(F.from_json(F.get_json_object(payload, "$.data"), "array<variant>")).alias(ITEM))
    number = lambda k: F.coalesce(text(k).try_cast("bigint"), F.lit(0))
    out = rows.select(text("id").alias("reddit_id"), text("subreddit").alias("subreddit"), F.substring(F.coalesce(text("title"), F.lit("")), 1, 2000).alias("title"), text("selftext").alias("selftext"), text("author").alias("author"), number("score").alias("score"), number("num_comments").alias("num_comments"), F.concat(F.lit("https://reddit.com"), text("permalink")).alias("url"), F.timestamp_seconds(text("created_utc").try_cast("double").cast("bigint")).alias("created_utc"))
    return out.filter("reddit_id is not null and created_utc is not null").withColumn("updated_at", F.col("created_utc"))


def reddit_comments(raw: DataFrame, payload: str = "payload") -> DataFrame:
    """Archive pages of comments: the post by its bare id, a parent only where it is a comment."""
    rows = raw.select(F.explode(F.from_json(F.get_json_object(payload, "$.data"), "array<variant>")).alias(ITEM))
    parent = F.when(F.startswith(text("parent_id"), F.lit("t1_")), F.substring(text("parent_id"), 4, 100))
    out = rows.select(text("id").alias("reddit_id"), F.regexp_replace(text("link_id"), "^t3_", "").alias("post_reddit_id"), parent.alias("parent_reddit_id"), text("author").alias("author"), text("body").alias("body"), F.coalesce(text("score").try_cast("bigint"), F.lit(0)).alias("score"), F.timestamp_seconds(text("created_utc").try_cast("double").cast("bigint")).alias("created_utc"))
    return out.filter("reddit_id is not null and created_utc is not null")


def _time(path: str) -> Column:
    return F.timestamp_seconds(text(path).try_cast("double").cast("bigint"))


def legacy_posts(raw: DataFrame, payload: str = "payload") -> DataFrame:
    """Submissions as the older worker fetched them, one payload each: {"submission": {..}, "comments": [..]}."""
    rows = raw.select(F.try_parse_json(F.get_json_object(payload, "$.submission")).alias(ITEM)).filter(F.col(ITEM).isNotNull())
    count = lambda k: text(k).try_cast("bigint").alias(k)
    out = rows.select(text("id").alias("reddit_id"), text("subreddit").alias("subreddit"), text("title").alias("title"), either("selftext").alias("selftext"), _words("author").alias("author"), count("score"), text("upvote_ratio").try_cast("double").alias("upvote_ratio"), count("num_comments"), text("url").alias("url"), text("link_flair_text").alias("flair"), _time("created_utc").alias("created_utc"))
    return out.filter("reddit_id is not null")


def legacy_comments(raw: DataFrame, payload: str = "payload") -> DataFrame:
    """Their whole comment trees: the parent by its bare id whether post or comment, depth, number of awards."""
    post = F.get_json_object(payload, "$.submission.id").alias("post_reddit_id")
    rows = raw.select(post, F.explode(F.from_json(F.get_json_object(payload, "$.comments"), "array<variant>")).alias(ITEM))
    awards = F.coalesce(F.size(F.from_json(F.to_json(value("all_awardings")), "array<variant>")), F.lit(0))
    out = rows.select("post_reddit_id", text("id").alias("reddit_id"), F.regexp_replace(text("parent_id"), "^[^_]*_", "").alias("parent_reddit_id"), text("body").alias("body"), _words("author").alias("author"), text("score").try_cast("bigint").alias("score"), text("depth").try_cast("int").alias("depth"), F.greatest(awards, F.lit(0)).alias("awards"), _time("created_utc").alias("created_utc"))
    return out.filter("reddit_id is not null")
