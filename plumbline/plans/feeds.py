"""Queries of the source mappings. Raw payloads are made from ``part``, mapped by the source's operator, and metadata is laid out in columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.plans.registry import query, read
from plumbline.sources import feeds, pages, reports, snapshots, videos


def _k() -> Column:
    return F.col("p_partkey")


def _text() -> Column:
    return _k().cast("string")


def _json(**fields: Column) -> Column:
    return F.to_json(F.struct(*(v.alias(k) for k, v in fields.items())))


def _parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The parts, dealt to all cores: a small file of many rows is one task, and their payloads are much larger than they are."""
    return read(spark, sf_dir, "part").repartition(spark.sparkContext.defaultParallelism, "p_partkey")


def _raw(spark: SparkSession, sf_dir: str, before: str, item: Column, after: str, *rest: Column) -> DataFrame:
    """One payload per part."""
    return _parts(spark, sf_dir).select(F.concat(F.lit(before), item, F.lit(after)).alias("payload"), *rest)


def _laid_out(rows: DataFrame, *keys: str, columns: tuple[str, ...] = ("ext_id", "url", "title", "body")) -> DataFrame:
    return rows.select(*columns, *(F.get_json_object("metadata", f"$.{k}").alias(f"m_{k}") for k in keys))


@query(
    """select 't3_' || p_partkey as ext_id, 'https://www.reddit.com' || case when p_partkey % 3 = 0 then '' else '/r/x/' || p_partkey end as url, p_name as title,
    case when p_partkey % 2 = 0 then p_type else p_name end as body, p_brand as m_sub, p_size::varchar as m_score, (p_size * 2)::varchar as m_num_comments, 'u' || p_partkey as m_author, (1700000000 + p_partkey)::varchar as m_created_utc,
    case when p_partkey % 5 = 0 then 'flair' end as m_flair from part where p_partkey % 11 <> 0"""
)
def source_reddit_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listing feed: a missing permalink gives the bare host, an empty text the title; posts without id go."""
    item = _json(id=F.when(_k() % 11 != 0, F.concat(F.lit("t3_"), _text())), permalink=F.when(_k() % 3 != 0, F.concat(F.lit("/r/x/"), _text())), title=F.col("p_name"), selftext=F.when(_k() % 2 == 0, F.col("p_type")).otherwise(""), subreddit=F.col("p_brand"), score=F.col("p_size"), num_comments=F.col("p_size") * 2, author=F.concat(F.lit("u"), _text()), created_utc=1700000000 + _k(), link_flair_text=F.when(_k() % 5 == 0, F.lit("flair")))
    raw = _raw(spark, sf_dir, '{"data":{"children":[{"data":', item, "}]}}")
    return _laid_out(feeds.FEEDS["reddit_feed"].rows(raw), "sub", "score", "num_comments", "author", "created_utc", "flair")


@query(
    """select p_partkey::varchar as ext_id, case when p_partkey % 3 = 0 then 'https://news.ycombinator.com/item?id=' || p_partkey else 'https://x.test/' || p_partkey end as url, p_name as title,
    case when p_partkey % 2 = 0 then p_type else p_name end as body, p_size::varchar as m_points, case when p_partkey % 4 <> 0 then (p_size + 1)::varchar end as m_num_comments, p_brand as m_author, '2024-01-01T00:00:00Z' as m_created_at, 'q' as m_query from part where p_partkey % 7 <> 0"""
)
def source_hackernews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Search hits: without an address the discussion's, without a text the title."""
    item = _json(objectID=F.when(_k() % 7 != 0, _text()), url=F.when(_k() % 3 != 0, F.concat(F.lit("https://x.test/"), _text())), title=F.col("p_name"), story_text=F.when(_k() % 2 == 0, F.col("p_type")), points=F.col("p_size"), num_comments=F.when(_k() % 4 != 0, F.col("p_size") + 1), author=F.col("p_brand"), created_at=F.lit("2024-01-01T00:00:00Z"), query=F.lit("q"))
    raw = _raw(spark, sf_dir, '{"hits":[', item, "]}")
    return _laid_out(feeds.FEEDS["hackernews"].rows(raw), "points", "num_comments", "author", "created_at", "query")


@query(
    """select p_partkey::varchar as ext_id, 'https://x.test/' || p_partkey as url, p_name as title, case p_partkey % 3 when 0 then p_type || chr(10) || p_brand when 1 then p_type else p_brand end as body,
    p_size::varchar as m_votes, (p_size + 2)::varchar as m_comments, '2024' as m_created_at, '["a","' || p_brand || '"]' as m_topics from part where p_partkey % 13 <> 0"""
)
def source_producthunt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posts of a graph query: tagline and description, names of the topics."""
    topics = F.array(*(F.struct(F.struct(n.alias("name")).alias("node")) for n in (F.lit("a"), F.col("p_brand"))))
    item = _json(id=F.when(_k() % 13 != 0, _text()), url=F.concat(F.lit("https://x.test/"), _text()), name=F.col("p_name"), tagline=F.when(_k() % 3 != 2, F.col("p_type")), description=F.when(_k() % 3 != 1, F.col("p_brand")), votesCount=F.col("p_size"), commentsCount=F.col("p_size") + 2, createdAt=F.lit("2024"), topics=F.struct(topics.alias("edges")))
    raw = _raw(spark, sf_dir, '{"data":{"posts":{"edges":[{"node":', item, "}]}}}")
    return _laid_out(feeds.FEEDS["producthunt"].rows(raw), "votes", "comments", "created_at", "topics")


@query(
    """select case when p_partkey % 2 = 0 then p_partkey::varchar else 'slug-' || p_partkey end as ext_id, case when p_partkey % 3 = 0 then 'https://x.test/' || p_partkey else 'https://www.ycombinator.com/companies/slug-' || p_partkey end as url,
    p_name as title, case when p_partkey % 5 = 0 then p_type else p_brand end as body, p_brand as m_one_liner, 'W24' as m_batch, p_type as m_industry, '["t1","t2"]' as m_tags, p_size::varchar as m_team_size, 'true' as m_top_company, 'false' as m_is_hiring, 'Active' as m_status from part"""
)
def source_ycombinator(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A list of companies; the id, or else the slug, is the key."""
    slug = F.concat(F.lit("slug-"), _text())
    item = _json(id=F.when(_k() % 2 == 0, _k()), slug=slug, website=F.when(_k() % 3 == 0, F.concat(F.lit("https://x.test/"), _text())), name=F.col("p_name"), long_description=F.when(_k() % 5 == 0, F.col("p_type")), one_liner=F.col("p_brand"), batch=F.lit("W24"), industry=F.col("p_type"), tags=F.array(F.lit("t1"), F.lit("t2")), team_size=F.col("p_size"), top_company=F.lit(True), isHiring=F.lit(False), status=F.lit("Active"))
    raw = _raw(spark, sf_dir, "[", item, "]")
    return _laid_out(feeds.FEEDS["ycombinator"].rows(raw), "one_liner", "batch", "industry", "tags", "team_size", "top_company", "is_hiring", "status")


@query(
    """select case when p_partkey % 2 = 0 then 'so' else 'None' end || '_' || p_partkey as ext_id, 'https://x.test/q/' || p_partkey as url, p_name as title, case when p_partkey % 3 = 0 then p_type else p_name end as body,
    case when p_partkey % 2 = 0 then 'so' end as m_site, p_size::varchar as m_score, (p_size % 5)::varchar as m_answers, '["sql"]' as m_tags, case when p_size > 20 then 'true' else 'false' end as m_is_answered from part where p_partkey % 9 <> 0"""
)
def source_stackexchange(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Questions keyed by site and id; items without a question id go."""
    item = _json(site=F.when(_k() % 2 == 0, F.lit("so")), question_id=F.when(_k() % 9 != 0, _k()), link=F.concat(F.lit("https://x.test/q/"), _text()), title=F.col("p_name"), body=F.when(_k() % 3 == 0, F.col("p_type")), score=F.col("p_size"), answer_count=F.col("p_size") % 5, tags=F.array(F.lit("sql")), is_answered=F.col("p_size") > 20)
    raw = _raw(spark, sf_dir, '{"items":[', item, "]}")
    return _laid_out(feeds.FEEDS["stackexchange"].rows(raw), "site", "score", "answers", "tags", "is_answered")


@query(
    """select case when p_partkey % 4 = 0 then 'https://x.test/?a=' || p_partkey || '&b=2' else 'g' || p_partkey end as ext_id, 'https://x.test/?a=' || p_partkey || '&b=2' as url, p_name || ' & <co> é' as title,
    case when p_partkey % 3 = 0 then p_name || ' & <co> é' else p_type || ' & more' end as body, 'feed1' as m_feed, case when p_partkey % 2 = 0 then 'Mon, 01 Jan 2024' else '' end as m_published from part"""
)
def source_news_rss(spark: SparkSession, sf_dir: str) -> DataFrame:
    """RSS items, seven in each payload: guid or link as key, description or title as body; CDATA is taken off, references are decoded."""
    guid = F.when(_k() % 4 != 0, F.concat(F.lit("<guid isPermaLink='false'>g"), _text(), F.lit("</guid>"))).otherwise("")
    about = F.when(_k() % 3 != 0, F.concat(F.lit("<description><![CDATA["), F.col("p_type"), F.lit(" & more]]></description>"))).otherwise("")
    when = F.when(_k() % 2 == 0, "<pubDate>Mon, 01 Jan 2024</pubDate>").otherwise("")
    item = F.concat(F.lit("<item>"), guid, F.lit("<link>https://x.test/?a="), _text(), F.lit("&amp;b=2</link><title>"), F.col("p_name"), F.lit(" &amp; &lt;co> &#233;</title>"), about, when, F.lit("</item>"))
    payload = F.concat(F.lit("<rss><channel><title>c</title>"), F.array_join(F.collect_list(item), ""), F.lit("</channel></rss>"))
    raw = _parts(spark, sf_dir).groupBy(F.floor(_k() / 7)).agg(payload.alias("payload"))
    return _laid_out(feeds.news_items(raw, "feed1"), "feed", "published")


@query(
    """select 'plug-' || p_partkey as ext_id, case when p_partkey % 2 = 0 then 'https://x.test/' || p_partkey else 'https://wordpress.org/plugins/plug-' || p_partkey || '/' end as url, 'A & ' || p_name as title,
    p_type || chr(10) || chr(10) || '[active_installs=' || p_size * 100 || ', rating=' || case when p_partkey % 3 = 0 then 'None' else (p_size * 2)::varchar end || '/100 (' || p_size || ' ratings), support_threads=4, resolved=None]' as body,
    (p_size * 100)::varchar as m_active_installs, case when p_partkey % 3 <> 0 then (p_size * 2)::varchar end as m_rating, p_size::varchar as m_num_ratings, '4' as m_support_threads from part where p_partkey % 8 <> 0"""
)
def source_wordpress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plugins: character references decoded, figures told in the text."""
    item = _json(slug=F.when(_k() % 8 != 0, F.concat(F.lit("plug-"), _text())), homepage=F.when(_k() % 2 == 0, F.concat(F.lit("https://x.test/"), _text())), name=F.concat(F.lit("A &amp; "), F.col("p_name")), short_description=F.col("p_type"), active_installs=F.col("p_size") * 100, rating=F.when(_k() % 3 != 0, F.col("p_size") * 2), num_ratings=F.col("p_size"), support_threads=F.lit(4))
    raw = _raw(spark, sf_dir, '{"plugins":[', item, "]}")
    return _laid_out(feeds.FEEDS["wordpress_plugins"].rows(raw), "active_installs", "rating", "num_ratings", "support_threads")


@query(
    """select p_partkey::varchar as ext_id, 'https://x.test/' || p_partkey as url, p_name as title, p_name || chr(10) || chr(10) || case when p_partkey % 2 = 0 then p_type else p_brand end as body,
    '["t"]' as m_tags, p_size::varchar as m_reactions, (p_size + 1)::varchar as m_comments_count, '3' as m_reading_time, '{"username":"u' || p_partkey || '","name":"N"}' as m_user from part where p_partkey % 10 <> 0"""
)
def source_devto(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Articles: title and text; id 0 is no id, reactions under either name."""
    item = _json(id=F.when(_k() % 10 == 0, 0).otherwise(_k()), url=F.concat(F.lit("https://x.test/"), _text()), title=F.col("p_name"), body_markdown=F.when(_k() % 2 == 0, F.col("p_type")), description=F.col("p_brand"), tag_list=F.when(_k() % 3 == 0, F.array(F.lit("t"))), tags=F.array(F.lit("t")), public_reactions_count=F.when(_k() % 3 == 1, F.col("p_size")), positive_reactions_count=F.col("p_size"), comments_count=F.col("p_size") + 1, reading_time_minutes=F.lit(3), user=F.struct(F.concat(F.lit("u"), _text()).alias("username"), F.lit("N").alias("name")))
    raw = _raw(spark, sf_dir, "[", item, "]")
    return _laid_out(feeds.FEEDS["devto"].rows(raw), "tags", "reactions", "comments_count", "reading_time", "user")


@query(
    """select 'r' || p_partkey as ext_id, 'https://apps.apple.com/' || case when p_partkey % 2 = 0 then 'de' else 'us' end || '/app/id77' as url, p_name as title, p_type as body, 'App' as m_app, (p_size % 5 + 1)::varchar as m_rating, '1.2' as m_version, p_brand as m_author from part where p_partkey % 6 <> 0"""
)
def source_appstore(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Review entries; the entry of the app itself has no rating and goes."""
    label = lambda c: F.struct(c.alias("label"))
    item = F.to_json(F.struct(label(F.concat(F.lit("r"), _text())).alias("id"), label(F.col("p_name")).alias("title"), label(F.col("p_type")).alias("content"), F.when(_k() % 6 != 0, label((F.col("p_size") % 5 + 1).cast("string"))).alias("im:rating"), label(F.lit("1.2")).alias("im:version"), F.struct(label(F.col("p_brand")).alias("name")).alias("author"), F.lit("App").alias("app"), F.lit("77").alias("app_id"), F.when(_k() % 2 == 0, F.lit("de")).alias("country")))
    raw = _raw(spark, sf_dir, '{"feed":{"entry":[', item, "]}}")
    return _laid_out(feeds.FEEDS["appstore_reviews"].rows(raw), "app", "rating", "version", "author")


@query(
    """select 'g' || p_partkey as ext_id, 'https://x.test/' || p_partkey as url, case when p_partkey % 2 = 0 then p_brand else trim(substr(b, 1, 60)) || case when length(b) > 60 then '...' else '' end end as title, b as body,
    (p_size % 5)::varchar as m_score, p_size::varchar as m_thumbs_up, case when p_partkey % 3 = 0 then '1.0' else '2.0' end as m_version, '2024-01-01' as m_at from (select *, p_type || ' ' || p_name || ' ' || p_type || ' ' || p_name as b from part where p_partkey % 7 <> 0)"""
)
def source_google_play(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reviews: without a title the first 60 characters; reviews without a text go."""
    body = F.concat_ws(" ", "p_type", "p_name", "p_type", "p_name")
    item = _json(reviewId=F.concat(F.lit("g"), _text()), url=F.concat(F.lit("https://x.test/"), _text()), title=F.when(_k() % 2 == 0, F.col("p_brand")), content=F.when(_k() % 7 != 0, body), score=F.col("p_size") % 5, thumbsUpCount=F.col("p_size"), reviewCreatedVersion=F.when(_k() % 3 == 0, F.lit("1.0")), appVersion=F.lit("2.0"), at=F.lit("2024-01-01"))
    raw = _raw(spark, sf_dir, '{"reviews":[', item, "]}")
    return _laid_out(feeds.FEEDS["google_play_reviews"].rows(raw), "score", "thumbs_up", "version", "at")


@query(
    """select 'key' || p_partkey as ext_id, 'https://marketplace.atlassian.com/apps/key' || p_partkey as url, p_name as title, p_name || chr(10) || chr(10) || case when p_partkey % 2 = 0 then p_brand || chr(10) || chr(10) || p_type else p_type end as body,
    '3.5' as m_rating, p_size::varchar as m_review_count, (p_size * 10)::varchar as m_downloads, '["c1","' || p_brand || '"]' as m_categories, 'V' as m_vendor, 'https://marketplace.atlassian.com/v/' || p_partkey as m_vendor_link, case when p_partkey % 2 = 0 then p_brand else p_type end as m_tagline from part"""
)
def source_atlassian(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Marketplace apps: tagline, then the summary where it says something else."""
    named = lambda c: F.struct(c.alias("name"))
    inner = F.struct(F.struct(F.lit(3.5).alias("averageStars"), F.col("p_size").alias("count")).alias("reviews"), F.struct((F.col("p_size") * 10).alias("downloads")).alias("distribution"), F.array(named(F.lit("c1")), named(F.col("p_brand"))).alias("categories"), named(F.lit("V")).alias("vendor"))
    item = _json(key=F.concat(F.lit("key"), _text()), name=F.col("p_name"), tagLine=F.when(_k() % 2 == 0, F.col("p_brand")), summary=F.col("p_type"), _embedded=inner, _links=F.struct(F.struct(F.concat(F.lit("/v/"), _text()).alias("href")).alias("vendor")))
    raw = _raw(spark, sf_dir, '{"_embedded":{"addons":[', item, "]}}")
    return _laid_out(feeds.FEEDS["atlassian_app"].rows(raw), "rating", "review_count", "downloads", "categories", "vendor", "vendor_link", "tagline")


@query(
    """select 'p' || p_partkey as reddit_id, p_brand as subreddit, substr(repeat(p_name || ' ', 150), 1, 2000) as title, case when p_partkey % 2 = 0 then p_type end as selftext, 'u' as author, case when p_partkey % 3 = 0 then 0 else p_size end::bigint as score,
    (p_size * 2)::bigint as num_comments, 'https://reddit.com/r/x/' || p_partkey as url, 1700000000 + p_partkey as created from part where p_partkey % 7 <> 0 and p_partkey % 5 <> 0"""
)
def source_reddit_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archive posts: titles cut at 2000, counts zero where missing; without id or time they go."""
    item = _json(id=F.when(_k() % 7 != 0, F.concat(F.lit("p"), _text())), subreddit=F.col("p_brand"), title=F.repeat(F.concat(F.col("p_name"), F.lit(" ")), 150), selftext=F.when(_k() % 2 == 0, F.col("p_type")), author=F.lit("u"), score=F.when(_k() % 3 != 0, F.col("p_size")), num_comments=F.col("p_size") * 2, permalink=F.concat(F.lit("/r/x/"), _text()), created_utc=F.when(_k() % 5 != 0, 1700000000 + _k()))
    rows = feeds.reddit_posts(_raw(spark, sf_dir, '{"data":[', item, "]}"))
    return rows.select("reddit_id", "subreddit", "title", "selftext", "author", "score", "num_comments", "url", F.unix_timestamp("created_utc").alias("created"))


@query(
    """select 'c' || p_partkey as reddit_id, 'p' || p_partkey % 50 as post_reddit_id, case when p_partkey % 3 = 0 then 'c' || p_partkey - 1 end as parent_reddit_id, p_brand as author, p_type as body, p_size::bigint as score, 1700000000 + p_partkey as created from part where p_partkey % 7 <> 0"""
)
def source_reddit_comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archive comments: the post by its bare id, a parent only where it is a comment."""
    parent = F.when(_k() % 3 == 0, F.concat(F.lit("t1_c"), (_k() - 1).cast("string"))).otherwise(F.concat(F.lit("t3_p"), (_k() % 50).cast("string")))
    item = _json(id=F.when(_k() % 7 != 0, F.concat(F.lit("c"), _text())), link_id=F.concat(F.lit("t3_p"), (_k() % 50).cast("string")), parent_id=parent, author=F.col("p_brand"), body=F.col("p_type"), score=F.col("p_size"), created_utc=1700000000 + _k())
    rows = feeds.reddit_comments(_raw(spark, sf_dir, '{"data":[', item, "]}"))
    return rows.select("reddit_id", "post_reddit_id", "parent_reddit_id", "author", "body", "score", F.unix_timestamp("created_utc").alias("created"))


def _submissions(spark: SparkSession, sf_dir: str) -> DataFrame:
    post = _json(id=F.concat(F.lit("p"), _text()), subreddit=F.col("p_brand"), title=F.col("p_name"), selftext=F.when(_k() % 2 == 0, F.col("p_type")).otherwise(""), author=F.when(_k() % 5 != 0, F.lit("u")), score=F.col("p_size"), upvote_ratio=F.lit(0.5), num_comments=F.lit(2), url=F.concat(F.lit("https://x.test/"), _text()), link_flair_text=F.lit("f"), created_utc=1700000000 + _k())
    first = _json(id=F.concat(F.lit("c"), _text()), parent_id=F.concat(F.lit("t3_p"), _text()), body=F.col("p_type"), author=F.lit("a"), score=F.col("p_size"), depth=F.lit(0), all_awardings=F.when(_k() % 2 == 0, F.array(F.lit("x"), F.lit("y"))), created_utc=1700000000 + _k())
    second = _json(id=F.concat(F.lit("d"), _text()), parent_id=F.concat(F.lit("t1_c"), _text()), body=F.col("p_brand"), score=F.col("p_size") + 1, depth=F.lit(1), all_awardings=F.array().cast("array<string>"), created_utc=1700000001 + _k())
    item = F.concat(post, F.lit(',"comments":['), first, F.lit(","), second, F.lit("]"))
    return _raw(spark, sf_dir, '{"submission":', item, "}")


@query(
    """select 'p' || p_partkey as reddit_id, p_brand as subreddit, p_name as title, case when p_partkey % 2 = 0 then p_type end as selftext, case when p_partkey % 5 = 0 then 'None' else 'u' end as author, p_size::bigint as score, 0.5::double as upvote_ratio, 'f' as flair, 1700000000 + p_partkey as created from part"""
)
def source_legacy_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Submissions of the older worker."""
    return feeds.legacy_posts(_submissions(spark, sf_dir)).select("reddit_id", "subreddit", "title", "selftext", "author", "score", "upvote_ratio", "flair", F.unix_timestamp("created_utc").alias("created"))


@query(
    """select 'p' || p_partkey as post_reddit_id, 'c' || p_partkey as reddit_id, 'p' || p_partkey as parent_reddit_id, p_type as body, 'a' as author, p_size::bigint as score, 0 as depth, case when p_partkey % 2 = 0 then 2 else 0 end as awards from part
    union all select 'p' || p_partkey, 'd' || p_partkey, 'c' || p_partkey, p_brand, 'None', p_size + 1, 1, 0 from part"""
)
def source_legacy_comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Comment trees of the older worker, with depth and awards."""
    return feeds.legacy_comments(_submissions(spark, sf_dir)).drop("created_utc")


@query(
    """select 'v' || p_partkey as video_id, case when p_partkey % 2 = 0 then 'UC' || p_partkey else '@' || p_partkey end as channel_id, p_name as title, p_type as description, p_size::bigint as duration_sec, (p_size * 100)::bigint as view_count,
    case when p_partkey % 4 <> 0 then p_size end::bigint as like_count, case when p_partkey % 3 = 0 then 1700000000 + p_partkey else 1704067200 end as published, '["a","b"]' as tags, 0 as n_heavy from part where p_partkey % 9 <> 0"""
)
def source_videos(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Video rows: the exact time or the upload day, the channel or its handle; heavy keys are left out."""
    item = _json(id=F.when(_k() % 9 != 0, F.concat(F.lit("v"), _text())), channel_id=F.when(_k() % 2 == 0, F.concat(F.lit("UC"), _text())), uploader_id=F.concat(F.lit("@"), _text()), title=F.col("p_name"), description=F.col("p_type"), duration=F.col("p_size"), view_count=F.col("p_size") * 100, like_count=F.when(_k() % 4 != 0, F.col("p_size")), timestamp=F.when(_k() % 3 == 0, 1700000000 + _k()), upload_date=F.lit("20240101"), tags=F.array(F.lit("a"), F.lit("b")), formats=F.array(F.lit("x")), thumbnails=F.array(F.lit("y")))
    rows = videos.videos(_raw(spark, sf_dir, "", item, ""))
    return rows.select("video_id", "channel_id", "title", "description", "duration_sec", "view_count", "like_count", F.unix_timestamp("published_at").alias("published"), "tags", F.size(F.array_intersect(F.json_object_keys("raw"), F.array(F.lit("formats"), F.lit("thumbnails")))).alias("n_heavy"))


@query(
    """select 'UC' || p_partkey as channel_id, p_name as title, case when p_partkey % 2 = 0 then '@h' || p_partkey end as handle, (p_size * 1000)::bigint as subscriber_count from part"""
)
def source_channels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Channel rows of video payloads: a handle only where it begins with @."""
    item = _json(channel_id=F.concat(F.lit("UC"), _text()), channel=F.when(_k() % 3 != 0, F.col("p_name")), uploader=F.col("p_name"), uploader_id=F.when(_k() % 2 == 0, F.concat(F.lit("@h"), _text())).otherwise("plain"), channel_follower_count=F.col("p_size") * 1000)
    return videos.channels(_raw(spark, sf_dir, "", item, "")).select("channel_id", "title", "handle", "subscriber_count")


@query(
    """select p_partkey, i - 1 as pos, case i when 1 then p_name || p_brand else p_type end as text, case i when 1 then 1.5 else p_size end::double as start, case i when 1 then 0.25 else 0 end::double as dur from part, range(1, 3) t(i)"""
)
def source_captions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Caption events into segments: parts are joined, milliseconds become seconds, blank events go."""
    part = lambda c: F.struct(c.alias("utf8"))
    event = lambda at, long, *said: F.concat(F.lit("{"), F.concat_ws(",", *(F.concat(F.lit(f'"{k}":'), v.cast("string")) for k, v in (("tStartMs", at), ("dDurationMs", long)) if v is not None), F.concat(F.lit('"segs":'), F.to_json(F.array(*map(part, said))))), F.lit("}"))
    events = F.concat(F.lit('{"events":['), F.concat_ws(",", event(F.lit(1500), F.lit(250), F.col("p_name"), F.col("p_brand")), F.lit('{"tStartMs":5}'), event(F.lit(7), None, F.lit("\n")), event(F.col("p_size") * 1000, None, F.col("p_type"))), F.lit("]}"))
    rows = _parts(spark, sf_dir).select("p_partkey", F.posexplode(videos.json3_segments(events)).alias("pos", "s"))
    return rows.select("p_partkey", F.col("pos").cast("long").alias("pos"), "s.text", "s.start", "s.dur")


@query(
    """select p_partkey, case when p_partkey % 3 = 0 then 'manual' when p_partkey % 3 = 1 then 'asr' else 'none' end as transcript_source, case when p_partkey % 3 = 2 then p_brand else p_name end as text from part where p_partkey % 3 <> 2 or p_partkey % 2 = 0"""
)
def source_transcript_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first candidate transcript that has segments."""
    one = lambda yes, c: videos.transcript_segments(F.when(yes, F.to_json(F.array(F.struct(c.alias("text"), F.lit(1.0).alias("start"), F.lit(2.0).alias("duration"))))).otherwise("[]"))
    best = videos.best_transcript([("manual", one(_k() % 3 == 0, F.col("p_name"))), ("asr", one(_k() % 3 == 1, F.col("p_name"))), ("none", one(_k() % 2 == 0, F.col("p_brand")))])
    rows = _parts(spark, sf_dir).select("p_partkey", best.alias("b")).filter("b is not null")
    return rows.select("p_partkey", "b.transcript_source", F.get("b.segments", F.lit(0))["text"].alias("text"))


@query(
    """select 'c' || p_partkey as comment_id, 'v1' as video_id, case when p_partkey % 3 = 0 then 'c' || p_partkey - 1 end as parent_id, p_brand as author, p_name as text, p_size::bigint as like_count, 1700000000 + p_partkey as published from part where p_partkey % 4 <> 0"""
)
def source_video_comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Comments of a video: 'root' is no parent, comments without id go."""
    item = _json(id=F.when(_k() % 4 != 0, F.concat(F.lit("c"), _text())), parent=F.when(_k() % 3 == 0, F.concat(F.lit("c"), (_k() - 1).cast("string"))).when(_k() % 3 == 1, "root"), author=F.col("p_brand"), text=F.col("p_name"), like_count=F.col("p_size"), timestamp=1700000000 + _k())
    rows = videos.comments(_raw(spark, sf_dir, "[", item, "]", F.lit("v1").alias("video_id")))
    return rows.select("comment_id", "video_id", "parent_id", "author", "text", "like_count", F.unix_timestamp("published_at").alias("published"))


@query(
    """select case when p_partkey % 2 = 0 then 'p' || p_partkey else 'https://x.test/' || p_partkey end as ext_id, 'https://x.test/' || p_partkey as url, p_name as title, case when p_partkey % 3 = 0 then p_type else p_name end as body,
    p_brand as m_subreddit, 'u' as m_user, p_size::varchar as m_num_comments, p_size::varchar as m_num_upvotes from part"""
)
def source_snapshot_reddit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of a snapshot job on posts: key, text and votes under their several names."""
    item = _json(post_id=F.when(_k() % 2 == 0, F.concat(F.lit("p"), _text())), url=F.concat(F.lit("https://x.test/"), _text()), title=F.col("p_name"), description=F.when(_k() % 3 == 0, F.col("p_type")), community_name=F.when(_k() % 5 == 0, F.col("p_brand")), subreddit=F.col("p_brand"), user_posted=F.lit("u"), num_comments=F.col("p_size"), num_upvotes=F.when(_k() % 4 == 0, F.col("p_size")), upvotes=F.col("p_size"))
    return _laid_out(snapshots.snapshot_rows(_raw(spark, sf_dir, "[", item, "]"), "reddit", "s"), "subreddit", "user", "num_comments", "num_upvotes")


@query(
    """select case when p_partkey % 2 = 0 then 'c' || p_partkey else 'https://x.test/' || p_partkey end as ext_id, 'https://x.test/' || p_partkey as url, case when p_partkey % 3 = 0 then substr(repeat(p_name, 20), 1, 200) else 'comment' end as title, p_type as body,
    'https://x.test/' || p_partkey as m_post_url, 'par' as m_parent, p_size::varchar as m_upvotes, p_brand as m_subreddit from part"""
)
def source_snapshot_comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of a snapshot job on comments."""
    item = _json(comment_id=F.when(_k() % 2 == 0, F.concat(F.lit("c"), _text())), url=F.concat(F.lit("https://x.test/"), _text()), post_title=F.when(_k() % 3 == 0, F.repeat(F.col("p_name"), 20)), comment=F.when(_k() % 4 == 0, F.col("p_type")), body=F.when(_k() % 4 == 1, F.col("p_type")), text=F.col("p_type"), parent_id=F.lit("par"), score=F.col("p_size"), community_name=F.col("p_brand"))
    return _laid_out(snapshots.snapshot_rows(_raw(spark, sf_dir, "[", item, "]"), "reddit_comment", "s"), "post_url", "parent", "upvotes", "subreddit")


_LD = """<html><head><script type="application/ld+json">"""


@query(
    """select 'app-' || p_partkey as ext_id, p_name as title, p_name || '. ' || p_type || ' [rating=' || case when p_partkey % 3 = 0 then 'None' else '4.5' end || ', reviews=' || case when p_partkey % 3 = 0 then 'None' else p_size::varchar end || ', price=9.99 USD, category=' || p_brand || ']' as body,
    case when p_partkey % 3 <> 0 then '4.5' end as m_rating, case when p_partkey % 3 <> 0 then p_size::varchar end as m_review_count, '9.99' as m_price, 'USD' as m_currency, p_brand as m_category from part where p_partkey % 7 <> 0"""
)
def source_shopify(spark: SparkSession, sf_dir: str) -> DataFrame:
    """App pages by their linked data; pages without any go."""
    rating = F.when(_k() % 3 != 0, F.struct(F.lit("4.5").alias("ratingValue"), F.col("p_size").cast("string").alias("ratingCount")))
    ld = F.to_json(F.struct(F.when(_k() % 7 != 0, "SoftwareApplication").otherwise("Thing").alias("@type"), F.col("p_name").alias("name"), F.col("p_type").alias("description"), rating.alias("aggregateRating"), F.struct(F.lit("9.99").alias("price"), F.lit("USD").alias("priceCurrency")).alias("offers"), F.col("p_brand").alias("applicationCategory")))
    rows = _parts(spark, sf_dir).select(F.concat(F.lit("https://apps.shopify.com/app-"), _text()).alias("url"), F.concat(F.lit(_LD), ld, F.lit("</script></head></html>")).alias("html"))
    return _laid_out(pages.shopify_apps(rows), "rating", "review_count", "price", "currency", "category", columns=("ext_id", "title", "body"))


@query(
    """select 'tool-' || p_partkey || '-2024-01-0' || i || '-' || lower(replace(p_brand, ' ', '-')) as ext_id, 'R' || i as title, p_type as body, 'tool-' || p_partkey as m_product_ext_id, p_name as m_product_name, i::varchar as m_rating, p_brand as m_reviewer, '2024-01-0' || i as m_date from part, range(1, 3) t(i)"""
)
def source_product_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reviews of product pages by their linked data, keyed by product, day and reviewer."""
    _, reviews = pages.product_pages(_products(spark, sf_dir))
    return _laid_out(reviews, "product_ext_id", "product_name", "rating", "reviewer", "date", columns=("ext_id", "title", "body"))


@query(
    """select 'tool-' || p_partkey as ext_id, p_name as name, p_brand as category, case when p_partkey % 2 = 0 then '10 USD' else '' end as pricing_text, 4.5::double as rating, p_size::bigint as n_reviews, p_type as description from part"""
)
def source_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products of product pages by their linked data."""
    products, _ = pages.product_pages(_products(spark, sf_dir))
    return products.select("ext_id", "name", "category", "pricing_text", "rating", "n_reviews", "description")


def _products(spark: SparkSession, sf_dir: str) -> DataFrame:
    review = lambda i: F.struct(F.struct(F.col("p_brand").alias("name")).alias("author"), F.struct(F.lit(str(i)).alias("ratingValue")).alias("reviewRating"), F.col("p_type").alias("reviewBody"), F.lit(f"R{i}").alias("name"), F.lit(f"2024-01-0{i}").alias("datePublished"))
    ld = F.to_json(F.struct(F.lit("SoftwareApplication").alias("@type"), F.col("p_name").alias("name"), F.col("p_type").alias("description"), F.struct(F.lit("4.5").alias("ratingValue"), F.col("p_size").cast("string").alias("reviewCount")).alias("aggregateRating"), F.when(_k() % 2 == 0, F.struct(F.lit("10").alias("price"))).alias("offers"), F.col("p_brand").alias("applicationCategory"), F.array(review(1), review(2)).alias("review")))
    return _parts(spark, sf_dir).select(F.concat(F.lit("https://x.test/products/tool-"), _text(), F.lit("/reviews")).alias("url"), F.concat(F.lit(_LD), ld, F.lit("</script></head></html>")).alias("html"))


@query(
    """select 'ext' || p_partkey as ext_id, p_name as title, p_name || '. ' || p_type as body, (p_size * 1000)::varchar as m_users, '4.5' as m_rating, p_size::varchar as m_rating_count, 'Tools & more' as m_category from part"""
)
def source_chrome_extensions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Extension pages by what can be seen on them."""
    html = F.concat(F.lit('<html><head><meta property="og:title" content="'), F.col("p_name"), F.lit(' - Chrome Web Store"><meta property="og:description" content="'), F.col("p_type"), F.lit('"></head><body><p>4.5 out of 5</p><p>'), F.col("p_size").cast("string"), F.lit(' ratings</p><a href="/category/tools">Tools &amp; more</a><p>'), F.col("p_size").cast("string"), F.lit("K users</p></body></html>"))
    rows = _parts(spark, sf_dir).select(F.concat(F.lit("ext"), _text()).alias("ext_id"), F.lit("u").alias("url"), html.alias("html"))
    return _laid_out(pages.chrome_extensions(rows), "users", "rating", "rating_count", "category", columns=("ext_id", "title", "body"))


@query(
    """select 'deal' || p_partkey as ext_id, p_name as title, p_name || '. ' || p_type as body, 'deal' as m_kind, p_brand as m_category, null::varchar as m_author from part
    union all select 'deal' || p_partkey || ':rev:0', 'deal' || p_partkey, p_type, 'review', null, p_brand from part"""
)
def source_deals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deals of a page's embedded data, and their reviews; blank reviews go."""
    deal = F.to_json(F.struct(F.concat(F.lit("deal"), _text()).alias("slug"), F.col("p_name").alias("name"), F.col("p_type").alias("tagline"), F.col("p_brand").alias("category"), F.array(F.struct(F.col("p_type").alias("body"), F.col("p_brand").alias("author")), F.struct(F.lit("").alias("body"), F.lit("x").alias("author"))).alias("comments")))
    html = F.concat(F.lit('<script id="__NEXT_DATA__" type="application/json">{"props":{"pageProps":{"deals":['), deal, F.lit("]}}}</script>"))
    rows = _parts(spark, sf_dir).select(F.lit("u").alias("url"), html.alias("html"))
    return _laid_out(pages.deal_pages(rows), "kind", "category", "author", columns=("ext_id", "title", "body"))


@query(
    """select p_partkey::varchar || ':alt-' || p_partkey as ext_id, p_name as title, p_name || '. ' || p_size || ' likes' as body, p_partkey::varchar as m_seed_software, p_size::varchar as m_likes, null::varchar as m_alt_count from part
    union all select p_partkey::varchar || ':__page__', p_partkey::varchar, p_name || ' ' || p_size || ' likes 7 comments', p_partkey::varchar, null, '1' from part"""
)
def source_alternatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cards of a directory page, and the page itself."""
    html = F.concat(F.lit('<ul><li><a href="/software/alt-'), _text(), F.lit('/about/">'), F.col("p_name"), F.lit("</a><p>"), F.col("p_size").cast("string"), F.lit(" likes</p></li></ul><p>7 comments</p>"))
    rows = _parts(spark, sf_dir).select(_text().alias("seed"), html.alias("html"))
    return _laid_out(pages.alternatives(rows), "seed_software", "likes", "alt_count", columns=("ext_id", "title", "body"))


@query(
    """select 't3_' || p_partkey as ext_id, case when p_partkey % 2 = 0 then 'https://old.reddit.com/r/x/' || p_partkey else 'https://x.test/' || p_partkey end as url, p_name || ' & more' as title, 'sub' as m_sub, p_size::varchar as m_score, p_brand as m_author from part"""
)
def source_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posts of a listing page."""
    href = F.concat(F.when(_k() % 2 == 0, "/r/x/").otherwise("https://x.test/"), _text())
    post = F.concat(F.lit('<div class="thing link" data-fullname="t3_'), _text(), F.lit('" data-score="'), F.col("p_size").cast("string"), F.lit('" data-author="'), F.col("p_brand"), F.lit('"><a class="title may-blank" href="'), href, F.lit('">'), F.col("p_name"), F.lit(" &amp; more</a></div>"))
    rows = _parts(spark, sf_dir).select(F.lit("sub").alias("sub"), F.concat(F.lit("<body>"), post, F.lit('<div class="thing link" data-fullname="t3_no"><p>x</p></div></body>')).alias("html"))
    return _laid_out(pages.listing_posts(rows), "sub", "score", "author", columns=("ext_id", "url", "title"))


@query(
    """select 'top-sellers' as report_type, 'B' || p_partkey as asin, '2024-03-05' as snapshot_date, p_name as title, p_brand as brand, round(p_retailprice, 2) as price, (p_size * 1000)::double as monthly_revenue, p_size as reviews from part where p_partkey % 9 <> 0"""
)
def source_seller_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of a report file by the spellings of its columns; rows without an item go."""
    rows = _parts(spark, sf_dir).select(F.when(_k() % 9 == 0, " ").otherwise(F.concat(F.lit(" B"), _text())).alias("ASIN"), F.col("p_name").alias("Product Name"), F.col("p_brand").alias("Brand"), F.concat(F.lit("$"), F.format_number("p_retailprice", 2)).alias("Current Price"), F.format_number(F.col("p_size") * 1000, 0).alias("Parent Revenue"), F.col("p_size").cast("string").alias("Review Count"), F.lit("top-sellers-20240305.csv").alias("_file"))
    return reports.seller_reports(rows, "2024-12-31").select("report_type", "asin", F.col("snapshot_date").cast("string").alias("snapshot_date"), "title", "brand", F.round("price", 2).alias("price"), "monthly_revenue", "reviews")


@query(
    """select p_partkey, case p_partkey % 4 when 0 then 'https://x.test/' || p_partkey when 1 then 'https://www.youtube.com/@c' || p_partkey || '/videos' when 2 then 'https://www.youtube.com/channel/UC' || lpad(p_partkey::varchar, 22, '0') || '/videos' else 'https://www.youtube.com/watch?v=v' || p_partkey end as target from part"""
)
def source_seed_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a seed names: an address, a handle, a channel or a video."""
    seed = F.when(_k() % 4 == 0, F.concat(F.lit("https://x.test/"), _text())).when(_k() % 4 == 1, F.concat(F.lit("@c"), _text())).when(_k() % 4 == 2, F.concat(F.lit("UC"), F.lpad(_text(), 22, "0"))).otherwise(F.concat(F.lit("v"), _text()))
    return _parts(spark, sf_dir).select("p_partkey", reports.seed_target(seed).alias("target"))
