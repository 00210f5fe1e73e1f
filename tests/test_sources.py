import json

import pytest
from pyspark.sql import functions as F

from plumbline.sources import embedder, feeds, pages, reports, snapshots, videos


def payloads(spark, *items):
    return spark.createDataFrame([(json.dumps(x),) for x in items], "payload string")


def only(df):
    (r,) = df.collect()
    return r


CASES = [
    ("reddit_feed", {"data": {"children": [{"data": {"id": "a", "permalink": "/r/x", "title": "T", "selftext": "", "score": 3, "subreddit": "s"}}]}}, ("a", "https://www.reddit.com/r/x", "T", "T"), {"score": 3, "sub": "s"}),
    ("hackernews", {"hits": [{"objectID": "7", "title": "T", "points": 2}, {"title": "no key"}]}, ("7", "https://news.ycombinator.com/item?id=7", "T", "T"), {"points": 2}),
    ("producthunt", {"data": {"posts": {"edges": [{"node": {"id": 5, "url": "u", "name": "N", "tagline": "t", "description": "d", "votesCount": 1, "topics": {"edges": [{"node": {"name": "x"}}]}}}]}}}, ("5", "u", "N", "t\nd"), {"votes": 1, "topics": ["x"]}),
    ("ycombinator", [{"slug": "co", "name": "Co", "one_liner": "one", "tags": ["a"]}], ("co", "https://www.ycombinator.com/companies/co", "Co", "one"), {"tags": ["a"]}),
    ("stackexchange", {"items": [{"site": "so", "question_id": 9, "link": "l", "title": "T", "body": "B"}]}, ("so_9", "l", "T", "B"), {"site": "so"}),
    ("wordpress_plugins", {"plugins": [{"slug": "p", "name": "A &amp; B", "short_description": "d", "rating": 90, "num_ratings": 4}]}, ("p", "https://wordpress.org/plugins/p/", "A & B", "d\n\n[active_installs=None, rating=90/100 (4 ratings), support_threads=None, resolved=None]"), {"rating": 90}),
    ("devto", [{"id": 3, "url": "u", "title": "T", "description": "d", "user": {"username": "n"}}], ("3", "u", "T", "T\n\nd"), {"user": {"username": "n"}}),
    ("appstore_reviews", {"app_id": 1, "feed": {"entry": {"id": {"label": "r1"}, "title": {"label": "T"}, "content": {"label": "C"}, "im:rating": {"label": "4"}}}}, ("r1", "https://apps.apple.com/us/app/id", "T", "C"), {"rating": "4"}),
    ("google_play_reviews", {"reviews": [{"reviewId": "g", "content": "c" * 70, "score": 2, "url": "u"}, {"reviewId": "h", "content": ""}]}, ("g", "u", "c" * 60 + "...", "c" * 70), {"score": 2}),
    ("atlassian_app", {"_embedded": {"addons": [{"key": "k", "name": "N", "tagLine": "t", "summary": "s", "_embedded": {"reviews": {"averageStars": 3.5}}}]}}, ("k", "https://marketplace.atlassian.com/apps/k", "N", "N\n\nt\n\ns"), {"rating": 3.5}),
]


@pytest.mark.parametrize("slug,payload,want,meta", CASES)
def test_feeds(spark, slug, payload, want, meta):
    r = only(feeds.FEEDS[slug].rows(payloads(spark, payload)))
    assert (r.source_slug, r.ext_id, r.url, r.title, r.body) == (slug, *want)
    got = json.loads(r.metadata)
    for k, v in meta.items():
        assert (got[k] == v) if not isinstance(v, dict) else v.items() <= got[k].items()


def test_news(spark):
    xml = "<rss><item><guid>g</guid><title>T</title><link>l</link><description><![CDATA[D]]></description><pubDate>p</pubDate></item><item><title>no key</title></item></rss>"
    r = only(feeds.news_items(spark.createDataFrame([(xml,)], "payload string"), "f"))
    assert (r.ext_id, r.url, r.title, r.body, json.loads(r.metadata)) == ("g", "l", "T", "D", {"feed": "f", "published": "p"})


def test_news_references_namespaces_and_broken_feeds(spark):
    one = "<item><guid isPermaLink='false'> g1 </guid><link>https://x?a=1&amp;b=2</link><title>A &amp;amp; B &#233; &lt;b&gt;</title><description><![CDATA[<p>x & y</p>]]></description></item>"
    feed = f"<?xml version='1.0' encoding='UTF-8'?><rss xmlns:media='http://m'><channel><title>c</title>{one}<item><link>l2</link><media:x>1</media:x></item></channel></rss>"
    rows = spark.createDataFrame([(feed,), ("<rss><channel><item><title>cut off",), ("",), (None,), ("<rss><channel/></rss>",)], "payload string")
    assert sorted((r.ext_id, r.url, r.title, r.body) for r in feeds.news_items(rows, "f").collect()) == [("g1", "https://x?a=1&b=2", "A &amp; B é <b>", "<p>x & y</p>"), ("l2", "l2", None, "")]


def test_archive_posts_and_comments(spark):
    posts = payloads(spark, {"data": [{"id": "a", "title": "t" * 3000, "created_utc": 86400, "permalink": "/p"}, {"id": "b"}]})
    r = only(feeds.reddit_posts(posts))
    assert (r.reddit_id, len(r.title), r.score, str(r.created_utc)) == ("a", 2000, 0, "1970-01-02 00:00:00")
    c = feeds.reddit_comments(payloads(spark, {"data": [{"id": "x", "link_id": "t3_a", "parent_id": "t3_a", "created_utc": 1}, {"id": "y", "link_id": "t3_a", "parent_id": "t1_x", "created_utc": 2}]}))
    assert sorted((r.reddit_id, r.post_reddit_id, r.parent_reddit_id) for r in c.collect()) == [("x", "a", None), ("y", "a", "x")]


def test_snapshots(spark):
    r = only(snapshots.snapshot_rows(payloads(spark, [{"post_id": "p", "url": "u", "title": "T", "markdown": "m", "community_name": "c"}]), "reddit", "reddit"))
    assert (r.ext_id, r.body, json.loads(r.metadata)["subreddit"]) == ("p", "m", "c")
    r = only(snapshots.snapshot_rows(payloads(spark, [{"comment_id": "c", "comment": "text", "num_upvotes": 2}]), "reddit_comment", "reddit_comment"))
    assert (r.ext_id, r.title, r.body) == ("c", "comment", "text")
    r = only(snapshots.snapshot_rows(payloads(spark, [{"product_id": "z", "name": "N", "review": "R"}]), "generic", "any"))
    assert (r.ext_id, r.title, r.body) == ("z", "N", "R")
    with pytest.raises(ValueError):
        snapshots.check_job({"name": "x"})
    day = only(snapshots.daily_inputs(spark.createDataFrame([("u", None)], "url string, date string"), F.lit("2024-03-01").cast("date")))
    assert (day.date, day.start_date, day.end_date) == ("2024-02-29",) * 3


def test_captions(spark):
    events = {"events": [{"tStartMs": 1000, "dDurationMs": 500, "segs": [{"utf8": "a"}, {"utf8": "b"}]}, {"tStartMs": 5}, {"segs": [{"utf8": " \n"}]}, {"tStartMs": 2500, "segs": [{"utf8": "c"}]}, {"segs": []}]}
    r = only(payloads(spark, events).select(videos.json3_segments(F.col("payload")).alias("s")))
    assert [tuple(s) for s in r.s] == [("ab", 1.0, 0.5), ("c", 2.5, 0.0)]
    info = {"subtitles": {"de": [{"ext": "vtt", "url": "v"}], "fr": [{"ext": "json3", "url": "f"}]}, "automatic_captions": {"en": [{"ext": "json3", "url": "e"}]}}
    r = only(payloads(spark, info).select(videos.caption_track(F.col("payload")).alias("t")))
    assert tuple(r.t) == ("f", "fr")  # manual first, whatever its language
    r = only(payloads(spark, [{"text": "x", "start": 1, "duration": 2}]).select(videos.transcript_segments(F.col("payload")).alias("s")).select(videos.best_transcript([("json3", F.array().cast(f"array<{videos.SEGMENT}>")), ("api", F.col("s"))]).alias("b")))
    assert r.b.transcript_source == "api" and tuple(r.b.segments[0]) == ("x", 1.0, 2.0)


def test_video_rows(spark):
    info = {"id": "v", "uploader_id": "@me", "channel": "Me", "title": "T", "upload_date": "20240102", "view_count": 5000000000, "formats": [1], "tags": ["a"], "channel_follower_count": "12"}
    r = only(videos.videos(payloads(spark, info, {"title": "no id"})))
    assert (r.video_id, r.channel_id, r.view_count, str(r.published_at), r.tags) == ("v", "@me", 5000000000, "2024-01-02 00:00:00", '["a"]')
    assert "formats" not in json.loads(r.raw)
    c = only(videos.channels(payloads(spark, info)))
    assert (c.channel_id, c.title, c.handle, c.subscriber_count) == ("@me", "Me", "@me", 12)
    rows = videos.comments(payloads(spark, [{"id": "1", "parent": "root"}, {"id": "2", "parent": "1"}, {"id": "3"}, {"parent": "1"}]).withColumn("video_id", F.lit("v")))
    assert sorted((r.comment_id, r.parent_id) for r in rows.collect()) == [("1", None), ("2", "1"), ("3", None)]


def test_pages(spark):
    ld = {"@type": "SoftwareApplication", "name": "App", "description": "D", "aggregateRating": {"ratingValue": 4.5, "ratingCount": 10}, "offers": [{"price": "9", "priceCurrency": "EUR"}], "review": {"author": {"name": "Ann Lee"}, "reviewRating": {"ratingValue": 5}, "reviewBody": "B", "name": "N", "datePublished": "2024-01-01"}}
    html = f'<script type="application/ld+json">not json</script><script type="application/ld+json">{json.dumps(ld)}</script>'
    df = spark.createDataFrame([("https://x.test/products/app/reviews", html), ("u", "<p>none</p>")], "url string, html string")
    products, reviews = pages.product_pages(df)
    p, r = only(products), only(reviews)
    assert (p.ext_id, p.name, p.pricing_text, p.rating, p.n_reviews) == ("app", "App", "9 EUR", 4.5, 10)
    assert (r.source_slug, r.ext_id, r.title, r.body) == ("trustradius_review", "app-2024-01-01-ann-lee", "N", "B")
    assert only(pages.shopify_apps(df)).body == "App. D [rating=4.5, reviews=10, price=9 EUR, category=None]"
    ext = '<meta property="og:title" content="Tool - Chrome Web Store"><meta property="og:description" content="About"><style>9 ratings</style><p>4.2 out of 5</p><p>1.1K ratings</p><p>800,000+ users</p>'
    e = only(pages.chrome_extensions(spark.createDataFrame([("id", "u", ext), ("x", "u", "<p>blocked</p>")], "ext_id string, url string, html string")))
    assert (e.title, e.body) == ("Tool", "Tool. About") and json.loads(e.metadata)["users"] == 800000 and json.loads(e.metadata)["rating_count"] == 1100
    data = {"props": {"pageProps": {"deals": [{"slug": "d", "name": "Deal", "tagline": "t", "comments": [{"body": "good"}, {"body": ""}]}]}}}
    deals = pages.deal_pages(spark.createDataFrame([("u", f'<script id="__NEXT_DATA__" type="x">{json.dumps(data)}</script>')], "url string, html string"))
    assert sorted((r.ext_id, r.body) for r in deals.collect()) == [("d", "Deal. t"), ("d:rev:0", "good")]
    alt = "<ul><li><a href='/software/beta/about/'>Beta</a> nice <b>1,234 likes</b></li></ul><p>7 comments</p>"
    got = {r.ext_id: r for r in pages.alternatives(spark.createDataFrame([("alpha", alt)], "seed string, html string")).collect()}
    assert json.loads(got["alpha:beta"].metadata)["likes"] == 1234 and json.loads(got["alpha:__page__"].metadata)["comment_count"] == 7


def test_reports_and_seeds(spark, tmp_path):
    (tmp_path / "best-sellers-2024-05-06.csv").write_text("﻿ASIN,Product Name,Revenue,Ratings\nB1,Thing,\"$1,200\",4.5\n,none,1,1\n", encoding="utf-8")
    r = only(reports.seller_reports(reports.read_csv(spark, f"file://{tmp_path}"), "2020-01-01"))
    assert (r.report_type, r.asin, r.title, r.monthly_revenue, r.rating, str(r.snapshot_date)) == ("best-sellers", "B1", "Thing", 1200.0, 4.5, "2024-05-06")
    seeds = spark.createDataFrame([("@me",), ("abc",), ("https://x",)], "s string").select(reports.seed_target(F.col("s")).alias("t"))
    assert [r.t for r in seeds.collect()] == ["https://www.youtube.com/@me/videos", "https://www.youtube.com/watch?v=abc", "https://x"]


def test_report_files_with_unlike_headers(spark, tmp_path):
    (tmp_path / "a-1.csv").write_text("asin,title,price\nB1,One,5\n", encoding="utf-8")
    (tmp_path / "b-2.csv").write_text("title,brand,asin\nTwo,Maker,B2\n\"Th\nree\",Maker\n", encoding="utf-8")
    got = reports.seller_reports(reports.read_csv(spark, f"file://{tmp_path}"), "2020-01-01").orderBy("asin").collect()
    assert [(r.report_type, r.asin, r.title, r.brand, r.price) for r in got] == [("a", "B1", "One", None, 5.0), ("b", "B2", "Two", "Maker", None)]


def test_embedder(spark):
    df = spark.createDataFrame([(1, "a b", 5, 1), (2, None, 0, 9)], "id long, text string, score long, dup_count long")
    got = embedder.embed(df, F.col("text"), 16).collect()
    assert [len(r.embedding) for r in got] == [16, 16]
    todo = df.withColumn("embedding", F.lit(None).cast("array<float>")).withColumn("attempts", F.when(F.col("id") == 2, 3))
    assert [r.id for r in embedder.priority_page(todo, 5).collect()] == [1]


def test_listing(spark):
    html = '<div class="thing id link" data-fullname="t3_a" data-score="5" data-author="me"><a class="thumb" href="/x"></a><a class="title may-blank" href="/r/s/1">A <b>title</b></a></div><div class="thing link" data-fullname="t3_b"><p>no title</p></div><div class="thing link" data-fullname="t3_c"><a href="https://y" class="title">C</a></div>'
    got = {r.ext_id: r for r in pages.listing_posts(spark.createDataFrame([("s", html)], "sub string, html string")).collect()}
    assert set(got) == {"t3_a", "t3_c"}
    assert (got["t3_a"].title, got["t3_a"].url, got["t3_c"].url) == ("A title", "https://old.reddit.com/r/s/1", "https://y")
    assert json.loads(got["t3_a"].metadata) == {"sub": "s", "score": "5", "author": "me"}


def test_archive_posts_without_id_or_time_go(spark):
    posts = payloads(spark, {"data": [{"id": "a", "created_utc": 1.0, "score": "3", "permalink": "/p"}, {"id": "b"}, {"created_utc": 2}]}, {"data": []}, {"error": 1})
    r = only(feeds.reddit_posts(posts))
    assert (r.reddit_id, r.title, r.score, r.num_comments, r.url, r.updated_at) == ("a", "", 3, 0, "https://reddit.com/p", r.created_utc)


def test_archive_comments_without_id_or_time_go(spark):
    c = feeds.reddit_comments(payloads(spark, {"data": [{"id": "x", "link_id": "t3_a", "parent_id": "t1_y", "created_utc": "5"}, {"id": "z", "link_id": "t3_a"}, {"link_id": "t3_a", "created_utc": 1}]}))
    r = only(c)
    assert (r.reddit_id, r.post_reddit_id, r.parent_reddit_id, r.score, str(r.created_utc)) == ("x", "a", "y", 0, "1970-01-01 00:00:05")


def test_submissions_of_the_older_worker(spark):
    rows = payloads(spark, {"submission": {"id": "p", "title": "T", "selftext": "", "score": "7", "upvote_ratio": 0.5, "created_utc": 86400.5}, "comments": []}, {"submission": {"title": "no id"}}, {"comments": []})
    r = only(feeds.legacy_posts(rows))
    assert (r.reddit_id, r.title, r.selftext, r.author, r.score, r.upvote_ratio, r.num_comments, str(r.created_utc)) == ("p", "T", None, "None", 7, 0.5, None, "1970-01-02 00:00:00")


def test_comment_trees_of_the_older_worker(spark):
    first = {"id": "c", "parent_id": "t3_p", "body": "B", "score": 2, "depth": 0, "all_awardings": ["x", "y"], "created_utc": 1}
    rows = payloads(spark, {"submission": {"id": "p"}, "comments": [first, {"id": "d", "parent_id": "t1_c", "author": "a", "depth": 1}, {"body": "no id"}]}, {"submission": {"id": "q"}})
    got = sorted((r.post_reddit_id, r.reddit_id, r.parent_reddit_id, r.author, r.score, r.depth, r.awards) for r in feeds.legacy_comments(rows).collect())
    assert got == [("p", "c", "p", "None", 2, 0, 2), ("p", "d", "c", "a", None, 1, 0)]


def test_texts_are_embedded_in_slices(spark):
    """An embedder gets a megabyte of text at once, not a batch of any size; vectors stand at their rows."""
    texts = ["word " * 100_000] * 5 + ["a", "", None, "b c"] * 3

    def careful(some, dims):
        assert sum(map(len, some)) <= 1 << 20
        return embedder.hashing(some, dims)

    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string").coalesce(1)
    got = {r.id: r.embedding for r in embedder.embed(df, F.col("text"), 8, careful, None).collect()}
    want = embedder.hashing([t or "" for t in texts], 8)
    assert all(got[i] == pytest.approx(list(v)) for i, v in enumerate(want)) and len(got) == len(texts)


def test_payloads_are_made_and_read_by_all_cores(spark):
    """Parts come in one small file; their payloads are dealt out."""
    import __spark_entry__ as entry_points

    for name in ("source_product_reviews", "source_videos", "source_chrome_extensions"):
        rows = entry_points.queries()[name](spark, "/root/testdata/sf0.01")
        assert rows.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism > 1, name
