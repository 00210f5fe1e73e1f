"""Pages of app stores and directories into rows: one page gives one row, or several."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions import htmlx
from plumbline.functions.numbers import human_int
from plumbline.functions.text import stripped


def _field(path: str) -> Column:
    return F.get_json_object("_ld", f"$.{path}")


def _offer(path: str) -> Column:
    return F.coalesce(_field(f"offers.{path}"), _field(f"offers[0].{path}"))


def _software(pages: DataFrame) -> DataFrame:
    found = F.array_compact(F.array(htmlx.json_ld_of(F.col("html"), "SoftwareApplication")))
    return pages.select("*", F.explode(found).alias("_ld"))  # a filter would look for it twice


def shopify_apps(pages: DataFrame) -> DataFrame:
    """(url, html) -> one document per app page."""
    handle = htmlx.last_part(F.col("url"))
    name = F.substring(F.coalesce(F.nullif(_field("name"), F.lit("")), handle), 1, 300)
    rating, count = _field("aggregateRating.ratingValue"), F.coalesce(_field("aggregateRating.ratingCount"), _field("aggregateRating.reviewCount"))
    category = F.coalesce(_field("applicationCategory"), _field("applicationSubCategory"))
    said = lambda c: F.coalesce(c, F.lit("None"))
    body = F.concat(name, F.lit(". "), F.coalesce(_field("description"), F.lit("")), F.lit(" [rating="), said(rating), F.lit(", reviews="), said(count), F.lit(", price="), said(_offer("price")), F.lit(" "), said(_offer("priceCurrency")), F.lit(", category="), said(category), F.lit("]"))
    meta = F.to_json(F.struct(rating.alias("rating"), count.alias("review_count"), _offer("price").alias("price"), _offer("priceCurrency").alias("currency"), category.alias("category")))
    return _software(pages).select(F.lit("shopify_app").alias("source_slug"), handle.alias("ext_id"), "url", name.alias("title"), body.alias("body"), meta.alias("metadata"))


def product_pages(pages: DataFrame, source: str = "trustradius", most_reviews: int = 50) -> tuple[DataFrame, DataFrame]:
    """(url, html) -> (products, reviews)."""
    parts = F.split(F.regexp_replace("url", "/+$", ""), "/")
    slug = F.when(F.endswith(F.col("url"), F.lit("/reviews")), F.element_at(parts, -2)).otherwise(F.element_at(parts, -1))
    name = F.substring(F.coalesce(F.nullif(_field("name"), F.lit("")), slug), 1, 300)
    price = _offer("price")
    count = F.coalesce(_field("aggregateRating.ratingCount"), _field("aggregateRating.reviewCount"))
    rows = _software(pages)
    pricing = F.to_json(F.struct(price.alias("price"), _offer("priceCurrency").alias("currency")))
    products = rows.select(F.lit(source).alias("source"), slug.alias("ext_id"), name.alias("name"), F.coalesce(_offer("offeredBy.name"), F.lit("")).alias("vendor"), F.coalesce(_field("applicationCategory"), F.lit("")).alias("category"), F.lit("").alias("website"), F.when(price.isNotNull(), F.concat_ws(" ", price, F.coalesce(_offer("priceCurrency"), F.lit("USD")))).otherwise("").alias("pricing_text"), pricing.alias("pricing"), _field("aggregateRating.ratingValue").try_cast("double").alias("rating"), count.try_cast("bigint").alias("n_reviews"), F.substring(F.coalesce(_field("description"), F.lit("")), 1, 5000).alias("description"))
    raw = _field("review")
    listed = F.when(F.startswith(raw, F.lit("{")), F.concat(F.lit("["), raw, F.lit("]"))).otherwise(raw)
    kind = "array<struct<author:struct<name:string>,reviewRating:struct<ratingValue:string>,reviewBody:string,name:string,datePublished:string>>"
    each = rows.select("url", slug.alias("slug"), name.alias("product"), F.explode(F.slice(F.from_json(listed, kind), 1, most_reviews)).alias("r"))
    author, day = F.coalesce("r.author.name", F.lit("")), F.coalesce("r.datePublished", F.lit(""))
    key = F.lower(F.replace(F.concat_ws("-", F.col("slug"), day, F.substring(author, 1, 30)), F.lit(" "), F.lit("-")))
    meta = F.to_json(F.struct(F.col("slug").alias("product_ext_id"), F.col("product").alias("product_name"), F.col("r.reviewRating.ratingValue").alias("rating"), author.alias("reviewer"), day.alias("date"), F.lit(source).alias("source")))
    reviews = each.select(F.lit(f"{source}_review").alias("source_slug"), key.alias("ext_id"), "url", F.coalesce("r.name", F.lit("")).alias("title"), F.coalesce("r.reviewBody", F.lit("")).alias("body"), meta.alias("metadata"))
    return products, reviews


def chrome_extensions(pages: DataFrame, suffix: str = " - Chrome Web Store") -> DataFrame:
    """(ext_id, url, html) -> documents; pages without name, rating and users are misses."""
    html = F.col("html")
    rows = pages.withColumn("_seen", htmlx.visible_text(html)).withColumn("_name", F.regexp_replace(htmlx.meta(html, "og:title"), suffix.replace("-", r"\-") + "$", ""))
    number = lambda p: F.nullif(F.regexp_extract("_seen", p, 1), F.lit(""))
    rating = number(r"([0-5](?:\.\d+)?) out of 5").try_cast("double")
    users = human_int(number(r"([\d,.]+[KMB]?\+?)\s+users"))
    counted = human_int(number(r"([\d,.]+[KMB]?)\s+ratings"))
    category = F.nullif(stripped(htmlx.few_entities(F.regexp_extract(html, r'(?is)href="[^"]*category/[^"]*"[^>]*>([^<]+)<', 1))), F.lit(""))
    found = rows.select("ext_id", "url", "_name", rating.alias("rating"), users.alias("users"), counted.alias("rating_count"), category.alias("category"), F.coalesce(htmlx.meta(html, "og:description"), htmlx.meta(html, "description"), F.lit("")).alias("_about"))
    found = found.filter("_name is not null or rating is not null or users is not null").withColumn("title", F.substring(F.coalesce("_name", "ext_id"), 1, 300))
    meta = F.to_json(F.struct("users", "rating", "rating_count", "category"))
    return found.select(F.lit("chrome_extension").alias("source_slug"), "ext_id", "url", "title", stripped(F.concat_ws(". ", "title", "_about")).alias("body"), meta.alias("metadata"))


def deal_pages(pages: DataFrame, path: str = "$.props.pageProps.deals") -> DataFrame:
    """(url, html) -> deals of the page's embedded data, and reviews as rows <slug>:rev:<i>."""
    deal = "struct<slug:string,name:string,tagline:string,category:string,subcategory:string,price:string,original_price:string,rating:string,review_count:bigint,id:string,comments:array<struct<body:string,rating:string,author:string,date:string>>>"
    rows = pages.select("url", F.explode(F.from_json(F.get_json_object(htmlx.next_data(F.col("html")), path), f"array<{deal}>")).alias("d")).filter("d.slug is not null")
    cols = lambda ext, title, body, meta: (F.lit("appsumo").alias("source_slug"), ext.alias("ext_id"), F.col("url"), title.alias("title"), body.alias("body"), meta.alias("metadata"))
    meta = F.to_json(F.struct(F.lit("deal").alias("kind"), "d.category", "d.subcategory", "d.price", "d.original_price", "d.rating", "d.review_count", F.col("d.id").alias("deal_id"), "d.slug"))
    deals = rows.select(*cols(F.col("d.slug"), F.col("d.name"), F.concat_ws(". ", "d.name", "d.tagline"), meta))
    each = rows.select("url", F.col("d.slug").alias("slug"), F.posexplode("d.comments").alias("i", "c")).filter("coalesce(c.body, '') <> ''")
    about = F.to_json(F.struct(F.lit("review").alias("kind"), F.col("slug").alias("parent_deal"), "c.rating", "c.author", "c.date"))
    return deals.unionByName(each.select(*cols(F.concat(F.col("slug"), F.lit(":rev:"), F.col("i").cast("string")), F.col("slug"), F.col("c.body"), about)))


def alternatives(pages: DataFrame) -> DataFrame:
    """(seed, html) -> a row per listed alternative, keyed seed:slug, and one for the page."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from plumbline.sources.cards import cards

        names = ("source_slug", "ext_id", "url", "title", "body", "metadata")
        for batch in batches:
            rows = [r for seed, html in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True) for r in cards(seed, html or "")]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.string()) for i in range(6)], names=list(names))

    return pages.select("seed", "html").mapInArrow(run, "source_slug string, ext_id string, url string, title string, body string, metadata string")


def listing_posts(pages: DataFrame, base: str = "https://old.reddit.com") -> DataFrame:
    """(sub, html) of a listing -> a document per post; a post without a title is passed over. On conflict only titles are updated."""
    post = F.explode(F.regexp_extract_all("html", F.lit(r'(?is)<div(?=[^>]*class="[^"]*\bthing\b)(?=[^>]*class="[^"]*\blink\b)[^>]*>(?:(?!<div[^>]*\bthing\b).)*'), 0))
    attribute = lambda n: F.nullif(F.regexp_extract("_post", rf'(?is)^<div[^>]*\b{n}="([^"]*)"', 1), F.lit(""))
    anchor = F.regexp_extract("_post", r'(?is)<a(?=[^>]*class="[^"]*\btitle\b)[^>]*>.*?</a>', 0)
    title = stripped(htmlx.few_entities(F.regexp_replace(F.regexp_extract(anchor, r"(?is)^<a[^>]*>(.*)</a>$", 1), "<[^>]*>", "")))
    href = F.regexp_extract(anchor, r'(?is)^<a[^>]*\bhref="([^"]*)"', 1)
    rows = pages.select("sub", post.alias("_post")).filter(anchor != "")
    meta = F.to_json(F.struct("sub", attribute("data-score").alias("score"), attribute("data-author").alias("author")))
    url = F.when(F.startswith(href, F.lit("/")), F.concat(F.lit(base), href)).otherwise(href)
    return rows.select(F.lit("reddit").alias("source_slug"), F.coalesce(attribute("data-fullname"), F.lit("")).alias("ext_id"), url.alias("url"), title.alias("title"), title.alias("body"), meta.alias("metadata"), F.sha2(title, 256).alias("content_hash"))
