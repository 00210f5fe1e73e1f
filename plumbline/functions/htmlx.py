"""Values in HTML: patterns as column expressions; tag removal as an Arrow function."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

_DROP = re.compile(r"<(script|style|noscript|svg)\b[^>]*>.*?</\1\s*>|<!--.*?-->|<[^>]+>", re.S | re.I)


def _first(text: Column, pattern: str) -> Column:
    return F.nullif(F.regexp_extract(text, pattern, 1), F.lit(""))


def few_entities(text: Column) -> Column:
    """The handful of references that feeds use."""
    out = text
    for a, b in (("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&#x27;", "'")):
        out = F.replace(out, F.lit(a), F.lit(b))
    return out


def title(html: Column) -> Column:
    return few_entities(_first(html, r"(?is)<title[^>]*>(.*?)</title>"))


def heading(html: Column) -> Column:
    return few_entities(_first(html, r"(?is)<h1[^>]*>(.*?)</h1>"))


def links(html: Column) -> Column:
    return F.regexp_extract_all(html, F.lit(r'(?i)<a\s[^>]*href="([^"]*)"'), 1)


def meta(html: Column, name: str) -> Column:
    return few_entities(_first(html, rf'(?is)<meta[^>]*(?:property|name)="{name}"[^>]*content="([^"]*)"'))


def json_ld(html: Column) -> Column:
    """All ld+json blocks."""
    return F.regexp_extract_all(html, F.lit(r'(?is)<script[^>]*type="application/ld\+json"[^>]*>(.*?)</script>'), 1)


def json_ld_of(html: Column, kind: str) -> Column:
    """The first ld+json block of a type; other blocks, and broken ones, are passed over."""
    found = F.filter(json_ld(html), lambda b: F.get_json_object(b, "$.@type") == kind)
    return F.get(found, F.lit(0))


def next_data(html: Column) -> Column:
    return _first(html, r'(?is)<script[^>]*id="__NEXT_DATA__"[^>]*>(.*?)</script>')


def sitemap_urls(xml: Column) -> Column:
    return F.regexp_extract_all(xml, F.lit(r"(?is)<loc>\s*(.*?)\s*</loc>"), 1)


def last_part(url: Column) -> Column:
    """The last part of a URL's path."""
    return F.element_at(F.split(F.regexp_replace(url, "/+$", ""), "/"), -1)


def visible_text(html: Column) -> Column:
    """Text without tags, scripts and styles, references decoded and white space collapsed."""

    @F.arrow_udf("string")
    def visible(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([None if x is None else " ".join(unescape(_DROP.sub(" ", x)).split()) for x in batch.to_pylist()], pa.string())

    return visible(html)
