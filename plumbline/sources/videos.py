"""Video metadata, captions and comments."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions.numbers import compact_date
from plumbline.sources.feeds import ITEM, either, text, value

SEGMENT = "struct<text:string,start:double,dur:double>"
HEAVY = ("formats", "thumbnails", "automatic_captions", "subtitles", "requested_formats", "heatmap", "comments")


def _items(raw: DataFrame, payload: str) -> DataFrame:
    return raw.select(F.explode(F.array_compact(F.array(F.try_parse_json(payload)))).alias(ITEM))  # parsed once, whatever is asked of it


def _int(path: str) -> Column:
    return text(path).try_cast("double").cast("bigint")


def channels(raw: DataFrame, payload: str = "payload") -> DataFrame:
    uploader = text("uploader_id")
    meta = F.to_json(F.struct(value("uploader_url").alias("uploader_url"), value("channel_url").alias("channel_url")))
    empty = lambda n, t: F.lit(None).cast(t).alias(n)
    out = _items(raw, payload).select(either("channel_id", "uploader_id").alias("channel_id"), either("channel", "uploader").alias("title"), F.when(F.startswith(uploader, F.lit("@")), uploader).alias("handle"), _int("channel_follower_count").alias("subscriber_count"), empty("video_count", "bigint"), empty("view_count", "bigint"), empty("country", "string"), empty("description", "string"), meta.alias("metadata"))
    return out.filter("channel_id is not null")


def videos(raw: DataFrame, payload: str = "payload") -> DataFrame:
    """Video rows; the exact time where there is one, else the upload day; heavy keys are left out of ``raw``."""
    published = F.coalesce(F.timestamp_seconds(_int("timestamp")), compact_date(text("upload_date")))
    light = F.map_filter(F.from_json(F.to_json(ITEM), "map<string,variant>"), lambda k, _: ~k.isin(*HEAVY))
    out = _items(raw, payload).select(text("id").alias("video_id"), either("channel_id", "uploader_id").alias("channel_id"), text("title").alias("title"), text("description").alias("description"), _int("duration").alias("duration_sec"), _int("view_count").alias("view_count"), _int("like_count").alias("like_count"), _int("comment_count").alias("comment_count"), published.alias("published_at"), F.coalesce(F.to_json(value("tags")), F.lit("[]")).alias("tags"), F.to_json(light).alias("raw"))
    return out.filter("video_id is not null")


def json3_segments(payload: Column) -> Column:
    """Caption events into segments: text of all parts, seconds; events without visible text are dropped."""
    events = F.from_json(F.get_json_object(payload, "$.events"), "array<struct<tStartMs:bigint,dDurationMs:bigint,segs:array<struct<utf8:string>>>>")
    said = F.transform(F.coalesce(events, F.array().cast("array<struct<tStartMs:bigint,dDurationMs:bigint,segs:array<struct<utf8:string>>>>")), lambda e: F.struct(F.array_join(F.transform(F.coalesce(e["segs"], F.array().cast("array<struct<utf8:string>>")), lambda s: F.coalesce(s["utf8"], F.lit(""))), "").alias("text"), (F.coalesce(e["tStartMs"], F.lit(0)) / 1000.0).alias("start"), (F.coalesce(e["dDurationMs"], F.lit(0)) / 1000.0).alias("dur")))
    return F.filter(said, lambda s: s["text"].rlike(r"\S"))


def transcript_segments(payload: Column) -> Column:
    """Segments with ``duration`` under its short name."""
    rows = F.from_json(payload, "array<struct<text:string,start:double,duration:double>>")
    return F.transform(rows, lambda s: F.struct(F.coalesce(s["text"], F.lit("")).alias("text"), F.coalesce(s["start"], F.lit(0.0)).alias("start"), F.coalesce(s["duration"], F.lit(0.0)).alias("dur")))


def caption_track(payload: Column, langs: Sequence[str] = ("en",)) -> Column:
    """(url, lang) of one json3 track: manual before automatic; preferred languages in order, then the first other."""
    kind = "map<string,array<struct<ext:string,url:string>>>"
    found = []
    for source in ("subtitles", "automatic_captions"):
        tracks = F.from_json(F.get_json_object(payload, f"$.{source}"), kind)
        url = lambda formats: F.get(F.filter(formats, lambda f: (f["ext"] == "json3") & (F.coalesce(f["url"], F.lit("")) != "")), F.lit(0))["url"]
        for lang in langs:
            at = url(F.try_element_at(tracks, F.lit(lang)))
            found.append(F.when(at.isNotNull(), F.struct(at.alias("url"), F.lit(lang).alias("lang"))))
        others = F.filter(F.transform(F.map_entries(tracks), lambda e: F.struct(url(e["value"]).alias("url"), e["key"].alias("lang"))), lambda t: t["url"].isNotNull())
        found.append(F.get(others, F.lit(0)))
    return F.coalesce(*found)


def best_transcript(candidates: Sequence[tuple[str, Column]]) -> Column:
    """(segments, source) of the first candidate that has segments."""
    return F.coalesce(*(F.when(F.size(c) > 0, F.struct(c.alias("segments"), F.lit(n).alias("transcript_source"))) for n, c in candidates))


def comments(raw: DataFrame, payload: str = "payload", key: str = "video_id") -> DataFrame:
    """Comment rows of each video; 'root' is no parent, rows without id are dropped."""
    rows = raw.select(key, F.explode(F.from_json(payload, "array<variant>")).alias(ITEM))
    parent = F.nullif(F.nullif(text("parent"), F.lit("")), F.lit("root"))
    out = rows.select(either("id").alias("comment_id"), key, parent.alias("parent_id"), text("author").alias("author"), text("text").alias("text"), _int("like_count").alias("like_count"), F.timestamp_seconds(_int("timestamp")).alias("published_at"))
    return out.filter("comment_id is not null")
