"""Model output into records: problem statements, opportunities, video insights, legacy signals.

The models themselves are behind ``Client``: a function of prompts to replies. None is called here.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions import jsonx
from plumbline.functions.text import priority, topic_slug
from plumbline.operators.queues import in_batches

Client = Callable[[Sequence[str]], Sequence[str]]


def ask(rows: DataFrame, prompt: Column, client: Client, out: str = "reply") -> DataFrame:
    """Rows with the reply of a client to each prompt; batches go to the workers, failures are the client's to retry."""

    @F.arrow_udf("string")
    def reply(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for prompts in batches:
            yield pa.array(list(client(prompts.to_pylist())), pa.string())

    return rows.withColumn(out, reply(prompt))


def batches(signals: DataFrame, size: int = 200, text_chars: int = 500, most: int = 20_000) -> DataFrame:
    """The ``most`` signals of the highest priority in groups of ``size``, most important first, as (batch, items JSON)."""
    item = F.struct(F.col("id"), F.substring("text", 1, text_chars).alias("text"))
    rank = F.struct(-priority(F.col("score"), F.col("dup_count")), F.col("id"), item.alias("item"))
    dealt = in_batches(signals, [priority(F.col("score"), F.col("dup_count")).desc(), F.col("id")], size, most)
    listed = dealt.groupBy("batch").agg(F.sort_array(F.collect_list(rank)).alias("rows"))
    return listed.select("batch", F.to_json(F.transform("rows", lambda r: r["item"])).alias("items"))


def audience_of(icp: Column) -> Column:
    low = F.lower(F.trim(icp))
    return F.when(F.contains(low, F.lit("agency")), "agency").when(F.contains(low, F.lit("ecom")), "ecom").otherwise("saas_operator")


def statements(replies: DataFrame, reply: str = "reply") -> DataFrame:
    """One row per valid statement in the replies: from {"statements": [..]}, {"themes": [..]}, a list, or one statement."""
    text = jsonx.json_in_prose(F.col(reply))
    listed = F.coalesce(F.get_json_object(text, "$.statements"), F.get_json_object(text, "$.themes"))
    items = F.when(F.startswith(text, F.lit("[")), text).when(listed.isNotNull(), listed).otherwise(F.concat(F.lit("["), text, F.lit("]")))
    parsed = F.explode(F.from_json(items, "array<variant>"))
    rows = replies.withColumn("_item", parsed).withColumn("_json", F.to_json("_item"))
    field = lambda k: F.get_json_object("_json", f"$.{k}")
    ids = jsonx.id_list(field("supporting_signal_ids"))
    severity = jsonx.clamp_int(field("severity"), 1, 5, 3)
    out = rows.select(
        *(c for c in replies.columns if c != reply),
        field("statement").alias("statement"),
        audience_of(field("icp")).alias("icp"),
        *(F.coalesce(field(k), F.lit("")).alias(k) for k in ("job_to_be_done", "current_workaround", "frequency_note")),
        jsonx.text_list(field("wtp_quotes")).alias("wtp_quotes"),
        severity.alias("severity"),
        ids.alias("supporting_signal_ids"),
        pre_score(severity, ids).alias("pre_score"),
    )
    return out.filter(F.char_length("statement") >= 10).withColumn("statement_key", F.sha2("statement", 256))


def pre_score(severity: Column, ids: Column) -> Column:
    return severity * F.greatest(F.lit(1), F.size(ids))


def quotes(value: Column) -> Column:
    """JSON list of {"quote": ..} or strings -> strings."""
    items = F.from_json(value, "array<variant>")
    return F.filter(F.transform(items, lambda v: F.coalesce(F.get_json_object(F.to_json(v), "$.quote"), F.try_variant_get(v, "$", "string"))), lambda q: q.isNotNull())


def final_score(wedge: Column, wave: Column, edge: Column, open_market: Column, n_funded: Column | None = None, most_funded: int = 3) -> Column:
    """0.5 wedge + 0.3 wave + 0.2 edge where the market is open, else 0. With ``n_funded``, a crowded field closes it, too."""
    gate = F.coalesce(open_market, F.lit(True))
    if n_funded is not None:
        gate = gate & (n_funded < most_funded)
    return F.when(gate, wedge * 0.5 + wave * 0.3 + edge * 0.2).otherwise(F.lit(0.0))


def opportunities(rows: DataFrame, reply: str = "reply", judge: str = "judge", strict: bool = False) -> DataFrame:
    """Statements with a model's verdict -> opportunities. Input: id, statement, icp and the reply. Replies without JSON are dropped."""
    text = F.regexp_extract(reply, r"(?s)\{.*\}", 0)
    rows = rows.withColumn("_json", text).filter(F.try_parse_json("_json").isNotNull() & (F.col("_json") != ""))
    field = lambda k: F.get_json_object("_json", f"$.{k}")
    one = "struct<name:string,funded:boolean,stage:string,exact_icp_match:boolean,url:string>"
    raw = field("competitors")
    rivals = F.when(F.startswith(raw, F.lit("{")), F.array(F.from_json(raw, one))).otherwise(F.coalesce(F.from_json(raw, f"array<{one}>"), F.array().cast(f"array<{one}>")))
    out = rows.withColumn("competitors", rivals).withColumn("n_funded_incumbents", F.size(F.filter("competitors", lambda c: c["funded"])))
    for k in ("wedge_score", "wave_score", "edge_score"):
        out = out.withColumn(k, jsonx.clamp_score(field(k)))
    gate = F.coalesce(field("saturation_ok").try_cast("boolean"), F.lit(True))
    score = final_score(F.col("wedge_score"), F.col("wave_score"), F.col("edge_score"), gate, F.col("n_funded_incumbents") if strict else None)
    wave = F.nullif(field("wave"), F.lit(""))
    return out.select(
        F.col("id").alias("problem_statement_id"), F.substring("statement", 1, 200).alias("title"), "statement", "icp", gate.alias("saturation_ok"),
        "wedge_score", wave.alias("wave"), "wave_score", "edge_score", "competitors", "n_funded_incumbents",
        *(F.coalesce(field(k), F.lit("")).alias(k) for k in ("tam_estimate", "sam_estimate", "success_evidence", "bear_case", "structural_tailwind", "edge_fit_notes")),
        F.concat(F.coalesce(wave, F.lit("unknown")), F.lit("_wedge")).alias("expansion_vector"), score.alias("final_score"), F.lit(judge).alias("validated_by"), F.lit("scored").alias("status"),
    )


def competitors(found: DataFrame, key: str = "problem_statement_id") -> DataFrame:
    """One row per opportunity and named competitor; the first of a name stays."""
    rows = found.select(key, F.posexplode("competitors").alias("at", "c")).filter(F.coalesce(F.col("c.name"), F.lit("")) != "")
    first = rows.groupBy(key, F.col("c.name").alias("name")).agg(F.min_by(F.struct("c.exact_icp_match", "c.stage"), "at").alias("x"))
    return first.select(key, "name", F.coalesce("x.exact_icp_match", F.lit(False)).alias("exact_icp_match"), F.coalesce("x.stage", F.lit("")).alias("notes"))


def video_insights(rows: DataFrame, reply: str = "reply", key: str = "video_id") -> DataFrame:
    """Validated insight of each video; a reply without a summary is rejected."""
    text = jsonx.json_in_prose(F.col(reply))
    field = lambda k: F.get_json_object(text, f"$.{k}")
    lists = (jsonx.text_list(field(k)).alias(k) for k in ("actionable_insights", "pain_points", "ideas"))
    return rows.select(key, jsonx.clamp_int(field("scorecard_rating"), 1, 10, 1).alias("scorecard_rating"), field("summary").alias("summary"), *lists).filter("summary is not null")


def legacy_signals(replies: DataFrame, reply: str = "reply") -> DataFrame:
    """Signals of the older stage: summary cut and marked, tier as severity, topic as a slug."""
    text = F.regexp_extract(reply, r"(?s)\{.*\}", 0)
    kind = "array<struct<type:string,topic:string,summary:string,sentiment:double,wtp_tier:string,evidence_url:string,ai_angle:string,recurring_fit:boolean>>"
    rows = replies.select(F.explode(F.from_json(F.get_json_object(text, "$.signals"), kind)).alias("s")).select("s.*")
    cut = F.substring(F.coalesce("summary", F.lit("")), 1, 360)
    marked = F.when(F.coalesce("ai_angle", F.lit("")) != "", F.concat(cut, F.lit(" [AI: "), F.col("ai_angle"), F.lit("]"))).otherwise(cut)
    marked = F.when(F.col("recurring_fit") == F.lit(False), F.concat(F.lit("[one-off] "), marked)).otherwise(marked)
    return rows.select(F.lit("analysis").alias("source_slug"), "type", topic_slug(F.col("topic")).alias("topic"), marked.alias("summary"), "sentiment", F.coalesce(F.col("wtp_tier").try_cast("int"), F.lit(0)).alias("severity"), "evidence_url")
