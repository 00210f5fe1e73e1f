"""Queries of payload mapping and of validated records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.functions import htmlx, numbers
from plumbline.functions.text import snippet
from plumbline.operators import statements as S
from plumbline.plans.registry import query, read

_SCORES = "c_custkey % 6 as wedge, (c_custkey // 7) % 6 as wave, c_nationkey % 6 as edge, c_acctbal >= 0 as ok"


def verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Model replies: JSON inside prose."""
    k = F.col("c_custkey")
    rival = F.array(F.struct(F.concat(F.lit("rival"), (k % 4).cast("string")).alias("name"), (k % 2 == 0).alias("funded"), F.lit("seed").alias("stage")), F.struct(F.lit("").alias("name"), F.lit(True).alias("funded"), F.lit("a").alias("stage")), F.struct(F.lit("Big").alias("name"), (k % 3 == 0).alias("funded"), F.lit("b").alias("stage")))
    body = F.to_json(F.struct((k % 6).alias("wedge_score"), (F.floor(k / 7) % 6).alias("wave_score"), (F.col("c_nationkey") % 6).alias("edge_score"), (F.col("c_acctbal") >= 0).alias("saturation_ok"), rival.alias("competitors")))
    reply = F.concat(F.lit("Here it is: "), body, F.lit(" Done."))
    return read(spark, sf_dir, "customer").select(k.alias("id"), F.col("c_name").alias("statement"), F.lit("ecom").alias("icp"), reply.alias("reply"))


@query(f"select c_custkey as problem_statement_id, c_name as title, case when ok then round(0.5 * least(5, wedge) + 0.3 * least(5, wave) + 0.2 * least(5, edge), 6)::double else 0 end as final_score, 'unknown_wedge' as expansion_vector, ((c_custkey % 2 = 0)::int + 1 + (c_custkey % 3 = 0)::int)::int as n_funded_incumbents from (select *, {_SCORES} from customer)")
def final_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = S.opportunities(verdicts(spark, sf_dir))
    return got.select("problem_statement_id", "title", F.round("final_score", 6).alias("final_score"), "expansion_vector", "n_funded_incumbents")


@query(f"select c_custkey as id, case when ok and n < 3 then round(0.5 * wedge + 0.3 * wave + 0.2 * edge, 6)::double else 0 end as final_score from (select *, {_SCORES}, (c_custkey % 2 = 0)::int + 1 + (c_custkey % 3 = 0)::int as n from customer)")
def strict_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With the stricter gate: three funded rivals close the market."""
    return S.opportunities(verdicts(spark, sf_dir), strict=True).select(F.col("problem_statement_id").alias("id"), F.round("final_score", 6).alias("final_score"))


@query("select c_custkey as problem_statement_id, name, false as exact_icp_match, notes from customer, lateral (values ('rival' || (c_custkey % 4), 'seed'), ('Big', 'b')) t(name, notes)")
def competitor_sidecar(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.competitors(S.opportunities(verdicts(spark, sf_dir)))


@query("select o_custkey as id, (least(5, greatest(1, o_custkey % 8)) * greatest(1, count(*)))::int as pre_score from orders group by 1")
def pre_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.collect_list("o_orderkey").alias("ids"))
    severity = F.least(F.lit(5), F.greatest(F.lit(1), (F.col("o_custkey") % 8).cast("int")))
    return o.select(F.col("o_custkey").alias("id"), S.pre_score(severity, F.col("ids")).alias("pre_score"))


@query(
    """select c_custkey as id, 'Statement of ' || c_name as statement, case c_custkey % 3 when 0 then 'agency' when 1 then 'ecom' else 'saas_operator' end as icp,
    case c_custkey % 4 when 0 then 3 when 1 then 5 when 2 then 1 else 4 end as severity, case c_custkey % 4 when 1 then 2 when 2 then 0 else 1 end as n_ids, case c_custkey % 2 when 0 then 1 else 2 end as n_quotes from customer"""
)
def statement_coercion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replies of uneven quality into valid statements; too short ones are rejected."""
    k = F.col("c_custkey")
    icp = F.when(k % 3 == 0, '"Agency owner"').when(k % 3 == 1, '"ECOM"').otherwise("null")
    severity = F.when(k % 4 == 0, '"bad"').when(k % 4 == 1, "9").when(k % 4 == 2, '"-2"').otherwise("4.7")
    ids = F.when(k % 4 == 1, '"7, 8.0, x"').when(k % 4 == 2, "null").when(k % 4 == 3, "[3]").otherwise("12")
    quotes = F.when(k % 2 == 0, '"only one"').otherwise('["a","b"]')
    one = F.concat(F.lit('{"statement":"Statement of '), F.col("c_name"), F.lit('","icp":'), icp, F.lit(',"severity":'), severity, F.lit(',"supporting_signal_ids":'), ids, F.lit(',"wtp_quotes":'), quotes, F.lit("}"))
    reply = F.when(k % 5 == 0, F.concat(F.lit("text ["), one, F.lit("]"))).when(k % 5 == 1, F.concat(F.lit('{"themes":['), one, F.lit("]}"))).when(k % 5 == 2, one).otherwise(F.concat(F.lit('so {"statements":['), one, F.lit(',{"statement":"short"}]} ok')))
    got = S.statements(read(spark, sf_dir, "customer").select(k.alias("id"), reply.alias("reply")))
    return got.select("id", "statement", "icp", "severity", F.size("supporting_signal_ids").alias("n_ids"), F.size("wtp_quotes").alias("n_quotes"))


@query("select c_custkey as video_id, case c_custkey % 3 when 0 then 10 when 1 then 1 else 7 end as scorecard_rating, case when c_custkey % 2 = 0 then 1 else 0 end as n_ideas from customer where c_custkey % 4 <> 3")
def insight_coercion(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    rating = F.when(k % 3 == 0, "11").when(k % 3 == 1, '"none"').otherwise('"7.9"')
    reply = F.concat(F.lit('{"scorecard_rating":'), rating, F.when(k % 4 == 3, "").otherwise(',"summary":"s"'), F.lit(',"ideas":'), F.when(k % 2 == 0, '"one"').otherwise("null"), F.lit("}"))
    got = S.video_insights(read(spark, sf_dir, "customer").select(k.alias("video_id"), reply.alias("reply")))
    return got.select("video_id", "scorecard_rating", F.size("ideas").alias("n_ideas"))


@query("select c_custkey as id, case when c_custkey % 2 = 0 then 'x|y' else 'z' end as quotes from customer")
def quote_decoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    raw = F.when(k % 2 == 0, '[{"quote":"x"},"y"]').otherwise('["z"]')
    return read(spark, sf_dir, "customer").select(k.alias("id"), F.array_join(S.quotes(raw), "|").alias("quotes"))


@query("select c_custkey as id, (case when c_custkey % 3 = 0 then '[one-off] ' else '' end) || 'sum' || (case when c_custkey % 2 = 0 then ' [AI: bot]' else '' end) as summary, 'my_topic' as topic, (c_custkey % 6)::int as severity from customer")
def legacy_decorations(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    one = F.to_json(F.struct(k.cast("string").alias("evidence_url"), F.lit("My-topic!").alias("topic"), F.lit("sum").alias("summary"), (k % 6).cast("string").alias("wtp_tier"), F.when(k % 2 == 0, "bot").alias("ai_angle"), (k % 3 != 0).alias("recurring_fit")))
    got = S.legacy_signals(read(spark, sf_dir, "customer").select(F.concat(F.lit('{"signals":['), one, F.lit("]}")).alias("reply")))
    return got.select(F.col("evidence_url").cast("bigint").alias("id"), "summary", "topic", "severity")


@query("select event_id, json_extract_string(props, '$.k')::bigint as k from events")
def json_extract_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "events").select("event_id", F.variant_get(F.parse_json("props"), "$.k", "bigint").alias("k"))


@query("select p_partkey, case p_partkey % 4 when 0 then p_size * 1000 when 1 then p_size * 1000000 + 500000 when 2 then 1000 * p_size + 1 else null end::bigint as n, round(p_retailprice, 2) as price from part")
def human_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, size = F.col("p_partkey"), F.col("p_size").cast("string")
    text = F.when(k % 4 == 0, F.concat(size, F.lit("K"))).when(k % 4 == 1, F.concat(size, F.lit(".5m+"))).when(k % 4 == 2, F.concat(F.format_number(F.col("p_size") * 1000 + 1, 0), F.lit("+"))).otherwise("many")
    price = numbers.money(F.concat(F.lit("$"), F.format_number(F.col("p_retailprice"), 2)))
    return read(spark, sf_dir, "part").select("p_partkey", numbers.human_int(text).alias("n"), F.round(price, 2).alias("price"))


@query(
    r"""select page_id, replace(replace(replace(replace(replace(replace(t, '&amp;', '&'), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&#x27;', '''') as title, n_links
    from (select page_id, nullif(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1), '') as t, len(regexp_extract_all(html, '(?i)<a\s[^>]*href="([^"]*)"'))::int as n_links from pages)"""
)
def html_title(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read(spark, sf_dir, "pages")
    return p.select("page_id", htmlx.title(F.col("html")).alias("title"), F.size(htmlx.links(F.col("html"))).alias("n_links"))


@query("select conv_id, string_agg(text, ' ' order by turn) as transcript from conversations group by 1")
def transcript_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Segments of a thread, in order, as one text."""
    c = read(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "text"))).alias("t"))
    return c.select("conv_id", F.array_join(F.transform("t", lambda s: s["text"]), " ").alias("transcript"))


@query(r"select doc_id, case when length(t) <= 80 then t else regexp_replace(substr(t, 1, 79), '[ \t\n\x0b\f\r]?[^ \t\n\x0b\f\r]*$', '') || ' …' end as snippet from (select doc_id, trim(regexp_replace(coalesce(text, ''), '[ \t\n\x0b\f\r]+', ' ', 'g'), ' ') as t from documents)")
def text_snippets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "documents").select("doc_id", snippet(F.col("text"), 80).alias("snippet"))


@query("select doc_id::varchar as ext_id, 'https://x.test/' || doc_id as url, source as title, case when doc_id % 2 = 0 then text else source end as body from documents where doc_id % 7 <> 0")
def map_feed_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw feed payloads into documents: a missing body is the title, rows without id are dropped."""
    from plumbline.sources.feeds import FEEDS

    i = F.col("doc_id")
    hit = F.to_json(F.struct(F.when(i % 7 != 0, i.cast("string")).alias("objectID"), F.concat(F.lit("https://x.test/"), i.cast("string")).alias("url"), F.col("source").alias("title"), F.when(i % 2 == 0, F.col("text")).alias("story_text")))
    raw = read(spark, sf_dir, "documents").select(F.concat(F.lit('{"hits":['), hit, F.lit("]}")).alias("payload"))
    return FEEDS["hackernews"].rows(raw).select("ext_id", "url", "title", "body")


@query("select page_id, list_filter(string_split(rtrim(url, '/'), '/'), lambda x: true)[-1] as handle from pages")
def url_handles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last part of each page's address."""
    return read(spark, sf_dir, "pages").select("page_id", htmlx.last_part(F.col("url")).alias("handle"))


@query(f"select c_custkey as problem_statement_id, substr(c_name, 1, 200) as title, c_name as statement, 'ecom' as icp, ok as saturation_ok, wedge::double as wedge_score, wave::double as wave_score, edge::double as edge_score, '' as bear_case, 'bulk' as validated_by, 'scored' as status from (select *, least(5, c_custkey % 6) as wedge_, {_SCORES} from customer)")
def opportunity_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An opportunity's row as it is written."""
    got = S.opportunities(verdicts(spark, sf_dir), judge="bulk")
    return got.select("problem_statement_id", "title", "statement", "icp", "saturation_ok", *(F.col(c).cast("double").alias(c) for c in ("wedge_score", "wave_score", "edge_score")), "bear_case", "validated_by", "status")
