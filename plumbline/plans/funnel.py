"""Queries of the lexical funnel. The word lists are probes that occur in the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.functions import text as T
from plumbline.functions.fts import full_text_match
from plumbline.functions.lexicon import AUDIENCES
from plumbline.operators import queues, tier0
from plumbline.plans.registry import query, read

PROBE = ["and the", "of the", "is and"]
STARTERS = ["and the", "of the", "the and"]
FEEDS = {f"src{i}": f"feed_{i}" for i in range(1, 8)}
_LEX = "(" + " or ".join(f"contains(regexp_replace(lower(text), '\\s+', ' ', 'g'), '{p}')" for p in PROBE) + ")"
_RAW = "(" + " or ".join(f"contains(lower(text), '{p}')" for p in PROBE) + ")"
_ASK = r"regexp_matches(lower(text), '(^|[.!?]\s+|\n\s*)(and the|of the|the and)')"
_LONG = "length(text) between 300 and 4000"
_KEPT = f"length(text) between 80 and 4000 and ({_LEX} or {_ASK} or {_LONG})"
_SCORE = "n_chars % 97"
_VOTES = ", ".join("(" + " + ".join(f"contains(lower(text), '{w}')::int" for w in ws) + f") as {k}" for k, ws in AUDIENCES.items())
_ICP = "case when greatest(agency, ecom, saas_operator) = 0 then null when agency >= ecom and agency >= saas_operator then 'agency' when ecom >= saas_operator then 'ecom' else 'saas_operator' end"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table documents in the funnel's shape."""
    d = read(spark, sf_dir, "documents")
    return d.select(F.lit("doc").alias("source"), F.col("doc_id").cast("string").alias("source_id"), "doc_id", "text", (F.col("n_chars") % 97).alias("score"))


def kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = documents(spark, sf_dir)
    return tier0.signals(d, F.col("source"), F.col("source_id"), F.col("text"), F.col("score"), F.lit(None).cast("timestamp"), PROBE, STARTERS)


@query(f"select doc_id::varchar as source_id, 'pain' as intent, length(text)::bigint as n_len, ({_SCORE})::bigint as score from documents where {_KEPT}")
def tier0_keep(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kept(spark, sf_dir).select("source_id", "intent", F.char_length("text").cast("long").alias("n_len"), "score")


@query("select doc_id, array_to_string(list_filter(['and the', 'is and', 'of the'], lambda p: contains(lower(text), p)), '|') as hits from documents where " + _RAW)
def tier0_lexicon_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = documents(spark, sf_dir).withColumn("h", T.lexicon_hits(F.col("text"), PROBE))
    return d.filter(F.size("h") > 0).select("doc_id", F.array_join(F.array_sort("h"), "|").alias("hits"))


@query(f"select doc_id, {_ICP} as icp_guess from (select doc_id, {_VOTES} from documents)")
def tier0_icp_vote(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents(spark, sf_dir).select("doc_id", T.audience(F.col("text")).alias("icp_guess"))


@query(
    rf"""select doc_id, {_ASK} as by_sql,
    (regexp_matches(n, '(^|[.!?\n]\s*)(and the|of the|the and)\b') or (contains(n, '?') and (contains(n, 'and ') or contains(n, 'the ')))) as by_shape
    from (select doc_id, text, regexp_replace(lower(text), '\s+', ' ', 'g') as n from documents)"""
)
def tier0_question_shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = F.col("text")
    return documents(spark, sf_dir).select("doc_id", T.starts_question(t, STARTERS).alias("by_sql"), T.question_shape(t, STARTERS, ["and ", "the "]).alias("by_shape"))


_FEEDS_SQL = "(values " + ", ".join(f"('{k}', '{v}')" for k, v in FEEDS.items()) + ") f(source, label)"


@query(
    f"""select label as source, doc_id::varchar as source_id, (doc_id % 6)::bigint as score,
    case when doc_id % 2 = 0 then timestamp '2024-03-01 10:00:00' else timestamp '2024-01-01' end as created_at_src
    from (select label, doc_id, '' || ' ' || text as text from documents join {_FEEDS_SQL} using (source))
    where length(text) between 80 and 4000 and ({_LEX} or {_LONG})"""
)
def tier0_reviews_keep(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = read(spark, sf_dir, "documents")
    rating = F.concat((F.col("doc_id") % 6).cast("string"), F.lit(".7"))
    at = F.when(F.col("doc_id") % 2 == 0, F.lit("2024-03-01 10:00:00")).otherwise(F.lit("today"))
    meta = F.to_json(F.struct(rating.alias("rating"), at.alias("at")))
    rows = d.select(F.col("source").alias("source_slug"), F.col("doc_id").alias("ext_id"), F.lit(None).cast("string").alias("title"), F.col("text").alias("body"), meta.alias("metadata"), F.lit("2024-01-01").cast("timestamp").alias("fetched_at"))
    return tier0.review_signals(rows, FEEDS, words=PROBE).select("source", "source_id", "score", "created_at_src")


@query(f"select doc_id::varchar as source_id, ({_SCORE})::bigint as score, length(text)::bigint as n_len from documents where length(text) >= 40 and {_SCORE} >= 10 and not ({_KEPT}) order by 2 desc, 1 limit 20")
def tier0_audit_misses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = tier0.audit(documents(spark, sf_dir), kept(spark, sf_dir), 20, 10, words=PROBE, starters=STARTERS)
    return found.select("source_id", F.col("score").cast("long").alias("score"), F.char_length("text").cast("long").alias("n_len"))


@query(f"select doc_id::varchar as source_id from documents where {_KEPT} and doc_id % 2 = 1")
def tier0_idempotent_insert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a second run over everything adds after a first over the even ids."""
    rows = kept(spark, sf_dir)
    first = rows.filter(F.col("source_id").cast("long") % 2 == 0)
    return tier0.insert_new(first, rows).select("source_id")


_RANKED = f"""select doc_id::varchar as source_id, ((greatest({_SCORE}, 0) + 1) * n)::bigint as priority, row_number() over (order by (greatest({_SCORE}, 0) + 1) * n desc, doc_id::varchar) as place
  from documents join (select sha256(text) as h, count(*) as n from documents group by 1) c on sha256(text) = c.h where {_KEPT} and length(text) > 20"""


@query(f"select source_id, priority from ({_RANKED}) where place <= 100")
def rank_top_signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = kept(spark, sf_dir).withColumn("h", F.sha2("text", 256))
    copies = documents(spark, sf_dir).groupBy(F.sha2("text", 256).alias("h")).agg(F.count("*").alias("n"))
    return tier0.top_signals(rows.join(copies, "h").withColumn("dup_count", F.col("n")), 100).select("source_id", F.col("priority").cast("long").alias("priority"))


@query(
    f"""select doc_id, array_to_string(list_filter([case when {_LEX} then 'lexicon:' || array_to_string(list_filter(['and the', 'is and', 'of the'], lambda p: contains(regexp_replace(lower(text), '\\s+', ' ', 'g'), p)), ',') end,
    case when length(text) >= 300 then 'long(' || length(text) || ')' end, case when not {_LEX} and length(text) < 300 then 'NO-PATH' end], lambda x: x is not null), ' | ') as flags from documents"""
)
def diagnose_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents(spark, sf_dir).select("doc_id", F.array_join(T.diagnose(F.col("text"), PROBE, ["no such starter"]), " | ").alias("flags"))


@query("select sha256(text) as text_hash, min(doc_id) as doc_id, count(*) as dup_count from documents group by 1")
def exact_dup_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tier0.fold_exact(read(spark, sf_dir, "documents"), key="doc_id")


@query("select doc_id, nullif(regexp_replace(coalesce(r, ''), '[^0-9].*$', ''), '')::bigint as score from (select doc_id, case doc_id % 4 when 0 then (doc_id % 50) || '.35' when 1 then '-3' when 2 then null else (doc_id % 9)::varchar end as r from documents)")
def rating_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col("doc_id")
    r = F.when(i % 4 == 0, F.concat((i % 50).cast("string"), F.lit(".35"))).when(i % 4 == 1, F.lit("-3")).when(i % 4 == 3, (i % 9).cast("string"))
    return read(spark, sf_dir, "documents").select("doc_id", T.rating_score(r).alias("score"))


@query("select doc_id, case when doc_id % 3 = 0 then timestamp '2024-05-06 07:08:09' else timestamp '2023-01-01' end as at from documents")
def guarded_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = F.when(F.col("doc_id") % 3 == 0, F.lit("2024-05-06 07:08:09")).when(F.col("doc_id") % 3 == 1, F.lit("yesterday"))
    return read(spark, sf_dir, "documents").select("doc_id", T.guarded_time(v, F.lit("2023-01-01").cast("timestamp")).alias("at"))


@query("select doc_id, sha256(coalesce(text, '')) as content_hash from documents")
def content_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "documents").select("doc_id", T.content_hash(F.col("text")).alias("content_hash"))


@query("select event_type, substr(regexp_replace(replace(replace(lower(event_type || '-X y!' || user_id % 3), '-', '_'), ' ', '_'), '[^a-z0-9_]', '', 'g'), 1, 60) as slug, count(*) as n from events group by all")
def topic_slugs(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = F.concat(F.col("event_type"), F.lit("-X y!"), (F.col("user_id") % 3).cast("string"))
    return read(spark, sf_dir, "events").groupBy("event_type", T.topic_slug(raw).alias("slug")).agg(F.count("*").alias("n"))


@query("select source, count(*) as n from (select source from documents where n_chars > 500 union all select role from conversations where length(text) > 50 union all select 'page' from pages) group by 1")
def union_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stages of several sources as one table."""
    a = read(spark, sf_dir, "documents").filter("n_chars > 500").select("source")
    b = read(spark, sf_dir, "conversations").filter("length(text) > 50").select(F.col("role").alias("source"))
    c = read(spark, sf_dir, "pages").select(F.lit("page").alias("source"))
    return queues.union_all([a, b, c]).groupBy("source").agg(F.count("*").alias("n"))


@query()
def full_text_keep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents matched by stems and positions instead of substrings."""
    d = read(spark, sf_dir, "documents")
    return d.select("doc_id", full_text_match(F.col("text"), ["whom thonan", "stations", "heating"]).alias("matched")).filter("matched").select("doc_id")
