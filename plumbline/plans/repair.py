"""Queries of gap repair and of prompt packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.operators import gaps, packing
from plumbline.plans.registry import query, read

MOST, BUDGET = 7200, 14_000
THEMES = ["slow exports", "billing surprises", "slow exports", "missing integrations"]
_LONG = "1704067200"
_HEAD = packing.header(THEMES)
_SQL_HEAD = _HEAD.replace("\n", "' || chr(10) || '")


@query(
    f"""with t as (select event_type as shard, floor(epoch(ts))::bigint as t from events), asked as (select distinct event_type as shard from events union select 'never seen'),
    r as (select shard, {_LONG} + 86400 as lo, {_LONG} + 86400 * 12 as hi from asked union all select shard, {_LONG} + 86400 * 20, {_LONG} + 86400 * 21 from asked),
    p as (select r.shard, lo, hi, t from r left join t on t.shard = r.shard and t > lo and t < hi union all select shard, lo, hi, lo from r union all select shard, lo, hi, hi from r),
    g as (select shard, t as after, lead(t) over (partition by shard, lo order by t) as before from p where t is not null)
    select shard, after, before from g where before - after > {MOST}"""
)
def gap_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is to be read again of three requested ranges, two of which overlap, for each type of event and one that has none."""
    e = read(spark, sf_dir, "events").select("event_type", F.unix_timestamp(F.col("ts").cast("timestamp")).alias("t"))
    shards = e.select(F.col("event_type").alias("shard")).distinct().union(spark.createDataFrame([("never seen",)], "shard string"))
    days = F.explode(F.array(*(F.struct(F.lit(int(_LONG) + 86400 * a).alias("after"), F.lit(int(_LONG) + 86400 * b).alias("before")) for a, b in ((1, 8), (5, 12), (20, 21)))))
    return gaps.to_read(e, shards.select("shard", days.alias("d")).select("shard", "d.*"), "event_type", "t", MOST)


@query(
    f"""with i as (select doc_id, n_chars, '[' || doc_id || '] ' || substr(coalesce(text, ''), 1, 500) as item from documents),
    s as (select *, length(item) + 1 as size, sum(length(item) + 1) over (order by n_chars desc, doc_id) as total from i),
    p as (select *, (total - 1) // ({BUDGET} - {len(_HEAD)} - (select max(size) from s)) as prompt from s)
    select prompt::bigint as prompt, count(*) as n_items, sum(size)::bigint + {len(_HEAD)} as n_chars, sha256('{_SQL_HEAD}' || string_agg(item || chr(10), '' order by n_chars desc, doc_id)) as text_sha256 from p group by prompt"""
)
def packed_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as items in order of size, in prompts of 14,000 characters at most with the themes carried over."""
    d = read(spark, sf_dir, "documents").select("doc_id", F.col("n_chars").cast("long").alias("n_chars"), F.substring(F.coalesce("text", F.lit("")), 1, 500).alias("text"))
    order = [F.col("n_chars").desc(), F.col("doc_id")]
    rows = packing.packed(d, F.concat(F.lit("["), F.col("doc_id").cast("string"), F.lit("] "), "text"), order, BUDGET, THEMES, ranges=5)
    made = packing.prompts(rows, [-F.col("n_chars"), F.col("doc_id")], THEMES)
    return made.select("prompt", "n_items", F.char_length("text").cast("long").alias("n_chars"), F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256"))
