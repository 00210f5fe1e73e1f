"""Queries of the roll-ups."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.operators import rollup
from plumbline.plans.registry import query, read

AS_OF = "2001-01-01"
_MEMBERS = "(select label as cluster_id, vec_id as id, 's' || (vec_id % 3) as source, 1 + vec_id % 4 as dup_count, vec_id % 11 as score, embedding from embeddings)"
_DATED = "(select o_orderpriority as cluster_id, o_orderdate as created_at_src from orders)"
_SIGNALS = """(select event_type as type, case user_id % 6 when 0 then 'Slow Sync' when 1 then 'slow-sync' when 2 then 'slow sync' when 3 then '' else 'topic ' || (user_id % 40) end as topic,
 (event_id % 6)::int as severity, (event_id % 9)::double / 4 as sentiment from events)"""


def members(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col("vec_id")
    return read(spark, sf_dir, "embeddings").select(F.col("label").alias("cluster_id"), i.alias("id"), F.concat(F.lit("s"), (i % 3).cast("string")).alias("source"), (i % 4 + 1).alias("dup_count"), (i % 11).alias("score"), "embedding")


def dated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("cluster_id"), F.col("o_orderdate").cast("timestamp").alias("created_at_src"))


def signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    u, e = F.col("user_id") % 6, F.col("event_id")
    topic = F.when(u == 0, "Slow Sync").when(u == 1, "slow-sync").when(u == 2, "slow sync").when(u == 3, "").otherwise(F.concat(F.lit("topic "), (F.col("user_id") % 40).cast("string")))
    return read(spark, sf_dir, "events").select(F.col("event_type").alias("type"), topic.alias("topic"), (e % 6).cast("int").alias("severity"), ((e % 9).cast("double") / 4).alias("sentiment"))


@query(f"select cluster_id, count(*) as member_count, sum(dup_count)::bigint as total_dup_weight, count(distinct source) as source_spread, array_to_string(list_sort(list(distinct source)), ',') as sources, first(id order by dup_count * greatest(score, 1) desc, id) as medoid_signal_id from {_MEMBERS} group by 1")
def cluster_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollup.cluster_stats(members(spark, sf_dir)).withColumn("sources", F.array_join("sources", ","))


@query(f"select cluster_id, i - 1 as dim, round(avg(embedding[i]::double), 6) as mean from {_MEMBERS}, range(1, 65) t(i) group by all")
def cluster_centroid(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = rollup.centroids(members(spark, sf_dir), 64)
    return c.select("cluster_id", F.posexplode("centroid").alias("d", "m")).select("cluster_id", F.col("d").cast("bigint").alias("dim"), F.round("m", 6).alias("mean"))


_TREND = f"select cluster_id, regr_slope(c, epoch(q) / (90 * 86400.0)) as s from (select cluster_id, date_trunc('quarter', created_at_src) as q, count(*)::double as c from {_DATED} group by all) group by 1"
_YOY = f"""select cluster_id, sum(case when created_at_src >= timestamp '{AS_OF}' - interval 12 months then 1 else 0 end)
 / nullif(sum(case when created_at_src < timestamp '{AS_OF}' - interval 12 months and created_at_src >= timestamp '{AS_OF}' - interval 24 months then 1 else 0 end), 0) as y from {_DATED} group by 1"""


@query(f"select cluster_id, round(case when isnan(s) then null else s end, 6) as trend_acceleration from ({_TREND})")
def quarter_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollup.quarter_trend(dated(spark, sf_dir), None).withColumn("trend_acceleration", F.round("trend_acceleration", 6))


@query(f"select cluster_id, round(y, 6) as yoy_ratio from ({_YOY})")
def yoy_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollup.yoy_ratio(dated(spark, sf_dir), AS_OF).withColumn("yoy_ratio", F.round("yoy_ratio", 6))


@query(
    f"""select cluster_id, 'cluster_' || cluster_id as label, count(*) as member_count, sum(dup)::bigint as total_dup_weight, count(distinct src) as source_spread,
    first(id order by dup * greatest(score, 1) desc, id) as medoid_signal_id, any_value(round(case when isnan(s) then null else s end, 6)) as trend_acceleration, any_value(round(y, 6)) as yoy_ratio
    from (select o_orderpriority as cluster_id, o_orderkey as id, o_orderstatus as src, 1 + o_orderkey % 4 as dup, o_orderkey % 11 as score from orders) m
    left join ({_TREND}) using (cluster_id) left join ({_YOY}) using (cluster_id) group by 1"""
)
def materialise_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    o, k = read(spark, sf_dir, "orders"), F.col("o_orderkey")
    m = o.select(F.col("o_orderpriority").alias("cluster_id"), k.alias("id"), F.col("o_orderstatus").alias("source"), (k % 4 + 1).alias("dup_count"), (k % 11).alias("score"), F.col("o_orderdate").cast("timestamp").alias("created_at_src"), F.lit(False).alias("is_duplicate"))
    got = rollup.materialise(m, AS_OF, since=None)
    return got.select("cluster_id", "label", "member_count", "total_dup_weight", "source_spread", "medoid_signal_id", F.round("trend_acceleration", 6).alias("trend_acceleration"), F.round("yoy_ratio", 6).alias("yoy_ratio"))


_TOPICS = f"select lower(regexp_replace(topic, '[^a-zA-Z0-9]+', '_', 'g')) as ntopic, count(*) as c, round(avg(severity), 1) as wtp, round(avg(sentiment), 2) as sent from {_SIGNALS} where coalesce(topic, '') <> '' group by 1 order by c desc, wtp desc, ntopic limit 30"


@query(_TOPICS)
def topic_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollup.topic_rollup(signals(spark, sf_dir))


@query(f"select 'Opportunity: ' || ntopic as title, ntopic as topic, c as signal_count, wtp as avg_wtp_tier, sent as avg_sentiment, least(0.95, c / 30.0)::double as confidence from ({_TOPICS})")
def insight_confidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The insights table, rebuilt as a whole."""
    return rollup.insights(rollup.topic_rollup(signals(spark, sf_dir))).drop("qual_summary")


@query(f"select topic, count(*) as mentions, round(avg(sentiment), 2) as avg_sentiment, round(avg(severity), 2) as avg_severity from {_SIGNALS} where type in ('click', 'view', 'purchase') group by 1")
def pain_points_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollup.pain_points(signals(spark, sf_dir), ("click", "view", "purchase"))


@query("select n_regionkey, string_agg(n_name, ', ' order by n_name) as names, count(*) as n from nation group by 1")
def name_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollup.names(read(spark, sf_dir, "nation"), ["n_regionkey"], "n_name")


@query("select s_name as service, n_name as container, r_name as host from supplier join nation on s_nationkey = n_nationkey join region on n_regionkey = r_regionkey")
def service_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The inventory view: services on containers on hosts."""
    services = read(spark, sf_dir, "supplier").select(F.col("s_name").alias("service"), F.col("s_nationkey").alias("container_id"))
    containers = read(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("container_id"), F.col("n_name").alias("container"), F.col("n_regionkey").alias("host_id"))
    hosts = read(spark, sf_dir, "region").select(F.col("r_regionkey").alias("host_id"), F.col("r_name").alias("host"))
    return rollup.inventory(services, containers, hosts)


@query("select count(*) as calls, sum(user_id)::bigint as tok_in, sum(event_id)::bigint as tok_out, round((sum(user_id) * 0.2288 + sum(event_id) * 0.3432) / 1000000, 6) as cost from events")
def token_cost(spark: SparkSession, sf_dir: str) -> DataFrame:
    calls = read(spark, sf_dir, "events").select(F.col("user_id").alias("tok_in"), F.col("event_id").alias("tok_out"))
    return rollup.token_cost(calls, 0.2288, 0.3432).withColumn("cost", F.round("cost", 6))


@query("select event_type, count(*) as n, sum(case when value > 50 then 1 else 0 end)::bigint as high from events group by 1")
def scope_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollup.scope_counts(read(spark, sf_dir, "events"), ["event_type"], high=F.col("value") > 50)


@query("select n.n_name as subreddit, r.r_name as keyword, 'New' as sort_by, 10 as num_of_posts from nation n cross join region r")
def cartesian_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Job inputs: every feed with every keyword of a job's two short lists."""
    from plumbline.sources.snapshots import expand_inputs

    n = read(spark, sf_dir, "nation").select(F.col("n_name").alias("subreddit"))
    return expand_inputs(n, read(spark, sf_dir, "region").select(F.col("r_name").alias("keyword")))


@query("select time_bucket(interval '1 day', ts) as day, event_type, count(*) as n from events group by all")
def daily_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Extra, beyond the funnel: event-time windows."""
    e = read(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    return e.groupBy(F.window("ts", "1 day").alias("w"), "event_type").agg(F.count("*").alias("n")).select(F.col("w.start").alias("day"), "event_type", "n")
