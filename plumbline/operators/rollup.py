"""Roll-ups of clusters, topics and time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions.text import rollup_topic


def cluster_stats(members: DataFrame) -> DataFrame:
    """Per cluster: members, summed copies, sources, and the member of the greatest weight (ties: smallest id).

    Input: cluster_id, id, source, dup_count, score.
    """
    weight = F.col("dup_count") * F.greatest(F.coalesce(F.col("score"), F.lit(0)), F.lit(1))
    return members.filter("cluster_id is not null").groupBy("cluster_id").agg(
        F.count("*").alias("member_count"),
        F.sum("dup_count").alias("total_dup_weight"),
        F.count_distinct("source").alias("source_spread"),
        F.array_sort(F.collect_set("source")).alias("sources"),
        F.max_by("id", F.struct(weight.alias("w"), (-F.col("id")).alias("i"))).alias("medoid_signal_id"),
    )


def centroids(members: DataFrame, dims: int) -> DataFrame:
    """Mean vector of each cluster, one partial sum per dimension on the map side."""
    means = F.array(*(F.avg(F.get(F.col("embedding"), F.lit(i)).cast("double")) for i in range(dims)))
    return members.filter("cluster_id is not null").groupBy("cluster_id").agg(means.alias("centroid"))


def quarter_counts(members: DataFrame, since: str | None = "2020-01-01") -> DataFrame:
    """Rows per cluster and quarter; quarters without rows are not filled in."""
    dated = members.filter(F.col("created_at_src").isNotNull())
    if since:
        dated = dated.filter(F.col("created_at_src") >= F.lit(since).cast("timestamp"))
    return dated.groupBy("cluster_id", F.date_trunc("quarter", "created_at_src").alias("q")).agg(F.count("*").alias("c"))


def quarter_trend(members: DataFrame, since: str | None = "2020-01-01") -> DataFrame:
    """Slope of the quarterly counts over time in units of 90 days; null with a single quarter."""
    x = F.unix_timestamp("q") / F.lit(90 * 86400.0)
    return quarter_counts(members, since).groupBy("cluster_id").agg(F.regr_slope(F.col("c").cast("double"), x).alias("trend_acceleration"))


def yoy_ratio(members: DataFrame, as_of: str) -> DataFrame:
    """Rows of the last 12 months over those of the 12 before; null where there were none."""
    end = F.lit(as_of).cast("timestamp")
    at = F.col("created_at_src")
    year, two = end - F.expr("interval 12 months"), end - F.expr("interval 24 months")
    late = F.sum(F.when(at >= year, 1).otherwise(0))
    early = F.sum(F.when((at < year) & (at >= two), 1).otherwise(0))
    return members.filter(at.isNotNull()).groupBy("cluster_id").agg((late / F.nullif(early, F.lit(0))).alias("yoy_ratio"))


def materialise(members: DataFrame, as_of: str, dims: int | None = None, since: str | None = "2020-01-01") -> DataFrame:
    """All figures of the live members' clusters, under the label cluster_<id>."""
    live = members.filter("cluster_id is not null and not coalesce(is_duplicate, false)")
    out = cluster_stats(live).join(quarter_trend(live, since), "cluster_id", "left").join(yoy_ratio(live, as_of), "cluster_id", "left")
    if dims:
        out = out.join(centroids(live, dims), "cluster_id", "left")
    return out.withColumn("label", F.concat(F.lit("cluster_"), F.col("cluster_id").cast("string")))


def topic_rollup(signals: DataFrame, n: int = 30) -> DataFrame:
    """The n most frequent topics with their mean severity and sentiment."""
    named = signals.filter(F.coalesce(F.col("topic"), F.lit("")) != "").withColumn("ntopic", rollup_topic(F.col("topic")))
    found = named.groupBy("ntopic").agg(F.count("*").alias("c"), F.round(F.avg("severity"), 1).alias("wtp"), F.round(F.avg("sentiment"), 2).alias("sent"))
    return found.orderBy(F.col("c").desc(), F.col("wtp").desc_nulls_first(), "ntopic").limit(n)


def insights(topics: DataFrame) -> DataFrame:
    """Title, sentence and confidence of each topic of the roll-up."""
    sentence = F.concat(F.col("c").cast("string"), F.lit(" signals on '"), F.col("ntopic"), F.lit("'; avg willingness-to-pay tier "), F.col("wtp").cast("string"), F.lit("/5; sentiment "), F.col("sent").cast("string"), F.lit("."))
    return topics.select(F.concat(F.lit("Opportunity: "), F.col("ntopic")).alias("title"), F.col("ntopic").alias("topic"), F.col("c").alias("signal_count"), F.coalesce("wtp", F.lit(0.0)).alias("avg_wtp_tier"), F.coalesce("sent", F.lit(0.0)).alias("avg_sentiment"), sentence.alias("qual_summary"), F.least(F.lit(0.95), F.col("c") / 30.0).alias("confidence"))


def pain_points(signals: DataFrame, kinds: Sequence[str] = ("pain_point", "complaint", "feature_request")) -> DataFrame:
    """Mentions and means per topic, for the kinds of signal that name a pain."""
    return signals.filter(F.col("type").isin(*kinds)).groupBy("topic").agg(F.count("*").alias("mentions"), F.round(F.avg("sentiment"), 2).alias("avg_sentiment"), F.round(F.avg("severity"), 2).alias("avg_severity"))


def resume_offsets(rows: DataFrame, by: str, at: Column, floor: str | None = None) -> DataFrame:
    """The latest time per feed, from which the next run goes on; never before ``floor``."""
    latest = F.max(at)
    return rows.groupBy(by).agg((F.greatest(latest, F.lit(floor).cast("timestamp")) if floor else latest).alias("resume_at"))


def token_cost(calls: DataFrame, price_in: float, price_out: float) -> DataFrame:
    """Tokens and their price over all calls. Prices are per million tokens."""
    cost = (F.sum("tok_in") * price_in + F.sum("tok_out") * price_out) / 1_000_000
    return calls.agg(F.count("*").alias("calls"), F.sum("tok_in").alias("tok_in"), F.sum("tok_out").alias("tok_out"), cost.alias("cost"))


def names(rows: DataFrame, by: Sequence[str], name: str) -> DataFrame:
    """(by, names, n): the names of a group in order, as one text."""
    return rows.groupBy(*by).agg(F.array_join(F.array_sort(F.collect_list(name)), ", ").alias("names"), F.count("*").alias("n"))


def inventory(services: DataFrame, containers: DataFrame, hosts: DataFrame) -> DataFrame:
    """(service, container, host): services on the containers of hosts."""
    return services.join(containers, "container_id").join(hosts, "host_id").select("service", "container", "host")


def scope_counts(rows: DataFrame, by: Sequence[str], **flags: Column) -> DataFrame:
    """Rows of each scope, and how many of them have each flag."""
    return rows.groupBy(*by).agg(F.count("*").alias("n"), *(F.count_if(F.coalesce(c, F.lit(False))).alias(k) for k, c in flags.items()))
