"""Queries of ordered limits, queues, marks, appends, snapshot jobs, the search index and embeddings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.functions import fts
from plumbline.functions.text import priority
from plumbline.operators import queues, statements, tier0
from plumbline.operators.upsert import NEW, upsert
from plumbline.plans.registry import query, read
from plumbline.sources import embedder


@query("select event_id, event_type, value from events order by ts desc, event_id limit 50")
def newest_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return queues.newest(read(spark, sf_dir, "events"), "ts", 50, ["event_id"]).select("event_id", "event_type", "value")


@query("select event_id, case when event_id % 3 <> 0 then floor(epoch(ts))::bigint end as published from events order by published desc nulls last, event_id limit 50")
def newest_nulls_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows without a time come after all others."""
    e = read(spark, sf_dir, "events").select("event_id", F.when(F.col("event_id") % 3 != 0, F.unix_timestamp("ts")).alias("published"))
    return queues.newest(e, "published", 50, ["event_id"])


@query("select o_orderkey, o_custkey from orders where o_orderkey > 100 order by o_orderkey limit 200")
def keyset_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    return queues.page_after(read(spark, sf_dir, "orders"), "o_orderkey", 100, 200).select("o_orderkey", "o_custkey")


@query("select doc_id from (select * from documents order by doc_id limit 300) where length(text) between 80 and 4000 and lang = 'en'")
def scan_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A limit on what is scanned, before the predicates, in order."""
    d = queues.scanned(read(spark, sf_dir, "documents"), 300, ["doc_id"])
    return d.filter(F.char_length("text").between(80, 4000) & (F.col("lang") == "en")).select("doc_id")


@query("select o_orderkey from orders where o_orderkey not in (select l_orderkey from lineitem where l_linenumber >= 2) order by o_orderdate, o_orderkey limit 1")
def queue_claim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The oldest job that nobody has."""
    held = read(spark, sf_dir, "lineitem").filter("l_linenumber >= 2").select(F.col("l_orderkey").alias("o_orderkey"))
    return queues.claim(read(spark, sf_dir, "orders"), held, "o_orderkey", "o_orderdate").select("o_orderkey")


@query("select source, ('0x' || substr(md5(source), 1, 8))::bigint % 3 as shard, count(*) as n from documents where source is not null group by all")
def source_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources dealt to three shards; each shard reads its own."""
    d = read(spark, sf_dir, "documents").filter("source is not null").groupBy("source").agg(F.count("*").alias("n"))
    return d.select("source", queues.shard(F.col("source"), 3).cast("bigint").alias("shard"), "n")


@query("select doc_id, case when quality = 1 then 1 when length(text) > 40 then 2 end as run from documents left join (select doc_id, max(quality) as quality from labels group by 1) using (doc_id) where quality = 1 or length(text) > 40")
def mark_written(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table of processed keys after a second run over what the first one left; keys keep their first mark."""
    d = read(spark, sf_dir, "documents").select("doc_id", F.char_length("text").alias("n"))
    first = read(spark, sf_dir, "labels").filter("quality = 1").select("doc_id").distinct().join(d.select("doc_id"), "doc_id").withColumn("processed_at", F.lit(1))
    todo = queues.unprocessed(d.filter("n > 40"), first, "doc_id")
    return queues.mark(first, todo, "doc_id", F.lit(2)).withColumnRenamed("processed_at", "run")


@query("select c_custkey, c_mktsegment, rank from (select c_custkey, c_mktsegment, row_number() over (order by c_acctbal desc, c_custkey) as rank from customer) where rank <= 30")
def rebuilt_insights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Truncate and rebuild: the table is the top 30 of this run, whatever it held before."""
    c = queues.in_batches(read(spark, sf_dir, "customer"), [F.col("c_acctbal").desc(), F.col("c_custkey")], 1, 30)
    return c.select("c_custkey", "c_mktsegment", (F.col("batch") + 1).cast("bigint").alias("rank"))


@query("select event_type, count(*) as n from (select * from events where event_id % 2 = 0 union all select * from events where event_id % 2 = 0) group by 1")
def plain_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The older stage's append: a rerun adds its rows again."""
    e = read(spark, sf_dir, "events").filter("event_id % 2 = 0").select("event_id", "event_type")
    return queues.append_once(e, e, []).groupBy("event_type").agg(F.count("*").alias("n"))


@query("select event_type, count(*) as n from events group by 1")
def chunk_append_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunks appended by their key: a rerun, and the overlap of two runs, add nothing."""
    e = read(spark, sf_dir, "events").select("event_id", "event_type")
    half = e.filter("event_id % 2 = 0")
    return queues.append_once(half, e, ["event_id"]).groupBy("event_type").agg(F.count("*").alias("n"))


@query("select sha256('Statement ' || p_type) as statement_key, 'Statement ' || p_type as statement, count(*) as n_replies from part group by 2")
def statement_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statements by the hash of their text: reruns of a reply give the same id, where a null key never conflicts."""
    reply = F.concat(F.lit('{"statements":[{"statement":"Statement '), F.col("p_type"), F.lit('"}]}'))
    got = statements.statements(read(spark, sf_dir, "part").select("p_partkey", reply.alias("reply")))
    return got.groupBy("statement_key", "statement").agg(F.count("*").alias("n_replies"))


@query("select s_suppkey as ext_id, s_name as name, 'old' as website, case when s_suppkey % 2 = 0 then s_acctbal else 0 end as rating from supplier")
def product_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products by (source, ext_id): figures follow the run, the website stays as first written."""
    s = read(spark, sf_dir, "supplier").select(F.lit("x").alias("source"), F.col("s_suppkey").alias("ext_id"), F.col("s_name").alias("name"), "s_acctbal")
    old = s.select("source", "ext_id", F.lit("before").alias("name"), F.lit("old").alias("website"), F.lit(0.0).alias("rating"))
    new = s.select("source", "ext_id", "name", F.lit("new").alias("website"), F.when(F.col("ext_id") % 2 == 0, F.col("s_acctbal")).otherwise(0.0).alias("rating"))
    return upsert(old, new, ["source", "ext_id"], {"name": NEW, "rating": NEW}).select("ext_id", "name", "website", "rating")


@query("select o_orderkey, (row_number() over (order by o_totalprice desc, o_orderkey) - 1) // 200 as batch from orders qualify row_number() over (order by o_totalprice desc, o_orderkey) <= 1000")
def priority_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The most important signals in batches of 200, in order of priority."""
    o = queues.in_batches(read(spark, sf_dir, "orders"), [F.col("o_totalprice").desc(), F.col("o_orderkey")], 200, 1000)
    return o.select("o_orderkey", F.col("batch").cast("bigint").alias("batch"))


@query("select c_custkey as id, (greatest(coalesce(floor(c_acctbal)::bigint, 0), 0) + 1) * (c_custkey % 3 + 1) as priority from customer where c_custkey % 4 <> 0 and c_custkey % 5 < 3 order by priority desc, id limit 100")
def embed_backlog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The next page to embed: without a vector, not failed too often, most important first."""
    k = F.col("c_custkey")
    c = read(spark, sf_dir, "customer").select(k.alias("id"), F.floor("c_acctbal").cast("bigint").alias("score"), (k % 3 + 1).alias("dup_count"), F.when(k % 4 == 0, F.array(F.lit(1.0))).alias("embedding"), (k % 5).alias("attempts"))
    return embedder.priority_page(c, 100).select("id", priority(F.col("score"), F.col("dup_count")).alias("priority"))


@query("select p_partkey as id, (p_partkey * 7) % 100 as pre_score from part order by pre_score desc, id limit 50")
def validation_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The statements to validate next: the highest score first, none as zero."""
    p = read(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), (F.col("p_partkey") * 7 % 100).alias("pre_score"))
    return p.orderBy(F.coalesce("pre_score", F.lit(0)).desc(), "id").limit(50)


@query("select c_custkey as id, dense_rank() over (order by round(c_acctbal) desc) as rank from customer where c_acctbal > 0")
def opportunity_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ranks by final score. The scores are counted first, so that only their distinct values are put in order."""
    c = read(spark, sf_dir, "customer").filter("c_acctbal > 0").select(F.col("c_custkey").alias("id"), F.round("c_acctbal").cast("bigint").alias("score"))
    from pyspark.sql import Window

    ranks = c.select("score").distinct().withColumn("rank", F.row_number().over(Window.orderBy(F.col("score").desc())).cast("bigint"))
    return c.join(ranks, "score").select("id", "rank")


@query("select case when o_custkey % 4 = 0 then 'ready' when o_custkey % 4 = 1 then 'retry' else 'pending' end as state, count(*) as n from (select distinct o_custkey from orders) group by 1")
def snapshot_polling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a poll makes of the pending jobs: ready, to be asked again, or still waiting."""
    jobs = read(spark, sf_dir, "orders").select(F.col("o_custkey").alias("snapshot_id")).distinct()
    k = F.col("snapshot_id")
    results = jobs.filter(k % 4 < 3).select(k, F.when(k % 4 == 2, "running").otherwise("ready").alias("status"), F.lit(3).alias("n_records"), F.when(k % 4 == 0, "[1,2,3]").otherwise("[]").alias("payload"))
    return queues.snapshot_states(jobs, results).groupBy("state").agg(F.count("*").alias("n"))


@query("select distinct o_custkey as snapshot_id from orders where o_custkey % 4 <> 0")
def snapshot_survivors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The queue after a poll: every job that isn't ready."""
    jobs = read(spark, sf_dir, "orders").select(F.col("o_custkey").alias("snapshot_id")).distinct()
    k = F.col("snapshot_id")
    results = jobs.filter(k % 4 < 2).select(k, F.lit("ready").alias("status"), (k % 4).alias("n_records"), F.when(k % 4 == 0, "[1]").otherwise("[]").alias("payload"))
    return queues.survivors(queues.snapshot_states(jobs, results), ["snapshot_id"])


@query(
    """with e as (select l_orderkey as parent, l_linenumber as pos, case when l_linenumber % 3 = 0 then 'list' else 'video' end as kind, case when l_linenumber % 3 = 0 then l_orderkey + 1 else l_partkey end as id from lineitem),
    d as (select parent as seed, pos as p, 0 as q, id from e where kind = 'video' union all select a.parent, a.pos, b.pos, b.id from e a join e b on a.kind = 'list' and b.kind = 'video' and b.parent = a.id),
    f as (select seed, id, min((p, q)) as o from d where seed % 10 = 0 group by all)
    select seed, id as video, place as "at" from (select seed, id, row_number() over (partition by seed order by o, id) as place from f) where place <= 4"""
)
def channel_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Videos of channels, and of the lists in them, one level deep; the first four of each."""
    n = F.col("l_linenumber")
    entries = read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("parent"), n.alias("pos"), F.when(n % 3 == 0, "list").otherwise("video").alias("kind"), F.when(n % 3 == 0, F.col("l_orderkey") + 1).otherwise(F.col("l_partkey")).alias("id"))
    seeds = entries.filter("parent % 10 = 0").select(F.col("parent").alias("seed")).distinct()
    return queues.listing(entries, seeds, 4).withColumn("at", F.col("at").cast("bigint"))


@query("select conv_id * 100 + turn as id from conversations c where turn > 0 and conv_id % 3 <> 0 and length(text) between 80 and 4000 and (contains(lower(text), 'and the') or contains(lower(text), 'of the') or contains(lower(text), 'is and'))")
def comments_of_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Comments whose post is known, by the lexicon alone."""
    c = read(spark, sf_dir, "conversations")
    posts = c.filter("turn = 0 and conv_id % 3 <> 0").select(F.col("conv_id").alias("reddit_id"), F.lit("x").alias("subreddit"))
    rows = c.filter("turn > 0").select((F.col("conv_id") * 100 + F.col("turn")).alias("reddit_id"), F.col("conv_id").alias("post_id"), F.col("text").alias("body"), F.lit(1).alias("score"), F.lit(None).cast("timestamp").alias("created_utc"))
    got = tier0.comment_signals(rows, posts, words=["and the", "of the", "is and"], starters=[], long_min=10**6)
    return got.select(F.col("source_id").cast("bigint").alias("id"))


@query("select conv_id as id, length(t) as n from (select conv_id, string_agg(text, ' ' order by turn) as t from conversations group by 1) where length(t) between 80 and 20000 and (contains(lower(t), 'and the') or contains(lower(t), 'of the') or contains(lower(t), 'is and'))")
def transcripts_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transcripts under their longer upper bound."""
    c = read(spark, sf_dir, "conversations").groupBy(F.col("conv_id").alias("video_id")).agg(F.array_sort(F.collect_list(F.struct("turn", "text"))).alias("transcript"))
    videos = c.withColumn("view_count", F.lit(0)).withColumn("published_at", F.lit(None).cast("timestamp"))
    got = tier0.transcript_signals(videos, words=["and the", "of the", "is and"], starters=[], long_min=10**6)
    return got.select(F.col("source_id").cast("bigint").alias("id"), F.char_length("text").cast("bigint").alias("n"))


@query("select w as lexeme, o_orderkey, list(i order by i)::varchar as positions from (select o_orderkey, unnest([o_orderkey::varchar, o_custkey::varchar, o_orderkey::varchar]) as w, unnest([1, 3, 4]) as i from orders) group by all")
def number_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The keyword index of numbers, which no stemming changes; a stop word counts in the positions alone."""
    o = read(spark, sf_dir, "orders").select("o_orderkey", F.concat_ws(" ", "o_orderkey", F.lit("the"), "o_custkey", "o_orderkey").alias("text"))
    index = fts.inverted_index(o, "o_orderkey", "text")
    return index.select("lexeme", "o_orderkey", F.concat(F.lit("["), F.array_join("positions", ", "), F.lit("]")).alias("positions"))


@query()
def keyword_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The inverted index of all documents, by stem."""
    return fts.inverted_index(read(spark, sf_dir, "documents"), "doc_id", "text").select("lexeme", "doc_id", F.size("positions").alias("n"))
