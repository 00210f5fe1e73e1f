"""Queries of the write policies. Batch 1 has the even events, batch 2 the odd ones."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.operators import queues, threads
from plumbline.operators.rollup import resume_offsets as offsets
from plumbline.operators.upsert import MERGE, NEW, OLD, RICHER, SnapshotTable, insert_ignore, last_wins, replace_stale, upsert
from plumbline.plans.registry import query, read
from plumbline.session import scratch

KEY = ["event_type", "user_id"]
_BATCHES = """with e as (select event_type, user_id, event_id, ts, value, props from events),
b1 as (select distinct on (event_type, user_id) * from e where event_id % 2 = 0 order by event_type, user_id, event_id desc),
b2 as (select distinct on (event_type, user_id) * from e where event_id % 2 = 1 order by event_type, user_id, event_id desc),
m as (select coalesce(b1.event_type, b2.event_type) as event_type, coalesce(b1.user_id, b2.user_id) as user_id, b1.event_id as i1, b2.event_id as i2,
  b1.ts as t1, b2.ts as t2, b1.value as v1, b2.value as v2, b1.props as p1, b2.props as p2 from b1 full join b2 using (event_type, user_id)) """


def batch(spark: SparkSession, sf_dir: str, odd: int) -> DataFrame:
    e = read(spark, sf_dir, "events").filter(F.col("event_id") % 2 == odd)
    return last_wins(e.select(*KEY, "event_id", "ts", "value", "props"), KEY, ["event_id"])


@query("select event_type, user_id, max(event_id) as event_id, arg_max(value, event_id) as value from events group by all")
def inbatch_last_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read(spark, sf_dir, "events")
    return last_wins(e.select(*KEY, "event_id", "value"), KEY, ["event_id"])


@query(_BATCHES + "select event_type, user_id, i2 as event_id from m where i1 is null")
def insert_ignored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return insert_ignore(batch(spark, sf_dir, 0), batch(spark, sf_dir, 1), KEY).select(*KEY, "event_id")


@query(_BATCHES + "select event_type, user_id, coalesce(i1, i2) as event_id, coalesce(t1, t2) as ts, coalesce(v2, v1) as value, coalesce(p2, p1) as props from m")
def upsert_update_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Value and properties are replaced; id and time stay those of the first insert."""
    return upsert(batch(spark, sf_dir, 0), batch(spark, sf_dir, 1), KEY, {"value": NEW, "props": NEW}, OLD)


@query(_BATCHES + "select event_type, user_id, coalesce(v2, v1) as value, coalesce(p1, p2) as props from m")
def upsert_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return upsert(batch(spark, sf_dir, 0), batch(spark, sf_dir, 1), KEY, {"value": NEW}, OLD).select(*KEY, "value", "props")


@query(
    _BATCHES
    + """select event_type, user_id, coalesce(case when v2 > 50 then v2 end, v1) as value,
    coalesce(json_extract_string(p2, '$.k')::bigint, json_extract_string(p1, '$.k')::bigint) as k, case when i1 is null then null else i1 end as first_id, i2 as last_id from m"""
)
def upsert_keep_richer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A null in the batch doesn't erase; metadata objects are merged key by key."""
    a = batch(spark, sf_dir, 0).withColumn("props", F.concat(F.lit('{"a":'), F.col("event_id").cast("string"), F.lit(","), F.substring("props", 2, 1000)))
    b = batch(spark, sf_dir, 1).withColumn("value", F.when(F.col("value") > 50, F.col("value"))).withColumn("props", F.concat(F.lit('{"b":'), F.col("event_id").cast("string"), F.lit(","), F.substring("props", 2, 1000)))
    got = upsert(a, b, KEY, {"value": RICHER, "props": MERGE}, OLD)
    field = lambda k: F.get_json_object("props", f"$.{k}").cast("bigint")
    return got.select(*KEY, "value", field("k").alias("k"), field("a").alias("first_id"), field("b").alias("last_id"))


@query(_BATCHES + "select event_type, user_id, coalesce(v2, v1) as value, p1 as transcript from m")
def upsert_owner_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch without the owner's column leaves it alone."""
    a = batch(spark, sf_dir, 0).withColumnRenamed("props", "transcript")
    return upsert(a, batch(spark, sf_dir, 1).drop("props"), KEY, {"value": NEW}, OLD).select(*KEY, "value", "transcript")


@query(
    """with c as (select conv_id * 100 + turn as comment_id, conv_id * 100 + turn - 1 as parent, turn, text from conversations where turn > 0),
    o as (select comment_id, case when turn % 2 = 1 then parent end as parent_id, 'old' as text from c where turn % 3 <> 2), b as (select comment_id, case when turn % 2 = 0 then parent end as parent_id, text from c where turn % 3 <> 1)
    select comment_id, coalesce(b.parent_id, o.parent_id) as parent_id, coalesce(b.text, o.text) as text from o full join b using (comment_id)"""
)
def upsert_coalesce_parent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch that overlaps the table: its texts win, and parents that it doesn't know stay."""
    c = comments(spark, sf_dir).select("comment_id", F.col("parent").alias("parent_id"), "text", "turn")
    known = lambda odd: F.when(F.col("turn") % 2 == odd, F.col("parent_id")).alias("parent_id")
    old = c.filter("turn % 3 <> 2").select("comment_id", known(1), F.lit("old").alias("text"))
    new = c.filter("turn % 3 <> 1").select("comment_id", known(0), "text")
    return upsert(old, new, ["comment_id"], {"text": NEW, "parent_id": RICHER})


@query(_BATCHES + "select event_type, user_id, coalesce(i2, i1) as event_id, coalesce(t2, t1) as ts, coalesce(v2, v1) as value, coalesce(p2, p1) as props from m")
def insight_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every column is replaced."""
    return upsert(batch(spark, sf_dir, 0), batch(spark, sf_dir, 1), KEY, {}, NEW)


@query(
    """select report_type, asin, snapshot_date::varchar as snapshot_date, arg_max(revenue, seq) as revenue, arg_min(title, seq) as title from (
    select 'r' || (o_orderkey % 3) as report_type, 'B' || (o_custkey % 500) as asin, o_orderdate::date as snapshot_date, o_totalprice as revenue, o_orderpriority as title, o_orderkey as seq from orders) group by all"""
)
def report_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reports on (type, item, day): the first title stays, figures follow the last."""
    o = read(spark, sf_dir, "orders")
    r = o.select(F.concat(F.lit("r"), F.col("o_orderkey") % 3).alias("report_type"), F.concat(F.lit("B"), F.col("o_custkey") % 500).alias("asin"), F.col("o_orderdate").cast("date").alias("snapshot_date"), F.col("o_totalprice").alias("revenue"), F.col("o_orderpriority").alias("title"), F.col("o_orderkey").alias("seq"))
    key = ["report_type", "asin", "snapshot_date"]
    first = r.groupBy(*key).agg(F.min_by("revenue", "seq").alias("revenue"), F.min_by("title", "seq").alias("title"))
    return upsert(first, last_wins(r, key, ["seq"]).select(*key, "revenue"), key, {"revenue": NEW}).withColumn("snapshot_date", F.col("snapshot_date").cast("string"))


@query(
    """with o as (select c_custkey as k from customer where c_custkey % 5 <> 0), b as (select c_custkey as k from customer where c_custkey % 3 <> 0)
    select coalesce(o.k, b.k) as problem_statement_id, case when b.k is null then 'old' else 'new' end as title, case when o.k is null then 9 else o.k % 5 end::bigint as sub_score, case when b.k is null then 0 else b.k % 7 end::bigint as final_score from o full join b on o.k = b.k"""
)
def partial_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A rerun over some rows updates their title and final score; sub-scores stay as first written."""
    c = read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("problem_statement_id"))
    k, number = F.col("problem_statement_id"), lambda c: c.cast("bigint")
    old = c.filter(k % 5 != 0).select(k, F.lit("old").alias("title"), number(k % 5).alias("sub_score"), number(F.lit(0)).alias("final_score"))
    new = c.filter(k % 3 != 0).select(k, F.lit("new").alias("title"), number(F.lit(9)).alias("sub_score"), number(k % 7).alias("final_score"))
    return upsert(old, new, ["problem_statement_id"], {"title": NEW, "final_score": NEW})


@query("select c_custkey as cluster_key from customer where c_custkey in (select o_custkey from orders where o_custkey is not null)")
def stale_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("cluster_key"))
    return replace_stale(c, read(spark, sf_dir, "orders").select(F.col("o_custkey").alias("cluster_key")), ["cluster_key"])


@query("select doc_id from documents where doc_id not in (select doc_id from labels) and length(text) > 40")
def mark_processed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a run still has to process: documents without a processed key."""
    d = read(spark, sf_dir, "documents").filter(F.char_length("text") > 40).select("doc_id")
    return queues.unprocessed(d, read(spark, sf_dir, "labels"), "doc_id")


@query("select vec_id, case when label < 5 then vec_id % 7 when vec_id % 2 = 0 then 100 + label end as cluster_id from embeddings")
def reset_reassign(spark: SparkSession, sf_dir: str) -> DataFrame:
    from plumbline.operators.cluster import reassign

    e = read(spark, sf_dir, "embeddings").select("vec_id", "label", F.when(F.col("vec_id") % 2 == 0, F.col("label") + 100).otherwise(None).cast("bigint").alias("cluster_id"))
    rows = e.withColumnRenamed("vec_id", "id")
    new = rows.filter("label < 5").select("id", (F.col("id") % 7).alias("cluster_id"))
    return reassign(rows, new, F.col("label") < 5).select(F.col("id").alias("vec_id"), "cluster_id")


@query("select source, n from (select event_type as source, count(*) as n from events where user_id not in (select c_custkey from customer where c_custkey % 2 = 0) group by 1)")
def seen_keys_skipped(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read(spark, sf_dir, "events")
    seen = read(spark, sf_dir, "customer").filter(F.col("c_custkey") % 2 == 0).select(F.col("c_custkey").alias("user_id"))
    return queues.unprocessed(e, seen, "user_id").groupBy(F.col("event_type").alias("source")).agg(F.count("*").alias("n"))


def comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns after the first as comments, each under the turn before it."""
    c = read(spark, sf_dir, "conversations")
    return c.filter("turn > 0").select((F.col("conv_id") * 100 + F.col("turn")).alias("comment_id"), (F.col("conv_id") * 100 + F.col("turn") - 1).alias("parent"), "conv_id", "turn", "text")


@query("select c.conv_id * 100 + c.turn as comment_id, p.conv_id + 1000000 as post_pk from conversations c join (select conv_id from conversations where turn = 0 and conv_id % 3 <> 0) p using (conv_id) where turn > 0")
def stage_insert_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    posts = read(spark, sf_dir, "conversations").filter((F.col("turn") == 0) & (F.col("conv_id") % 3 != 0)).select("conv_id", (F.col("conv_id") + 1000000).alias("post_pk"))
    return threads.stage_join(comments(spark, sf_dir), posts, "conv_id", "post_pk").select("comment_id", "post_pk")


@query("select c.conv_id * 100 + c.turn as comment_id, p.conv_id * 1000 + p.turn as parent_id from conversations c left join (select * from conversations where turn > 0) p on p.conv_id * 100 + p.turn = c.conv_id * 100 + c.turn - 1 where c.turn > 0")
def parent_fixup(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = comments(spark, sf_dir).withColumn("id", F.col("conv_id") * 1000 + F.col("turn"))
    return threads.fix_parents(c, "comment_id", "parent", "id").select("comment_id", "parent_id")


@query("select conv_id * 100 + turn as comment_id, conv_id * 100 + 1 as root, turn - 1 as depth from conversations where turn > 0")
def thread_rebuild(spark: SparkSession, sf_dir: str) -> DataFrame:
    return threads.rebuild(comments(spark, sf_dir), "comment_id", "parent")


@query("select conv_id * 100 + turn as comment_id, conv_id * 100 + 1 as root, turn - 1 as depth from conversations where turn > 0")
def thread_recursive(spark: SparkSession, sf_dir: str) -> DataFrame:
    comments(spark, sf_dir).createOrReplaceTempView("thread_comments")
    return threads.rebuild_sql(spark, "thread_comments", "comment_id", "parent")


@query("select event_type, greatest(max(ts), timestamp '2024-01-15') as resume_at from events group by 1")
def resume_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read(spark, sf_dir, "events")
    return offsets(e, "event_type", F.col("ts").cast("timestamp"), "2024-01-15")


@query("select c_custkey, c_acctbal + case when c_custkey % 2 = 0 then 1 else 0 end as balance, c_custkey % 3 = 0 as late from customer")
def keyed_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table in buckets after a write and two merges, each a commit of its own."""
    c = read(spark, sf_dir, "customer").select("c_custkey", F.col("c_acctbal").alias("balance"), (F.col("c_custkey") % 3 == 0).alias("late"))
    table = SnapshotTable(spark, scratch(spark, "keyed-table"), buckets=4)
    table.write(c.filter("not late"), ["c_custkey"])
    table.merge(c.filter("late"), ["c_custkey"], {})
    table.merge(c.filter("c_custkey % 2 = 0").withColumn("balance", F.col("balance") + 1), ["c_custkey"], {"balance": NEW})
    return table.read()
