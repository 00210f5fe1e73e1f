"""Queries of vectors and clusters. The test vectors lie far apart, hence the wide threshold."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.functions.vectors import truncate
from plumbline.operators import cluster, neighbors, vecindex
from plumbline.plans.registry import ORACLES, query, read
from plumbline.session import scratch

NEAR = 0.60
_PAIRS = f"(select a.vec_id as a, b.vec_id as b, 1 - list_cosine_similarity(a.embedding::double[], b.embedding::double[]) as d from embeddings a join embeddings b on a.vec_id < b.vec_id where 1 - list_cosine_similarity(a.embedding::double[], b.embedding::double[]) < {NEAR})"


@query(f"select a, b, round(d, 6) as distance from {_PAIRS}")
def cosine_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbors.exact_pairs(read(spark, sf_dir, "embeddings"), NEAR).withColumn("distance", F.round("distance", 6))


@query(
    """select query, neighbour, rank, round(d, 6) as distance from (select q.vec_id as query, e.vec_id as neighbour, d, row_number() over (partition by q.vec_id order by d, e.vec_id) as rank
    from (select * from embeddings where vec_id % 100 = 0) q, lateral (select vec_id, 1 - list_cosine_similarity(q.embedding::double[], embedding::double[]) as d from embeddings) e where e.vec_id <> q.vec_id) where rank <= 10"""
)
def knn_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest of every query whose id is divisible by 100."""
    e = read(spark, sf_dir, "embeddings")
    return neighbors.knn(e, e.filter(F.col("vec_id") % 100 == 0), 10).select("query", "neighbour", F.col("rank").cast("bigint").alias("rank"), F.round("distance", 6).alias("distance"))


@query("select vec_id, i - 1 as dim, round(embedding[i]::double / sqrt(list_sum(list_transform(embedding[1:16], lambda x: x::double * x::double))), 6) as x from embeddings, range(1, 17) t(i)")
def matryoshka_truncate(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read(spark, sf_dir, "embeddings").select("vec_id", F.posexplode(truncate(F.col("embedding"), 16)).alias("d", "x"))
    return e.select("vec_id", F.col("d").cast("bigint").alias("dim"), F.round("x", 6).alias("x"))


@query(
    f"""with recursive p as materialized (select a, b from {_PAIRS}), ids as (select vec_id as id, row_number() over (order by vec_id) as n from embeddings),
    less as materialized (select id, n, list(a) filter (a is not null) as lower_ from ids left join p on p.b = id group by all),
    walk(n, seeds) as (select 0::bigint, []::bigint[] union all
      select w.n + 1, case when list_has_any(coalesce(l.lower_, []), w.seeds) then w.seeds else list_append(w.seeds, l.id) end from walk w join less l on l.n = w.n + 1),
    final as (select seeds from walk order by n desc limit 1)
    select id, case when list_contains(seeds, id) then id else list_min(list_intersect(lower_, seeds)) end as seed from less, final"""
)
def fold_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ordered greedy fold."""
    e = read(spark, sf_dir, "embeddings")
    return neighbors.fold(e, neighbors.exact_pairs(e, NEAR))


@query(
    f"""select vec_id, case when vec_id = seed then total else own end::bigint as dup_count, vec_id <> seed as is_duplicate, true as deduped
    from (select id as vec_id, seed, id % 3 + 1 as own, sum(id % 3 + 1) over (partition by seed) as total from ({ORACLES["fold_dedup"]}))"""
)
def folded_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seeds take the copies of their members, members are marked."""
    e = read(spark, sf_dir, "embeddings")
    folded = neighbors.fold(e, neighbors.exact_pairs(e, NEAR))
    rows = e.select("vec_id", (F.col("vec_id") % 3 + 1).alias("dup_count"))
    return neighbors.fold_counts(rows, folded).select("vec_id", F.col("dup_count").cast("bigint").alias("dup_count"), "is_duplicate", "deduped")


@query("select vec_id as id, dense_rank() over (order by bucket, first_id) - 1 as cluster_id from (select vec_id, bucket, min(vec_id) over (partition by bucket, local) as first_id from (select vec_id, vec_id % 5 as bucket, label as local from embeddings) where local <> 3)")
def relabel_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dense labels over (bucket, first appearance); noise stays out."""
    e = read(spark, sf_dir, "embeddings")
    found = e.select(F.col("vec_id").alias("id"), (F.col("vec_id") % 5).cast("int").alias("bucket"), F.when(F.col("label") == 3, -1).otherwise(F.col("label")).alias("local"))
    return cluster.relabel(found)


@query()
def kmeans_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster.coarse(read(spark, sf_dir, "embeddings"), k=8, dims=32).select("id", "bucket")


@query()
def density_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = cluster.fine(cluster.coarse(read(spark, sf_dir, "embeddings"), dims=32))
    return cluster.relabel(found)


@query()
def lsh_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbors.lsh_pairs(read(spark, sf_dir, "embeddings"), NEAR)


@query()
def ann_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of every vector the 200 nearest under the distance, by the approximate index."""
    found = neighbors.neighbours(neighbors.lsh_pairs(read(spark, sf_dir, "embeddings"), NEAR), 200)
    return found.withColumn("distance", F.round("distance", 6))


@query()
def fold_lsh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ordered greedy fold over the approximate pairs."""
    e = read(spark, sf_dir, "embeddings")
    return neighbors.fold(e, neighbors.lsh_pairs(e, NEAR))


@query()
def index_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of every vector the 200 nearest by a kept index, to which a third of the rows was appended after it was built."""
    e = read(spark, sf_dir, "embeddings")
    late = F.pmod(F.xxhash64("vec_id"), F.lit(3)) == 0
    index = vecindex.VectorIndex.build(e.filter(~late), scratch(spark, "vector-index"))
    index.append(e.filter(late))
    return index.search(e, 200, NEAR).withColumn("distance", F.round("distance", 6))


@query(f"select q.vec_id as query, e.vec_id as neighbour from embeddings q join embeddings e on 1 - list_cosine_similarity(q.embedding::double[], e.embedding::double[]) < {NEAR} where q.vec_id % 100 = 0")
def index_within(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All vectors under the distance of every query whose id is divisible by 100, from the kept index, exactly."""
    e = read(spark, sf_dir, "embeddings")
    index = vecindex.VectorIndex.build(e, scratch(spark, "vector-index"))
    return index.within(e.filter("vec_id % 100 = 0"), NEAR).select("query", "neighbour")


@query(ORACLES["fold_dedup"])
def fold_online(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ordered greedy fold in three batches by ranges of ids, each against the kept seeds."""
    e = read(spark, sf_dir, "embeddings")
    low, high = e.agg(F.min("vec_id"), F.max("vec_id")).first()
    state = vecindex.OnlineFold(spark, scratch(spark, "fold"), NEAR)
    for i in range(3):
        state.add(e.filter(F.floor((F.col("vec_id") - low) * 3 / (high - low + 1)) == i))
    return state.folded()


@query()
def embed_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings by the offline hashing embedder."""
    from plumbline.sources.embedder import embed

    return embed(read(spark, sf_dir, "documents").select("doc_id", "text"), F.col("text"), dims=256, most_chars=None).select("doc_id", F.size("embedding").alias("dims"), "embedding")


@query()
def embed_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The older stage: documents with a body of more than 30 characters, by the first 2000 of title and body, 768 values."""
    from plumbline.sources.embedder import embed

    d = read(spark, sf_dir, "documents").filter(F.char_length("text") > 30).select("doc_id", F.concat_ws(". ", "source", "text").alias("text"))
    return embed(d, F.col("text"), dims=768, most_chars=2000).select("doc_id", "embedding")
