"""Queries of the stored word index."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.operators.searchindex import B, K1, SearchIndex
from plumbline.plans.registry import query, read
from plumbline.session import scratch

ASKED = ["the thing of nation", "retion whom und", "stations heating", "pour les onal"]
PHRASES = ["of the", "the thing", "et de", "in the"]
_WORDS = r"w as materialized (select doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+') as ws from documents where doc_id is not null)"
_LIST = ", ".join(f"({i}, '{q}')" for i, q in enumerate(ASKED))


def _index(spark: SparkSession, sf_dir: str, stemmed: bool) -> SearchIndex:
    """Three quarters of the documents, and the rest added later."""
    d = read(spark, sf_dir, "documents").select("doc_id", "text")
    late = F.pmod(F.xxhash64("doc_id"), F.lit(4)) == 0
    return SearchIndex.build(d.filter(~late), scratch(spark, "search"), stemmed=stemmed, buckets=16).append(d.filter(late))


@query(
    f"""with {_WORDS}, t as materialized (select doc_id, len(ws) as length, unnest(ws) as x from w),
    q as (select qid, unnest(list_distinct(regexp_extract_all(lower(q), '[\\p{{L}}\\p{{N}}]+'))) as x from (values {_LIST}) v(qid, q)),
    f as materialized (select doc_id, x, any_value(length) as length, count(*) as tf from t where x in (select x from q) group by doc_id, x),
    df as (select x, count(*) as n from f group by x), s as (select count(*) as docs, avg(len(ws)) as mean from w),
    r as (select qid, doc_id, sum(ln(1 + (docs - n + 0.5) / (n + 0.5)) * tf * {K1 + 1} / (tf + {K1} * ({1 - B} + {B} * length / mean))) as score from q join f using (x) join df using (x), s group by qid, doc_id)
    select qid, doc_id, round(score, 6) as score from (select *, row_number() over (partition by qid order by round(score, 9) desc, doc_id) as rank from r) where rank <= 20"""
)
def search_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best documents of some queries by BM25, from the stored index."""
    index = _index(spark, sf_dir, stemmed=False)
    found = None
    for i, q in enumerate(ASKED):
        one = index.search(q, 20).select(F.lit(i).alias("qid"), F.col("key").alias("doc_id"), F.round("score", 6).alias("score"))
        found = one if found is None else found.unionByName(one)
    return found


@query(f"with {_WORDS}, p as (select unnest({PHRASES!r}) as phrase) select doc_id, phrase from w, p where contains(' ' || array_to_string(ws, ' ') || ' ', ' ' || phrase || ' ')")
def search_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with a phrase, by positions in the stored index."""
    return _index(spark, sf_dir, stemmed=False).phrases(PHRASES).select(F.col("key").alias("doc_id"), "phrase")


@query()
def search_stemmed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with a phrase by stems; tested against a scan."""
    return _index(spark, sf_dir, stemmed=True).phrases(["whom thonan", "stations", "heating"]).select("key", "phrase")
