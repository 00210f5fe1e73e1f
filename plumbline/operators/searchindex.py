"""A stored index of words: postings in files by lexeme, ranked search by BM25 with block maxima, phrases by positions.

A folder of Parquet files holds one row for each lexeme and block of documents: the postings
of the block's documents (key, number of places, document length, places), how many they are,
and the largest number of places and the smallest length among them, which bound any score in
the block. Rows lie in buckets by the lexeme's hash, sorted by lexeme, so a query reads the
buckets of its own lexemes and, in them, the row groups that have these. A document's block is
the hash of its key, so the blocks of all lexemes line up; batches that are added later have
blocks of their own. The texts are shuffled once, by block: a block's postings are made in one
place and written to the buckets from there, so a bucket has a file for each task that wrote.

Ranked search first reads the bounds alone. The blocks with the highest sums of bounds are
scored, which gives a k-th best score; then only blocks whose bound reaches it are. The
result is that of scoring every document.

Keys name documents: a batch must have each once, and none that is there already. Rows with a
null key are left out. A null or empty text is a document without words. Words are runs of
letters and digits in lower case, ``stemmed`` (English, stop words left out) or as they are.
"""

from __future__ import annotations

import math
import re
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from plumbline.functions.fts import compile_phrases, grouped_places, lexeme_places, lexemes

#: Documents of a block, buckets of lexemes, and blocks that are scored to find the bar.
BLOCK, BUCKETS, FIRST = 128, 64, 64
#: Documents of a task that makes and sorts postings; small inputs are dealt to all cores.
DOCS = 8192
#: Weights of the ranking.
K1, B = 1.2, 0.75
_WORD, _WORDS = r"[\p{L}\p{N}]+", re.compile(r"[^\W_]+")


def _plain(text: Column, stemmed: bool) -> Column:
    """What is shuffled of a text: the stemmer's input, or the words with one space between them."""
    return text if stemmed else F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+", " "))


class SearchIndex:
    """The index in a folder that the driver and all executors share."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        batches = spark.read.parquet(f"{self.path}/batches").collect()  # a row for each batch
        self.stemmed, self.buckets = batches[0]["stemmed"], batches[0]["buckets"]
        self.next = max(b["batch"] for b in batches) + 1
        self.docs, length = sum(b["docs"] for b in batches), sum(b["length"] for b in batches)
        self.mean = length / self.docs if length else 1.0
        self._rows = spark.read.parquet(f"{self.path}/postings")

    @classmethod
    def build(cls, docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", stemmed: bool = True, buckets: int = BUCKETS) -> SearchIndex:
        _add(docs, path.rstrip("/"), 0, key, text, stemmed, buckets)
        return cls(docs.sparkSession, path)

    def append(self, docs: DataFrame, key: str = "doc_id", text: str = "text") -> SearchIndex:
        """Add a batch of new documents; files that are there stay as they are."""
        _add(docs, self.path, self.next, key, text, self.stemmed, self.buckets)
        return SearchIndex(self.spark, self.path)

    def lexemes(self, query: str) -> list[str]:
        """The distinct lexemes of a query."""
        if self.stemmed:
            return list(dict.fromkeys(s for s, _ in lexemes(query)))
        return list(dict.fromkeys(_WORDS.findall(query.lower())))

    def postings(self, words: Sequence[str]) -> DataFrame:
        """The rows of some lexemes; the files of other buckets aren't read."""
        own = F.lit(False)
        for w in words:  # the planner folds these to numbers
            own = own | (F.col("bucket") == F.pmod(F.xxhash64(F.lit(w)), F.lit(self.buckets)).cast("int"))
        return self._rows.filter(own & F.col("lexeme").isin(list(words)))

    def _weights(self, rows: DataFrame) -> dict[str, float]:
        """Rareness of each lexeme that is there."""
        found = rows.groupBy("lexeme").agg(F.sum("n").alias("n")).collect()  # as many as the query has words
        return {r["lexeme"]: math.log(1 + (self.docs - r["n"] + 0.5) / (r["n"] + 0.5)) for r in found}

    def _score(self, weight: Column, tf: Column, length: Column) -> Column:
        return weight * tf * (K1 + 1) / (tf + K1 * (1 - B + B * length / F.lit(self.mean)))

    def search(self, query: str, k: int = 10) -> DataFrame:
        """(key, score): the k documents that rank highest, ties by key."""
        words = self.lexemes(query)
        rows = self.postings(words)
        weights = self._weights(rows)
        if not weights:
            kind = rows.select(F.explode("postings").alias("p")).select("p.key").schema["key"].dataType.simpleString()
            return self.spark.createDataFrame([], f"key {kind}, score double")
        weight = F.element_at(F.create_map(*(F.lit(x) for w, v in weights.items() for x in (w, v))), F.col("lexeme"))

        def ranked(some: DataFrame) -> DataFrame:
            each = some.select("lexeme", F.explode("postings").alias("p")).select("p.key", self._score(weight, F.col("p.tf"), F.col("p.length")).alias("s"))
            return each.groupBy("key").agg(F.sum("s").alias("score")).orderBy(F.col("score").desc(), "key").limit(k)

        bounds = rows.groupBy("block").agg(F.sum(self._score(weight, F.col("most"), F.col("shortest"))).alias("bound"))
        first = [r["block"] for r in bounds.orderBy(F.col("bound").desc(), "block").limit(FIRST).collect()]
        best = ranked(rows.filter(F.col("block").isin(first))).collect()
        if len(best) < k:
            return ranked(rows)
        bar = best[-1]["score"] * (1 - 1e-12)  # sums of the same numbers in another order may differ
        return ranked(rows.join(bounds.filter(F.col("bound") >= bar).select("block"), "block", "left_semi"))

    def scored_blocks(self, query: str, k: int = 10) -> tuple[int, int]:
        """Blocks of documents whose bound reaches the k-th best score, and blocks that have a word of the query."""
        rows = self.postings(self.lexemes(query))
        weights = self._weights(rows)
        weight = F.element_at(F.create_map(*(F.lit(x) for w, v in weights.items() for x in (w, v))), F.col("lexeme"))
        bounds = rows.groupBy("block").agg(F.sum(self._score(weight, F.col("most"), F.col("shortest"))).alias("bound"))
        bar = min(r["score"] for r in self.search(query, k).collect())
        r = bounds.agg(F.count_if(F.col("bound") >= bar), F.count("*")).first()
        return r[0], r[1]

    def phrases(self, phrases: Sequence[str]) -> DataFrame:
        """(key, phrase): the documents in which the words of a phrase stand at the distances that they have in it."""
        steps = [(p, s) for p in phrases for s in self._steps(p)]
        rows = self.postings(sorted({w for _, s in steps for w, _ in s}))
        places = rows.select("block", "lexeme", F.explode("postings").alias("p")).select("block", "p.key", "lexeme", "p.places")
        of = places.groupBy("block", "key").agg(F.map_from_entries(F.collect_list(F.struct("lexeme", "places"))).alias("at"))

        def hit(s: list[tuple[str, int]]) -> Column:
            (head, _), rest = s[0], s[1:]
            here = lambda i: [F.array_contains(F.try_element_at("at", F.lit(w)), i + d) for w, d in rest]
            test = lambda i: _all(here(i))
            return F.coalesce(F.exists(F.try_element_at("at", F.lit(head)), test), F.lit(False))

        flags = F.array(*(F.when(hit(s), F.lit(p)) for p, s in steps)) if steps else F.array().cast("array<string>")
        return of.select("key", F.explode(F.array_distinct(F.array_compact(flags))).alias("phrase"))

    def _steps(self, phrase: str) -> list[list[tuple[str, int]]]:
        if self.stemmed:
            return compile_phrases([phrase])
        words = _WORDS.findall(phrase.lower())
        return [[(w, i) for i, w in enumerate(words)]] if words else []


def _all(tests: list[Column]) -> Column:
    out = F.lit(True)
    for t in tests:
        out = out & F.coalesce(t, F.lit(False))
    return out


def _add(docs: DataFrame, path: str, batch: int, key: str, text: str, stemmed: bool, buckets: int) -> None:
    """Write a batch's postings, and then that it is there."""
    spark = docs.sparkSession
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text")).filter("key is not null")
    n, kind = rows.count(), rows.schema["key"].dataType.simpleString()
    block = F.concat_ws(":", F.lit(batch), F.pmod(F.xxhash64("key"), F.lit(max(1, n // BLOCK))))

    def postings(docs_of_block: pa.Table) -> pa.Table:
        t = docs_of_block.sort_by("key").combine_chunks()
        words, row, places = lexeme_places(t.column("text").combine_chunks(), stemmed)
        length = np.bincount(row, minlength=t.num_rows).astype(np.int32)
        lexeme, row, tf, places = grouped_places(words, row, places)
        coded = lexeme.dictionary_encode()
        first = np.flatnonzero(np.diff(coded.indices.to_numpy(zero_copy_only=False), prepend=-1))
        own = length[row]
        one = pa.StructArray.from_arrays([t.column("key").take(pa.array(row)).combine_chunks(), pa.array(tf.astype(np.int32)), pa.array(own), places], ["key", "tf", "length", "places"])
        ends = np.r_[first, len(row)].astype(np.int32)
        over = lambda f, x: f.reduceat(x, first) if len(first) else x[:0]
        names = pa.array([t.column("block")[0].as_py()] * len(first), pa.string())
        return pa.table({"lexeme": coded.dictionary, "block": names, "n": pa.array(np.diff(ends).astype(np.int64)), "most": pa.array(over(np.maximum, tf).astype(np.int32)), "shortest": pa.array(over(np.minimum, own)), "total": pa.array(over(np.add, tf).astype(np.int64)), "postings": pa.ListArray.from_arrays(pa.array(ends), one)})

    schema = f"lexeme string, block string, n long, most int, shortest int, total long, postings array<struct<key:{kind},tf:int,length:int,places:array<int>>>"
    parts = min(max(1, n // BLOCK), max(spark.sparkContext.defaultParallelism, -(-n // DOCS)))
    texts = rows.select("key", _plain(F.col("text"), stemmed).alias("text"), block.alias("block")).repartition(parts, "block")
    blocks = texts.groupBy("block").applyInArrow(postings, schema)
    bucket = F.pmod(F.xxhash64("lexeme"), F.lit(buckets)).cast("int").alias("bucket")
    words = Observation()
    seen = blocks.observe(words, F.sum("total").alias("length")).drop("total")
    seen.select("*", bucket).sortWithinPartitions("bucket", "lexeme", "block").write.mode("append").partitionBy("bucket").parquet(f"{path}/postings")
    length = (words.get.get("length") or 0) if n else 0
    spark.createDataFrame([(batch, n, length, stemmed, buckets)], "batch int, docs long, length long, stemmed boolean, buckets int").coalesce(1).write.mode("append").parquet(f"{path}/batches")
