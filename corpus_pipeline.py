"""A corpus pipeline of five stages: each calls one operator on all that its predecessor kept.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and
read again as the next one's docs. All but the last return the columns of ``docs``. Rows with
nulls in any column, empty and very long texts, ties and repeated rows go through as the
operators define; an empty table comes out empty.
"""

from __future__ import annotations

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm import mixing, nbsvm, pii, simhash
from plumbline.llm.lattice import SLICE
from plumbline.llm.queries import MIX, SEED, WEIGHTS
from plumbline.llm.shared import arrow_map, drop, spare, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier doesn't reject."""
    model = nbsvm.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    score = spare(docs, "score")
    scored = nbsvm.with_score(docs, model, score_col=score)
    return scored.filter(nbsvm.predicted(F.col(score)) == 1).select(*(F.col(f"`{c}`") for c in docs.columns))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: that with the smallest doc_id."""
    return simhash.keep_first(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without personal data; n_chars follows the text."""
    clean = pii.sanitise(docs)
    if "n_chars" not in docs.columns:
        return clean
    size = F.char_length(F.col("text")).cast(docs.schema["n_chars"].dataType)
    return clean.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(size))


def mixing_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the budgets of domains, languages and sources take, one row per epoch."""
    return mixing.mix(docs, WEIGHTS, **MIX)


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of each text, sampled by its doc_id."""
    path = public_tokenizers.path("piece_bpe_32k.model")

    def encode(part: pa.RecordBatch, texts: list[bytes]) -> pa.RecordBatch:
        from plumbline.llm.lattice import lattice

        keys = np.array([k or 0 for k in part.column("doc_id").to_pylist()], np.int64)
        ids, counts = lattice(path).sample(texts, keys, SEED)
        pieces = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(counts))).astype(np.int32)), pa.array(ids, pa.int32()))
        return pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("lang"), part.column("source"), pieces, pa.array(counts.astype(np.int32))], names=["doc_id", "lang", "source", "pieces", "n_pieces"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), F.col("source").cast("string").alias("source"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return arrow_map(rows, encode, "doc_id long, lang string, source string, pieces array<int>, n_pieces int", most=SLICE)


STAGES = [
    ("quality classifier", quality),
    ("SimHash near-dedup", near_duplicates),
    ("PII", personal_data),
    ("mixing sources to target weights", mixing_weights),
    ("SentencePiece encoding and decoding", sentencepiece),
]

#: Hash orders, hinge-loss weights and XXH64 are beyond DuckDB SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table documents."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    for i, (_, stage) in enumerate(STAGES):
        docs = table(stage(spark, docs, sf_dir), f"stage-{i}")
        drop(*before)
        before = [docs]
    return docs
