"""The registered queries of the corpus operators; each covers its whole table."""

from __future__ import annotations

import zlib
from collections.abc import Callable

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm import fim, html_text, jaccard, mixing, nbsvm, oracles, orderhash, pii, repetition, simhash, substring, tokenfile, vacode
from plumbline.llm.lattice import SLICE
from plumbline.llm.shared import arrow_map, scratch, texts_of

SEED = 20240131
#: Whole weights of the mixing tree's nodes; those not named weigh one.
WEIGHTS = {"domain": {"domain0": 4, "domain1": 3, "domain2": 2, "domain3": 1}, "lang": {"en": 5, "de": 2, "fr": 2, "es": 1}}
FIM = {"seed": 7, "rate": 100, "spm": 50}
MIX = {"seed": SEED, "share": 1.0, "max_epochs": 2}


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of each page."""
    return html_text.extract(read(spark, sf_dir, "pages"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of each document by naive Bayes support vectors."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    model = nbsvm.train(docs, read(spark, sf_dir, "labels"))
    scored = nbsvm.with_score(docs, model)
    return scored.select("doc_id", nbsvm.held_out(F.col("doc_id")).alias("held_out"), "score", nbsvm.predicted(F.col("score")).alias("predicted"))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents selected by the budgets of their leaves, one row per epoch."""
    return mixing.mix(read(spark, sf_dir, "documents"), WEIGHTS, **MIX, with_leaf=True)


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that stay after removing 50-word windows that an earlier document has."""
    kept = substring.remove_repeats(read(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sampled segmentation of each text, seeded by doc_id, and the round trip back."""
    path = public_tokenizers.path("piece_bpe_32k.model")

    def work(part: pa.RecordBatch, texts: list[bytes]) -> pa.RecordBatch:
        from plumbline.llm.lattice import lattice

        model = lattice(path)
        keys = np.array([k or 0 for k in part.column(0).to_pylist()], np.int64)
        ids, counts = model.sample(texts, keys, SEED)
        end = np.cumsum(counts)
        rows = [ids[a:b] for a, b in zip((end - counts).tolist(), end.tolist(), strict=True)]
        crc = [zlib.crc32(x.astype("<u4").tobytes()) for x in rows]
        same = [model.decode(x) == t for x, t in zip(rows, texts, strict=True)]
        return pa.RecordBatch.from_arrays([part.column(0), pa.array(counts), pa.array(crc, pa.int64()), pa.array(same)], names=["doc_id", "n_pieces", "pieces_crc32", "lossless"])

    return arrow_map(texts_of(read(spark, sf_dir, "documents")), work, "doc_id long, n_pieces long, pieces_crc32 long, lossless boolean", most=SLICE)


def op6_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in each text: base patterns, and terms that disclose them."""
    found = pii.personal_data(read(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = pii.listed(F.col("base"))
    terms = F.transform(F.coalesce("terms", F.array().cast("array<struct<start:int,stop:int,disclosure:double>>")), lambda t: F.concat_ws(":", F.lit("term"), t["start"], t["stop"]))
    every = F.array_join(F.filter(F.concat(F.array(base), terms), lambda x: x != ""), ",")
    return found.select("doc_id", *map(count, pii.KINDS), F.sha2(base, 256).alias("base_sha256"), every.alias("spans"))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash fingerprint and near-duplicate component of each document."""
    found = simhash.near_duplicates(read(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.fingerprint_hex(F.col("fp")).alias("fingerprint"), "component_id")


def op8_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order MinHash of each text and of its edited text, and how alike they are."""
    rows = orderhash.with_next(read(spark, sf_dir, "documents"))
    rows = rows.withColumn("edited", orderhash.edited(F.col("text"), F.col("next_text")))
    rows = rows.select("doc_id", F.char_length("text").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"), "signature", "next_signature", orderhash.signature(F.col("edited")).alias("edited_signature"))
    return rows.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        orderhash.as_text(F.col("signature")).alias("fingerprint"),
        orderhash.as_text(F.col("edited_signature")).alias("edited_fingerprint"),
        orderhash.likeness(F.col("signature"), F.col("edited_signature")).alias("near_edited"),
        orderhash.likeness(F.col("signature"), F.col("next_signature")).alias("near_next"),
    )


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of each text written to Simple-8b files and read back."""
    path = scratch(spark, "tokens")
    tokenfile.write_tokens(read(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"))
    return tokenfile.read_digests(spark, path)


def op10_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and repetition verdict of each document."""
    return repetition.repetition_quality(read(spark, sf_dir, "documents"))


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each text cut in three and put in order behind sentinels, and the text that these give back."""
    made = fim.arranged(read(spark, sf_dir, "documents"), **FIM)
    digest = lambda text: F.sha2(text.cast("binary"), 256)
    return made.select(
        "doc_id",
        "n",
        "form",
        F.char_length("prefix").cast("long").alias("prefix_chars"),
        F.char_length("middle").cast("long").alias("middle_chars"),
        digest(F.col("output")).alias("output_sha256"),
        digest(fim.restored(F.col("output"), F.col("form"))).alias("restored_sha256"),
    )


def op12_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of each document under Jaccard similarity of its shingles."""
    return jaccard.similar(read(spark, sf_dir, "documents"))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes of the vectors, their errors, and the codebooks' digest."""
    return vacode.compress(read(spark, sf_dir, "embeddings"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corpus pipeline, all stages."""
    import corpus_pipeline  # it imports this module

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_html_text": op1_html_text,
    "op2_quality": op2_quality,
    "op3_mixing": op3_mixing,
    "op4_substring_dedup": op4_substring_dedup,
    "op5_sentencepiece": op5_sentencepiece,
    "op6_personal_data": op6_personal_data,
    "op7_simhash": op7_simhash,
    "op8_order_minhash": op8_order_minhash,
    "op9_token_files": op9_token_files,
    "op10_repetition": op10_repetition,
    "op11_fill_in_middle": op11_fill_in_middle,
    "op12_jaccard_join": op12_jaccard_join,
    "op13_vector_codes": op13_vector_codes,
    "pipeline": pipeline,
}
ORACLES: dict[str, str] = {"op3_mixing": mixing.oracle(WEIGHTS, **MIX), "op4_substring_dedup": oracles.OP4, "op10_repetition": oracles.OP10, "op11_fill_in_middle": fim.oracle(**FIM), "op12_jaccard_join": jaccard.ORACLE, "op13_vector_codes": vacode.oracle()}
