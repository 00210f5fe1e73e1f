from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import pytest

corpus_pipeline = pytest.importorskip("corpus_pipeline")

from plumbline.llm import mixing, nbsvm, pii, simhash  # noqa: E402
from plumbline.llm.lattice import lattice  # noqa: E402
from plumbline.llm.queries import MIX, WEIGHTS  # noqa: E402
from tests.llm.test_simhash import brute_fp, components  # noqa: E402


def test_stages_keep_columns_and_decide(spark, docs, tmp_path):
    base = docs
    labels = spark.createDataFrame([(i, int(i != 12)) for i in range(13)], "doc_id long, quality int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    now, names = base, [n for n, _ in corpus_pipeline.STAGES]
    assert len(names) == 5
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, now, str(tmp_path)).write.parquet(f"{tmp_path}/{i}")
        now, before = spark.read.parquet(f"{tmp_path}/{i}"), now
        if i < 4:
            assert now.columns == base.columns
        if i == 1:
            ids = [r.doc_id for r in now.collect() if r.doc_id is not None]
            comps = {r.doc_id: r.component_id for r in simhash.near_duplicates(before.filter("doc_id is not null")).collect()}
            assert set(ids) == {d for d, c in comps.items() if d == c}
        if i == 2:
            assert not any(pii.base_spans(r.text or "") for r in now.collect())
    rows = now.collect()
    assert rows and all(len(r.pieces) == r.n_pieces for r in rows)


def test_whole_run_against_each_stage_by_itself(spark):
    """Classifier by its own scores, near copies by brute force, budgets by SQL, and pieces that give the sanitised text back."""
    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = nbsvm.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    good = {r.doc_id: r.text for r in nbsvm.with_score(docs, model).filter("score >= 0.3").collect()}
    assert 0 < len(good) < docs.count()
    part = components({i: brute_fp(t) for i, t in good.items()})
    first = [i for i in good if part[i] == i]
    assert len(first) < len(good)
    clean = pii.sanitise(docs.filter(docs["doc_id"].isin(first)))
    text = {r.doc_id: r.text for r in clean.collect()}
    assert not any(pii.base_spans(t or "") for t in text.values())
    documents = clean.toPandas()  # noqa: F841  DuckDB finds it by name
    want = Counter(duckdb.sql(f"select doc_id from ({mixing.oracle(WEIGHTS, **MIX)})").df().doc_id.tolist())
    rows = corpus_pipeline.run(spark, sf_dir).collect()
    assert Counter(r.doc_id for r in rows) == want
    pieces = lattice(public_tokenizers.path("piece_bpe_32k.model"))
    assert all(pieces.decode(np.array(r.pieces, np.int64)) == (text[r.doc_id] or "").encode() for r in rows)


def test_empty_table(spark, empty, tmp_path):
    spark.createDataFrame([], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    now = empty
    for _, stage in corpus_pipeline.STAGES:
        now = stage(spark, now, str(tmp_path))
    assert now.count() == 0
    assert nbsvm.THRESHOLD == 0.3
