import zlib

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from plumbline.llm import simple8b, tokenfile
from plumbline.llm.bytebpe import encoder

PATH = public_tokenizers.path("byte_bpe_50k.json")


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 3), st.integers(0, 60000), st.integers(0, 2**64 - 1)), max_size=700))
def test_simple8b_round_trip(ids):
    words, first = simple8b.encode(np.array(ids, np.uint64))
    assert simple8b.decode(words, first).tolist() == ids
    assert len(first) == -(-len(ids) // simple8b.BLOCK)


def test_simple8b_packs_small_ids_tightly():
    words, _ = simple8b.encode(np.zeros(simple8b.BLOCK * 4, np.uint64))
    assert len(words) <= 4 * 9


@settings(max_examples=120, deadline=None)
@given(st.lists(st.text(alphabet="aZ \n\t\r\x0b\x1c\x85\xa0é漢🙂'.,!19|　 st", max_size=40), max_size=5))
def test_pieces_encode_as_the_whole_text(texts):
    ids, counts = encoder(PATH)([t.encode() for t in texts])
    end = np.cumsum(counts)
    t = Tokenizer.from_file(PATH)
    assert [ids[b - n : b].tolist() for n, b in zip(counts, end, strict=True)] == [e.ids for e in t.encode_batch(texts, add_special_tokens=False)]


def test_added_tokens_are_their_own_ids(monkeypatch):
    from plumbline.llm import bytebpe

    t, e = Tokenizer.from_file(PATH), bytebpe.Encoder(PATH)
    texts = ["a<|endoftext|>b", "<|endoftext|>", "", " x <|endoftext|> \n<|endoftext|><|endoftext|>y z", "<|endoftext", "plain, text"]
    for _ in range(2):
        ids, counts = e([x.encode() for x in texts])
        end = np.cumsum(counts)
        assert [ids[b - n : b].tolist() for n, b in zip(counts, end, strict=True)] == [x.ids for x in t.encode_batch(texts, add_special_tokens=False)]

        def unsure(self, texts):
            raise bytebpe.Unsure

        monkeypatch.setattr(bytebpe.Encoder, "_pieces", unsure)


def test_far_and_missing_ids_make_no_large_bucket(spark, tmp_path, monkeypatch):
    from pyspark.sql import functions as F

    monkeypatch.setattr(tokenfile, "range_count", lambda df: 8)
    rows = [(i, f"text {i}") for i in range(2000)] + [(1 << 62, "far"), (-(1 << 62), "far")] + [(None, f"none {i}") for i in range(1000)]
    path = f"file://{tmp_path}/far"
    tokenfile.write_tokens(spark.createDataFrame(rows, "doc_id long, text string"), path, PATH)
    sizes = [r.n for r in spark.read.parquet(path).groupBy("bucket").agg(F.sum(F.size("doc_ids")).alias("n")).collect()]
    assert sum(sizes) == len(rows) and max(sizes) < len(rows) / 4
    got = tokenfile.read_digests(spark, path).orderBy("start").collect()
    assert [r.doc_id for r in got] == sorted((r[0] for r in rows), key=lambda d: -(1 << 63) if d is None else d)


def test_files_and_back(spark, docs, tmp_path, monkeypatch):
    monkeypatch.setattr(tokenfile, "CHUNK", 300)
    path = f"file://{tmp_path}/tokens"
    tokenfile.write_tokens(docs, path, PATH)
    t = Tokenizer.from_file(PATH)
    rows = sorted(((r.doc_id if r.doc_id is not None else -1, r.text or "") for r in docs.collect()), key=lambda r: (r[0], r[1].encode()))
    want, at = [], 0
    for d, text in rows:
        ids = np.array([*t.encode(text, add_special_tokens=False).ids, 2], "<u4")
        want.append((d if d >= 0 else None, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    got = [tuple(r) for r in tokenfile.read_digests(spark, path).orderBy("start").collect()]
    assert got == want
    texts = sorted((r.doc_id if r.doc_id is not None else -1, r.text) for r in tokenfile.read_texts(spark, path, PATH).collect())
    assert texts == sorted(rows)


def test_empty_table(spark, empty, tmp_path):
    path = f"file://{tmp_path}/none"
    tokenfile.write_tokens(empty, path, PATH)
    assert tokenfile.read_digests(spark, path).count() == 0
