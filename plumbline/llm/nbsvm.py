"""Quality classifier: naive Bayes support vectors (operator 2).

Features are indicators of hashed n-grams: of 1 to 4 bytes of the text, and of 1 to 3 word
shapes (letter case, punctuation, repeats of the word before). Each indicator is scaled by
its log-count ratio between the classes, each document to length one; a linear hinge-loss
model is fitted by dual coordinate descent, and its margins become probabilities by a
logistic fit on held-back folds of the training rows.

The model is fitted on at most ``MOST`` labelled documents, those with the smallest hash of
their doc_id, in one task, which gets their features (at most ``SPACE`` places each), not
their texts; only its weights (``SPACE`` numbers) go to the driver and to the executors.
Scoring reads every text whole.

Null and empty texts have no features and get the score of the bias alone. Of rows that repeat
a doc_id the one with the smallest features trains. Rows with a null doc_id aren't held out. Rows without label, with a null label or null doc_id, or whose document is missing don't train. Without
rows of both classes the score is the share of label 1, or 0.5 where there are none. Repeated
rows score alike; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.shared import arrow_map, slices, texts_of, trim
from plumbline.llm.words import Words, grams, mix

SPACE, MOST, EPOCHS, COST, SMOOTH, FOLDS = 1 << 18, 4000, 8, 1.0, 1.0, 3
THRESHOLD = 0.3
_SHIFT = np.uint32(32 - 18)
_ODD = (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F)
#: Texts are cut into such stretches while their n-grams are gathered, to bound memory.
_STRETCH = 1 << 20
_KIND = np.zeros(256, np.uint8)  # by byte: 1 lower case, 2 upper case, 3 digit, 4 other ASCII, 5 beyond
for _c in range(256):
    _KIND[_c] = 5 if _c > 127 else 1 if chr(_c).islower() else 2 if chr(_c).isupper() else 3 if chr(_c).isdigit() else 4


def _bytes(text: bytes, seen: np.ndarray) -> None:
    for at in range(0, len(text), _STRETCH):
        part = text[at : at + _STRETCH + 3]
        x = np.frombuffer(part, np.uint8).astype(np.uint32)
        gram = np.zeros(len(x), np.uint32)
        for k in range(4):
            if len(x) <= k:
                break
            gram = gram[: len(x) - k] | x[k:] << np.uint32(8 * k)
            seen[(gram * np.uint32(_ODD[k]) + np.uint32(k)) * np.uint32(0x9E3779B1) >> _SHIFT] = True


def features(texts: list[bytes]) -> Iterator[np.ndarray]:
    """Places in the feature space of each text's n-grams, each once."""
    w = Words(texts)
    h = w.hashes()
    same = np.zeros(len(h), bool)
    same[1:] = (h[1:] == h[:-1]) & (w.doc[1:] == w.doc[:-1])
    shape = np.minimum(w.end - w.start, 15).astype(np.uint64) // np.uint64(4)
    shape |= _KIND[w.buf[w.start]].astype(np.uint64) << np.uint64(4) | _KIND[w.buf[w.end - 1]].astype(np.uint64) << np.uint64(8)
    shape |= same.astype(np.uint64) << np.uint64(12)
    shape = mix(shape + np.uint64(1))
    rest = w.rest()
    placed = []
    for n in (1, 2, 3):
        g = grams(shape, n)
        placed.append(np.where(rest[: len(g)] >= n, g >> np.uint64(64 - 18), SPACE).astype(np.int64))
    seen = np.zeros(SPACE + 1, bool)
    for d, t in enumerate(texts):
        _bytes(t, seen)
        a, b = w.first[d], w.first[d + 1]
        for p in placed:
            seen[p[a : min(b, len(p))]] = True
        seen[SPACE] = False
        at = np.flatnonzero(seen)
        seen[at] = False
        yield at


@dataclass(frozen=True)
class Model:
    """Weight of each feature, bias, and the logistic that turns margins into probabilities."""

    weight: np.ndarray
    bias: float
    slope: float
    offset: float

    def score(self, texts: list[bytes]) -> np.ndarray:
        margin = np.array([self.weight[at].sum(dtype=np.float64) / np.sqrt(max(len(at), 1)) for at in features(texts)])
        return 1.0 / (1.0 + np.exp(-np.clip(self.slope * (margin + self.bias) + self.offset, -30, 30)))


def _descend(rows: list[np.ndarray], values: list[np.ndarray], y: np.ndarray, cost: float, epochs: int, seed: int) -> tuple[np.ndarray, float]:
    """Dual coordinate descent for the L1-hinge loss; the bias is one more feature of value 1."""
    rng = np.random.default_rng(seed)
    w, bias = np.zeros(SPACE), 0.0
    dual = np.zeros(len(rows))
    norm = np.array([float(v @ v) + 1.0 for v in values])
    for _ in range(epochs):
        moved = 0.0
        for i in rng.permutation(len(rows)):
            at, v = rows[i], values[i]
            slope = y[i] * (float(w[at] @ v) + bias) - 1.0
            new = min(max(dual[i] - slope / norm[i], 0.0), cost)
            step = (new - dual[i]) * y[i]
            if step:
                dual[i] = new
                w[at] += step * v
                bias += step
                moved = max(moved, abs(step))
        if moved < 1e-2:
            break
    return w, bias


def _logistic(margin: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset by Newton steps, with smoothed targets."""
    pos = int((y > 0).sum())
    t = np.where(y > 0, (pos + 1) / (pos + 2), 1 / (len(y) - pos + 2))
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * margin + b, -30, 30)))
        g = np.array([((p - t) * margin).sum(), (p - t).sum()])
        q = p * (1 - p)
        hess = np.array([[(q * margin * margin).sum() + 1e-6, (q * margin).sum()], [(q * margin).sum(), q.sum() + 1e-6]])
        da, db = np.linalg.solve(hess, g)
        a, b = a - da, b - db
        if abs(da) + abs(db) < 1e-7:
            break
    return float(a), float(b)


def fit(texts: list[bytes], labels: np.ndarray) -> Model:
    """Fit on texts and their labels 0 or 1, in the order given."""
    return _fit([at.astype(np.int32) for at in features(texts)], labels)


def _fit(rows: list[np.ndarray], labels: np.ndarray) -> Model:
    y = np.where(np.asarray(labels) == 1, 1.0, -1.0)
    if not len(y) or abs(y.sum()) == len(y):
        share = 0.5 if not len(y) else float((y > 0).mean())
        share = min(max(share, 1e-6), 1 - 1e-6)
        return Model(np.zeros(SPACE, np.float32), 0.0, 0.0, float(np.log(share / (1 - share))))
    counts = {s: np.full(SPACE, SMOOTH) for s in (1.0, -1.0)}
    for at, s in zip(rows, y, strict=True):
        counts[s][at] += 1
    ratio = np.log(counts[1.0] / counts[1.0].sum()) - np.log(counts[-1.0] / counts[-1.0].sum())
    values = [ratio[at] / np.sqrt(max(len(at), 1)) for at in rows]
    fold = np.arange(len(rows)) % FOLDS
    margin = np.zeros(len(rows))
    for k in range(FOLDS):
        there = np.flatnonzero(fold != k)
        w, bias = _descend([rows[i] for i in there], [values[i] for i in there], y[there], COST, EPOCHS, k)
        for i in np.flatnonzero(fold == k):
            margin[i] = float(w[rows[i]] @ values[i]) + bias
    slope, offset = _logistic(margin, y)
    w, bias = _descend(rows, values, y, COST, EPOCHS, FOLDS)
    return Model((w * ratio).astype(np.float32), bias, slope, offset)


def _features(part: pa.RecordBatch, texts: list[bytes]) -> pa.RecordBatch:
    found = [at.astype("<i4").tobytes() for at in features(texts)]
    return pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("label"), pa.array(found, pa.binary())], names=["doc_id", "label", "places"])


def _fit_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[tuple[int, int, bytes]] = []
    for batch in batches:
        held += zip(*(batch.column(c).to_pylist() for c in ("doc_id", "label", "places")), strict=True)
    held.sort()
    m = _fit([np.frombuffer(x, "<i4") for _, _, x in held], np.array([y for _, y, _ in held]))
    del held
    trim()
    yield pa.RecordBatch.from_arrays([pa.array([m.weight.tobytes()]), *(pa.array([x]) for x in (m.bias, m.slope, m.offset))], names=["weight", "bias", "slope", "offset"])


def held_out(doc_id: F.Column) -> F.Column:
    """Rows that never train: CRC-32 of the id as text is a multiple of 5."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", most: int = MOST) -> Model:
    """A model of ``labels[label]``, from at most ``most`` rows that aren't held out."""
    rows = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label"))
    rows = rows.filter(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & ~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("label").alias("label"))
    sample = rows.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)  # the bound that makes it fit to broadcast
    found = arrow_map(texts_of(docs).join(F.broadcast(sample), "doc_id"), _features, "doc_id long, label int, places binary")
    one = found.groupBy("doc_id", "label").agg(F.min("places").alias("places"))  # at most ``most`` rows
    got = one.repartition(1).mapInArrow(_fit_rows, "weight binary, bias double, slope double, offset double").first()
    if got is None:
        return fit([], np.zeros(0))
    return Model(np.frombuffer(bytes(got["weight"]), np.float32), got["bias"], got["slope"], got["offset"])


def with_score(docs: DataFrame, model: Model, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """``docs`` and the probability of label 1 for each whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            done = [pa.array(shared.value.score(part)) for _, part in slices([pa.RecordBatch.from_arrays([texts], names=["text"])])]
            yield pa.concat_arrays(done) if done else pa.array([], pa.float64())
        trim()

    return docs.withColumn(score_col, score(F.coalesce(F.col(text_col).cast("string"), F.lit(""))))


def predicted(score: F.Column) -> F.Column:
    return (score >= THRESHOLD).cast("int")
