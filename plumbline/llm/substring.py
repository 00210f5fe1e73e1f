"""Substring dedup with suffix automata of reference shards (operator 4).

A window is ``WINDOW`` consecutive words of one document. Every word is removed that lies in
a window whose word sequence also starts in a document with a smaller doc_id.

The reference is the whole corpus, so its automata have no size bound and can't be broadcast
to every document. They are cut into shards that documents visit instead: each window is
named by its anchor, the smallest hash among the word grams in it. Equal windows have equal
anchors, so a run of windows with one anchor (a segment) only has to meet the segments of
the same anchor. Per anchor:

* segments are streamed in order of doc_id through a suffix automaton of those before them;
  matching statistics of ``WINDOW`` words or more are the removed spans; then the segment
  joins the automaton, unless all of it is there already;
* where more than ``HOT`` segments have the anchor, those of equal content are first folded
  to one, owned by the smallest doc_id; the other carriers are covered as a whole;
* where more than ``HOT`` are left after that (a passage quoted in very many documents),
  they are not put into one task: their windows are aggregated by their own hashes, with
  partial minima on the map side, which gives the same spans.

Null and empty texts, and texts shorter than a window, lose nothing. Rows with a null doc_id
are neither searched nor used as reference. Rows that repeat a doc_id count as one document:
they are no reference of each other, and each loses what its own text shares with smaller
doc_ids. An empty table gives no rows; other columns are not read.
"""

from __future__ import annotations


from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.shared import arrow_map, drop, slices, table, texts_of, trim
from plumbline.llm.words import Words, covered, grams, mix, runs, window_min

WINDOW, GRAM, HOT = 50, 16, 500
#: Windows of a segment; longer runs of one anchor (a word over and over) are cut, which parts no window.
MOST_WINDOWS = 256
_POWER = np.uint64(0xD6E8FEB86659FD93)
_SEGMENT = "anchor long, content long, doc_id long, row long, start int, n int"
#: A class of segments: those of one anchor that are judged as one.
_CLASS = ["anchor", "content", "who"]
_RUNS = "array<struct<skip:int,n:int>>"


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def _segments(part: pa.RecordBatch, texts: list[bytes]) -> pa.RecordBatch | None:
    """Runs of windows with one anchor: where they start and how many windows they have."""
    w = Words(texts)
    h = w.hashes()
    anchor = window_min(grams(h, GRAM), WINDOW - GRAM + 1)
    at = np.flatnonzero(w.rest()[: len(anchor)] >= WINDOW)
    if not len(at):
        return None
    doc, anchor, whole = w.doc[at], anchor[at], grams(h, WINDOW)[at]
    begin = runs(np.concatenate(([True], (doc[1:] != doc[:-1]) | (anchor[1:] != anchor[:-1]))))
    nth = np.arange(len(at)) - np.repeat(begin, np.diff(np.append(begin, len(at))))
    begin = np.flatnonzero(nth % MOST_WINDOWS == 0)
    size = np.diff(np.append(begin, len(at)))
    power = np.cumprod(np.full(MOST_WINDOWS, _POWER))
    content = mix(np.add.reduceat(whole * power[nth % MOST_WINDOWS], begin) + size.astype(np.uint64))
    ids, rows = (part.column(i).take(pa.array(doc[begin])) for i in ("doc_id", "row"))
    start = at[begin] - w.first[doc[begin]]
    return pa.RecordBatch.from_arrays([_signed(anchor[begin]), _signed(content), ids, rows, pa.array(start.astype(np.int32)), pa.array(size.astype(np.int32))], names=["anchor", "content", "doc_id", "row", "start", "n"])


class Automaton:
    """Suffix automaton of the word sequences added so far."""

    def __init__(self) -> None:
        self.next: list[dict[int, int]] = [{}]
        self.link, self.size = [-1], [0]

    def _state(self, size: int, link: int, moves: dict[int, int]) -> int:
        self.next.append(moves)
        self.link.append(link)
        self.size.append(size)
        return len(self.size) - 1

    def _split(self, p: int, c: int, q: int) -> int:
        """The state of p's longest word with c; a copy of q where q has longer words, too."""
        if self.size[q] == self.size[p] + 1:
            return q
        copy = self._state(self.size[p] + 1, self.link[q], dict(self.next[q]))
        self.link[q] = copy
        while p >= 0 and self.next[p].get(c) == q:
            self.next[p][c] = copy
            p = self.link[p]
        return copy

    def add(self, words: list[int]) -> None:
        last, nxt, link, size = 0, self.next, self.link, self.size
        for c in words:
            q = nxt[last].get(c)
            if q is not None:  # an earlier sequence went this way
                last = self._split(last, c, q)
                continue
            new, p = self._state(size[last] + 1, 0, {}), last
            while p >= 0 and c not in nxt[p]:
                nxt[p][c] = new
                p = link[p]
            if p >= 0:
                link[new] = self._split(p, c, nxt[p][c])
            last = new

    def matches(self, words: list[int], least: int) -> list[int]:
        """Starts of the stretches of ``least`` words that some added sequence has (from its matching statistics)."""
        nxt, link, size = self.next, self.link, self.size
        at, length, out = 0, 0, []
        for i, c in enumerate(words):
            while at and c not in nxt[at]:
                at = link[at]
                length = size[at]
            to = nxt[at].get(c)
            at, length = (0, 0) if to is None else (to, length + 1)
            if length >= least:
                out.append(i + 1 - least)
        return out


def _spans(starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ascending places -> runs (first, count)."""
    begin = runs(np.concatenate(([True], np.diff(starts) != 1)))
    return starts[begin], np.diff(np.append(begin, len(starts)))


def _stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Segments sorted by (anchor, doc_id, content, who) -> the windows of each that an earlier document of its anchor has."""
    shard, anchor, doc, waiting, before = Automaton(), None, None, [], None
    for batch in batches:
        out: list[tuple[int, int, int, list[dict]]] = []
        for a, content, who, d, words in zip(*(batch.column(c).to_pylist() for c in (*_CLASS, "doc_id", "words")), strict=True):
            if (a, content, who) == before:  # of a row that repeats
                continue
            before = (a, content, who)
            if a != anchor:
                shard, anchor, doc, waiting = Automaton(), a, d, []
            if d != doc:  # segments of one document are not references of each other
                for x in waiting:
                    shard.add(x)
                doc, waiting = d, []
            seq = np.frombuffer(words, np.int64).tolist()
            found = shard.matches(seq, WINDOW) if len(shard.size) > 1 else []
            if found:
                out.append((a, content, who, [{"skip": x, "n": n} for x, n in zip(*(y.tolist() for y in _spans(np.array(found))), strict=True)]))
            if len(found) < len(seq) - WINDOW + 1:
                waiting.append(seq)
        if out:
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.struct([("skip", pa.int32()), ("n", pa.int32())])))
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True), kinds, strict=True)], names=[*_CLASS, "runs"])


def _contents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, row, text, segs) -> the word hashes of each segment; of rows that repeat, each task takes one."""
    seen: set[tuple[int, int]] = set()
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.binary())
    for part, texts in slices(batches):
        w = Words(texts)
        h = w.hashes().view(np.int64)
        rows: list[list] = [[] for _ in kinds]
        for i, (doc, row, segs) in enumerate(zip(*(part.column(c).to_pylist() for c in ("doc_id", "row", "segs")), strict=True)):
            if (doc, row) in seen:
                continue
            seen.add((doc, row))
            for s in segs:
                at = w.first[i] + s["start"]
                for to, x in zip(rows, (*(s[c] for c in _CLASS), doc, s["hot"], h[at : at + s["n"] + WINDOW - 1].tobytes()), strict=True):
                    to.append(x)
        if rows[0]:
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(rows, kinds, strict=True)], names=[*_CLASS, "doc_id", "hot", "words"])
    trim()


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Segments with their word hashes -> one row per window, named by two hashes."""
    for batch in batches:
        held: list[list[np.ndarray]] = []
        for *of, words in zip(*(batch.column(c).to_pylist() for c in (*_CLASS, "doc_id", "words")), strict=True):
            seq = np.frombuffer(words, np.uint64)
            one = grams(seq, WINDOW)
            held.append([one.view(np.int64), grams(mix(seq), WINDOW).view(np.int64), *(np.full(len(one), x) for x in of), np.arange(len(one))])
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*held, strict=True)], names=["one", "two", *_CLASS, "doc_id", "skip"])


def _folded(skips: F.Column) -> F.Column:
    """Ascending places -> their runs."""

    def of(begins: F.Column) -> F.Column:
        end = lambda r: F.coalesce(F.get(begins, r + 1), F.size(skips))
        return F.transform(begins, lambda i, r: F.struct(F.get(skips, i).cast("int").alias("skip"), (end(r) - i).alias("n")))

    begins = F.filter(F.sequence(F.lit(0), F.size(skips) - 1), lambda i: ~F.get(skips, i - 1).eqNullSafe(F.get(skips, i) - 1))
    return F.get(F.transform(F.array(begins), of), F.lit(0))


def _rows_of(docs: DataFrame) -> DataFrame:
    """(doc_id, row, text); ``row`` tells rows of one doc_id apart by their text."""
    return texts_of(docs).withColumn("row", F.xxhash64("text"))


def repeated_spans(docs: DataFrame) -> DataFrame:
    """(doc_id, row, spans): from word ``start`` on, ``n`` windows that a document with a smaller doc_id has, too.

    What is joined is a table first, so that each side of a join is dealt out anew and AQE can split a hot key.
    """
    texts = _rows_of(docs).filter("doc_id is not null")
    segments = table(arrow_map(texts, _segments, _SEGMENT), "segments")
    shared = segments.groupBy("anchor").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b"), F.count("*").alias("c")).filter("a < b")
    shared = table(shared.select("anchor", (F.col("c") > HOT).alias("folds")), "anchors")
    who = F.when(F.col("folds"), F.lit(0).cast("long")).otherwise(F.xxhash64("doc_id", "row")).alias("who")
    found = table(segments.join(shared, "anchor").select("anchor", "content", who, "doc_id", "row", "start", "n"), "shared-segments")
    drop(segments, shared)
    classes = found.groupBy(*_CLASS).agg(F.min(F.struct("doc_id", "row", "start", "n")).alias("o"), F.max("doc_id").alias("last"))
    classes = table(classes.select(*_CLASS, "o.*", "last"), "classes")
    sizes = table(classes.groupBy("anchor").agg(F.count("*").alias("k")).filter("k > 1").select("anchor", (F.col("k") > HOT).alias("hot")), "shards")
    listed = classes.join(sizes, "anchor").groupBy("doc_id", "row").agg(F.collect_list(F.struct(*_CLASS, "start", "n", "hot")).alias("segs"))
    words = "anchor long, content long, who long, doc_id long, hot boolean, words binary"
    content = table(texts.join(listed, ["doc_id", "row"]).mapInArrow(_contents, words), "segment-words")
    drop(sizes)
    streamed = content.filter("not hot").repartition("anchor").sortWithinPartitions("anchor", "doc_id", "content", "who").mapInArrow(_stream, f"anchor long, content long, who long, runs {_RUNS}")
    windows = content.filter("hot").mapInArrow(_windows, "one long, two long, anchor long, content long, who long, doc_id long, skip long")
    first = table(windows.groupBy("one", "two").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most")).filter("least < most").drop("most"), "windows")
    counted = windows.join(first, ["one", "two"]).filter("least < doc_id").groupBy(*_CLASS).agg(F.sort_array(F.collect_set("skip")).alias("skips"))
    runs_of = streamed.unionByName(counted.select(*_CLASS, _folded(F.col("skips")).alias("runs")))
    judged = classes.select(*_CLASS, F.col("doc_id").alias("owner"), "last").join(runs_of, _CLASS, "left").filter("last > owner or runs is not null")
    judged = table(judged.drop("last"), "judged")
    drop(content, first, classes)
    copied = F.array(F.struct("start", "n"))
    own = F.transform("runs", lambda r: F.struct((F.col("start") + r["skip"]).alias("start"), r["n"].alias("n")))
    spans = found.join(judged, _CLASS).select("doc_id", "row", F.when(F.col("doc_id") > F.col("owner"), copied).otherwise(own).alias("part"))
    spans = table(spans.filter("part is not null").groupBy("doc_id", "row").agg(F.flatten(F.collect_set("part")).alias("spans")), "spans")
    drop(found, judged)
    return spans


def _cut(part: pa.RecordBatch, texts: list[bytes]) -> pa.RecordBatch:
    """(doc_id, text, spans) -> the words that stay."""
    w = Words(texts)
    start, size = [], []
    for i, spans in enumerate(part.column("spans").to_pylist()):
        for s in spans or ():
            start.append(w.first[i] + s["start"])
            size.append(s["n"] + WINDOW - 1)
            assert s["start"] + size[-1] <= w.count[i], "a span of another text"
    gone = covered(len(w.start), np.array(start, np.int64), np.array(size, np.int64)) if start else np.zeros(len(w.start), bool)
    kept = []
    for i, t in enumerate(texts):
        words = t.split()
        lost = gone[w.first[i] : w.first[i + 1]]
        kept.append(b" ".join([x for x, y in zip(words, lost.tolist(), strict=True) if not y] if lost.any() else words).decode("utf-8", "replace"))
    removed = np.bincount(w.doc, gone, len(texts)).astype(np.int64)
    return pa.RecordBatch.from_arrays([part.column(0), pa.array(w.count.astype(np.int64)), pa.array(removed), pa.array(kept)], names=["doc_id", "n_words", "n_removed", "kept"])


def remove_repeats(docs: DataFrame) -> DataFrame:
    """Per document: n_words, n_removed, and ``kept``, the words that stay, joined by one space."""
    return arrow_map(_rows_of(docs).join(repeated_spans(docs), ["doc_id", "row"], "left"), _cut, "doc_id long, n_words long, n_removed long, kept string")
