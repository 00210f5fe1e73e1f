"""Order MinHash document fingerprints, in DataFrame functions alone (operator 8).

A text's k-mers are its runs of ``K`` words (a shorter text is one k-mer). Each k-mer is
numbered by its occurrence in the text, so that repeats count. The hash of a numbered k-mer
puts it in one of ``BINS`` bins; of each bin the ``PICKS`` with the smallest hashes are
selected, put back into text order, and hashed as a tuple. The tuples of the bins are the
fingerprint: moving a passage changes it, as it changes the edit distance.

Likeness of two fingerprints: bins with equal tuples, as a share of the bins that either has.
Two empty fingerprints are alike (1.0), an empty one and another are not (0.0).

Null and empty texts, and texts of white space, have empty fingerprints. Equal texts have
equal fingerprints. The next document is that of the next row by (doc_id, hash of the text),
so rows that repeat a doc_id follow each other; null ids come first; after the last row comes
the first, and a single row follows itself. An empty table gives no rows; other columns are
not read.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.llm.shared import range_count, table, texts_of

K, BINS, PICKS = 5, 32, 2


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _bin(h: Column) -> Column:
    return F.shiftrightunsigned(h, 64 - 5)


def _smallest(keys: Column) -> Column:
    """Of ascending keys, the first ``PICKS`` of each bin."""
    return F.filter(keys, lambda x, i: ~_bin(x["h"]).eqNullSafe(_bin(F.get(keys, i - PICKS)["h"])))


def _key(h: Column, place: Column) -> Column:
    """A k-mer's hash, then its place in the text."""
    return F.struct(h.alias("h"), place.alias("place"))


_KEYS = "array<struct<h:bigint,place:int>>"


def _kmers(words: Column) -> Column:
    n = F.size(words)
    whole = F.transform(F.slice(words, F.lit(1), F.greatest(n - (K - 1), F.lit(1))), lambda w, i: _key(F.xxhash64(w, *(F.get(words, i + j) for j in range(1, K))), i))
    return F.when(n == 0, F.array().cast(_KEYS)).otherwise(F.sort_array(whole))


def _numbered(keys: Column) -> Column:
    """Ascending k-mers -> the selected numbered ones: a first occurrence goes by its k-mer's hash, later ones by (hash, number)."""

    def renamed(again: Column) -> Column:
        """Ascending keys of second and later occurrences -> keys by hash and number."""
        begins = F.filter(F.sequence(F.lit(0), F.size(again) - 1), lambda i: ~F.get(again, i)["h"].eqNullSafe(F.get(again, i - 1)["h"]))

        def numbers(at: Column) -> Column:
            stop = lambda r: F.coalesce(F.get(at, r + 1), F.size(again))
            return F.flatten(F.transform(at, lambda i, r: F.transform(F.slice(again, i + 1, stop(r) - i), lambda k, j: _key(F.xxhash64(k["h"], j + 2), k["place"]))))

        return F.when(F.size(again) == 0, F.array().cast(_KEYS)).otherwise(_let(begins, numbers))

    firsts = F.filter(keys, lambda x, i: ~x["h"].eqNullSafe(F.get(keys, i - 1)["h"]))
    again = F.filter(keys, lambda x, i: x["h"].eqNullSafe(F.get(keys, i - 1)["h"]))
    more = _let(F.sort_array(_let(again, renamed)), _smallest)
    return _let(F.sort_array(F.concat(_let(firsts, _smallest), more)), _smallest)


def _tuples(keys: Column) -> Column:
    """One long for each bin that has k-mers: the bin, then 32 bits of the tuple in text order."""

    def tuple_of(i: Column) -> Column:
        own = F.filter(F.slice(keys, i + 1, F.lit(PICKS)), lambda k: _bin(k["h"]) == _bin(F.get(keys, i)["h"]))
        placed = F.sort_array(F.transform(own, lambda k: F.struct(k["place"].alias("place"), k["h"].alias("h"))))
        hashed = _let(placed, lambda p: F.xxhash64(*(F.get(p, F.lit(j))["h"] for j in range(PICKS))))
        return F.shiftleft(_bin(F.get(keys, i)["h"]), 32).bitwiseOR(hashed.bitwiseAND((1 << 32) - 1))

    begins = F.filter(F.transform(keys, lambda k, i: F.when(~_bin(k["h"]).eqNullSafe(_bin(F.get(keys, i - 1)["h"])), i)), lambda i: i.isNotNull())
    return F.transform(begins, tuple_of)


def signature(text: Column) -> Column:
    """The fingerprint as an array of longs, ascending by bin."""
    words = F.filter(F.split(text, "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    return _let(words, lambda w: _let(_kmers(w), lambda k: _let(_numbered(k), _tuples)))


def as_text(sig: Column) -> Column:
    """The fingerprint as hex digits: two for the bin and eight for the tuple."""
    return F.array_join(F.transform(sig, lambda x: F.lpad(F.lower(F.hex(x)), 10, "0")), "")


def likeness(a: Column, b: Column) -> Column:
    bins = lambda s: F.transform(s, lambda x: F.shiftright(x, 32))
    either = F.size(F.array_union(bins(a), bins(b)))
    return F.when(either == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / either)


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, text, signature) of each row."""
    return texts_of(docs).withColumn("signature", signature(F.col("text")))


def _place_of() -> Column:
    """Where a row stands in the order of documents, as a struct without nulls."""
    return F.struct(F.col("doc_id").isNotNull().alias("known"), F.coalesce("doc_id", F.lit(0)).alias("id"), F.col("row"))


def _dealt(rows: DataFrame) -> DataFrame:
    """Rows with (bucket, late): ranges between sampled quantiles of their place, each followed (late) by the first rows of the next.

    The ranges' heads are looked up in two steps, as in a book: the square root of their number is a literal, and as many
    for each of those are joined by broadcast. So they cost 25 bytes for each range.
    """
    n = range_count(rows)
    places = table(rows.select(_place_of().alias("place")), "places")
    heads = places.repartitionByRange(n, "place").groupBy(F.spark_partition_id().alias("p")).agg(F.min("place").alias("head"))
    # One row per range.
    heads = table(heads.select("head", (F.row_number().over(Window.orderBy("head")) - 1).alias("b")), "heads")
    step = math.isqrt(n - 1) + 1
    pages = [tuple(r["head"]) for r in heads.filter(F.col("b") % step == 0).orderBy("b").collect()]
    last = heads.count() - 1
    if last < 0:
        return rows.withColumn("bucket", F.lit(0)).withColumn("late", F.lit(0))
    lines = heads.groupBy((F.col("b") / step).cast("int").alias("page")).agg(F.sort_array(F.collect_list("head")).alias("heads"))
    upto = lambda heads, place: F.size(F.filter(heads, lambda h: h <= place)) - 1
    book = F.array(*(F.struct(F.lit(known).alias("known"), F.lit(i).cast("long").alias("id"), F.lit(h).cast("long").alias("row")) for known, i, h in pages))
    found = rows.withColumn("place", _place_of()).withColumn("page", upto(book, F.col("place"))).join(F.broadcast(lines), "page")
    found = found.withColumn("line", upto(F.col("heads"), F.col("place")))
    bucket = F.col("page") * step + F.col("line")
    first = F.get("heads", F.col("line")) == F.col("place")
    to = lambda b, late: F.struct(b.cast("int").alias("bucket"), F.lit(late).alias("late"))
    before = F.when(bucket == 0, to(F.lit(last), 2)).otherwise(to(bucket - 1, 1))
    dealt = found.select("doc_id", "row", "text", "signature", F.explode(F.when(first, F.array(to(bucket, 0), before)).otherwise(F.array(to(bucket, 0)))).alias("to"))
    return dealt.select("doc_id", "row", "text", "signature", "to.bucket", "to.late")


def with_next(docs: DataFrame) -> DataFrame:
    """(doc_id, text, signature) of each row, and next_text, next_signature of the row that follows by (doc_id, hash of the text).

    Each text is shuffled once, after its fingerprint is made; the first rows of a bucket are also sent to the one before.
    """
    rows = texts_of(docs).withColumn("row", F.xxhash64("text")).withColumn("signature", signature(F.col("text")))
    order = Window.partitionBy("bucket").orderBy("late", "doc_id", "row", "text")
    following = _dealt(rows).withColumn("next_text", F.lead("text").over(order)).withColumn("next_signature", F.lead("signature").over(order))
    return following.filter("late = 0").select("doc_id", "text", "signature", "next_text", "next_signature")


def edited(text: Column, following: Column) -> Column:
    """The last half of ``text``'s code points replaced by as many of the beginning of ``following``."""
    half = F.floor(F.char_length(text) / 2).cast("int")
    return F.concat(F.left(text, F.char_length(text) - half), F.left(following, half))
