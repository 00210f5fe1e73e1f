"""Text predicates and projections of the funnel, as column expressions."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from plumbline.functions.automaton import phrase_hits
from plumbline.functions.lexicon import AUDIENCES, QUESTION_STARTERS, QUESTION_WORDS, phrases

MIN_LEN, MAX_LEN, LONG_MIN, TRANSCRIPT_MAX = 80, 4000, 300, 20000



def stripped(c: Column) -> Column:
    """Without white space on either side, line breaks included."""
    return F.btrim(c, F.lit(" \t\n\r\x0b\x0c"))


def title_body(title: Column, body: Column) -> Column:
    """Title, a space, body; nulls as empty, so the space always counts in the length."""
    return F.concat(F.coalesce(title, F.lit("")), F.lit(" "), F.coalesce(body, F.lit("")))


def squeezed(text: Column) -> Column:
    """Lower case with white space collapsed; null as empty."""
    return F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"\s+", " ")


def length_gate(text: Column, low: int = MIN_LEN, high: int = MAX_LEN) -> Column:
    return F.char_length(text).between(low, high)


def lexicon_hits(text: Column, words: Sequence[str] | None = None, squeeze: bool = False) -> Column:
    """Phrases found in the text: on the raw lower-case text as listed (those of the lexicon with longer ones first), or sorted on the squeezed text."""
    hits = phrase_hits(squeezed(text) if squeeze else F.lower(text), phrases() if words is None else words)
    if squeeze:
        return F.array_sort(F.array_distinct(hits))
    return hits if words is not None else longest_first(hits)


def longest_first(texts: Column) -> Column:
    """Longer texts before shorter ones, equally long ones by name."""
    keyed = F.array_sort(F.transform(texts, lambda p: F.struct((-F.char_length(p)).alias("n"), p.alias("p"))))
    return F.transform(keyed, lambda s: s["p"])


def has_phrase(text: Column, words: Sequence[str] | None = None) -> Column:
    """Any phrase is in the squeezed text."""
    listed = phrases() if words is None else words
    return F.size(phrase_hits(squeezed(text), listed)) > 0 if listed else F.lit(False)


def _java_quote(text: str) -> str:
    return re.sub(r"([\\.\[\]{}()*+?^$|#&~-])", r"\\\1", text)


def starts_question(text: Column, starters: Sequence[str] | None = None) -> Column:
    """A starter at the text's start, after a sentence end and white space, or after a line break; no word end is asked for."""
    joined = "|".join(map(_java_quote, QUESTION_STARTERS if starters is None else starters))
    if not joined:
        return F.lit(False)
    return F.lower(text).rlike(rf"(?i)(^|[.!?]\s+|\n\s*)({joined})")


def question_shape(text: Column, starters: Sequence[str] | None = None, words: Sequence[str] | None = None) -> Column:
    """On squeezed text: a starter at a sentence boundary, ending at a word end, or a question mark with a question word."""
    low = squeezed(text)
    joined = "|".join(map(_java_quote, QUESTION_STARTERS if starters is None else starters))
    asks = F.contains(low, F.lit("?")) & low.rlike("|".join(map(_java_quote, QUESTION_WORDS if words is None else words)))
    return (low != "") & (low.rlike(rf"(?:^|[.!?\n]\s*)(?:{joined})\b") | asks)


def keep(text: Column, matched: Column, question: Column | None, long_min: int = LONG_MIN, high: int = MAX_LEN) -> Column:
    """Lexicon, question shape (where asked for) or length; engagement never gates."""
    long_text = F.char_length(text).between(long_min, high)
    return (matched | question | long_text) if question is not None else (matched | long_text)


def audience(text: Column, keywords: Mapping[str, Sequence[str]] | None = None) -> Column:
    """The audience with most keywords in the text; ties go to the one listed first; none found is null."""
    low = F.lower(text)
    named = AUDIENCES if keywords is None else keywords
    counts = {k: F.size(F.filter(F.array(*map(F.lit, v)), lambda w: F.instr(low, w) > 0)) for k, v in named.items()}
    votes = F.array(*(F.struct(n.alias("n"), F.lit(-i).alias("first"), F.lit(k).alias("name")) for i, (k, n) in enumerate(counts.items())))
    best = F.array_max(votes)
    return F.when(best["n"] > 0, best["name"])


def rating_score(rating: Column) -> Column:
    """The leading digits as a number: 4.35 is 4, and what begins with anything else is null."""
    return F.nullif(F.regexp_replace(F.coalesce(rating, F.lit("")), "(?s)[^0-9].*$", ""), F.lit("")).try_cast("bigint")


def guarded_time(value: Column, fallback: Column) -> Column:
    """The value as a timestamp if it begins with a date, else the fallback."""
    return F.when(value.rlike(r"^\d{4}-\d{2}-\d{2}"), F.coalesce(value.try_cast("timestamp"), fallback)).otherwise(fallback)


def topic_slug(topic: Column) -> Column:
    """Lower case, dashes and spaces as underscores, the rest of the punctuation dropped, at most 60 characters."""
    return F.substring(F.regexp_replace(F.translate(F.lower(F.coalesce(topic, F.lit(""))), "- ", "__"), "[^a-z0-9_]", ""), 1, 60)


def rollup_topic(topic: Column) -> Column:
    """The roll-up's own normal form: each run of other characters is one underscore."""
    return F.lower(F.regexp_replace(topic, "[^a-zA-Z0-9]+", "_"))


def diagnose(text: Column, words: Sequence[str] | None = None, starters: Sequence[str] | None = None, long_min: int = LONG_MIN) -> Column:
    """Which paths would keep a text: up to three phrases, question shape, length; or none."""
    hits = lexicon_hits(text, words, squeeze=True)
    long_text = F.char_length(F.coalesce(text, F.lit("")))
    flags = F.array_compact(
        F.array(
            F.when(F.size(hits) > 0, F.concat(F.lit("lexicon:"), F.array_join(F.slice(hits, 1, 3), ","))),
            F.when(question_shape(text, starters), F.lit("question-shape")),
            F.when(long_text >= long_min, F.concat(F.lit("long("), long_text.cast("string"), F.lit(")"))),
        )
    )
    return F.when(F.size(flags) > 0, flags).otherwise(F.array(F.lit("NO-PATH")))


def snippet(text: Column, width: int = 280, mark: str = " …") -> Column:
    """White space collapsed, cut at a word's end so that text and mark have at most ``width`` characters."""
    flat = F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"\s+", " "))
    head = F.substring(flat, 1, width - len(mark) + 1)
    cut = F.regexp_replace(head, r"\s?\S*$", "")
    return F.when(F.char_length(flat) <= width, flat).otherwise(F.concat(cut, F.lit(mark)))


def priority(score: Column, dup_count: Column) -> Column:
    """Rank key of a signal."""
    return (F.greatest(F.coalesce(score, F.lit(0)), F.lit(0)) + 1) * dup_count


def content_hash(body: Column) -> Column:
    return F.sha2(F.coalesce(body, F.lit("")), 256)
