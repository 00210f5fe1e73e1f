"""Full-text matching by stems and positions: an English stemmer, stop words, phrase queries.

The stemmer follows the published English (Porter2) algorithm. Stop words keep their position,
so a phrase matches across them only where the text has as many words in between.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

from plumbline.functions.slices import in_slices

# The English stop words of the public full-text configuration.
STOP_WORDS = frozenset(
    """i me my myself we our ours ourselves you your yours yourself yourselves he him his himself she her hers herself it its itself
    they them their theirs themselves what which who whom this that these those am is are was were be been being have has had having
    do does did doing a an the and but if or because as until while of at by for with about against between into through during before
    after above below to from up down in out on off over under again further then once here there when where why how all any both each
    few more most other some such no nor not only own same so than too very s t can will just don should now""".split()
)
# Fixed values of the published algorithm: irregular words, suffix tables.
_SPECIAL = {
    "skis": "ski", "skies": "sky", "dying": "die", "lying": "lie", "tying": "tie", "idly": "idl", "gently": "gentl", "ugly": "ugli",
    "early": "earli", "only": "onli", "singly": "singl", "sky": "sky", "news": "news", "howe": "howe", "atlas": "atlas",
    "cosmos": "cosmos", "bias": "bias", "andes": "andes",
}
_STAY = frozenset("inning outing canning herring earring proceed exceed succeed".split())
_STEP2 = {
    "ization": "ize", "ational": "ate", "ousness": "ous", "iveness": "ive", "fulness": "ful", "tional": "tion", "biliti": "ble",
    "lessli": "less", "entli": "ent", "ation": "ate", "alism": "al", "aliti": "al", "fulli": "ful", "ousli": "ous", "iviti": "ive",
    "enci": "ence", "anci": "ance", "abli": "able", "izer": "ize", "ator": "ate", "alli": "al", "bli": "ble",
}
_STEP3 = {"ational": "ate", "tional": "tion", "alize": "al", "icate": "ic", "iciti": "ic", "ical": "ic", "ness": "", "ful": ""}
_STEP4 = ("ement", "ance", "ence", "able", "ible", "ment", "ant", "ent", "ism", "ate", "iti", "ous", "ive", "ize", "al", "er", "ic")
_VOWEL = "aeiouy"
_REGION = re.compile(r"[aeiouy][^aeiouy]")


def _regions(w: str) -> tuple[int, int]:
    first = re.match("gener|commun|arsen", w)
    if first:
        r1 = first.end()
    else:
        m = _REGION.search(w)
        r1 = m.end() if m else len(w)
    m = _REGION.search(w, r1)
    return r1, m.end() if m else len(w)


def _short_end(w: str) -> bool:
    return bool(re.search(r"[^aeiouy][aeiouy][^aeiouywxY]$", w) or re.fullmatch(r"[aeiouy][^aeiouy]", w))


def _suffix(w: str, table) -> str:
    return next((s for s in table if w.endswith(s)), "")


@lru_cache(200_000)
def stem(word: str) -> str:
    """The stem of a lower-case word."""
    if word in _SPECIAL:
        return _SPECIAL[word]
    if len(word) <= 2:
        return word
    w = re.sub(r"^y|(?<=[aeiouy])y", "Y", word.lstrip("'"))
    r1, r2 = _regions(w)
    w = re.sub("('s'|'s|')$", "", w)
    if w.endswith("sses"):
        w = w[:-2]
    elif w.endswith(("ied", "ies")):
        w = w[:-2] if len(w) > 4 else w[:-1]
    elif w.endswith("s") and not w.endswith(("us", "ss")) and re.search(f"[{_VOWEL}]", w[:-2]):
        w = w[:-1]
    if w in _STAY:
        return w
    end = _suffix(w, ("eedly", "ingly", "edly", "eed", "ing", "ed"))
    if end in ("eedly", "eed"):
        if len(w) - len(end) >= r1:
            w = w[: -len(end)] + "ee"
    elif end and re.search(f"[{_VOWEL}]", w[: -len(end)]):
        w = w[: -len(end)]
        if w.endswith(("at", "bl", "iz")):
            w += "e"
        elif re.search(r"(bb|dd|ff|gg|mm|nn|pp|rr|tt)$", w):
            w = w[:-1]
        elif _short_end(w) and r1 >= len(w):
            w += "e"
    if len(w) > 2 and w[-1] in "yY" and w[-2] not in _VOWEL:
        w = w[:-1] + "i"
    end = _suffix(w, (*_STEP2, "ogi", "li"))
    if end and len(w) - len(end) >= r1:
        head = w[: -len(end)]
        if end == "ogi":
            w = w[:-1] if head.endswith("l") else w
        elif end == "li":
            w = head if head[-1:] and head[-1] in "cdeghkmnrt" else w
        else:
            w = head + _STEP2[end]
    end = _suffix(w, (*_STEP3, "ative"))
    if end and len(w) - len(end) >= r1:
        if end == "ative":
            w = w[:-5] if len(w) - 5 >= r2 else w
        else:
            w = w[: -len(end)] + _STEP3[end]
    end = _suffix(w, (*_STEP4, "ion"))
    if end and len(w) - len(end) >= r2 and (end != "ion" or w[-4:-3] in ("s", "t")):
        w = w[: -len(end)]
    if w.endswith("e"):
        if len(w) - 1 >= r2 or (len(w) - 1 >= r1 and not _short_end(w[:-1])):
            w = w[:-1]
    elif w.endswith("ll") and len(w) - 1 >= r2:
        w = w[:-1]
    return w.replace("Y", "y")


_WORD = re.compile(r"[^\W_]+")


def lexemes(text: str) -> list[tuple[str, int]]:
    """(stem, position) of each word that is no stop word; positions count all words from one."""
    return [(stem(w), i) for i, w in enumerate((m.group() for m in _WORD.finditer(text.lower())), 1) if w not in STOP_WORDS]


def compile_phrases(phrases: Sequence[str]) -> list[list[tuple[str, int]]]:
    """Each phrase as stems with their distance from its first one; phrases of stop words alone vanish."""
    out: list[list[tuple[str, int]]] = []
    for p in phrases:
        found = lexemes(p)
        if found:
            steps = [(s, i - found[0][1]) for s, i in found]
            if steps not in out:
                out.append(steps)
    return out


def matches(text: str | None, queries: list[list[tuple[str, int]]]) -> bool:
    if not text:
        return False
    places: dict[str, set[int]] = {}
    for s, i in lexemes(text):
        places.setdefault(s, set()).add(i)
    return any(any(all(i + d in places.get(s, ()) for s, d in q[1:]) for i in places.get(q[0][0], ())) for q in queries)


def full_text_match(text: Column, phrases: Sequence[str]) -> Column:
    """Any of the phrases, by stems and distances."""
    queries = compile_phrases(phrases)

    @F.arrow_udf("boolean")
    def match(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([matches(t, queries) for _, some in in_slices(batch) for t in some.to_pylist()], pa.bool_())

    return match(text)


def lexeme_places(texts: pa.Array, stemmed: bool) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(lexeme, row, position) of all words of some texts, in their order; texts that aren't stemmed have one space between words."""
    if stemmed:
        found = [lexemes(t or "") for t in texts.to_pylist()]
        row = np.repeat(np.arange(len(found)), [len(f) for f in found])
        words, places = pa.array([s for f in found for s, _ in f], pa.string()), np.array([i for f in found for _, i in f], np.int32)
        return words, row, places
    lists = pc.split_pattern(pc.fill_null(texts, ""), " ")
    count = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    row, words = np.repeat(np.arange(len(texts)), count), lists.flatten()
    places = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count) + 1
    there = pc.not_equal(words, "")  # an empty text is split into one empty word
    keep = there.to_numpy(zero_copy_only=False)
    return words.filter(there), row[keep], places[keep].astype(np.int32)


def grouped_places(words: pa.Array, row: np.ndarray, places: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray, pa.Array]:
    """(lexeme, row, how many places, places) of each lexeme of each row; a lexeme's rows follow each other."""
    coded = words.dictionary_encode()
    code = coded.indices.to_numpy(zero_copy_only=False)
    order = np.lexsort((places, row, code))
    code, row = code[order], row[order]
    first = np.flatnonzero(np.r_[True, (code[1:] != code[:-1]) | (row[1:] != row[:-1])]) if len(code) else np.zeros(0, np.int64)
    ends = np.r_[first, len(code)].astype(np.int32)
    return coded.dictionary.take(pa.array(code[first])), row[first], np.diff(ends), pa.ListArray.from_arrays(pa.array(ends), pa.array(places[order], pa.int32()))


def inverted_index(docs, key: str, text: str):
    """(lexeme, key, positions): a keyword index as a table, to be partitioned by lexeme when written."""
    kind = docs.schema[key].dataType.simpleString()

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, texts in in_slices(batch.column(1)):
                lexeme, row, _, places = grouped_places(*lexeme_places(texts, True))
                yield pa.RecordBatch.from_arrays([lexeme, batch.column(0).take(pa.array(row + at)), places], names=["lexeme", "key", "places"])

    rows = docs.select(key, text).mapInArrow(listed, f"lexeme string, key {kind}, places array<int>")
    return rows.groupBy("lexeme", F.col("key").alias(key)).agg(F.array_sort(F.flatten(F.collect_list("places"))).alias("positions"))
