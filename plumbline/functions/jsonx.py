"""JSON in prose, shallow merges and tolerant coercions, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def json_in_prose(text: Column) -> Column:
    """From the first brace to the last, else from the first bracket to the last; null where neither is."""
    braces = F.regexp_extract(text, r"(?s)\{.*\}", 0)
    brackets = F.regexp_extract(text, r"(?s)\[.*\]", 0)
    outer = F.when(F.instr(text, "[").between(F.lit(1), F.instr(text, "{") - 1) & (brackets != ""), brackets)  # a list of objects is taken whole
    return F.coalesce(outer, F.nullif(braces, F.lit("")), F.nullif(brackets, F.lit("")))


def shallow_merge(old: Column, new: Column) -> Column:
    """Top-level keys of both, the new one's values on top. Nested values stay JSON text."""
    pairs = lambda c: F.coalesce(F.from_json(c, "map<string,string>"), F.create_map().cast("map<string,string>"))
    merged = F.map_concat(F.map_filter(pairs(old), lambda k, _: ~F.map_contains_key(pairs(new), k)), pairs(new))
    return F.when(old.isNull() & new.isNull(), None).otherwise(F.to_json(F.map_from_entries(F.array_sort(F.map_entries(merged)))))


def clamp_int(value: Column, low: int, high: int, default: int) -> Column:
    """A whole number in bounds; decimals are cut, and what is no number is the default."""
    return F.least(F.lit(high), F.greatest(F.lit(low), F.coalesce(value.try_cast("double").cast("int"), F.lit(default))))


def clamp_score(value: Column, high: float = 5.0) -> Column:
    return F.least(F.lit(high), F.greatest(F.lit(0.0), F.coalesce(value.try_cast("double"), F.lit(0.0))))


def text_list(value: Column) -> Column:
    """JSON text of null, one string or a list -> list of strings; a blank string is an empty list."""
    text = F.trim(value)
    empty = F.array().cast("array<string>")
    as_list = F.from_json(text, "array<string>")
    one = F.when(F.startswith(text, F.lit('"')), F.get_json_object(F.concat(F.lit('{"v":'), text, F.lit("}")), "$.v")).otherwise(text)
    return F.when(text.isNull() | (text == "null"), empty).when(F.startswith(text, F.lit("[")), F.coalesce(as_list, empty)).when(F.trim(one) == "", empty).otherwise(F.array(one))


def id_list(value: Column) -> Column:
    """JSON text of a number, a comma list or an array -> the whole numbers in it; others are skipped."""
    inner = F.regexp_replace(F.coalesce(value, F.lit("")), r'[\[\]"]', "")
    parts = F.transform(F.split(inner, ","), lambda p: F.trim(p).try_cast("double").cast("bigint"))
    return F.filter(parts, lambda x: x.isNotNull())
