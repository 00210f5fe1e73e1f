"""Vectors as arrays of floats."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine_distance(a: Column, b: Column) -> Column:
    return F.lit(1.0) - dot(a, b) / (norm(a) * norm(b))


def truncate(a: Column, dims: int = 256) -> Column:
    """The first dimensions, at length one again; a zero vector stays zero."""
    head = F.transform(F.slice(a, 1, dims), lambda x: x.cast("double"))
    return F.transform(F.array(head), lambda v: F.transform(v, lambda x: F.when(norm(v) > 0, x / norm(v)).otherwise(x)))[0]


def parse(text: Column) -> Column:
    """'[1,2,3]' -> array of floats."""
    return F.from_json(text, "array<float>")


def literal(a: Column) -> Column:
    return F.concat(F.lit("["), F.array_join(F.transform(a, lambda x: x.cast("string")), ","), F.lit("]"))
