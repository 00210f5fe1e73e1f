"""Seller report files and seed lists."""

from __future__ import annotations

import csv
import io
import json
from collections.abc import Iterator
from itertools import islice

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.functions.numbers import date_in_name, money
from plumbline.functions.text import stripped

_ROWS = 10_000

# Spellings of the report's columns.
ALIASES = {
    "asin": ["asin"],
    "title": ["title", "product name", "name"],
    "brand": ["brand"],
    "category": ["category", "category path"],
    "price": ["price", "current price"],
    "monthly_revenue": ["monthly revenue", "revenue", "parent revenue"],
    "monthly_units": ["monthly sales", "monthly units", "units sold", "sales"],
    "rating": ["rating", "ratings", "star"],
    "reviews": ["reviews", "review count", "ratings count", "num reviews"],
}


def _rows_of_files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole files -> their rows, each with its own file's header."""
    for batch in batches:
        for text, name in zip(*(batch.column(c).to_pylist() for c in ("value", "_file")), strict=True):
            rows = csv.reader(io.StringIO(text.lstrip("\ufeff"), newline=""))
            header = [c.strip() for c in next(rows, [])]
            at = {c.lower(): i for i, c in enumerate(header)}  # of columns alike, the last
            whole = (r + [None] * (len(header) - len(r)) for r in rows if r)
            while part := list(islice(whole, _ROWS)):
                cells = pa.array([[(c, r[i]) for c, i in at.items()] for r in part], pa.map_(pa.string(), pa.string()))
                raw = pa.array([json.dumps(dict(zip(header, r, strict=False)), ensure_ascii=False) for r in part])
                yield pa.RecordBatch.from_arrays([cells, raw, pa.array([name] * len(part))], names=["cells", "raw", "_file"])


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """Report files, each with a header of its own: (cells by lower-case column, raw, _file). A file is read as a whole."""
    files = spark.read.text(path, wholetext=True).select("value", F.col("_metadata.file_name").alias("_file"))
    return files.mapInArrow(_rows_of_files, "cells map<string,string>, raw string, _file string")


def seller_reports(rows: DataFrame, today: str) -> DataFrame:
    """Rows of report files into (report_type, asin, snapshot_date, ..); rows without an item are dropped.

    ``rows`` come from ``read_csv``, or have the report's columns themselves and ``_file``.
    """
    if "cells" not in rows.columns:
        own = [c for c in rows.columns if c != "_file"]
        cells = F.create_map(*(x for c in own for x in (F.lit(c.strip().lower()), F.col(f"`{c}`").cast("string"))))
        rows = rows.select(cells.alias("cells"), F.to_json(F.struct(*(F.col(f"`{c}`") for c in own))).alias("raw"), "_file")

    def pick(name: str) -> Column:
        """The first of the spellings that the row's file has."""
        found = F.lit(None).cast("string")
        for spelling in reversed(ALIASES[name]):
            found = F.when(F.map_contains_key("cells", spelling), F.col("cells")[spelling]).otherwise(found)
        return found

    name = F.regexp_replace("_file", r"\.csv$", "")
    kind = F.substring(F.array_join(F.filter(F.split(name, "-"), lambda p: ~p.rlike(r"^\d+$")), "-"), 1, 60)
    out = rows.select(
        F.coalesce(F.nullif(kind, F.lit("")), F.lit("report")).alias("report_type"), stripped(F.coalesce(pick("asin"), F.lit(""))).alias("asin"), F.coalesce(date_in_name(F.col("_file")), F.lit(today).cast("date")).alias("snapshot_date"),
        *(pick(c).alias(c) for c in ("title", "brand", "category")), *(money(pick(c)).alias(c) for c in ("price", "monthly_revenue", "monthly_units", "rating")),
        F.coalesce(money(pick("reviews")).cast("int"), F.lit(0)).alias("reviews"), "raw", F.col("_file").alias("source_file"),
    )
    return out.filter("asin <> ''")


def seed_ids(spark: SparkSession, path: str) -> DataFrame:
    """One id per line; blank lines and comments are skipped."""
    line = stripped(F.col("value"))
    return spark.read.text(path).select(line.alias("id")).filter((line != "") & ~F.startswith(line, F.lit("#"))).distinct()


def seed_target(seed: Column) -> Column:
    """What a seed names: a video by its id, a channel's page, or the address as it is."""
    return F.when(F.startswith(seed, F.lit("http")), seed).when(F.startswith(seed, F.lit("@")), F.concat(F.lit("https://www.youtube.com/"), seed, F.lit("/videos"))).when(seed.rlike("^UC[0-9A-Za-z_-]{22}$"), F.concat(F.lit("https://www.youtube.com/channel/"), seed, F.lit("/videos"))).otherwise(F.concat(F.lit("https://www.youtube.com/watch?v="), seed))
