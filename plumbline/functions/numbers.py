"""Numbers and dates as people and exports write them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def human_int(text: Column) -> Column:
    """'1.1K' is 1100, '800,000+' is 800000; what is no number is null. Halves go to the even neighbour."""
    plain = F.upper(F.trim(F.translate(text, ",+", "")))
    unit = F.right(plain, F.lit(1))
    times = F.when(unit == "K", 1_000.0).when(unit == "M", 1_000_000.0).when(unit == "B", 1_000_000_000.0)
    number = F.when(times.isNotNull(), F.expr("1") * F.substring(plain, F.lit(1), F.char_length(plain) - 1).try_cast("double") * times).otherwise(plain.try_cast("double"))
    return F.bround(number, 0).cast("bigint")


def money(text: Column) -> Column:
    """A number without thousands marks, currency or percent signs."""
    return F.trim(F.translate(text, ",$₹%", "")).try_cast("double")


def likes(text: Column) -> Column:
    """The count ahead of 'likes'."""
    return F.nullif(F.translate(F.regexp_extract(text, r"([0-9][0-9,]*)\s+likes?", 1), ",", ""), F.lit("")).try_cast("bigint")


def epoch_time(seconds: Column) -> Column:
    return F.timestamp_seconds(seconds.try_cast("bigint"))


def compact_date(text: Column) -> Column:
    """YYYYMMDD as the start of that day."""
    return F.try_to_timestamp(text.cast("string"), F.lit("yyyyMMdd"))


def date_in_name(name: Column) -> Column:
    """The first YYYY-MM-DD, YYYY_MM_DD or YYYYMMDD in a file name."""
    return F.regexp_replace(F.regexp_extract(name, r"(\d{4}[-_]?\d{2}[-_]?\d{2})", 1), "[-_]", "").try_cast("string").transform(lambda c: F.try_to_timestamp(F.nullif(c, F.lit("")), F.lit("yyyyMMdd")).cast("date"))
