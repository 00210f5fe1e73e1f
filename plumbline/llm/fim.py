"""Fill-in-middle transformation in Spark SQL functions alone (operator 11).

A text is cut into units (by default lines with their breaks), and two cuts between units,
drawn from the row's key, part it into prefix, middle and suffix. The parts are put in order
behind sentinels: ``psm`` is prefix, suffix, middle; ``spm`` is suffix, prefix, middle. Which
rows are arranged, and how, is drawn from the key as well, so a run can be repeated on any
number of executors and rows need no shuffle.

Draws are 32-bit groups of the hex SHA-256 of ``seed:key``; a number modulo n + 1 is a place
between n units. A text stays plain if it is empty, if it holds a sentinel, or if its draw
isn't under ``rate``. ``restored`` parses the sentinels and gives the text back, exactly,
since no part can hold one, nor can a part and a sentinel make another where they meet:
a sentinel begins with its only ``<`` and ends with its only ``>``.

Null texts count as empty. A null key draws as an empty one. Repeated rows and ties (rows of
one key) are cut alike where they have as many units. Texts of any length are cut whole. An
empty table gives no rows. The columns made replace columns of the same name; ``arranged``
keeps no others than those that ``keep`` names.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNITS = r"[^\n]*\n|[^\n]+"
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
_ANY = "<[PSM]>"
PLAIN, PSM, SPM = "plain", "psm", "spm"


def draw(key: Column, seed: int, nth: int) -> Column:
    """The nth group of eight hex digits of the key's hash, as a number."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256)
    return F.conv(F.substring(digest, 8 * nth - 7, 8), 16, 10).cast("long")


def _joined(units: str, first: Column, last: Column) -> Column:
    """Units from place ``first`` up to place ``last``."""
    return F.array_join(F.slice(F.col(units), first + 1, last - first), "")


def arranged(docs: DataFrame, seed: int, rate: int = 100, spm: int = 50, id_col: str = "doc_id", text_col: str = "text", keep: Sequence[str] = ()) -> DataFrame:
    """Per row: the id, n units, form, prefix, middle and suffix (null if plain), and output.

    Of each 100 rows about ``rate`` are arranged, of those ``spm`` suffix first.
    """
    key, text = F.col(id_col), F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(*dict.fromkeys((id_col, *keep)), text.alias("_fim_text"), *(draw(key, seed, i).alias(f"_fim_{i}") for i in (1, 2, 3, 4)))
    rows = rows.withColumn("_fim_units", F.regexp_extract_all("_fim_text", F.lit(UNITS), 0))
    rows = rows.withColumn("n", F.size("_fim_units").cast("long"))
    one, two = (F.col(f"_fim_{i}") % (F.col("n") + 1) for i in (1, 2))
    rows = rows.withColumns({"_fim_a": F.least(one, two).cast("int"), "_fim_b": F.greatest(one, two).cast("int")})
    plain = (F.col("_fim_text") == "") | F.col("_fim_text").rlike(_ANY) | (F.col("_fim_3") % 100 >= rate)
    rows = rows.withColumn("form", F.when(plain, PLAIN).when(F.col("_fim_4") % 100 < spm, SPM).otherwise(PSM))
    a, b = F.col("_fim_a"), F.col("_fim_b")
    part = lambda first, last: F.when(F.col("form") != PLAIN, _joined("_fim_units", first, last))
    rows = rows.withColumns({"prefix": part(F.lit(0), a), "middle": part(a, b), "suffix": part(b, F.col("n").cast("int"))})
    output = F.when(F.col("form") == PSM, F.concat(F.lit(PREFIX), "prefix", F.lit(SUFFIX), "suffix", F.lit(MIDDLE), "middle"))
    output = output.when(F.col("form") == SPM, F.concat(F.lit(SUFFIX), "suffix", F.lit(PREFIX), "prefix", F.lit(MIDDLE), "middle"))
    rows = rows.withColumn("output", output.otherwise(F.col("_fim_text")))
    return rows.drop("_fim_text", "_fim_units", "_fim_a", "_fim_b", *(f"_fim_{i}" for i in (1, 2, 3, 4)))


def restored(output: Column, form: Column) -> Column:
    """The text from its arrangement: what follows each sentinel, in the order of the text."""
    parts = F.split(output, _ANY, -1)
    of = {PSM: (1, 3, 2), SPM: (2, 3, 1)}
    whole = lambda order: F.concat(*(F.get(parts, i) for i in order))
    return F.when(form == PSM, whole(of[PSM])).when(form == SPM, whole(of[SPM])).otherwise(output)


def oracle(seed: int, rate: int, spm: int) -> str:
    """DuckDB SQL for the digests of ``arranged`` over the table documents."""
    number = lambda i: f"('0x' || substr(h, {8 * i - 7}, 8))::bigint"
    return f"""with t as (select doc_id, coalesce(text, '') as t, sha256('{seed}:' || coalesce(doc_id::varchar, '')) as h from documents),
u as (select *, regexp_extract_all(t, '[^\\n]*\\n|[^\\n]+') as u from t),
c as (select *, len(u) as n, least({number(1)} % (len(u) + 1), {number(2)} % (len(u) + 1)) as a, greatest({number(1)} % (len(u) + 1), {number(2)} % (len(u) + 1)) as b from u),
f as (select *, case when t = '' or contains(t, '{PREFIX}') or contains(t, '{SUFFIX}') or contains(t, '{MIDDLE}') or {number(3)} % 100 >= {rate} then '{PLAIN}'
  when {number(4)} % 100 < {spm} then '{SPM}' else '{PSM}' end as form,
  array_to_string(u[1:a], '') as p, array_to_string(u[a + 1:b], '') as m, array_to_string(u[b + 1:], '') as s from c)
select doc_id, n, form, case when form <> '{PLAIN}' then length(p) end as prefix_chars, case when form <> '{PLAIN}' then length(m) end as middle_chars,
  sha256(case form when '{PSM}' then '{PREFIX}' || p || '{SUFFIX}' || s || '{MIDDLE}' || m when '{SPM}' then '{SUFFIX}' || s || '{PREFIX}' || p || '{MIDDLE}' || m else t end) as output_sha256,
  sha256(t) as restored_sha256 from f"""
