"""DuckDB SQL that says what operators 4 and 10 say, over the table documents (one row per doc_id)."""

from __future__ import annotations

from plumbline.llm.repetition import BASE_N, BASE_WORDS, COVERAGE, LINES
from plumbline.llm.substring import WINDOW

_WORDS = r"w as (select doc_id, text, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') as ws from documents)"
_EACH = "each as (select doc_id, unnest(range(1, len(ws) + 1)) as p, unnest(ws) as x from w)"


def _grams(name: str, n: int) -> str:
    """Windows of n words: (doc_id, i, h)."""
    return f"{name} as (select doc_id, i, md5(array_to_string(ws[i:i + {n - 1}], ' ')) as h from (select doc_id, ws, unnest(range(1, len(ws) - {n - 2})) as i from w where len(ws) >= {n}))"


OP4 = f"""with {_WORDS}, {_EACH}, {_grams("win", WINDOW)},
least_ as (select h, min(doc_id) as d from win group by h),
gone as (select distinct doc_id, unnest(range(i, i + {WINDOW})) as p from win join least_ using (h) where d < doc_id)
select w.doc_id, count(each.p) as n_words, count(gone.p) as n_removed,
  sha256(coalesce(string_agg(case when gone.p is null then x end, ' ' order by each.p), '')) as kept_sha256
from w left join each on w.doc_id = each.doc_id left join gone on gone.doc_id = each.doc_id and gone.p = each.p group by w.doc_id"""

_LENGTHS = (BASE_N, *COVERAGE)
_COVERS = ",\n".join(
    f"""{_grams(f"g{n}", n)},
c{n} as (select distinct doc_id, unnest(range(i, i + {n})) as p from (select *, count(*) over (partition by doc_id, h) as k from g{n}) where k > 1),
s{n} as (select doc_id, count(*) as words, sum(length(x)) as chars from c{n} join each using (doc_id, p) group by 1)"""
    for n in _LENGTHS
)
_JOINS = " ".join(f"left join s{n} on s{n}.doc_id = w.doc_id" for n in _LENGTHS)
_SHARES = ", ".join(f"coalesce(s{n}.chars, 0)::double / greatest(total, 1) as share_{n}" for n in COVERAGE)
_BAD = " or ".join(f"share_{n} > {most}" for n, most in COVERAGE.items())
OP10 = rf"""with {_WORDS}, {_EACH}, {_COVERS},
lines as (select doc_id, unnest(range(1, len(l) + 1)) as p, unnest(l) as line from (select doc_id, string_split(coalesce(text, ''), chr(10)) as l from documents)),
dup as (select doc_id, count(*) as n, sum(length(regexp_replace(line, '[\x20\x09-\x0D]+', '', 'g'))) as chars
  from (select *, row_number() over (partition by doc_id, line order by p) as k from lines where regexp_matches(line, '[^\x20\x09-\x0D]')) where k > 1 group by 1),
size as (select doc_id, count(*) as n, sum(length(x)) as total from each group by 1),
m as (select w.doc_id, coalesce(size.n, 0) as n_words, coalesce(total, 0)::bigint as word_chars, len(regexp_extract_all(coalesce(text, ''), '[#*$%&|<>]')) as n_symbols,
  coalesce(dup.n, 0) as n_dup_lines, coalesce(s{BASE_N}.words, 0) as n_repeat_words, coalesce(dup.chars, 0)::double / greatest(coalesce(total, 0), 1) as dup_line_share, {_SHARES}
  from w left join size on size.doc_id = w.doc_id left join dup on dup.doc_id = w.doc_id {_JOINS})
select *, n_words < {BASE_WORDS} or 100 * n_repeat_words > 50 * n_words as base_failed,
  not (n_words < {BASE_WORDS} or 100 * n_repeat_words > 50 * n_words) and not (dup_line_share > {LINES} or {_BAD}) as kept from m"""
