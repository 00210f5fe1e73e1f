"""Mixing sources to target weights by hierarchical budgeting, in DataFrame functions alone (operator 3).

Documents hang on a tree of domain, language and source; each node has a whole weight. A
budget of tokens flows down the tree. At each node it is shared among the children by
weight; a child that can't use its share (its tokens, ``max_epochs`` times over, are fewer)
is filled and what it leaves goes to its siblings, by weight again. As a node's capacity is
that of all leaves below it, a shortage is made up among siblings before it reaches the
ancestors' siblings. All sums are exact whole numbers; what division leaves over goes to the
first children by name, one token each, so every node's budget is spent in full.

A leaf with a budget of q whole passes over its tokens and a rest takes each document q
times, one per epoch, and of the next epoch the longest prefix within the rest. The order of
an epoch is that of md5(seed:epoch:doc_id). The prefix is found from sums over hash ranges
of the leaf, about the square root of its documents in number, so that no task orders a large
leaf; what is left of it is one row per leaf: its whole passes and the last hash that it takes.

Null domains, languages and sources count as ''. Null and empty texts have no tokens: they
cost nothing and come with the prefix they stand in; a leaf without tokens takes each of its
documents once. A null doc_id is ordered as ''. Rows that repeat a doc_id share their place
and go together. Weights that are missing, or less than one, are one. An empty table gives
no rows; other columns are kept by ``mix``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.llm.shared import drop, spare, table

LEVELS = ("domain", "lang", "source")
_BIG = "decimal(38,0)"


def tokens_of(text: Column) -> Column:
    """Words of the text, as an estimate of its tokens."""
    return F.coalesce(F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("long")


def domain_of(source: Column) -> Column:
    """Default domain: the number at the end of the source's name, modulo 4."""
    number = F.try_to_number(F.nullif(F.regexp_extract(source, "([0-9]{1,9})$", 1), F.lit("")), F.lit("999999999"))
    return F.coalesce(F.concat(F.lit("domain"), (number.cast("long") % 4).cast("string")), F.lit(""))


def _weight(name: Column, weights: dict[str, int]) -> Column:
    out = F.lit(1)
    for k, w in sorted(weights.items(), reverse=True):
        out = F.when(name == k, max(int(w), 1)).otherwise(out)
    return out.cast(_BIG)


def _share(children: DataFrame, parent: tuple[str, ...], name: str) -> DataFrame:
    """Rows (.., name, cap, w, budget of the parent) -> the budget of each child."""
    order = Window.partitionBy(*parent).orderBy(F.col("cap") / F.col("w"), name) if parent else Window.orderBy(F.col("cap") / F.col("w"), name)
    whole = Window.partitionBy(*parent) if parent else Window.partitionBy(F.lit(0))
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    rows = children.withColumn("cap_before", F.coalesce(F.sum("cap").over(before), F.lit(0)).cast(_BIG)).withColumn("w_rest", (F.sum("w").over(whole) - F.coalesce(F.sum("w").over(before), F.lit(0))).cast(_BIG))
    full = (F.col("budget") - F.col("cap_before")).cast("decimal(20,0)") * F.col("w").cast("decimal(12,0)") >= F.col("cap").cast("decimal(20,0)") * F.col("w_rest").cast("decimal(12,0)")
    rows = rows.withColumn("filled", full)
    rows = rows.withColumn("left", (F.col("budget") - F.coalesce(F.sum(F.when(F.col("filled"), F.col("cap"))).over(whole), F.lit(0))).cast("decimal(20,0)"))
    rows = rows.withColumn("w_left", F.sum(F.when(~F.col("filled"), F.col("w"))).over(whole).cast("decimal(12,0)"))
    rows = rows.withColumn("part", F.when(~F.col("filled"), F.expr("(left * cast(w as decimal(12,0))) div w_left").cast(_BIG)))
    over = F.col("left") - F.sum("part").over(whole)
    named = Window.partitionBy(*parent, "filled").orderBy(name)
    more = F.when(F.row_number().over(named) <= over, 1).otherwise(0)  # less than the child's capacity: it isn't filled
    budget = F.when(F.col("filled"), F.col("cap")).otherwise(F.col("part") + more).cast(_BIG)
    return rows.withColumn("budget", budget).drop("cap_before", "w_rest", "filled", "left", "w_left", "part")


def budgets(leaves: DataFrame, weights: dict[str, dict[str, int]], target: Column, max_epochs: int) -> DataFrame:
    """(domain, lang, source, tokens) -> the same and the budget of each leaf. ``target`` is an aggregate over the leaves."""
    caps = leaves.withColumn("cap", (F.col("tokens") * max_epochs).cast(_BIG))
    root = leaves.agg(F.least(target.cast("long"), F.sum("tokens") * max_epochs).cast(_BIG).alias("budget"))
    above: tuple[str, ...] = ()
    now = root
    for level in LEVELS:
        below = (*above, level)
        children = caps.groupBy(*below).agg(F.sum("cap").cast(_BIG).alias("cap")).withColumn("w", _weight(F.col(level), weights.get(level, {})))
        joined = children.join(now, list(above)) if above else children.crossJoin(F.broadcast(now))  # the root is one row
        now = _share(joined, above, level).select(*below, "budget")
        above = below
    return leaves.join(now, list(LEVELS)).withColumn("budget", F.col("budget").cast("long"))


def _key(seed: int, epoch: Column) -> Column:
    return F.md5(F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"))


def plan(slim: DataFrame, weights: dict[str, dict[str, int]], seed: int, share: float, max_epochs: int) -> DataFrame:
    """(doc_id, domain, lang, source, n_tokens) -> per leaf: tokens, budget, whole passes ``full``, and the last hash taken of the next."""
    # Hex digits of the hash ranges: 16^digits is about the root of the leaf's documents.
    digits = F.greatest(F.lit(1), F.ceil(F.log(F.count("*").cast("double")) / (2 * math.log(16)))).cast("int")
    leaves = slim.groupBy(*LEVELS).agg(F.sum("n_tokens").alias("tokens"), digits.alias("digits"))
    leaf = budgets(leaves, weights, F.floor(F.sum("tokens") * F.lit(share)), max_epochs)
    full = F.when(F.col("tokens") == 0, 1).otherwise(F.expr("budget div greatest(tokens, 1)")).cast("int")
    leaf = leaf.withColumn("full", full).withColumn("rest", F.when(F.col("tokens") == 0, 0).otherwise(F.col("budget") % F.greatest("tokens", F.lit(1))))
    leaf = table(leaf, "mix-leaves")
    open_ = leaf.filter("rest > 0").select(*LEVELS, "full", "rest", "digits")
    rows = slim.join(open_, list(LEVELS)).withColumn("key", _key(seed, F.col("full") + 1)).withColumn("range", F.substring("key", F.lit(1), F.col("digits")))
    sums = rows.groupBy(*LEVELS, "range").agg(F.sum("n_tokens").alias("n"), F.max("rest").alias("rest"), F.max("key").alias("last"))
    along = Window.partitionBy(*LEVELS).orderBy("range")
    sums = table(sums.withColumn("after", F.sum("n").over(along)).withColumn("before", F.col("after") - F.col("n")), "mix-ranges")
    # In the one range that the rest ends in, documents are ordered one by one.
    cut = sums.filter("before <= rest and after > rest").select(*LEVELS, "range", "before")
    inside = rows.join(cut, [*LEVELS, "range"]).withColumn("upto", F.col("before") + F.sum("n_tokens").over(Window.partitionBy(*LEVELS, "range").orderBy("key")))
    lasts = inside.filter("upto <= rest").select(*LEVELS, F.col("key").alias("last")).unionByName(sums.filter("after <= rest").select(*LEVELS, "last"))
    lasts = lasts.groupBy(*LEVELS).agg(F.max("last").alias("last"))
    out = table(leaf.join(lasts, list(LEVELS), "left"), "mix-plan")
    drop(leaf, sums)
    return out


def mix(docs: DataFrame, weights: dict[str, dict[str, int]], seed: int = 0, share: float = 1.0, max_epochs: int = 2, domain: Column | None = None, with_leaf: bool = False) -> DataFrame:
    """The documents selected, all columns; a document of several epochs comes once for each.

    ``share``: the target, as a share of all tokens. ``with_leaf`` gives doc_id, the leaf, ``epoch`` and ``n_tokens`` instead.
    """
    name = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    leaf_of = {"domain": name(domain_of(F.col("source")) if domain is None else domain), "lang": name(F.col("lang")), "source": name(F.col("source"))}
    slim = table(docs.select(F.col("doc_id").cast("long").alias("doc_id"), *(c.alias(k) for k, c in leaf_of.items()), tokens_of(F.col("text")).alias("n_tokens")), "mix-tokens")
    own = {x: spare(docs, f"_{x}") for x in (*LEVELS, "full", "last", "epoch")}
    leaf = plan(slim, weights, seed, share, max_epochs).select(*(F.col(x).alias(own[x]) for x in (*LEVELS, "full", "last")))
    copies = F.col(own["full"]) + F.when(_key(seed, F.col(own["full"]) + 1) <= F.col(own["last"]), 1).otherwise(0)
    if with_leaf:
        on = [F.col(x) == F.col(own[x]) for x in LEVELS]
        return slim.join(leaf, on).filter(copies > 0).withColumn("epoch", F.explode(F.sequence(F.lit(1), copies))).select("doc_id", *LEVELS, "epoch", "n_tokens")
    on = [c == F.col(own[k]) for k, c in leaf_of.items()]
    chosen = docs.join(leaf, on).filter(copies > 0)
    return chosen.select(*(F.col(f"`{c}`") for c in docs.columns), F.explode(F.sequence(F.lit(1), copies)).alias(own["epoch"])).drop(own["epoch"])


def oracle(weights: dict[str, dict[str, int]], seed: int, share: float, max_epochs: int) -> str:
    """DuckDB SQL for ``mix(with_leaf=True)`` over the table documents."""

    def case(level: str) -> str:
        whens = " ".join(f"when {level} = '{k}' then {max(int(w), 1)}" for k, w in sorted(weights.get(level, {}).items()))
        return f"(case {whens} else 1 end)::hugeint" if whens else "1::hugeint"

    parts, above, up = [], [], "root"
    for level in LEVELS:
        below = [*above, level]
        cols, part = ", ".join(below), f"partition by {', '.join(above)}" if above else ""
        using = f"join {up} using ({', '.join(above)})" if above else f"cross join {up}"
        parts.append(
            f"""c_{level} as (select {cols}, sum(tokens)::hugeint * {max_epochs} as cap, {case(level)} as w from leaves group by all),
o_{level} as (select *, coalesce(sum(cap) over (ord rows between unbounded preceding and 1 preceding), 0)::hugeint as cap_before,
  (sum(w) over (grp) - coalesce(sum(w) over (ord rows between unbounded preceding and 1 preceding), 0))::hugeint as w_rest
  from c_{level} {using} window ord as ({part} order by cap / w, {level}), grp as ({part})),
f_{level} as (select *, (budget - cap_before) * w >= cap * w_rest as filled from o_{level}),
l_{level} as (select *, (budget - coalesce(sum(case when filled then cap end) over (grp), 0))::hugeint as left_,
  case when not filled then ((budget - coalesce(sum(case when filled then cap end) over (grp), 0)::hugeint) * w) // (sum(case when not filled then w end) over (grp))::hugeint end::hugeint as share_
  from f_{level} window grp as ({part})),
b_{level} as (select {cols}, (case when filled then cap else share_ + case when row_number() over ({part}{"," if part else "partition by"} filled order by {level}) <= left_ - sum(share_) over ({part}) then 1 else 0 end end)::hugeint as budget from l_{level})"""
        )
        above, up = below, f"b_{level}"
    return f"""with docs as (select doc_id, coalesce('domain' || (try_cast(nullif(regexp_extract(source, '([0-9]{{1,9}})$', 1), '') as bigint) % 4)::varchar, '') as domain,
  coalesce(lang, '') as lang, coalesce(source, '') as source,
  coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::bigint as n_tokens from documents),
leaves as (select domain, lang, source, sum(n_tokens)::bigint as tokens from docs group by all),
root as (select least(floor(sum(tokens) * {share})::bigint, (sum(tokens) * {max_epochs})::bigint)::hugeint as budget from leaves),
{", ".join(parts)},
leaf as (select domain, lang, source, case when tokens = 0 then 1 else budget // greatest(tokens, 1) end::int as full_,
  case when tokens = 0 then 0 else budget % greatest(tokens, 1) end as rest from leaves join {up} using (domain, lang, source)),
keyed as (select docs.*, full_, rest, md5('{seed}:' || (full_ + 1)::varchar || ':' || coalesce(doc_id::varchar, '')) as key from docs join leaf using (domain, lang, source)),
cum as (select *, sum(n_tokens) over (partition by domain, lang, source order by key) as upto from keyed),
copies as (select *, full_ + case when rest > 0 and upto <= rest then 1 else 0 end as n from cum)
select doc_id, domain, lang, source, unnest(generate_series(1, n))::int as epoch, n_tokens from copies where n > 0"""
