"""Personal data by information-theoretic sanitisation (operator 6).

Base patterns find the protected entities: e-mail, IP, card and phone values. Corpus
co-occurrence then tells which terms reveal them. A term is a run of letters, digits and
characters beyond ASCII; it meets an entity when it stands in the same document, outside all
base spans. Over all documents, with c an entity and t a term,

    disclosure(c, t) = PMI(c, t) / IC(c) = log(N n(c,t) / (n(c) n(t))) / log(N / n(c))

which is 1 when t only ever occurs with c. A pair counts when ``SUPPORT`` different texts or
more have both, so exact copies of one text are no evidence and near copies are. Most values
are too rare for that, so c is also each class that a value belongs to: the name and the
domain of an e-mail, the network of an IP, the issuer of a card, the prefix of a phone, and
the kind itself. A pair also needs so many texts that chance would give an entity at most
``CHANCE`` of its terms, of all the terms that are tried (a bound on the tail, times their
number). The highest disclosure counts. From ``GENERALISE`` on the term is replaced by its kind,
from ``REMOVE`` on it is removed, wherever it stands in the documents that hold its entity.

What a pair scores follows from the sets of documents that have c and t alone. So entities
that stand in the same documents are one group, terms that do so another, and pairs are made
of groups: two copies of a directory make one pair, not one for each name and number.

Null and empty texts have no spans. Statistics are over documents (rows by doc_id); rows with
a null doc_id are searched for base spans but give no statistics and no terms. Rows that
repeat a doc_id are one document, which holds the entities of all of them; each row keeps its
own base spans and terms. An empty table gives no rows; other columns are kept by
``sanitise`` and not read by the rest.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.bits import bitmap, has
from plumbline.llm.shared import arrow_map, drop, slices, spare, table, texts_of, trim
from plumbline.llm.words import Words, covered, span_hashes

KINDS = ("email", "ip", "card", "phone")
SUPPORT, GENERALISE, REMOVE = 2, 0.7, 0.9
CHANCE = 0.05
_HELD = 1 << 20
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
#: A match can't begin inside a run of digits: it would have begun at the run's start.
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_TERM = re.compile(r"[A-Za-z0-9\x80-\U0010ffff]+")
_BETWEEN = np.ones(256, bool)
_BETWEEN[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """As the pattern would match from left to right; each run of local characters is walked once."""
    free, at = 0, text.find("@")
    while at >= 0:
        domain = _DOMAIN.match(text, at + 1) if at > free else None
        if domain:
            begin = at
            while begin > free and text[begin - 1] in _LOCAL:
                begin -= 1
            if begin < at:
                free = domain.end()
                yield begin, free
        at = text.find("@", at + 1)


def _luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _small(part: str) -> bool:
    return len(part := part.lstrip("0")) <= 3 and int(part or 0) <= 255


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points, by kind and then by start."""
    out = [("email", a, b) for a, b in _emails(text)]
    out += [("ip", *m.span()) for m in _IP.finditer(text) if all(map(_small, m.group().split(".")))]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13:
            digits = m.group().replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and _luhn(digits):
                out.append(("card", *m.span()))
    out += [("phone", *m.span()) for m in _PHONE.finditer(text) if 9 <= sum(map(str.isdigit, m.group())) <= 15]
    return out


def _plain(kind: str, value: str) -> str:
    return kind + ":" + (value.lower() if kind in ("email", "ip") else re.sub("[^0-9]", "", value))


def classes(kind: str, value: str) -> list[str]:
    """The value itself, then the classes that it belongs to, the kind last."""
    plain = _plain(kind, value)
    bare = plain[len(kind) + 1 :]
    wide = []
    if kind == "email":
        local, _, domain = bare.rpartition("@")
        name = re.sub("[^a-z]", "", local.partition("+")[0])
        wide = [f"name:{name}"] * bool(name) + [f"domain:{domain}"]
    elif kind == "ip":
        wide = [f"network:{bare.rpartition('.')[0]}"]
    elif kind == "card":
        wide = [f"issuer:{bare[:6]}"]
    elif kind == "phone":
        wide = [f"prefix:{bare[:-4]}"]
    return [plain, *wide, f"kind:{kind}"]


def _hash(items: list[str]) -> np.ndarray:
    """The hash that ``span_hashes`` gives to each item's bytes."""
    data = [x.encode() for x in items]
    end = np.cumsum([len(x) for x in data], dtype=np.int64) if data else np.zeros(0, np.int64)
    size = np.array([len(x) for x in data], np.int64)
    return span_hashes(np.frombuffer(b"".join(data) + bytes(16), np.uint8), end - size, end).view(np.int64)


_SPAN = "array<struct<kind:string,start:int,stop:int>>"
_OF = "array<struct<entity:long,wide:boolean>>"


def _find(part: pa.RecordBatch, texts: list[bytes]) -> pa.RecordBatch:
    found, held, kept = [], [], []
    for raw in texts:
        text = raw.decode()
        spans = base_spans(text)
        found.append([{"kind": k, "start": a, "stop": b} for k, a, b in spans])
        kept.append(text if spans else None)
        held.append(list(dict.fromkeys((c, i > 0) for k, a, b in spans for i, c in enumerate(classes(k, text[a:b])))))
    entity = iter(_hash([c for row in held for c, _ in row]).tolist())
    rows = [[{"entity": next(entity), "wide": wide} for _, wide in row] for row in held]
    span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("stop", pa.int32())]))
    of = pa.list_(pa.struct([("entity", pa.int64()), ("wide", pa.bool_())]))
    return pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("row"), pa.array(found, span), pa.array(rows, of), pa.array(kept, pa.string())], names=["doc_id", "row", "base", "of", "text"])


def row_of(text: F.Column) -> F.Column:
    """What tells rows of one doc_id apart, and texts from their copies."""
    return F.xxhash64(F.coalesce(text.cast("string"), F.lit("")))


def find_entities(docs: DataFrame) -> DataFrame:
    """Per row: its base spans, the entities that they are or belong to, and the text where there are any."""
    return arrow_map(texts_of(docs).withColumn("row", row_of(F.col("text"))), _find, f"doc_id long, row long, base {_SPAN}, of {_OF}, text string")


class _Outside:
    """Terms of texts outside their base spans: ``at`` are their places among all ``words``."""

    def __init__(self, part: pa.RecordBatch, texts: list[bytes]):
        self.words = w = Words([t.lower() for t in texts], _BETWEEN)
        begins = (w.buf[: len(w.data)] & 0xC0) != 0x80
        point = np.concatenate(([0], np.cumsum(begins)))  # code points before each byte
        base = part.column(part.schema.get_field_index("base"))
        spans = base.flatten()
        which = np.repeat(np.arange(len(texts)), pc.list_value_length(base).to_numpy(zero_copy_only=False))
        first = point[w.begin[:-1]]
        low, high = (spans.field(f).to_numpy() + first[which] for f in ("start", "stop"))
        inside = np.concatenate(([0], np.cumsum(covered(int(point[-1]), low, high - low))))
        start, stop = point[w.start], point[w.end]
        self.at = np.flatnonzero(inside[stop] == inside[start])
        self.hash = w.hashes()
        self.start, self.stop = start - first[w.doc], stop - first[w.doc]


def _terms(part: pa.RecordBatch, texts: list[bytes]) -> pa.RecordBatch | None:
    """Each term of a text once."""
    o = _Outside(part, texts)
    if not len(o.at):
        return None
    h, d = o.hash[o.at], o.words.doc[o.at]
    order = np.lexsort((h, d))
    h, d = h[order], d[order]
    once = np.append(True, (h[1:] != h[:-1]) | (d[1:] != d[:-1]))
    ids, rows = (part.column(c).take(pa.array(d[once])) for c in ("doc_id", "row"))
    return pa.RecordBatch.from_arrays([ids, rows, pa.array(h[once].view(np.int64))], names=["doc_id", "row", "term"])


def _places(bits: np.ndarray, part: pa.RecordBatch, texts: list[bytes]) -> pa.RecordBatch:
    """Every place of the terms whose bit is set."""
    o = _Outside(part, texts)
    at = o.at[has(bits, o.hash[o.at])]
    ids, rows = (part.column(c).take(pa.array(o.words.doc[at])) for c in ("doc_id", "row"))
    return pa.RecordBatch.from_arrays([ids, rows, pa.array(o.hash[at].view(np.int64)), pa.array(o.start[at].astype(np.int32)), pa.array(o.stop[at].astype(np.int32))], names=["doc_id", "row", "term", "start", "stop"])


def _summed(term: list[np.ndarray], n: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Each term once, with the sum of its numbers."""
    terms, at = np.unique(np.concatenate(term), return_inverse=True)
    return terms, np.bincount(at, weights=np.concatenate(n)).astype(np.int64)


def _term_counts(bits: np.ndarray, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of a task that have a term, of the terms whose bit is set; slices are summed up to ``_HELD`` terms."""
    term: list[np.ndarray] = []
    count: list[np.ndarray] = []

    def given() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(term[0].view(np.int64)), pa.array(count[0])], names=["term", "n"])

    for _, texts in slices(batches):
        w = Words([t.lower() for t in texts], _BETWEEN)
        h = w.hashes()
        at = np.flatnonzero(has(bits, h))
        if not len(at):
            continue
        h, d = h[at], w.doc[at]
        order = np.lexsort((d, h))
        h, d = h[order], d[order]
        once = np.append(True, (h[1:] != h[:-1]) | (d[1:] != d[:-1]))
        term.append(h[once])
        count.append(np.ones(len(term[-1]), np.int64))
        if sum(map(len, term)) > _HELD:
            term[:], count[:] = ([x] for x in _summed(term, count))
            if len(term[0]) > _HELD // 2:
                yield given()
                term.clear()
                count.clear()
    if term:
        term[:], count[:] = ([x] for x in _summed(term, count))
        yield given()
    trim()


def unlikely(support: F.Column, n_class: F.Column, n_term: F.Column, n: float, tried: int) -> F.Column:
    """Whether so many texts with both are more than chance gives: Chernoff's bound of the tail for a term strewn over ``n`` documents, for ``tried`` terms."""
    mean = n_class * n_term / F.lit(n)
    bound = support * F.log(support / mean) - support + mean
    return (support > mean) & (bound >= F.lit(np.log(max(tried, 1) / CHANCE)))


def _holders(found: DataFrame) -> DataFrame:
    """The rows that can give evidence: those with an id and a base span."""
    return found.filter("doc_id is not null and text is not null")


def _members(found: DataFrame) -> DataFrame:
    """(doc_id, entity, wide), each once."""
    return _holders(found).select("doc_id", F.explode("of").alias("x")).select("doc_id", "x.entity", "x.wide").distinct()


def _group(*ids: str) -> tuple[F.Column, F.Column]:
    """Two sums by which sets of rows are told apart."""
    return F.sum(F.xxhash64(*ids).cast("decimal(38,0)")).alias("s"), F.bit_xor(F.xxhash64(*ids, F.lit(7))).alias("x")


@dataclass
class Disclosure:
    """Pairs of groups over the lower threshold, and who is in a group."""

    flagged: DataFrame  # (entities, terms, disclosure)
    entity_groups: DataFrame  # (entity, entities)
    holders: DataFrame  # (doc_id, entities)
    term_groups: DataFrame  # (term, terms)


def disclosing_groups(docs: DataFrame, found: DataFrame) -> Disclosure:
    """The pairs of groups of entities and of terms that exceed the lower threshold.

    Pairs are made only of groups that can still pass: n(c,t) is at most n(c), and at most the number of
    documents that have t and any entity; either bounds n(t).
    """
    ids = texts_of(docs).filter("doc_id is not null")
    n = float(ids.select("doc_id").distinct().count())
    members = table(_members(found), "pii-members")
    sizes = members.groupBy("entity", "wide").agg(F.count("*").alias("n_entity"), *_group("doc_id")).filter((F.col("n_entity") >= SUPPORT) & (F.col("n_entity") < n))
    sizes = table(sizes.select("entity", "n_entity", F.xxhash64("n_entity", "s", "x").alias("entities")), "pii-entities")
    holders = table(members.join(sizes, "entity").select("doc_id", "entities").distinct(), "pii-holders")
    least = F.pow(F.col("n_entity") / F.lit(n), F.lit(1 - GENERALISE))  # of the documents of a term, the share that must hold the entity
    groups = sizes.groupBy("entities").agg(F.first("n_entity").alias("n_entity")).withColumn("least", least * (1 - 1e-9)).withColumn("most", F.col("n_entity") / F.col("least"))
    groups = table(groups, "pii-entity-groups")
    bound = groups.agg(F.min("least"), F.max("most")).first()
    least, most = bound[0] or 1.0, bound[1] or 0.0
    words = table(arrow_map(_holders(found).select("doc_id", "row", "base", "text"), _terms, "doc_id long, row long, term long"), "pii-words")
    often = words.groupBy("term").agg(F.count_distinct("row").alias("n"), F.count("*").alias("held"), *_group("doc_id", "row")).filter(F.col("n") >= SUPPORT)
    often = table(often.drop("n"), "pii-terms-held")
    bits = docs.sparkSession.sparkContext.broadcast(bitmap(often, "term"))
    counts = ids.mapInArrow(lambda batches: _term_counts(bits.value, batches), "term long, n long").groupBy("term").agg(F.sum("n").alias("n_term"))
    # Where rows repeat a doc_id the count of a term may exceed its documents, which lowers the disclosure.
    rare = often.join(counts, "term").filter(F.col("n_term").between(SUPPORT, most) & (F.col("held") >= F.col("n_term") * least))
    rare = table(rare.select("term", "n_term", "held", F.xxhash64("n_term", "held", "s", "x").alias("terms")), "pii-terms")
    tried = rare.count()
    of = words.join(rare, "term").groupBy("doc_id", "terms").agg(F.first("n_term").alias("n_term"), F.first("held").alias("held"), F.collect_set("row").alias("rows"))
    near = of.join(holders, "doc_id").join(groups, "entities").filter("n_term <= most and held >= n_term * least")
    near = near.select("entities", "terms", "n_entity", "n_term", F.posexplode("rows").alias("nth", "row"))
    joint = near.groupBy("entities", "terms", "n_entity", "n_term").agg(F.count_distinct("row").alias("support"), F.sum((F.col("nth") == 0).cast("long")).alias("both"))
    joint = joint.filter((F.col("support") >= SUPPORT) & unlikely(F.col("support"), F.col("n_entity"), F.col("n_term"), n, tried))
    share = F.log(F.lit(n) * F.col("both") / (F.col("n_entity") * F.greatest("n_term", "both"))) / F.log(F.lit(n) / F.col("n_entity"))
    flagged = table(joint.select("entities", "terms", share.alias("disclosure")).filter(F.col("disclosure") >= GENERALISE), "pii-flagged")
    drop(members, groups, words, often)
    return Disclosure(flagged, sizes.select("entity", "entities"), holders, rare.select("term", "terms"))


def disclosing_terms(docs: DataFrame, found: DataFrame) -> DataFrame:
    """(entity, term, disclosure) of each pair over the lower threshold; as many rows as there are pairs."""
    d = disclosing_groups(docs, found)
    return d.flagged.join(d.entity_groups, "entities").join(d.term_groups, "terms").select("entity", "term", "disclosure")


def term_spans(docs: DataFrame, found: DataFrame) -> DataFrame:
    """(doc_id, row, terms): every place of a disclosing term in the documents of its entity, with its disclosure, by start."""
    d = disclosing_groups(docs, found)
    terms = d.term_groups.join(d.flagged.select("terms").distinct(), "terms")
    bits = docs.sparkSession.sparkContext.broadcast(bitmap(terms, "term"))
    places = arrow_map(_holders(found).select("doc_id", "row", "base", "text"), lambda part, texts: _places(bits.value, part, texts), "doc_id long, row long, term long, start int, stop int")
    # One row for each place, whatever the number of pairs: a document brings its entities, a term those that it discloses.
    held = d.holders.groupBy("doc_id").agg(F.collect_set("entities").alias("held"))
    told = d.flagged.groupBy("terms").agg(F.collect_list(F.struct("disclosure", "entities")).alias("told"))
    hit = places.join(terms.join(told, "terms").select("term", "told"), "term").join(held, "doc_id")
    most = F.array_max(F.filter("told", lambda t: F.array_contains("held", t["entities"])))["disclosure"]
    hit = hit.select("doc_id", "row", "start", "stop", most.alias("disclosure")).filter("disclosure is not null")
    return hit.groupBy("doc_id", "row").agg(F.sort_array(F.collect_set(F.struct("start", "stop", "disclosure"))).alias("terms"))


def personal_data(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, ``base`` spans, and ``terms`` that disclose an entity of the document."""
    found = table(find_entities(docs), "pii-found")
    return found.select("doc_id", "row", "base").join(term_spans(docs, found), ["doc_id", "row"], "left").drop("row")


def listed(spans: F.Column) -> F.Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ",")


def _replaced(text: str, terms: list[dict]) -> str:
    """The text with base spans replaced by their kind, terms by their kind or by nothing."""
    cover = [(a, b, f"<{k.upper()}>") for k, a, b in base_spans(text)]
    for t in terms:
        what = text[t["start"] : t["stop"]]
        cover.append((t["start"], t["stop"], "" if t["disclosure"] >= REMOVE else "<NUMBER>" if what.isdigit() else "<NAME>" if what[:1].isupper() else "<WORD>"))
    out, at = [], 0
    for a, b, to in sorted(cover, key=lambda x: (x[0], -x[1])):
        if a >= at:
            out += [text[at:a], to]
        at = max(at, b)
    return "".join((*out, text[at:]))


def sanitise(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``docs`` with personal data replaced in the text; a null text stays null, other columns stay as they are."""
    slim = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    found = table(find_entities(slim), "pii-found")
    of, row, own = spare(docs, "of"), spare(docs, "row"), spare(docs, "terms")
    terms = table(term_spans(slim, found), "pii-terms").select(F.col("doc_id").alias(of), F.col("row").alias(row), F.col("terms").alias(own))

    @F.arrow_udf("string")
    def clean(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, spans in batches:
            yield pa.array([None if t is None else _replaced(t, s or []) for t, s in zip(texts.to_pylist(), spans.to_pylist(), strict=True)], pa.string())

    joined = docs.join(terms, (docs[id_col].cast("long") == terms[of]) & (row_of(docs[text_col]) == terms[row]), "left")
    return joined.select(*(clean(docs[c].cast("string"), terms[own]).alias(c) if c == text_col else docs[c] for c in docs.columns))
