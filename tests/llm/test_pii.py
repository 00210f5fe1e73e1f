import random
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from plumbline.llm import pii
from plumbline.llm.bits import bitmap

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
PART = st.sampled_from(["a", "@", "b.c", "1", "23", ".", "-", "+", " ", "(", ")", "255", "é", "4111111111111111", "x@y.z", "1.2.3.4", "_", "%", "\n", "+1 (386) 555-3733", "0", "٣"])


def brute(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            if kind == "ip" and any(int(x) > 255 for x in m.group().split(".")):
                continue
            if kind == "card":
                doubled = [int(c) * (1 + i % 2) for i, c in enumerate(digits[::-1])]
                if not 13 <= len(digits) <= 19 or sum(n - 9 * (n > 9) for n in doubled) % 10:
                    continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            out.append((kind, *m.span()))
    return out


@settings(max_examples=500, deadline=None)
@given(st.lists(PART, max_size=40).map("".join))
def test_base_spans_are_those_of_the_patterns(text):
    assert pii.base_spans(text) == brute(text)


def test_long_runs_take_linear_time():
    for text in ("a" * 400000, "1" * 400000, "1 " * 200000, "a@" * 200000, "+" * 400000, "a." * 200000 + "@"):
        pii.base_spans(text)


def corpus(spark):
    rows = [(i, f"filler{i} word{i * 3} the mail of Kowalska is anna@k.org and more{i} text{i}") for i in range(6)]
    rows += [(100 + i, f"other document about the thing number {i} the mail of is and more") for i in range(200)]
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_terms_that_disclose_an_entity(spark):
    df = corpus(spark)
    got = {r.doc_id: r for r in pii.personal_data(df).collect()}
    text = dict(df.collect())
    assert {text[i][t.start : t.stop] for i in range(6) for t in got[i].terms} == {"Kowalska"}
    assert all(got[i].terms is None for i in range(100, 300))
    clean = {r.doc_id: r.text for r in pii.sanitise(df).collect()}
    assert clean[0] == "filler0 word0 the mail of  is <EMAIL> and more0 text0"
    assert clean[150] == text[150]


def test_rare_values_are_judged_by_their_classes(spark):
    """No value is seen twice, so none has support alone."""
    rows = [(i, f"filler{i} write to Kowalska at desk{i}.anna{i}@k.org or more{i}") for i in range(6)]
    rows += [(10 + i, f"place{i} machine of Hauptrechner is 10.1.7.{i} and rest{i}") for i in range(6)]
    rows += [(20 + i, f"thing{i} paid by Zahlmeister with 411111{c} then{i}") for i, c in enumerate(("1111111111", "0000000021", "0000000039", "0000000047", "0000000005", "0000000013"))]
    rows += [(30 + i, f"call{i} the Vorzimmer on +1 (386) 555-300{i} before{i}") for i in range(6)]
    rows += [(100 + i, f"other{i} the write to at or machine of is and paid by with then call on before") for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    text, got = dict(rows), {r.doc_id: r.terms for r in pii.personal_data(df).collect()}
    for begin, name in ((0, "Kowalska"), (10, "Hauptrechner"), (20, "Zahlmeister"), (30, "Vorzimmer")):
        for i in range(begin, begin + 6):
            if pii.base_spans(text[i]):
                assert {text[i][t.start : t.stop] for t in got[i]} == {name}
    assert all(got[i] is None for i in range(100, 500))


def test_terms_anywhere_in_the_documents_of_an_entity(spark):
    """Far from the address, again after it, and once more in another document of the entity; not where it isn't held."""
    far = " ".join(["the mail of and more"] * 8)
    rows = [(i, f"é filler{i} Kowalska in{i} {far} anna@k.org {far} kowalska again{i} Kowalska") for i in range(6)]
    rows += [(100 + i, f"é other{i} {far}") for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    text, got = dict(rows), {r.doc_id: r.terms for r in pii.personal_data(df).collect()}
    for i in range(6):
        assert [(t.start, text[i][t.start : t.stop]) for t in got[i]] == [(m.start(), m.group()) for m in re.finditer("(?i)kowalska", text[i])]
    assert all(got[i] is None for i in range(100, 300))
    clean = {r.doc_id: r.text for r in pii.sanitise(df).collect()}
    assert "owalska" not in "".join(clean.values()) and clean[3].startswith("é filler3  in3 the mail")


def test_disclosure_against_brute_force(spark):
    """Random documents, some with values, some copied whole: every pair's disclosure by the formula."""
    from math import log

    rng = random.Random(7)
    values = ["a.b@k.org", "c.d@k.org", "10.1.7.3", "10.1.7.9", "+1 (386) 555-3733"]
    rows = []
    for i in range(300):
        if i % 10 == 0 and rows:
            text = rng.choice(rows)[1]
        else:
            v = rng.choice(values) if rng.random() < 0.2 else ""
            own = [f"near{values.index(v)}"] * (rng.random() < 0.8) if v else []
            text = " ".join([*(f"t{min(int(rng.expovariate(0.05)), 90)}" for _ in range(12)), *own, v])
        rows.append((i, text))
    rows += [(5, "anna t1 near0 a.b@k.org"), (7, "other text of a repeated id near1")]
    held, seen, ids = {}, {}, {d for d, _ in rows}
    for d, t in rows:
        for k, a, b in pii.base_spans(t):
            held.setdefault(d, {}).update((c, i > 0) for i, c in enumerate(pii.classes(k, t[a:b])))
    texts, kept = {}, {}
    for d, t in rows:
        bare = t
        for _, a, b in sorted(pii.base_spans(t), key=lambda x: -x[1]):
            bare = bare[:a] + " " + bare[b:]
        own = set(re.findall(r"[a-z0-9]+", bare.lower()))
        texts.setdefault(d, []).append((t, own))
        kept[d, t] = own
    n, entity, term = len(ids), {}, {}
    for d in ids:
        for c, wide in held.get(d, {}).items():
            entity.setdefault((c, wide), set()).add(d)
    for d, t in rows:
        for x in set(re.findall(r"[a-z0-9]+", t.lower())):
            term[x] = term.get(x, 0) + 1
    pairs = {}
    for (c, _), of in entity.items():
        for x in {x for d in of for t, own in texts[d] if pii.base_spans(t) for x in own}:
            both = {d for d in of for t, own in texts[d] if x in own and pii.base_spans(t)}
            support = {t for d in of for t, own in texts[d] if x in own and pii.base_spans(t)}
            if len(of) >= pii.SUPPORT:
                share = log(n * len(both) / (len(of) * max(term[x], len(both)))) / log(n / len(of))
                pairs[c, x] = len(of), len(both), len(support), share
    # The terms tried: those of two texts with values that could still pass with some entity.
    least = {c: (len(of) / n) ** (1 - pii.GENERALISE) for (c, _), of in entity.items() if len(of) >= pii.SUPPORT}
    most = max(len(of) / least[c] for (c, _), of in entity.items() if c in least)
    rows_with = lambda x: {(d, t) for d, own in texts.items() for t, o in own if x in o and pii.base_spans(t)}
    tried = sum(len({t for _, t in rows_with(x)}) >= pii.SUPPORT and pii.SUPPORT <= term[x] <= most and len(rows_with(x)) >= term[x] * min(least.values()) * (1 - 1e-9) for x in term)
    for (c, x), (n_c, _, support, share) in pairs.items():
        mean = n_c * term[x] / n
        if support >= pii.SUPPORT and support > mean and support * log(support / mean) - support + mean >= log(tried / pii.CHANCE) and share >= pii.GENERALISE:
            seen[c, x] = round(share, 9)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    names = {x: y for y, x in zip([*{c for c, _ in entity}, *term], pii._hash([*{c for c, _ in entity}, *term]).tolist(), strict=True)}
    got = {(names[r.entity], names[r.term]): round(r.disclosure, 9) for r in pii.disclosing_terms(df, pii.find_entities(df)).collect()}
    assert got == seen and seen


def test_rows_of_one_doc_id_keep_their_own_places(spark):
    rows = [(i, f"filler{i} of Kowalska anna@k.org") for i in range(5)] + [(5, "a much longer text says that Kowalska has anna@k.org"), (5, "Kowalska: anna@k.org")]
    rows += [(100 + i, f"other{i} of a much longer text says that has") for i in range(100)]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    assert all("owalska" not in r.text for r in pii.sanitise(df).collect() if r.doc_id == 5)
    assert {r.text for r in pii.sanitise(df).collect() if r.doc_id == 5} == {"a much longer text says that  has <EMAIL>", ": <EMAIL>"}


def test_classes_of_a_value():
    assert pii.classes("email", "Anna.Kowalska+x@K.org") == ["email:anna.kowalska+x@k.org", "name:annakowalska", "domain:k.org", "kind:email"]
    assert pii.classes("ip", "10.1.7.3") == ["ip:10.1.7.3", "network:10.1.7", "kind:ip"]


def test_copies_are_no_evidence(spark):
    rows = [(i, "mail of Kowalska anna@k.org") for i in range(9)] + [(100 + i, f"other {i}") for i in range(50)]
    assert pii.personal_data(spark.createDataFrame(rows, "doc_id long, text string")).filter("terms is not null").count() == 0


def test_bitmap_has_just_the_ends_of_the_hashes(spark):
    import numpy as np

    terms = [0, 1, 5, 32767, 32768, (1 << 24) - 1, -1, -(2**63)]
    bits = np.unpackbits(bitmap(spark.createDataFrame([(t,) for t in terms], "term long"), "term"), bitorder="little")
    assert set(np.flatnonzero(bits).tolist()) == {t & ((1 << 24) - 1) for t in terms}


def test_odd_rows_and_other_columns(docs, empty):
    assert sorted((str(r.doc_id), [tuple(s) for s in r.base]) for r in pii.personal_data(docs).collect()) == sorted((str(r.doc_id), brute(r.text or "")) for r in docs.collect())
    clean = pii.sanitise(docs)
    assert clean.columns == docs.columns and clean.count() == docs.count()
    assert clean.filter("doc_id = 3").first().text is None
    assert pii.personal_data(empty).count() == 0 and pii.sanitise(empty).count() == 0


def directories(n, rest):
    """Three near copies of a list of n names and numbers, and short texts."""
    line = lambda i: f"name{i} +1 555 {i:07d}"
    whole = "\n".join(map(line, range(n)))
    return [(1, whole), (2, whole + " more"), (3, whole + " still"), *((10 + i, f"short text {i} of words") for i in range(rest))]


def test_directories_make_few_pairs(spark):
    """Names and numbers of near copies are groups: pairs don't grow with the product of their numbers."""
    pairs = []
    for n in (20, 400):
        df = spark.createDataFrame(directories(n, 300), "doc_id long, text string")
        found = pii.find_entities(df)
        pairs.append(pii.disclosing_groups(df, found).flagged.count())
        got = {r.doc_id: r for r in pii.personal_data(df).collect()}
        assert all(len(got[d].terms) == n and len(got[d].base) == n for d in (1, 2, 3))
    assert pairs[0] == pairs[1] and pairs[1] < 5
