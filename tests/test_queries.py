"""Every registered query that has an oracle, against DuckDB on the smallest tables."""

import datetime as dt
import math
import re
from collections import Counter
from decimal import Decimal

import duckdb
import numpy as np
import pyarrow as pa
import pytest

import __spark_entry__ as entry_points
from plumbline.functions import fts

DIR = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    """Values as both engines would give them: whole numbers of any width as int, all else as it is."""
    if isinstance(v, Decimal) and v == v.to_integral_value():
        return int(v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    if isinstance(v, list):
        return tuple(map(plain, v))
    return tuple((k, plain(x)) for k, x in v.items()) if isinstance(v, dict) else v


def rows_of(arrow):
    columns = [[plain(v) for v in arrow.column(c).to_pylist()] for c in sorted(arrow.column_names)]
    return list(zip(*columns, strict=True))


def coarse(v):
    """A key to sort by that small differences between floats don't change."""
    return f"{v:.6g}" if isinstance(v, float) else tuple(map(coarse, v)) if isinstance(v, tuple) else str(v)


def same(a, b):
    """Whole numbers exactly, floats to 1e-9 of their size."""
    if isinstance(a, float) or isinstance(b, float):
        return a is not None and b is not None and math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-12) or a != a and b != b
    if isinstance(a, tuple) and isinstance(b, tuple):
        return len(a) == len(b) and all(map(same, a, b))
    return a == b and isinstance(a, bool) == isinstance(b, bool)


def assert_same(got, want):
    assert len(got) == len(want)
    order = lambda r: (*(coarse(v) for v in r if not isinstance(v, float)), *(coarse(v) for v in r))
    for a, b in zip(sorted(got, key=order), sorted(want, key=order), strict=True):
        assert same(a, b), (a, b)


def test_the_comparison_tells_whole_numbers_apart():
    one, two = (pa.table({"a": pa.array([1704067799, None], pa.int64())}), pa.table({"a": pa.array([1704067800, None], pa.int64())}))
    assert_same(rows_of(one), rows_of(one))
    with pytest.raises(AssertionError):
        assert_same(rows_of(one), rows_of(two))
    assert not same(0.1, 0.1000001) and same(0.1, 0.1 + 1e-12) and not same(1, None) and not same(True, 1)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
@pytest.mark.parametrize("name", sorted(entry_points.oracle_sql()))
def test_query_against_oracle(spark, name, sf):
    con = duckdb.connect()
    con.sql("set timezone = 'UTC'")
    for t in TABLES:
        con.sql(f"create view {t} as select * from '/root/testdata/{sf}/{t}.parquet'")
    got = entry_points.queries()[name](spark, f"/root/testdata/{sf}").toArrow()
    want = con.sql(entry_points.oracle_sql()[name]).to_arrow_table()
    assert sorted(got.column_names) == sorted(want.column_names)
    assert_same(rows_of(got), rows_of(want))


def table(name):
    return duckdb.sql(f"select * from '{DIR}/{name}.parquet'").df()


def stems(text):
    """(stem, place) of the words that are no stop words, place by place."""
    words = re.findall(r"[^\W_]+", text.lower())
    return [(fts.stem(w), i) for i, w in enumerate(words) if w not in fts.STOP_WORDS]


def test_full_text_against_a_scan_of_all_places(spark):
    want = set()
    for doc, text in table("documents")[["doc_id", "text"]].itertuples(index=False):
        found = set(stems(text or ""))
        for phrase in ("whom thonan", "stations", "heating"):
            steps = stems(phrase)
            if any(all((s, i + at - steps[0][1]) in found for s, at in steps) for _, i in found):
                want.add(doc)
    got = [r.doc_id for r in entry_points.queries()["full_text_keep"](spark, DIR).collect()]
    assert sorted(got) == sorted(want) and want


def test_keyword_index_against_counts(spark):
    want = Counter((s, doc) for doc, text in table("documents")[["doc_id", "text"]].itertuples(index=False) for s, _ in stems(text or ""))
    got = {(r.lexeme, r.doc_id): r.n for r in entry_points.queries()["keyword_index"](spark, DIR).collect()}
    assert got == dict(want)


def test_buckets_are_of_the_nearest_centre(spark):
    e = table("embeddings").sort_values("vec_id")
    x = np.array(e.embedding.tolist())[:, :32]
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    got = {r.id: r.bucket for r in entry_points.queries()["kmeans_buckets"](spark, DIR).collect()}
    own = np.array([got[i] for i in e.vec_id])
    assert set(got) == set(e.vec_id) and set(own) <= set(range(8))
    centre = np.array([x[own == b].mean(0) for b in sorted(set(own))])
    near = ((x[:, None, :] - centre[None]) ** 2).sum(2)
    place = np.searchsorted(sorted(set(own)), own)
    assert (near.argmin(1) == place).mean() > 0.95  # the last round of means may move a few
    spread = near[np.arange(len(x)), place].sum()
    shuffled = np.random.default_rng(0).permutation(place)
    assert spread < 0.9 * ((x - np.array([x[shuffled == b].mean(0) for b in range(len(centre))])[shuffled]) ** 2).sum()


def test_density_clusters_against_buckets_solved_here(spark):
    """Each bucket of the same k-means by the same rule, named by (bucket, first id)."""
    from plumbline.operators import cluster

    rows = cluster.coarse(spark.read.parquet(f"{DIR}/embeddings.parquet"), dims=32).collect()
    buckets: dict = {}
    for r in sorted(rows, key=lambda r: r.id):
        buckets.setdefault(r.bucket, []).append((r.id, r.v))
    names, want = [], {}
    for b, members in sorted(buckets.items()):
        x = np.array([v for _, v in members], np.float32)
        local = np.zeros(len(x), int) if len(x) < 10 else cluster._density(x, 5)
        for (i, _), label in zip(members, local, strict=True):
            if label >= 0:
                if (b, label) not in names:
                    names.append((b, label))
                want[i] = names.index((b, label))
    got = {r.id: r.cluster_id for r in entry_points.queries()["density_clusters"](spark, DIR).collect()}
    assert got == want


@pytest.mark.parametrize("name", ["lsh_neighbours", "ann_topk", "fold_lsh", "embed_text"])
def test_query_without_oracle_runs(spark, name):
    """What they return is tested in test_operators."""
    assert entry_points.queries()[name](spark, DIR).count() > 0


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0
