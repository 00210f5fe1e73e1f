import duckdb
import pytest

from plumbline.llm import mixing

CASES = [({}, 1, 1.0, 2), ({"lang": {"en": 7, "de": 2}, "domain": {"domain0": 3}}, 2, 0.4, 1), ({"source": {"src1": 50}}, 3, 1.5, 3)]


def table(spark):
    rows = [(i, " ".join(["w"] * (i * 7 % 23)), ["en", "de", None][i * i % 3], f"src{i * i % 6}" if i % 11 else None) for i in range(300)]
    rows += [(i, None, "en", "src9") for i in range(300, 305)] + [(7, "w w w", "fr", "src7")] * 3
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")


@pytest.mark.parametrize("weights,seed,share,epochs", CASES)
def test_against_sql(spark, weights, seed, share, epochs):
    df = table(spark)
    got = mixing.mix(df, weights, seed, share, epochs, with_leaf=True).toPandas()
    documents = df.toPandas()  # noqa: F841  DuckDB finds it by name
    want = duckdb.sql(mixing.oracle(weights, seed, share, epochs)).df()
    cols = sorted(got.columns)
    assert sorted(map(str, got[cols].values.tolist())) == sorted(map(str, want[cols].values.tolist()))
    assert mixing.mix(df, weights, seed, share, epochs).count() == len(got)


def test_shortage_goes_to_siblings_first(spark):
    # One leaf of the first language is small: its sibling source makes it up, the other language is left alone.
    rows = [(i, "w " * 10, "en", "src0" if i < 2 else "src4") for i in range(102)] + [(1000 + i, "w " * 10, "de", "src0") for i in range(100)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = mixing.mix(df, {}, 1, 0.5, 1, with_leaf=True).groupBy("lang", "source").sum("n_tokens").collect()
    assert {(r[0], r[1]): r[2] for r in got} == {("en", "src0"): 20, ("en", "src4"): 480, ("de", "src0"): 500}


def test_columns_stay_and_odd_rows_go_through(docs, empty):
    out = mixing.mix(docs, {}, 1, 1.0, 2)
    assert out.columns == docs.columns
    assert mixing.mix(empty, {}, 1).count() == 0 and mixing.mix(empty, {}, 1, with_leaf=True).count() == 0
