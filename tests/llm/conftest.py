import pytest

#: Nulls, empty and short texts, ties, repeated rows, one very long text.
WORDS = "the quick brown fox jumps over the lazy dog while seven wizards mix a potion of rare herbs under pale moon light near old stone bridges".split()


def passage(k: int, n: int) -> str:
    return " ".join(WORDS[(k * 7 + i * (k % 5 + 1) + i * i % (k + 3)) % len(WORDS)] + str((k * 31 + i * 17) % 97) for i in range(n))


ROWS = [
    (0, passage(1, 120), "en", "src0", 1),
    (1, passage(2, 60) + "\n" + passage(1, 120), "en", "src0", 2),
    (2, "", "de", None, 0),
    (3, None, None, "src1", None),
    (4, " \t\n", "fr", "src2", 3),
    (5, "one two", "en", "src0", 7),
    (6, passage(1, 120), "en", "src0", 1),
    (7, passage(1, 119) + " changed", "en", "src3", 1),
    (8, "é ß 漢字 🙂 ▁ mark " * 30, "zz", "src4", 5),
    (9, passage(3, 300) + " " + passage(2, 55), None, "odd", 4),
    (10, "x" * 30000, "en", "src0", 30000),
    (11, " ".join(passage(i, 40) for i in range(400)), "en", "src0", 9),
    (12, "same line here\n" * 60, "en", "src0", 9),
    (None, "no id at all", "en", "src0", 1),
    (6, passage(1, 120), "en", "src0", 1),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs(spark):
    """The rows above, with columns whose names clash with those that the operators make."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame(ROWS, SCHEMA)
    return df.withColumns({c: F.lit("mine") for c in ("score", "anchor", "fp", "key", "bucket", "spans", "base", "kept", "domain", "epoch", "terms", "rep", "signature", "_domain", "_full", "_last", "_epoch", "of", "gone")})


@pytest.fixture(scope="session")
def empty(docs):
    return docs.limit(0)
