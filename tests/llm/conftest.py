import pytest

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, Score double, key string, h long, fp string, batch int"


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Null and empty texts, a very long text, repeated rows, null keys, and
    columns whose names the operators use inside."""
    long = " ".join(f"word{i % 997} the" for i in range(30_000))
    clean = "the cat sat on a mat and looked at the moon while rain fell on the old roof " * 4
    rows = [(1, None, "en", "a"), (2, "", "en", "a"), (3, long, "en", "a"), (4, clean, "en", "a"), (4, clean, "en", "a"),
            (5, clean, None, None), (None, "loose words without a key", "en", None), (6, "12 34 !!", "en", "b"), (7, " \n\t ", "fr", "b"),
            (8, "a", "fr", "b")]
    return spark.createDataFrame([(i, t, la, s, None, 0.5, "k", 1, "f", 2) for i, t, la, s in rows], SCHEMA)


@pytest.fixture(scope="session")
def no_docs(edge_docs):
    return edge_docs.limit(0)


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{SF01}/documents.parquet").cache()


@pytest.fixture(scope="session")
def labels(spark):
    return spark.read.parquet(f"{SF01}/labels.parquet")
