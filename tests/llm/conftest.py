import pytest

from broadsheet.llm.common import documents

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key string, id string, size string, words string"


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and long texts, ties, repeated rows, column names that operators use."""
    long = " ".join(f"w{k % 977}x{k % 1013}" for k in range(30_000)) + " under the MIT license"
    shared = "a passage that is long enough to be shared by several of these documents word for word"
    texts = [
        (1, "Under the MIT License. under the mit license cc by nc"), (2, None), (3, ""), (4, "   \n"), (5, long), (6, long),
        (7, "one two three"), (8, "one two three"), (8, "one two three"), (9, f"x {shared} y"), (10, f"z {shared} q"),
        (None, "no id"), (None, None), (11, "\x00　é한 \U0001f600 under"), (12, "One TWO three"),
    ]
    rows = [(i, t, None if k % 3 else "en", None if k % 4 == 0 else f"s{k % 2}", None, "k", "i", "s", "w") for k, (i, t) in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def sf_docs(spark):
    return documents(spark, "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def texts(odd_docs, sf_docs):
    """(doc_id, text) of both fixtures, for brute force."""
    return tuple([(r.doc_id, r.text or "") for r in d.collect()] for d in (odd_docs, sf_docs))
