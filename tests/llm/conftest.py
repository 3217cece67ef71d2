import pytest

DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def document(doc_id, text, source="a", lang="en"):
    return (doc_id, text, lang, source, None if text is None else len(text))


def edge_rows():
    """Nulls in every column, empty, blank and very long texts, ties and repeated rows."""
    long = " ".join(f"w{i % 977}" for i in range(30_000))
    rows = [
        document(1, "one two three four five six seven eight nine ten eleven twelve"),
        document(2, "one two three four five six seven eight nine ten eleven twelve"),
        document(3, None),
        document(4, ""),
        document(5, " \t\n "),
        document(6, "Ünï çødé 漢字   tail\nsecond line\n"),
        document(7, long, None),
        document(8, long + " end", None),
        document(-9, "negative id", "b", None),
        document(None, "no id at all", "b"),
        document(None, None, None, None),
        document(10, "word", "c"),
        document(10, "word", "c"),
        document(11, "word word word word", "c"),
        document(2**62, "far away", "c"),
    ]
    return rows


@pytest.fixture(scope="session")
def edges(spark):
    return spark.createDataFrame(edge_rows(), DOCUMENTS)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], DOCUMENTS)


@pytest.fixture(scope="session")
def clashing(edges):
    """The same rows with columns named like those that operators make."""
    from pyspark.sql import functions as F

    names = ["size", "shard", "salt", "key", "token", "node", "score", "spans", "items", "bucket", "run", "number", "text_key", "drops"]
    return edges.withColumns({name: F.lit("x") for name in names})


@pytest.fixture(scope="session")
def corpus():
    """The smallest table, as (doc_id, text) in order of doc_id."""
    import pyarrow.dataset as ds

    rows = ds.dataset("/root/testdata/sf0.001/documents.parquet").to_table(columns=["doc_id", "text"]).to_pylist()
    return sorted((r["doc_id"], r["text"]) for r in rows)
