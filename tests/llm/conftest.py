import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                     T.StructField("n_chars", T.LongType())])
#: Names that the operators use inside.
CLASHES = ("row", "rank", "digest", "tie", "id", "key", "size", "place", "bucket", "position", "positions", "fp",
           "component", "best", "_text", "_source", "ids", "start", "tokens", "hash", "n", "s", "b", "word",
           "whole_text", "leaf", "middle", "Text2")


def frame(spark, rows):
    return spark.createDataFrame([(*r, *[None] * (5 - len(r))) for r in rows], DOCS)


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Nulls in every column, empty and blank texts, a very long text, a long
    one without white space, ties and rows repeated whole."""
    long = " ".join(f"word{i % 977} and, Other{i % 13}" for i in range(15_000))
    unsplit = "abcdefghij" * 7_000
    rows = [(1, "One two three four five six", "en", "a", 27), (2, "one  two three\nfour five six", "en", "a", 28),
            (2, "one  two three\nfour five six", "en", "a", 28), (3, None, "en", "a", 0), (4, "", None, None, None),
            (5, " \t\n ", "de", "b", 4), (None, "One two three four five six", "en", None, 27), (6, long, "en", "b", len(long)),
            (7, unsplit, "fr", "c", len(unsplit)), (None, None, None, None, None), (8, "a", "en", "c", 1),
            (9, "é ü 漢字 \x1c x", "fr", "c", 11)]
    return frame(spark, rows)


@pytest.fixture(scope="session")
def clash_docs(edge_docs):
    return edge_docs.withColumns({c: F.lit(7) for c in CLASHES})


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def tokenizer():
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")
