import pytest

EDGE = [
    (0, "alpha beta gamma delta epsilon zeta", "en", "s", 1),
    (1, "alpha beta gamma delta epsilon zeta", "en", "s", 1),
    (1, "alpha beta gamma delta epsilon zeta", "en", "s", 1),
    (1, "another text with the same id as the one above", None, None, None),
    (2, None, "en", None, None),
    (3, "", "de", "s", 0),
    (4, " \n\t \n", "de", "s", 5),
    (5, "x", "fr", "s", 1),
    (None, "a row without an id but with words", "fr", "s", 1),
    (6, "12 34 -- ##", None, "s", 1),
    (7, "one\ntwo\nthree\nfour\nfive\n\nsix", "en", "s", 1),
    (8, "zero\none\ntwo\nthree\nfour\n", "en", "s", 1),
    (9, "go " * 200, "en", "s", 600),
    (10, " ".join(f"w{i}" for i in range(30_000)), "en", "s", 1),
    (11, "prefix " + " ".join(f"w{i}" for i in range(100, 180)) + " suffix", "en", "s", 1),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def edge(spark):
    """Nulls, empty and very long texts, ties and repeated rows, with columns whose names operators also use."""
    from pyspark.sql import functions as F

    clashes = ["_id", "_t1", "_t", "row", "score", "piece", "length", "node", "kept", "starts", "sequence_id", "n"]
    return spark.createDataFrame(EDGE, SCHEMA).withColumns({c: F.lit("mine") for c in clashes}).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def docs(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")
