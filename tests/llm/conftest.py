import pytest

CLASHING = ["1 AS h", "2 AS pos", "'x' AS spans", "3 AS n_hit", "4 AS fp", "5 AS root", "6 AS node", "'y' AS words", "7 AS features",
            "8 AS score", "9 AS list", "10 AS term", "11 AS row", "12 AS doc", "13 AS leak", "14 AS text_hash"]


@pytest.fixture
def clashing(spark):
    """A DataFrame of the given rows, with extra columns whose names the operators use themselves."""
    return lambda rows, schema: spark.createDataFrame(rows, schema).selectExpr("*", *CLASHING)


@pytest.fixture
def odd_docs(clashing):
    """Null and empty texts, a null id, repeated rows, two texts under one id, a very long text, white space only."""
    return clashing([(1, None), (2, ""), (3, " \n\t "), (None, "some words without an id here"), (4, "twice the same row"), (4, "twice the same row"),
                     (5, "one text"), (5, "another text"), (6, "word " * 30_000), (7, "x" * 60_000), (8, "déjà 語 😀 vu\x00")],
                    "doc_id long, text string")


@pytest.fixture
def no_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string")
