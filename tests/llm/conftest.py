import os

import pytest
from pyspark.sql import functions as F

DATA = "/root/testdata"

#: Texts that operators must survive: NULL, empty, blank, repeated, long, and with odd characters.
ODD = [None, "", " \t\n", "one", "One  word\n\nOne  word", "x" * 50_000, "a b " * 20_000, "\\<turn>&é漢😀\x00\r\n", "a b " * 20_000]


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Odd documents with columns that clash with the operators' own names, repeated and NULL ids."""
    rows = [(i, t, None, "s", 7) for i, t in enumerate(ODD)] + [(None, "one more line here", "en", None, None), (3, "one", None, "s", 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    clash = ("hash", "group", "shard", "node", "score", "n_lines", "ids", "path", "_text", "_range", "sequence_id", "label")
    return docs.withColumns({c: F.lit("x") for c in clash})


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)


@pytest.fixture(scope="session")
def small():
    return os.path.join(DATA, "sf0.001")
