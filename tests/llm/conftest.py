import random

import pytest

from contactloom.session import ship_package

#: Names that the operators use inside; tables may have them too.
CLASHING = {"t": "x", "i": 1, "k": 2, "h1": 3, "h2": 4, "n": 5, "p": 0.5, "c": "z", "salt": 7, "kept": False, "length": 9, "spans": "s", "_bucket": 1, "key": 2}


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    ship_package(spark)


@pytest.fixture
def documents(spark):
    """A frame of (doc_id, text) pairs with the columns of documents, and clashing ones if asked."""

    def make(pairs, clash=False):
        rows = [(i, t, "en", "src0", None if t is None else len(t)) for i, t in pairs]
        df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").repartition(3)
        if clash:
            from pyspark.sql import functions as F

            df = df.withColumns({k: F.lit(v) for k, v in CLASHING.items()})
        return df

    return make


@pytest.fixture
def edge_pairs():
    """Null and empty texts, null ids, repeated rows, ties, a very long text."""
    words = random.Random(8)
    long = " ".join(f"w{words.randrange(5000)}" for _ in range(60_000))
    return [(None, None), (None, "null id here"), (1, None), (2, ""), (3, "same text"), (4, "same text"), (5, "again and again"), (5, "again and again"), (6, long), (7, "   \n\t "), (8, "é ▁ ü\u2003wide \x00 nul 😀")]
