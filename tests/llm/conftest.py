import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                       T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])
# Names that the operators use inside.
CLASHING = ["size", "key", "fp", "root", "component_id", "anchor", "tid", "piece", "length", "wanted", "id", "bands", "target", "n_words", "kept", "part", "nth", "weight", "digest", "words"]


def rows_of(texts, lang="en", source="a"):
    return [(i, t, lang, source, None if t is None else len(t)) for i, t in texts]


@pytest.fixture(scope="session")
def docs_of(spark):
    """documents-shaped frame of (doc_id, text) pairs or of full rows."""
    def make(rows):
        rows = list(rows)
        return spark.createDataFrame(rows if rows and len(rows[0]) == 5 else rows_of(rows), SCHEMA)
    return make


@pytest.fixture(scope="session")
def clashing():
    """The same frame with further columns of names that operators use."""
    return lambda df: df.select("*", *[F.lit(i).alias(c) for i, c in enumerate(CLASHING)])


@pytest.fixture(scope="session")
def prose():
    """prose(seed, words): invented text."""
    syllables = "ta re mi so lu ven dar kel os in an ter bo qui sha pel".split()

    def make(seed, words, line=12):
        r = random.Random(seed)
        w = ["".join(r.choices(syllables, k=r.randint(1, 3))) for _ in range(words)]
        return "\n".join(" ".join(w[i:i + line]) + "." for i in range(0, words, line))
    return make


@pytest.fixture(scope="session")
def odd(docs_of, prose):
    """Nulls in every column, empty and blank texts, a very long text, ties and repeated rows."""
    long_ = prose(1, 30_000)
    rows = [(1, prose(2, 60), "en", "a", 5), (2, None, "en", "a", None), (3, "", None, None, 0), (4, " \n\t ", "fr", "b", 4), (5, long_, "fr", None, len(long_)),
            (6, prose(2, 60), None, "a", 5), (6, prose(2, 60), None, "a", 5), (None, prose(3, 40), "en", "b", 9), (None, None, None, None, None), (9, "é" * 300 + " \x00 日本語", "ja", "c", 310),
            (10, prose(4, 50), "en", "a", 7), (11, "one", "en", "b", 3)]
    return docs_of(rows)
