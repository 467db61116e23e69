import pytest
from pyspark.sql import types as T

DOCUMENTS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])


@pytest.fixture(scope="session")
def documents(spark):
    """A function: rows (doc_id, text) or (doc_id, text, lang) -> a documents table."""

    def make(rows, parts=3):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "s", None if r[1] is None else len(r[1])) for r in rows]
        return spark.createDataFrame(full, DOCUMENTS).repartition(parts)

    return make


#: Nulls, empty and odd texts, repeated rows and ids, a long text.
ODD = [
    (1, None), (2, ""), (3, " \n\t "), (4, "one"), (4, "one"), (4, "two words"), (None, "a null id"), (None, None), (5, "x" * 5000), (6, "word " * 4000), (7, "é日本 \U0001f642‍ a\x1cb\x85c"),
    (8, "a\n\nb\r\nc"), (-9, "negative id"), (2**62, "large id"), (10, "1234567890 " * 30),
]


@pytest.fixture(scope="session")
def odd():
    return ODD
