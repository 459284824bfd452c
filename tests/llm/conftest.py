import pytest
from pyspark.sql import types as T

#: Documents with columns whose names the operators use themselves.
SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        *[T.StructField(c, T.StringType()) for c in ("size", "score", "key", "id", "n", "_row", "dropped", "taken", "bucket", "line")],
    ]
)


@pytest.fixture(scope="session")
def docs_of(spark):
    """A documents table, with further columns, from (doc_id, text, lang, source) rows."""

    def make(rows, parts=3):
        full = [(i, t, lang, s, len(t) if t is not None else None, *["x"] * 10) for i, t, lang, s in rows]
        return spark.createDataFrame(full, SCHEMA).repartition(parts)

    return make


#: Nulls in every column, empty texts, ties, repeated rows and one long text.
ODD = [
    (1, "the cat sat on the mat and saw the dog", "en", "a"),
    (2, None, "en", "a"),
    (3, "", "en", None),
    (4, "   \n\t ", None, "b"),
    (5, "der hund und die katze sind hier im haus", "de", "b"),
    (5, "der hund und die katze sind hier im haus", "de", "b"),
    (None, "the cat sat on the mat and saw the dog", "en", None),
    (None, None, None, None),
    (7, "12345 67890", "de", "c"),
    (8, "wort " * 30000, "de", "c"),
    (9, "the cat sat on the mat and saw the dog", "en", "a"),
]


@pytest.fixture(scope="session")
def odd(docs_of):
    return docs_of(ODD)


@pytest.fixture(scope="session")
def none(docs_of):
    return docs_of([], 1)
