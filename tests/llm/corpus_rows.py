import pytest
from pyspark.sql import types as T

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType())])


@pytest.fixture
def documents(spark):
    """Rows of (doc_id, text, lang, source) as documents, with columns that operators use inside."""
    def make(rows, extra=True):
        full = [(*r, *(None,) * (4 - len(r)), len(r[1]) if r[1] is not None else None) for r in rows]
        frame = spark.createDataFrame([(r[0], r[1], r[2], r[3], r[4]) for r in full], DOCS)
        if extra:
            frame = frame.selectExpr("*", "'x' AS _row", "1 AS _sketch", "2 AS _hits", "3 AS _facts",
                                     "4 AS _blob", "5 AS _spans", "6 AS _kept", "7 AS body")
        return frame.repartition(3)

    return make


# Nulls, empty and short texts, ties, repeated rows and keys, and a very long text.
ODD = [
    (1, None, None, None), (2, "", "en", "a"), (3, " \n\t ", "en", "a"), (4, "one", "en", None),
    (4, "one", "en", None), (None, "two words", None, "b"), (None, "two words", None, "b"),
    (5, "ÀÉ ß 日本語 x \U0001F600 \x1c\x85", "fr", "b"),
    (6, "long " * 30_000, "en", "b"), (7, "x" * 50_000, "xx", "b"),
    (8, "password: hunter2hunter2 <|endoftext|> | * $ #", "en", "b"),
]
