import pytest
from pyspark.sql import types as T

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()), T.StructField("key", T.StringType()),
    T.StructField("score", T.DoubleType()), T.StructField("fp", T.LongType())])


@pytest.fixture
def documents(spark):
    """Documents from (id, text, source); columns whose names operators use inside come along."""
    def make(rows):
        return spark.createDataFrame([(d, t, "en", s, len(t or ""), "k", 0.5, 7) for d, t, s in rows], SCHEMA)
    return make


@pytest.fixture
def odd(documents):
    """Nulls, empty texts, repeated rows, ties and a long text."""
    long = " ".join(f"w{i}" for i in range(30_000))
    return documents([(1, None, None), (2, "", "a"), (3, "one two three four five six", "a"), (3, "one two three four five six", "a"),
                      (None, "one two three four five six", None), (None, None, "b"), (4, long, "b"), (5, "  \n\t ", "b")])
