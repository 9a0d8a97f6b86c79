import pytest
from pyspark.sql import types as T

DOC = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())])


@pytest.fixture(scope="session")
def make_docs(spark):
    """A documents table; ``clash`` adds columns with the names operators use inside."""
    def make(rows, clash=False):
        df = spark.createDataFrame([(i, t) for i, t in rows], DOC)
        if clash:
            from pyspark.sql import functions as F
            for c in ("id", "size", "n", "key", "start", "end", "rid", "ws", "_id", "_text", "n_words", "tok", "word", "seg", "n_chars", "lang"):
                df = df.withColumn(c, F.lit("x"))
        return df
    return make


#: nulls, empty and blank texts, repeated rows, null ids, one long text
ODD = [(1, None), (2, ""), (3, "  \n\t "), (4, "one word"), (4, "one word"), (None, "no id here"), (None, None), (5, "a" * 30_000),
       (6, "same text again " * 40), (7, "same text again " * 40), (8, "ümläut ß 中文 😀 text line")]


@pytest.fixture(scope="session")
def odd():
    return ODD
