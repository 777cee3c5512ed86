import pytest
from pyspark.sql import types as T

#: Columns of ``documents`` and two more, one with a name that operators use themselves.
DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        T.StructField("fp", T.StringType()),
        T.StructField("count", T.LongType()),
    ]
)


@pytest.fixture(scope="session")
def make_docs(spark):
    def make(rows):
        """rows: (doc_id, text) or (doc_id, text, lang)."""
        full = [(r[0], r[1], r[2] if len(r) > 2 else None, None, len(r[1]) if r[1] else None, "x", 1) for r in rows]
        return spark.createDataFrame(full, DOCS)

    return make
