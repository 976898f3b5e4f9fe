import pytest
from pyspark.sql import types as T

SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # names that the operators use themselves
        *(T.StructField(c, T.StringType()) for c in ("row", "score", "h", "key", "node", "size", "words", "host", "taken", "fp", "k1", "clean", "label", "_bad", "_h", "bad", "id")),
    ]
)


@pytest.fixture(scope="session")
def frame(spark):
    """Documents from (doc_id, text, lang, source) with extra columns of clashing names."""

    def make(rows, parts=3):
        full = [(*r, None if r[1] is None else len(r[1]), *["x"] * (len(SCHEMA) - 5)) for r in rows]
        return spark.createDataFrame(full, SCHEMA).repartition(parts)

    return make
