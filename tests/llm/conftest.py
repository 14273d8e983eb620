import pytest
from pyspark.sql import types as T

DOCS = T.StructType([T.StructField(n, t) for n, t in (("doc_id", T.LongType()), ("text", T.StringType()), ("lang", T.StringType()), ("source", T.StringType()), ("n_chars", T.LongType()))])


@pytest.fixture
def docs(spark):
    """A table of documents from (doc_id, text) or (doc_id, text, lang, source)."""

    def make(*rows, **extra):
        full = [(i, t, *(more or (None, "s")), None if t is None else len(t)) for i, t, *more in rows]
        df = spark.createDataFrame(full, DOCS)
        for name, value in extra.items():
            from pyspark.sql import functions as F

            df = df.withColumn(name, F.lit(value))
        return df

    return make
