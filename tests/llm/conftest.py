import pytest
from pyspark.sql import types as T


@pytest.fixture(scope="session")
def docs_of(spark):
    """A documents table of (id, text) pairs; other columns as in the given table, one of them with a clashing name on request."""
    def make(rows, extra: str | None = None):
        schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                               T.StructField("source", T.StringType())] + ([T.StructField(extra, T.StringType())] if extra else []))
        return spark.createDataFrame([(i, t, "en", f"s{(i or 0) % 3}", *(["clash"] if extra else [])) for i, t in rows], schema)
    return make


@pytest.fixture(scope="session")
def texts_by_id():
    def collect(df, column="text"):
        return {r["doc_id"]: r[column] for r in df.collect()}
    return collect
