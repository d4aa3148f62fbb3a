import pytest
from pyspark.sql import types as T

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)


@pytest.fixture(scope="session")
def make_docs(spark):
    """A documents table from (doc_id, text) or (doc_id, text, lang, source) tuples, in several partitions."""

    def make(rows, parts=3):
        full = [(r[0], r[1], *(r[2:4] if len(r) > 2 else ("en", "s")), len(r[1] or "")) for r in rows]
        return spark.createDataFrame(full, DOCS).repartition(parts) if full else spark.createDataFrame([], DOCS)

    return make


@pytest.fixture(scope="session")
def stored_docs(make_docs, tmp_path_factory):
    """The same, written as Parquet in a folder like those of the test data; gives the folder."""

    def store(rows, name="documents", df=None):
        folder = str(tmp_path_factory.mktemp("sf"))
        (make_docs(rows) if df is None else df).write.parquet(f"{folder}/{name}.parquet")
        return folder

    return store
