import pytest
from pyspark.sql.types import LongType, StringType, StructField, StructType

DOCS = StructType([
    StructField("doc_id", LongType()), StructField("text", StringType()), StructField("lang", StringType()),
    StructField("source", StringType()), StructField("n_chars", LongType()), StructField("key", StringType()),
    StructField("node", StringType()), StructField("size", StringType()),
])


@pytest.fixture(scope="session")
def docs_of(spark):
    """A documents table of (doc_id, text[, lang[, source]]) rows, with extra columns that clash with inner names."""

    def build(*rows):
        full = [(*r, *[None] * (4 - len(r)), None, "k", None, "s") for r in rows]
        return spark.createDataFrame(full, DOCS)

    return build
