"""Rows of documents for the tests of this folder."""

import pytest
from pyspark.sql import types as T

from spanlake.llm.common import prepare

DATA = "/root/testdata/sf0.01"

DOCUMENTS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)


@pytest.fixture
def docs(spark):
    """Rows of documents from (id, text) pairs."""
    prepare(spark)

    def make(*rows):
        full = [(i, t, "en", "s", None if t is None else len(t)) for i, t in rows]
        return spark.createDataFrame(full, DOCUMENTS)

    return make
