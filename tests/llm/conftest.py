import pytest

from pyspark.sql import types as T

#: Columns that clash with names the operators use inside or return.
DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()), T.StructField("_id", T.StringType()),
    T.StructField("score", T.StringType()), T.StructField("kept", T.StringType()), T.StructField("shard", T.StringType())])


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    from tripsmith.llm.common import ship_code
    ship_code(spark)


@pytest.fixture(scope="session")
def make_docs(spark):
    """A documents frame of (doc_id, text) pairs, with clashing extra columns."""
    def make(pairs):
        return spark.createDataFrame(
            [(i, t, None, None, None, "x", "y", "z", "w") for i, t in pairs], DOCS).repartition(3)
    return make
