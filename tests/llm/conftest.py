import pytest
from pyspark.sql import types as T


@pytest.fixture(scope="module")
def docs_of(spark):
    """A documents table from (doc_id, text) pairs, with extra columns of clashing names."""
    schema = T.StructType().add("doc_id", "long").add("text", "string").add("h", "string").add("score", "string") \
        .add("shard", "string").add("items", "string").add("n_lines", "string").add("fp", "string")

    def make(pairs):
        return spark.createDataFrame([(i, t, "x", "x", "x", "x", "x", "x") for i, t in pairs], schema)

    return make


#: Null ids and texts, empty and blank texts, ties, repeated rows, a very long text.
ODD = [(None, None), (None, "a b c d e f g h i j k l m"), (1, None), (2, ""), (2, ""), (3, " \n\t "), (4, "x"), (4, "x"),
       (5, "x"), (6, "word " * 60_000), (7, "word " * 60_000), (8, "\n".join(f"line {i % 50}" for i in range(4000))), (9, "é ü ß ñ İ")]
