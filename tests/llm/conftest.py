import pytest
from pyspark.sql import functions as F

#: Text rows that every operator must take: nulls, empties, ties, repeats, a very long text.
LONG = "the quick brown fox jumps over the lazy dog " * 20_000
TEXTS = [
    (1, "Hello world, this is a test of the packing of words"),
    (2, None),
    (3, ""),
    (4, "   \n\t "),
    (5, "HELLO world, this is a test of the packing of words"),
    (None, "no id here"),
    (7, LONG),
    (8, "Ünï ÇÖDÉ 漢字 😀 İK and ΑΣ"),
    (1, "Hello world, this is a test of the packing of words"),
    (9, "a\x00b\x1cc <|endoftext|> d"),
]


@pytest.fixture()
def edge_docs(spark):
    """The rows with columns whose names clash with the operators' own."""
    df = spark.createDataFrame(TEXTS, "doc_id long, text string")
    for name in ("id", "key", "node", "row", "run", "n", "score", "digest", "ids", "spans", "kept", "bands", "label"):
        df = df.withColumn(name, F.lit(name))
    return df.repartition(3)


@pytest.fixture()
def no_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string, id string")
