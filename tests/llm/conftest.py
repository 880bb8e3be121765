import pytest
from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])

#: Nulls in any column, empty and very long texts, ties, repeated rows.
ODD = [
    (1, None, None, None, None),
    (None, "a text without an id, of more than a few words for all that it is worth here", "en", None, 3),
    (2, "", "en", "s", 0),
    (3, " \t\n ", "en", "s", 4),
    (4, "12345 678 !!!", "en", "s", 13),
    (5, "the same text twice, word for word and line for line in this table of ours", "en", "s", 1),
    (5, "the same text twice, word for word and line for line in this table of ours", "en", "s", 1),
    (6, "the same text twice, word for word and line for line in this table of ours", "en", "t", 1),
    (7, "é ü ▁ 漢字 \u0000 🙂", "de", "s", 9),
    (8, "word " * 30_000, "en", "s", 150_000),
    (9, "x" * 40_000, None, "s", 40_000),
]


@pytest.fixture(scope="session")
def odd(spark):
    """The odd rows, with a further column whose name operators use themselves."""
    from pyspark.sql import functions as F

    return spark.createDataFrame(ODD, DOCS).repartition(3).withColumn("score", F.lit("mine")).withColumn("bucket", F.lit(1))


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def small(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
