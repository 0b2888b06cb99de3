import pytest
from pyspark.sql import types as T

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("score", T.StringType()),  # clashes with results
        T.StructField("key", T.IntegerType()),
    ]
)

PROSE = "The quiet river bends below the old stone bridge while seven herons watch the morning water rise slowly again"


@pytest.fixture(scope="session")
def odd_rows(spark):
    """Nulls, empty and long texts, repeated rows and ids, ties."""
    rows = [
        (1, PROSE, "en", "a", "x", 1),
        (1, PROSE, "en", "a", "x", 1),
        (2, None, None, None, None, None),
        (3, "", "en", "a", "", 0),
        (None, PROSE + " today", "en", "b", "x", 2),
        (5, "!!! ???", "fr", "b", "x", 3),
        (6, " ".join(f"word{i % 977} filler" for i in range(30_000)), "en", "a", "x", 4),
        (7, "le chat noir dort sous la table pendant que les enfants jouent dans la cour", "fr", "b", "x", 5),
        (8, "le chien court", "fr", None, "x", 5),
    ]
    return spark.createDataFrame(rows, DOCS).repartition(3)


@pytest.fixture(scope="session")
def no_rows(spark):
    return spark.createDataFrame([], DOCS)
