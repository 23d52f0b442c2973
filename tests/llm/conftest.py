import pytest
from pyspark.sql import types as T

from ledgerlake.session import ship_package

DOC = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                    T.StructField("score", T.DoubleType()), T.StructField("fp", T.StringType()), T.StructField("component_id", T.StringType())])
LONG = ("alpha beta gamma delta " * 4000).strip()
# nulls in every column, empty and very long texts, repeated rows, one id with two texts, clashing column names
ODD_ROWS = [(1, "a quiet morning by the river\nwith some birds", "en", 0.5, "x", "c"), (2, None, None, None, None, None), (3, "", "en", 1.0, "x", "c"), (4, "   \n\t ", "en", 1.0, "x", "c"),
            (5, LONG, "en", 1.0, "x", "c"), (6, "one", "en", 1.0, "x", "c"), (6, "one", "en", 1.0, "x", "c"), (7, "x" * 5000, "en", 1.0, "x", "c"), (None, "no id here at all", "en", 1.0, "x", "c"),
            (None, None, None, None, None, None), (8, "first text of eight words and some more", "en", 2.0, "y", "d"), (8, "second text of eight is different from that", "en", 2.0, "y", "d"),
            (9, "日本語 ▁ é ½ ́ 🙂 <|endoftext|>", "de", 2.0, "y", "d")]


@pytest.fixture(scope="session", autouse=True)
def package(spark):
    ship_package(spark)


@pytest.fixture(scope="session")
def odd_docs(spark):
    return spark.createDataFrame(ODD_ROWS, DOC).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOC)


@pytest.fixture(scope="session")
def labels_schema():
    return "doc_id long, quality int, toxic int"
