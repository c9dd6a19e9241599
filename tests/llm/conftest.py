from __future__ import annotations

import pytest
from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("spans", T.StringType()), T.StructField("digest", T.IntegerType()), T.StructField("n_chars", T.LongType())])


@pytest.fixture(scope="session", autouse=True)
def on_workers(spark):
    from __spark_entry__ import ROOT

    spark.sparkContext.environment["PYTHONPATH"] = ROOT


@pytest.fixture(scope="session")
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@pytest.fixture(scope="session")
def frame(spark):
    """Documents of the texts, with columns whose names the operators use inside."""

    def make(texts):
        return spark.createDataFrame([(i, x, "x", 1, None if x is None else len(x)) for i, x in enumerate(texts)], DOCS)

    return make


LONG = " ".join(f"w{i % 977} x{i % 31}" for i in range(40_000))
ODD = [None, "", " \n\t ", "one", "one", "a b c", "a b c", LONG, LONG, "é ñ  ü\n\n日本 語\x85x", "<|endoftext|> it's\r\nI'm", "x" * 3000]


@pytest.fixture(scope="session")
def odd(frame):
    return frame(ODD)


@pytest.fixture(scope="session")
def empty(frame):
    return frame([])
